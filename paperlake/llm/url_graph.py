"""URL filter: rules first, then trust and distrust spread over the link graph of hosts.

Hosts with pages that rules allow are trusted seeds, hosts with pages that
rules block are blocked seeds, each by the number of such pages. Trust follows
the links (a personalised PageRank from the trusted seeds); distrust goes
against them (the same from the blocked seeds on the reversed edges), since
whoever links to a blocked host is suspect and not the one linked to. Domains
are nodes too, whether or not they have pages: a host and its parent domain are
linked both ways, and so are that domain and its own parent, down to names of
two labels, so hosts of one owner meet there. Top-level domains are no nodes. A
host is blocked if its distrust exceeds ``ratio`` times its trust and ``floor`` times
an equal share of all hosts.

Only columns are used. The graph is aggregated to one row per pair of hosts
before anything iterates over it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperlake.runtime import cut_lineage

DAMPING = 0.85
STEPS = 12
STEPS_PER_PLAN = 4
RATIO = 1.0
FLOOR = 0.1
RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/")]

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
# an absolute or protocol-relative address in a link attribute
_LINK = r"""(?i)(?:href|src)\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)"""
_ADDRESS = r"^[0-9.]+(:[0-9]*)?$"
MAX_LABELS = 127
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def host_of(url: Column) -> Column:
    """The part after the first ``://`` up to a slash, question mark, hash or the end, in lower case; else empty."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, _URL, 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """Rule and verdict of the longest rule for the host or a parent domain and the beginning of the path; else null."""
    rule = verdict = F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # the longest ends up outermost
        domain, slash, rest = text.partition("/")
        fits = ((host == domain) | F.endswith(host, F.lit("." + domain))) & F.startswith(path, F.lit(slash + rest))
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def parsed(pages: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    return parts.withColumns({"rule": rule, "verdict": verdict})


def domain_steps(host: Column) -> Column:
    """(src, dst) from a host to its parent domain, from there to the next one, and so on to two labels.

    Addresses of digits have no domains, and neither have hosts of more than
    ``MAX_LABELS`` labels, which no name server can hold.
    """
    labels = F.split(host, r"\.")
    size = F.size(labels)
    named = size.between(3, MAX_LABELS) & ~F.rlike(host, F.lit(_ADDRESS))

    def step(i: Column) -> Column:
        return F.struct(F.array_join(F.slice(labels, i, size), ".").alias("src"),
                        F.array_join(F.slice(labels, i + 1, size), ".").alias("dst"))

    return F.transform(F.when(named, F.sequence(F.lit(1), size - 2)), step)


def host_links(pages: DataFrame) -> DataFrame:
    """(src, dst, n): links between different hosts, and between hosts, their domains and the domains' parents."""
    own = host_of(F.col("url"))
    linked = (pages.select(own.alias("src"), F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit(_LINK), 1))).alias("dst"))
              .select("src", lower_ascii(F.col("dst")).alias("dst")).filter("src <> dst and src <> ''")
              .groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n")))
    hosts = pages.select(own.alias("host")).distinct()
    up = hosts.select(F.inline(domain_steps(F.col("host")))).distinct()
    both = up.unionByName(up.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return (linked.unionByName(both.withColumn("n", F.lit(1).cast("long")))
            .groupBy("src", "dst").agg(F.sum("n").alias("n")))


def _weighted(links: DataFrame) -> DataFrame:
    out = links.groupBy("src").agg(F.sum("n").alias("out"))
    return links.join(out, "src").select("src", "dst", (F.col("n") / F.col("out")).alias("w"))


def spread(links: DataFrame, seeds: DataFrame, damping: float = DAMPING, steps: int = STEPS) -> DataFrame:
    """(kind, host, score) by ``steps`` rounds of a personalised PageRank.

    ``seeds`` has (kind, host, seed) with seeds summing to 1 per kind; kind
    "trust" follows the links, "distrust" the reversed ones. What arrives at a
    host without links leaves the graph.
    """
    back = links.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    edges = cut_lineage(_weighted(links).withColumn("kind", F.lit("trust")).unionByName(
        _weighted(back).withColumn("kind", F.lit("distrust"))), "edges")
    score = seeds.select("kind", "host", F.col("seed").alias("score"))
    for step in range(1, steps + 1):
        moved = (score.withColumnRenamed("host", "src").join(edges, ["kind", "src"])
                 .select("kind", F.col("dst").alias("host"), (F.col("score") * F.col("w") * damping).alias("part")))
        kept = seeds.select("kind", "host", (F.col("seed") * (1 - damping)).alias("part"))
        score = moved.unionByName(kept).groupBy("kind", "host").agg(F.sum("part").alias("score"))
        if step % STEPS_PER_PLAN == 0 or step == steps:
            score = cut_lineage(score, "scores")
    return score


def host_verdicts(pages: DataFrame, rules: list[tuple[str, str]] | None = None, ratio: float = RATIO, floor: float = FLOOR,
                  damping: float = DAMPING, steps: int = STEPS) -> DataFrame:
    """(host, trust, distrust, blocked) of every host of ``pages`` (page_id, url, html)."""
    judged = parsed(pages, rules or RULES).filter("host <> ''")
    hosts = cut_lineage(judged.groupBy("host").agg(F.count_if(F.col("verdict") == "allow").alias("trust"),
                                                   F.count_if(F.col("verdict") == "block").alias("distrust")), "hosts")
    both = hosts.select("host", F.explode(F.create_map(F.lit("trust"), "trust", F.lit("distrust"), "distrust")).alias("kind", "n"))
    totals = both.groupBy("kind").agg(F.sum("n").alias("total"))
    seeds = cut_lineage(both.filter("n > 0").join(F.broadcast(totals), "kind")  # two rows
                        .select("kind", "host", (F.col("n") / F.col("total")).alias("seed")), "seeds")
    scores = spread(host_links(pages), seeds, damping, steps)
    wide = scores.groupBy("host").agg(*(F.coalesce(F.max(F.when(F.col("kind") == k, F.col("score"))), F.lit(0.0)).alias(k)
                                        for k in ("trust", "distrust")))
    count = hosts.agg(F.count(F.lit(1)).alias("hosts"))
    return (hosts.select("host").join(wide, "host", "left").crossJoin(F.broadcast(count))  # one row
            .select("host", F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"), "hosts")
            .withColumn("blocked", (F.col("distrust") > ratio * F.col("trust")) & (F.col("distrust") * F.col("hosts") > floor))
            .drop("hosts"))


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]] | None = None, **kw) -> DataFrame:
    """page_id, host, path, rule and verdict of every row of ``pages`` (page_id, url, html).

    The verdict is the longest matching rule's, else the host's. Urls that are
    null or have no ``://`` have an empty host and path, match no rule and are
    allowed, as is every host that neither trust nor distrust reaches. A null
    html has no links. Rows without page_id and repeated rows are judged like
    all others. Extra columns are ignored.
    """
    rules = rules or RULES
    verdicts = cut_lineage(host_verdicts(pages, rules, **kw).filter("blocked").select("host", "blocked"), "verdicts")
    method = F.when(F.col("blocked"), "block").otherwise("allow")
    return (parsed(pages, rules).join(verdicts, "host", "left")
            .select("page_id", "host", "path", "rule", F.coalesce("verdict", method).alias("verdict")))


def oracle() -> str:
    """The query in DuckDB SQL, one common table expression per step."""
    def fits(text):
        domain, slash, rest = text.partition("/")
        return f"((host = '{domain}' OR ends_with(host, '.{domain}')) AND starts_with(path, '{slash + rest}'))"

    longest_first = sorted(RULES, key=lambda r: -len(r[1]))
    cases = {i: "CASE " + " ".join(f"WHEN {fits(r[1])} THEN '{r[i]}'" for r in longest_first) + " END" for i in (0, 1)}
    url = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    steps = "".join(f""",
s{i} AS (SELECT kind, host, sum(part) AS score FROM (
    SELECT s.kind, e.dst AS host, s.score * e.w * {DAMPING} AS part FROM s{i - 1} s JOIN edges e ON e.kind = s.kind AND e.src = s.host
    UNION ALL SELECT kind, host, seed * {1 - DAMPING} FROM seeds) GROUP BY kind, host)""" for i in range(1, STEPS + 1))
    link = _LINK.replace("'", "''")
    ascii_lower = f"'{_UPPER}', '{_LOWER}'"
    return f"""WITH cut AS (SELECT page_id, html,
    translate(COALESCE(regexp_extract(url, '{url}', 1), ''), {ascii_lower}) AS host,
    COALESCE(regexp_extract(url, '{url}', 2), '') AS path FROM pages),
judged AS (SELECT *, {cases[1]} AS rule, {cases[0]} AS verdict FROM cut),
hosts AS (SELECT host, count(*) FILTER (verdict = 'allow') AS trust, count(*) FILTER (verdict = 'block') AS distrust
    FROM judged WHERE host <> '' GROUP BY host),
seeds AS (SELECT 'trust' AS kind, host, trust / sum(trust) OVER () AS seed FROM hosts WHERE trust > 0
    UNION ALL SELECT 'distrust', host, distrust / sum(distrust) OVER () FROM hosts WHERE distrust > 0),
anchors AS (SELECT host AS src, unnest(list_distinct(regexp_extract_all(html, '{link}', 1))) AS dst FROM cut),
labels AS (SELECT string_split(host, '.') AS l FROM hosts WHERE NOT regexp_matches(host, '{_ADDRESS}')),
parents AS (SELECT DISTINCT array_to_string(l[i:], '.') AS src, array_to_string(l[i + 1:], '.') AS dst
    FROM (SELECT l, unnest(range(1, len(l) - 1)) AS i FROM labels WHERE len(l) BETWEEN 3 AND {MAX_LABELS})),
links AS (SELECT src, dst, count(*) AS n FROM (
    SELECT src, translate(dst, {ascii_lower}) AS dst FROM anchors UNION ALL SELECT src, dst FROM parents
    UNION ALL SELECT dst, src FROM parents) WHERE src <> dst AND src <> '' GROUP BY src, dst),
edges AS (SELECT 'trust' AS kind, src, dst, n / sum(n) OVER (PARTITION BY src) AS w FROM links
    UNION ALL SELECT 'distrust', dst, src, n / sum(n) OVER (PARTITION BY dst) FROM links),
s0 AS (SELECT kind, host, seed AS score FROM seeds){steps},
wide AS (SELECT host, COALESCE(sum(score) FILTER (kind = 'trust'), 0) AS trust,
    COALESCE(sum(score) FILTER (kind = 'distrust'), 0) AS distrust FROM s{STEPS} GROUP BY host),
blocked AS (SELECT host FROM hosts JOIN wide w USING (host)
    WHERE w.distrust > {RATIO} * w.trust AND w.distrust * (SELECT count(*) FROM hosts) > {FLOOR})
SELECT page_id, host, path, rule, COALESCE(verdict, CASE WHEN host IN (SELECT host FROM blocked) THEN 'block' ELSE 'allow' END)
    AS verdict FROM judged"""
