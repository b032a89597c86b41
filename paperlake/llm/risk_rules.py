"""Quality rules whose cutoffs come from labelled documents with a guarantee.

A rule rejects a document whose value is above a cutoff. For every stratum
and rule the cutoffs of a fixed grid are tested from the mildest to the
strictest on the documents labelled good: a cutoff passes if the exact
binomial tail shows a false rejection rate below the rule's share of ``risk``,
and the first failure ends the sequence (fixed-sequence testing, so the grid
itself needs no correction). Strata and rules are corrected by Bonferroni.
With probability ``1 - delta`` no stratum loses more than ``risk`` of its good
documents. Of the cutoffs that pass, the one that rejects most bad documents
beyond the good ones is used, and none if it would reject more good than bad.

Everything is column arithmetic: no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperlake.runtime import cut_lineage

from .columns import BLANK, has_word, let

RISK = 0.02
DELTA = 0.05
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
RUN = 8  # words of a repeated window
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

# name -> (value, cutoffs from the mildest to the strictest)
RULES: dict[str, tuple[str, list[float]]] = {
    "symbols": ("n_symbols / nullif(n_words, 0)", [3.0, 2.0, 1.5, 1.0, 0.7, 0.5, 0.3, 0.2, 0.1, 0.05]),
    "lines": ("n_dup_lines / nullif(n_lines, 0)", [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1]),
    "repeats": ("n_repeat_words / nullif(n_words, 0)", [0.28, 0.25, 0.22, 0.2, 0.18, 0.15, 0.12, 0.1]),
    "capitals": ("n_upper / nullif(word_chars, 0)", [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2]),
}


def _without(text: Column, letters: str) -> Column:
    return F.translate(text, letters, "")


def _repeat_words(words: Column) -> Column:
    """Words inside windows of ``RUN`` words that occur twice or more in the text."""
    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, i: F.when(i == 0, F.lit(RUN)).otherwise(
            F.least(F.lit(RUN), x - F.get(p, i - 1))))
        return F.aggregate(steps, F.lit(0), lambda total, s: total + s)

    def places(pairs: Column) -> Column:
        own = F.transform(pairs, lambda x, i: F.when(
            (x["h"] == F.get(pairs, i - 1)["h"]) | (x["h"] == F.get(pairs, i + 1)["h"]), x["i"]))
        return F.array_sort(F.array_compact(own))

    def count(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
            let(let(pairs, places), covered))

    def hashed(ws: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(ws) - RUN + 1), lambda i: F.xxhash64(F.slice(ws, i, RUN)))

    return let(words, lambda ws: F.when(F.size(ws) <= RUN, F.lit(0)).otherwise(let(hashed(ws), count)))


def measure(docs: DataFrame, *keep: str) -> DataFrame:
    """The counts of every text (null: empty), with the columns named in ``keep``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    trimmed = F.btrim(text, F.lit(BLANK))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[\\x20\\x09-\\x0D]+"))
    lines = F.filter(F.split(text, "\n"), has_word)
    counted = docs.select(
        *keep, F.length(_without(text, BLANK)).cast("long").alias("word_chars"),
        (F.length(text) - F.length(_without(text, SYMBOLS))).cast("long").alias("n_symbols"),
        (F.length(text) - F.length(_without(text, UPPER))).cast("long").alias("n_upper"),
        let(lines, lambda ls: F.struct(F.size(ls).alias("n"), (F.size(ls) - F.size(F.array_distinct(ls))).alias("dup"))).alias("_l"),
        let(words, lambda ws: F.struct(F.size(ws).alias("n"), _repeat_words(ws).alias("rep"))).alias("_w"))
    out = counted.select(
        *keep, F.col("_w.n").cast("long").alias("n_words"), "word_chars", "n_symbols", "n_upper",
        F.col("_l.n").cast("long").alias("n_lines"), F.col("_l.dup").cast("long").alias("n_dup_lines"),
        F.col("_w.rep").cast("long").alias("n_repeat_words"))
    return out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def binomial_tail(k: Column, n: Column, rate: float) -> Column:
    """P(X <= k) for X binomial(n, rate); 1 where k is not below the mean."""
    odds = F.log(F.lit(rate / (1 - rate)))
    start = F.struct((n * F.log(F.lit(1 - rate))).alias("term"), F.exp(n * F.log(F.lit(1 - rate))).alias("sum"))

    def step(s: Column, i: Column) -> Column:
        term = s["term"] + F.log((n - i + 1) / i) + odds
        return F.struct(term.alias("term"), (s["sum"] + F.exp(term)).alias("sum"))

    terms = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.when(k >= n * rate, F.lit(1.0)).otherwise(F.aggregate(terms, start, step)["sum"])


def _rejected(kind: str) -> Column:
    """Documents of one kind that the cutoff at ``place`` rejects."""
    return F.aggregate("seen", F.lit(0).cast("long"),
                       lambda t, s: t + F.when(s["level"] <= F.col("place"), s[kind]).otherwise(0))


def _cutoff(rule: str) -> Column:
    return F.get(F.map_values(F.map_filter("_c", lambda k, v: k == rule)), F.lit(0))


def choose_cutoffs(measured: DataFrame, labels: DataFrame, stratum: str = "stratum", risk: float = RISK,
                   delta: float = DELTA, rules: dict | None = None) -> DataFrame:
    """(stratum, rule, cutoff, good, good_rejected, bad_rejected) of the cutoffs in use.

    ``measured`` has doc_id, the stratum and the counts; ``labels`` has doc_id
    and quality (1 good, 0 bad; the lowest counts where a document has
    several, null labels do not count). Documents that fail the base rules
    are not looked at. A stratum without enough good documents to certify
    any cutoff has no row.
    """
    rules = rules or RULES
    grid = F.array(*(F.struct(F.lit(name).alias("rule"), F.expr(value).alias("value"),
                              F.array(*map(F.lit, cuts)).alias("cuts")) for name, (value, cuts) in rules.items()))
    verdicts = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    known = (measured.filter(~F.col("base_failed")).select("doc_id", stratum, grid.alias("grid")).join(verdicts, "doc_id")
             .select(stratum, "quality", F.explode("grid").alias("r"))
             # cutoffs are descending: a value rejects from position `level` on
             .select(stratum, F.col("r.rule").alias("rule"), (F.col("quality") == 1).alias("good"),
                     F.size(F.filter("r.cuts", lambda c: c >= F.col("r.value"))).alias("level"))
             .groupBy(stratum, "rule", "level").agg(F.count_if("good").alias("g"), F.count_if(~F.col("good")).alias("b")))
    levels = known.groupBy(stratum, "rule").agg(
        F.sum("g").alias("good"), F.collect_list(F.struct("level", "g", "b")).alias("seen"))
    cuts = F.element_at(F.create_map(*(x for name, (_, cs) in rules.items()
                                       for x in (F.lit(name), F.array(*map(F.lit, cs))))), F.col("rule"))
    tested = (levels.select(stratum, "rule", "good", "seen", F.posexplode(cuts).alias("place", "cutoff"))
              .select(stratum, "rule", "good", "place", "cutoff",
                      _rejected("g").alias("good_rejected"), _rejected("b").alias("bad_rejected")))
    strata = tested.select(F.count_distinct(stratum).alias("strata"))
    tested = tested.crossJoin(F.broadcast(strata))  # one row
    rate = risk / len(rules)
    tested = tested.withColumn("passes", binomial_tail(F.col("good_rejected"), F.col("good"), rate)
                               <= delta / (F.col("strata") * len(rules)))
    so_far = Window.partitionBy(stratum, "rule").orderBy("place")
    passed = tested.withColumn("open", F.min("passes").over(so_far)).filter("open")
    best = F.struct(F.col("bad_rejected") - F.col("good_rejected"), -F.col("place"))
    return (passed.groupBy(stratum, "rule").agg(
        F.max_by(F.struct("cutoff", "good", "good_rejected", "bad_rejected"), best).alias("c"))
        .select(stratum, "rule", "c.*").filter("bad_rejected > good_rejected"))


def apply_cutoffs(measured: DataFrame, cutoffs: DataFrame, stratum: str = "stratum", rules: dict | None = None) -> DataFrame:
    """Adds ``kept``. ``cutoffs`` is a short written table, whose size Spark checks before it broadcasts it."""
    rules = rules or RULES
    limits = cutoffs.groupBy(stratum).agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("_c"))
    over = [F.coalesce(F.expr(value) > _cutoff(name), F.lit(False)) for name, (value, _) in rules.items()]
    hit = over[0]
    for o in over[1:]:
        hit = hit | o
    joined = measured.join(cut_lineage(limits, "cutoffs"), stratum, "left")
    # the values divide by counts that are positive once the base rules hold
    return joined.withColumn("kept", F.when(F.col("base_failed"), False).otherwise(~hit)).drop("_c")


def _with_stratum(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.coalesce("lang", F.lit("")).alias("stratum"))


def judge(docs: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, lang): the counts, base_failed and kept.

    Strata are the languages; a null language is a stratum of its own. A null
    text is an empty one and fails the base rules. Rows without doc_id are
    judged and never count as labelled; repeated rows are judged alike.
    Without labels only the base rules reject. Extra columns are ignored.
    """
    measured = cut_lineage(measure(_with_stratum(docs), "doc_id", "stratum"), "measures")
    cutoffs = cut_lineage(choose_cutoffs(measured, labels, risk=risk, delta=delta), "cutoffs")
    return apply_cutoffs(measured, cutoffs)


def reject(docs: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with all their columns.

    The documents are read once to choose the cutoffs and once to be filtered;
    their texts are not shuffled.
    """
    measured = cut_lineage(measure(_with_stratum(docs), "doc_id", "stratum"), "measures")
    cutoffs = cut_lineage(choose_cutoffs(measured, labels, risk=risk, delta=delta), "cutoffs")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    row = docs.select(F.struct(*columns).alias("_row"), F.col("doc_id"), F.col("text"),
                      F.coalesce("lang", F.lit("")).alias("stratum"))
    judged = apply_cutoffs(measure(row, "_row", "stratum"), cutoffs)
    return judged.filter("kept").select("_row.*")


SQL_MEASURE = r"""
words AS (SELECT doc_id, COALESCE(lang, '') AS stratum, COALESCE(text, '') AS text,
    regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (SELECT doc_id, unnest(range(1, len(w) - 6)) AS i,
    unnest(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' '))) AS g FROM words WHERE len(w) >= 8),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1),
covered AS (SELECT doc_id, sum(least(8, i - COALESCE(before, -8))) AS n FROM
    (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM twice) GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT line) AS dup FROM
    (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM words)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
counts AS (SELECT w.doc_id, stratum, CAST(len(w) AS BIGINT) AS n_words,
    CAST(COALESCE(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS BIGINT) AS n_upper,
    CAST(COALESCE(l.n, 0) AS BIGINT) AS n_lines, CAST(COALESCE(l.dup, 0) AS BIGINT) AS n_dup_lines,
    CAST(COALESCE(c.n, 0) AS BIGINT) AS n_repeat_words
    FROM words w LEFT JOIN lines l USING (doc_id) LEFT JOIN covered c USING (doc_id)),
measured AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counts)"""


def _sql_rules() -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS rule, unnest({cuts}) AS cutoff, unnest(range({len(cuts)})) AS place" for name, (_, cuts) in RULES.items())


def oracle() -> str:
    """The query in DuckDB SQL."""
    values = " UNION ALL ".join(
        f"SELECT doc_id, stratum, '{name}' AS rule, CAST({value} AS DOUBLE) AS value FROM measured WHERE NOT base_failed"
        for name, (value, _) in RULES.items())
    rate = RISK / len(RULES)
    return f"""WITH {SQL_MEASURE},
vals AS ({values}), grid AS ({_sql_rules()}),
known AS (SELECT v.*, l.quality = 1 AS good FROM vals v
    JOIN (SELECT doc_id, min(quality) AS quality FROM labels WHERE quality IS NOT NULL GROUP BY doc_id) l USING (doc_id)),
tested AS (SELECT stratum, rule, place, cutoff, count(*) FILTER (good) AS n, count(*) FILTER (good AND value > cutoff) AS k,
    count(*) FILTER (NOT good AND value > cutoff) AS b FROM known JOIN grid USING (rule) GROUP BY ALL),
bounded AS (SELECT *, CASE WHEN k >= n * {rate} THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1), lambda i:
    exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({rate}) + (n - i) * ln(1 - {rate})))) END
    <= {DELTA} / ((SELECT count(DISTINCT stratum) FROM known) * {len(RULES)}) AS passes FROM tested),
opened AS (SELECT *, bool_and(passes) OVER (PARTITION BY stratum, rule ORDER BY place) AS open FROM bounded),
best AS (SELECT stratum, rule, cutoff, b - k AS gain FROM opened WHERE open
    QUALIFY row_number() OVER (PARTITION BY stratum, rule ORDER BY b - k DESC, place) = 1),
hit AS (SELECT DISTINCT doc_id FROM vals JOIN best USING (stratum, rule) WHERE gain > 0 AND value > cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM hit) AS kept FROM measured"""
