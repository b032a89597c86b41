"""Repeated runs of lines, by a suffix array over line ids.

The lines of a text that hold a word are a sequence of ids; a suffix is the
position of a line. Prefix doubling names all suffixes by their first
1, 2, 4, ... lines, up to the depth of interest: the name of 2k lines is made of the names of k lines here
and k lines further on. A suffix whose name occurs once is in its final place
and drops out, so the tables shrink to the repeated runs. Suffixes of one name
are an interval of the suffix array whose common prefix is at least that long.

Within an interval of common prefix ``min_lines`` the earliest position is the
one to keep; the lines that the others cover are deleted. Longer runs cover the
same lines, as each of their suffixes shares ``min_lines`` lines too: chains
of neighbouring suffixes whose earliest occurrences are neighbours give the
maximal repeated runs.

Intervals are aggregated to a count and a minimum by name, so that a line that
a third of all documents share is never gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperlake.runtime import cut_lineage

from . import bitmaps
from .columns import has_word, let

MIN_LINES = 2
_NO_ID = -(1 << 63)


def with_row_keys(docs: DataFrame) -> DataFrame:
    """``_doc`` and ``_h`` tell rows apart by doc_id and text; rows without doc_id come first."""
    return docs.withColumns({"_doc": F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)),
                             "_h": F.xxhash64(F.coalesce("text", F.lit("")))})


def line_table(docs: DataFrame) -> DataFrame:
    """(doc, h, pos, line, name): lines with a word, numbered by ``pos``; ``line`` is the number among all lines."""
    rows = with_row_keys(docs).filter("text is not null").select(F.col("_doc").alias("doc"), F.col("_h").alias("h"), "text")
    split = F.transform(F.split("text", "\n"), lambda line, i: F.struct(
        i.alias("line"), F.xxhash64(line).alias("name"), has_word(line).alias("full")))
    kept = F.filter(split, lambda s: s["full"])
    lines = rows.select("doc", "h", F.posexplode(kept).alias("pos", "s")).select("doc", "h", "pos", "s.line", "s.name")
    # equal rows are one place; their lines are narrower than their texts
    return lines.dropDuplicates(["doc", "h", "pos"])


def _intervals(named: DataFrame) -> DataFrame:
    """Positions whose name occurs more than once, with ``first``, the earliest of them."""
    groups = named.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc", "h", "pos")).alias("first"))
    return cut_lineage(named.join(groups.filter("n > 1").drop("n"), "name"), "interval")


def _joined(here: DataFrame, ahead: DataFrame, step: int) -> DataFrame:
    """Names of the runs made of the run of ``step`` lines here and the run of ``ahead`` that follows it."""
    nxt = ahead.select("doc", "h", (F.col("pos") - step).alias("pos"), F.col("name").alias("next"))
    return here.select("doc", "h", "pos", "name").join(nxt, ["doc", "h", "pos"]).select(
        "doc", "h", "pos", F.xxhash64("name", "next", F.lit(step)).alias("name"))


def repeated_suffixes(lines: DataFrame, depth: int) -> DataFrame:
    """(doc, h, pos, name, first): suffixes that share their first ``depth`` lines with another one.

    Doubles the compared length, and joins the powers of two that make up
    ``depth``. After each step only suffixes that still tie go on.
    """
    power, size = _intervals(lines.select("doc", "h", "pos", "name")), 1
    found = held = None
    while True:
        if depth & size:
            found, held = (power, size) if found is None else (_intervals(_joined(found, power, held)), held + size)
        if 2 * size > depth:
            return found
        power, size = _intervals(_joined(power, power, size)), 2 * size


def repeated_runs(lines: DataFrame, min_lines: int = MIN_LINES) -> DataFrame:
    """Maximal runs with an earlier occurrence: (doc, h, pos, n, src_doc, src_h, src_pos).

    Neighbouring suffixes whose earliest occurrences are neighbours too belong
    to one run; its interval is bounded by ``min_lines`` from below.
    """
    later = repeated_suffixes(lines, min_lines).filter(F.struct("doc", "h", "pos") > F.col("first"))
    order = Window.partitionBy("doc", "h").orderBy("pos")
    new = ((F.lag("pos").over(order) == F.col("pos") - 1) & (F.lag("first.doc").over(order) == F.col("first.doc"))
           & (F.lag("first.h").over(order) == F.col("first.h")) & (F.lag("first.pos").over(order) == F.col("first.pos") - 1))
    marked = later.withColumn("run", F.when(F.coalesce(new, F.lit(False)), 0).otherwise(1))
    return (marked.withColumn("run", F.sum("run").over(order)).groupBy("doc", "h", "run")
            .agg(F.min("pos").alias("pos"), (F.count(F.lit(1)) + (min_lines - 1)).cast("int").alias("n"), F.min("first").alias("src"))
            .select("doc", "h", "pos", "n", F.col("src.doc").alias("src_doc"), F.col("src.h").alias("src_h"), F.col("src.pos").alias("src_pos")))


def remove_runs(docs: DataFrame, min_lines: int = MIN_LINES) -> DataFrame:
    """doc_id, n_lines, n_deleted, n_runs, longest and kept_text for every row of ``docs`` (doc_id, text).

    ``n_lines`` counts lines with a word; lines without one are not compared
    and stay. ``n_runs`` counts the deleted stretches, ``longest`` is the
    longest run found. Positions are ordered by doc_id, then text hash, then
    line; the earliest occurrence of a run stays, in the same text too. Rows
    equal in doc_id and text are one place and treated alike. Rows without
    doc_id come first. A null text stays null with no lines. Extra columns are
    ignored.
    """
    lines = line_table(docs)
    runs = repeated_runs(lines, min_lines).groupBy("doc", "h").agg(
        F.collect_list(F.struct("pos", "n")).alias("runs"), F.max("n").alias("longest"))
    # only texts with a run are shuffled
    rows = bitmaps.meet(with_row_keys(docs.select("doc_id", "text")).withColumnsRenamed({"_doc": "doc", "_h": "h"}),
                        cut_lineage(runs, "runs"), ["doc", "h"])
    body = F.split("text", "\n")
    places = F.array_compact(F.transform(body, lambda x, i: F.when(has_word(x), i)))
    covered = F.flatten(F.transform("runs", lambda r: F.sequence(r["pos"], r["pos"] + r["n"] - 1)))
    gone = let(F.array_sort(F.array_distinct(covered)), lambda g: F.struct(
        g.alias("at"), F.size(F.filter(F.transform(g, lambda p, i: (i == 0) | (F.get(g, i - 1) != p - 1)), lambda s: s)).alias("runs")))
    counted = rows.select("doc_id", "text", "longest", F.when(F.col("runs").isNotNull(), gone).alias("gone"), places.alias("places"))
    dropped = let(F.col("places"), lambda ps: F.transform("gone.at", lambda p: F.get(ps, p)))
    kept = let(body, lambda ls: let(F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), dropped),
                                    lambda ps: F.transform(ps, lambda p: F.get(ls, p))))
    return counted.select(
        "doc_id", F.coalesce(F.size("places"), F.lit(0)).cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone.at")).cast("long").alias("n_deleted"),
        F.coalesce("gone.runs", F.lit(0)).cast("long").alias("n_runs"),
        F.coalesce("longest", F.lit(0)).alias("longest"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("kept_text"))


def oracle(min_lines: int = MIN_LINES) -> str:
    """The query in DuckDB SQL, from runs of ``min_lines`` lines joined as text."""
    ahead = " || chr(10) || ".join(["line"] + [f"lead(line, {k}) OVER w" for k in range(1, min_lines)])
    return f"""WITH cut AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
    unnest(range(len(string_split(text, chr(10))))) AS place FROM documents WHERE text IS NOT NULL),
lines AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY place) AS pos FROM cut
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
grams AS (SELECT doc_id, pos, {ahead} AS gram FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
later AS (SELECT doc_id, pos FROM grams WHERE gram IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY gram ORDER BY doc_id, pos) > 1),
gone AS (SELECT DISTINCT doc_id, pos + k AS pos FROM later, range({min_lines}) t(k)),
runs AS (SELECT doc_id, count(*) AS n_deleted, count(*) FILTER (before IS NULL OR before <> pos - 1) AS n_runs FROM
    (SELECT *, lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS before FROM gone) GROUP BY doc_id),
kept AS (SELECT c.doc_id, string_agg(c.line, chr(10) ORDER BY c.place) AS body FROM cut c
    LEFT JOIN lines l ON l.doc_id = c.doc_id AND l.place = c.place LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.pos = l.pos
    WHERE g.pos IS NULL GROUP BY c.doc_id)
SELECT d.doc_id, COALESCE(n.n, 0) AS n_lines, COALESCE(r.n_deleted, 0) AS n_deleted, COALESCE(r.n_runs, 0) AS n_runs,
    md5(COALESCE(k.body, '')) AS kept_md5 FROM documents d
LEFT JOIN (SELECT doc_id, count(*) AS n FROM lines GROUP BY doc_id) n USING (doc_id)
LEFT JOIN runs r USING (doc_id) LEFT JOIN kept k USING (doc_id)"""
