"""Mixing sources by temperature, within a token budget.

The share of a source in all tokens, raised to an exponent between 0 (all
sources alike) and 1 (as they are) and normalised, is its weight. The exponent
is found by bisection, four halvings at a time, so that the mixture has a
target entropy or no source is repeated more often than a limit; every trial
is one aggregate over the table of sources. The weights times the budget are
quotas; a quota is filled by whole passes over the source and the beginning of
one more pass. Every pass is its own keyed permutation of the documents, cut
into blocks: sums over blocks find the block in which the budget ends, and
only that block is put in order, so no source is sorted as a whole.

Without a budget the weights are the same powers of the shares, and the budget
is the largest that repeats nothing: the smallest source that counts is whole, a
larger one has the smallest one's tokens times a power of their ratio. Sources far
below an equal share take no part in this and stay whole, and no target takes more than
a given part of the corpus, so a tiny source limits nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperlake.runtime import cut_lineage

SEED = 17
BLOCK_DOCS = 4096
SHORT = 0.01  # of an equal share of the tokens: smaller sources do not count for the target of a mixture without a budget
KEEP = 0.5  # of all tokens: a mixture without a budget has no fewer
_ROUNDS, _CUTS = 6, 16


@dataclass(frozen=True)
class Mixture:
    """The exponent found, the budget in tokens and (source_key, tokens, weight, passes, last_key) per source.

    Without a given budget the weights of sources too small to count are not
    powers of their shares: they are whole.
    """

    exponent: float
    budget: float
    sources: DataFrame


def source_key(source: Column) -> Column:
    """A null source is a source of its own."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def tokens_of(text: Column) -> Column:
    """White-space separated words; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def _key(seed: int, turn: Column, doc_id: Column, text_hash: Column) -> Column:
    """Place of a document in the permutation of one pass."""
    return F.xxhash64(F.lit(seed), turn.cast("long"), doc_id, text_hash)


def _trial(totals: DataFrame, exponents: list[float]) -> dict[float, tuple[float, float, float, int]]:
    """Per exponent: sum of T^a, entropy, largest T^(a-1), sources."""
    grid = totals.filter("tokens > 0").select(F.log("tokens").alias("t"), F.explode(F.array(*map(F.lit, exponents))).alias("a"))
    power = F.exp(F.col("a") * F.col("t"))
    rows = grid.groupBy("a").agg(F.sum(power).alias("s"), F.sum(power * F.col("t")).alias("st"),
                                 F.max(F.exp((F.col("a") - 1) * F.col("t"))).alias("r"), F.count(F.lit(1)).alias("n")).collect()
    import math

    return {x.a: (x.s, math.log(x.s) - x.a * x.st / x.s, x.r, x.n) for x in rows}


def _bisect(trial, flat_enough) -> tuple[float, float]:
    """The ends of the last step between an exponent that is flat enough and one that is not; the same number twice if all are, or none."""
    ends = trial([0.0, 1.0])
    if flat_enough(ends[1.0], 1.0):
        return 1.0, 1.0
    if not flat_enough(ends[0.0], 0.0):
        return 0.0, 0.0
    low, high = 0.0, 1.0  # the condition holds at low exponents
    for _ in range(_ROUNDS):
        steps = [low + (high - low) * i / _CUTS for i in range(_CUTS + 1)]
        held = trial(steps)
        at = max((i for i, a in enumerate(steps) if flat_enough(held[a], a)), default=0)
        low, high = steps[at], steps[min(at + 1, _CUTS)]
    return low, high


def find_exponent(totals: DataFrame, entropy: float | None = None, repeats: float | None = None,
                  budget: float | None = None) -> tuple[float, float]:
    """(exponent, sum of T^exponent).

    ``entropy`` is the target as a share of the largest possible one; with an
    original entropy above it the exponent is 1. ``repeats`` asks for the
    flattest mixture in which ``budget`` tokens repeat no source more often.
    """
    import math

    if (entropy is None) == (repeats is None):
        raise ValueError("give a target entropy or a limit of repetitions")

    def flat_enough(trial, _) -> bool:
        s, h, r, n = trial
        return h >= entropy * math.log(n) - 1e-12 if entropy is not None else budget * r / s > repeats

    if not _trial(totals, [1.0]):
        return 1.0, 0.0
    low, high = _bisect(lambda steps: _trial(totals, steps), flat_enough)
    # on the safe side of the target
    best = low if entropy is not None else high
    return best, _trial(totals, [best])[best][0]


def find_whole_exponent(totals: DataFrame, entropy: float, short: float = SHORT, keep: float = KEEP) -> tuple[float, float, float]:
    """(exponent, tokens of the smallest source that counts, least tokens that count) of the largest mixture without repeats.

    Sources with at least ``short`` of an equal share count: the entropy is
    theirs, and they get the smallest one's tokens times the power of the ratio; all others are
    whole. An exponent that would leave less than ``keep`` of all tokens is raised
    until it does not.
    """
    import math

    n, total = totals.filter("tokens > 0").agg(F.count(F.lit(1)), F.sum("tokens")).first()
    if not n:
        return 1.0, 0.0, 0.0
    bound = short * total / n
    counted = totals.filter((F.col("tokens") > 0) & (F.col("tokens") >= bound))
    least, held = counted.agg(F.min("tokens"), F.sum("tokens")).first()

    def flat_enough(trial, a: float) -> bool:
        s, h, _, n = trial
        return h >= entropy * math.log(n) - 1e-12 or total - held + s * least ** (1 - a) < keep * total

    return _bisect(lambda steps: _trial(counted, steps), flat_enough)[0], float(least), bound


def measured(docs: DataFrame) -> DataFrame:
    return docs.select(source_key(F.col("source")).alias("source_key"), F.col("doc_id"),
                       F.xxhash64("text").alias("text_hash"), tokens_of(F.col("text")).alias("n"))


def plan_mixture(docs: DataFrame, entropy: float | None = None, repeats: float | None = None, budget: float | None = None,
                 seed: int = SEED, block_docs: int = BLOCK_DOCS) -> Mixture:
    """Weights, whole passes and the last permutation key of each source.

    Without a ``budget`` it is the largest that repeats no source more often
    than ``repeats`` (once if not given), which needs a target entropy; small
    sources give all they have and limit no other (see ``find_whole_exponent``).
    Sources without tokens get the weight 0.
    """
    rows = cut_lineage(measured(docs), "tokens")
    totals = cut_lineage(rows.groupBy("source_key").agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("docs")), "sources")
    if budget is None:
        if entropy is None:
            raise ValueError("give a target entropy or a budget")
        exponent, least, bound = find_whole_exponent(totals, entropy)
        power = F.lit(least) * F.pow(F.col("tokens") / F.lit(least or 1.0), F.lit(exponent))
        # at exponent 1 the tokens themselves, without rounding
        one_pass = F.when((F.col("tokens") >= bound) & F.lit(exponent < 1.0), F.least(power, F.col("tokens"))).otherwise(F.col("tokens"))
        quoted = totals.withColumn("quota", F.lit(float(repeats or 1.0)) * one_pass)
        budget = quoted.agg(F.coalesce(F.sum("quota"), F.lit(0.0))).first()[0]
        weighted = quoted.withColumn("weight", F.col("quota") / F.lit(budget or 1.0))
        return _planned(rows, weighted, exponent, budget, seed, block_docs)
    exponent, scale = find_exponent(totals, entropy, repeats if entropy is None else None, budget)
    weight = F.when((F.col("tokens") > 0) & F.lit(scale > 0), F.exp(exponent * F.log(F.greatest("tokens", F.lit(1)))) / (scale or 1.0)).otherwise(0.0)
    weighted = totals.withColumn("weight", weight).withColumn("quota", F.col("weight") * F.lit(float(budget)))
    return _planned(rows, weighted, exponent, budget, seed, block_docs)


def _planned(rows: DataFrame, weighted: DataFrame, exponent: float, budget: float, seed: int, block_docs: int) -> Mixture:
    """Passes and last keys for the quotas of ``weighted`` (source_key, tokens, docs, weight, quota)."""
    quota = F.col("quota")
    # a hair of tolerance, so that a quota of exactly one pass is one
    passes = F.when(F.col("tokens") > 0, F.floor(quota / F.col("tokens") + 1e-9)).otherwise(0).cast("long")
    planned = cut_lineage(weighted.withColumn("passes", passes).withColumn(
        "rest", F.greatest(quota - F.col("passes") * F.col("tokens"), F.lit(0.0))).drop("quota"), "quotas")

    bits = F.least(F.lit(40), F.ceil(F.log2(F.greatest(F.col("docs") / block_docs, F.lit(1.0))))).cast("int")
    spread = (rows.join(planned.select("source_key", "passes", "rest", bits.alias("bits")).filter("rest > 0"), "source_key")
              .withColumn("key", _key(seed, F.col("passes"), F.col("doc_id"), F.col("text_hash"))))
    # the high bits of the key, shifted to follow its signed order
    half = F.pow(F.lit(2.0), F.col("bits") - 1)
    spread = spread.withColumn("block", F.floor(F.col("key") / F.pow(F.lit(2.0), 64 - F.col("bits")) + half).cast("long"))
    blocks = spread.groupBy("source_key", "block").agg(F.sum("n").alias("n"), F.max("key").alias("top"), F.first("rest").alias("rest"))
    ahead = Window.partitionBy("source_key").orderBy("block")
    blocks = cut_lineage(blocks.withColumn("upto", F.sum("n").over(ahead)), "blocks")
    full = blocks.filter("upto <= rest").groupBy("source_key").agg(F.max("top").alias("last_key"))
    ending = (blocks.filter("upto > rest").groupBy("source_key").agg(F.min("block").alias("block"),
                                                                    F.min_by(F.col("upto") - F.col("n"), "block").alias("before")))
    inside = Window.partitionBy("source_key").orderBy("key")
    partial = (spread.join(ending, ["source_key", "block"]).withColumn("upto", F.col("before") + F.sum("n").over(inside))
               .filter("upto <= rest").groupBy("source_key").agg(F.max("key").alias("last_key")))
    last = full.unionByName(partial).groupBy("source_key").agg(F.max("last_key").alias("last_key"))
    sources = planned.join(last, "source_key", "left").select("source_key", "tokens", "weight", "passes", "last_key")
    return Mixture(exponent, float(budget), cut_lineage(sources, "mixture"))


def draw(docs: DataFrame, mixture: Mixture, seed: int = SEED) -> DataFrame:
    """The rows of ``docs`` as often as the mixture has them, with ``pass`` and ``place``.

    ``place`` orders the documents of a pass of a source: reading by (pass,
    place) is the permutation. The texts are not shuffled; the table of
    sources is joined by broadcast as long as Spark finds it small.
    Rows with equal doc_id and text share one place and are drawn together.
    """
    row = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), source_key(F.col("source")).alias("source_key"),
                      F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_h"))
    turns = row.join(mixture.sources.select("source_key", "passes", "last_key"), "source_key").withColumn(
        "pass", F.explode(F.sequence(F.lit(0).cast("long"), F.col("passes"))))
    placed = turns.withColumn("place", _key(seed, F.col("pass"), F.col("_id"), F.col("_h")))
    return placed.filter((F.col("pass") < F.col("passes")) | (F.col("place") <= F.col("last_key"))).select("_row", "pass", "place")


def mix(docs: DataFrame, **kw) -> DataFrame:
    """doc_id, source, pass, place and n_tokens of every drawn document.

    A null text has no tokens; a null source is a source of its own; rows
    without doc_id are placed by their text. Documents without tokens come
    with every whole pass. An empty table gives no rows. Extra columns are
    ignored.
    """
    return draw(docs, plan_mixture(docs, **kw)).select(
        F.col("_row.doc_id").alias("doc_id"), F.col("_row.source").alias("source"), "pass", "place",
        tokens_of(F.col("_row.text")).alias("n_tokens"))


def thin(docs: DataFrame, **kw) -> DataFrame:
    """The rows of ``docs`` drawn by a mixture, with their columns; a row drawn in several passes is there as often."""
    return draw(docs, plan_mixture(docs, **kw)).select("_row.*")
