"""Rule tables applied row by row: first match, products, labels, scores.

A rule table is a list with an order. It goes into the plan as one literal
array, whatever its length, so every operator here is a projection: nothing is
joined, grouped or shuffled. The ``_many`` forms take the list as an automaton
in the tasks instead.
"""

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperlake import kernels, vocab
from paperlake.functions import text as T
from paperlake.runtime import cut_lineage


def rule_array(rows, *names: str) -> Column:
    """Tuples of strings as one literal array of structs."""
    text = json.dumps([dict(zip(names, row)) for row in rows], ensure_ascii=False)
    return F.from_json(F.lit(text), "array<struct<" + ",".join(f"{n}:string" for n in names) + ">>")


def first_rule_match(tags: Column, rules=tuple(vocab.TAG_RULES), default: str = vocab.DEFAULT_CATEGORY) -> Column:
    """Category of the first tag holding any rule key; inside a tag the first rule wins."""
    table = rule_array(rules, "key", "category")

    def category_of(tag: Column) -> Column:
        return F.get(F.filter(table, lambda r: F.contains(F.lower(tag), r["key"])), F.lit(0))["category"]

    matched = F.filter(F.transform(tags, category_of), lambda c: c.isNotNull())
    return F.coalesce(F.get(matched, F.lit(0)), F.lit(default))


def product_match(df: DataFrame, keywords: str, products: list[tuple[str, str]]) -> DataFrame:
    """One row per product key found in a keyword list.

    ``products`` holds (key, first product of that key) in order. Keywords are
    taken in order, each key is used once, at the first keyword that holds it.
    Adds ``rank``, ``product_key`` and ``product``.
    """
    def hit(rule: Column, place: Column) -> Column:
        first = F.array_position(F.transform(keywords, lambda w: F.contains(F.lower(w), rule["key"])), F.lit(True))
        return F.struct(first.alias("word_pos"), place.alias("key_pos"), rule["key"].alias("product_key"),
                        rule["product"].alias("product"))

    hits = F.transform(rule_array(products, "key", "product"), hit)
    ordered = F.array_sort(F.filter(hits, lambda h: h["word_pos"] > 0))
    return (df.select("*", F.posexplode(ordered).alias("_pos", "_hit"))
            .select(*df.columns, (F.col("_pos") + 1).alias("rank"), "_hit.product_key", "_hit.product"))


def first_rule_match_many(tags: Column, rules, default: str = vocab.DEFAULT_CATEGORY) -> Column:
    """:func:`first_rule_match` for thousands of rules: the distinct tags of a batch go through one automaton.

    The time does not grow with the number of rules. Null tags match nothing,
    a null list gives the default.
    """
    match = kernels.first_rules([r[0] for r in rules], [r[1] for r in rules], default)

    def run(lists: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from match(lists)

    return F.arrow_udf(run, "string")(F.transform(tags, F.lower))


def product_match_many(df: DataFrame, keywords: str, products: list[tuple[str, str]]) -> DataFrame:
    """:func:`product_match` for thousands of products, by the same automaton."""
    match = kernels.keys_in_order([p[0] for p in products])

    def run(lists: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from match(lists)

    found = F.arrow_udf(run, "array<int>")(F.transform(keywords, F.lower))
    rule = F.get(rule_array(products, "key", "product"), F.col("_key"))
    return (df.select("*", F.posexplode(found).alias("_pos", "_key")).withColumn("_rule", rule)
            .select(*df.columns, (F.col("_pos") + 1).alias("rank"), F.col("_rule.key").alias("product_key"), "_rule.product"))


def category_label(category: Column, labels=tuple(vocab.CATEGORY_LABELS), default=vocab.DEFAULT_LABEL):
    """Display name and icon of a category code, as two Columns."""
    def lookup(position: int) -> Column:
        table = F.map_from_entries(rule_array([(row[0], row[position]) for row in labels], "code", "value"))
        return F.coalesce(F.try_element_at(table, category), F.lit(default[position - 1]))

    return lookup(1), lookup(2)


def with_score(papers: DataFrame, as_of, date_col: str = "pub_date", **vocabulary) -> DataFrame:
    """Add ``score`` by the relevance rules."""
    return papers.withColumn("score", T.relevance_score(T.text_of(), F.col(date_col), as_of, **vocabulary))


def score_topn_with_groups(papers: DataFrame, as_of, top_n: int, per: str, **vocabulary) -> DataFrame:
    """Best papers overall and of every group, told apart by ``scope``, from one pass over the texts.

    The best overall are among the best of their groups, which are written in between.
    """
    each = score_topn(papers, as_of, top_n, per, **vocabulary).select("pmid", per, "score")
    each = cut_lineage(each, "best-of-groups")
    best = each.orderBy(F.desc("score"), "pmid").limit(top_n)
    return (best.select(F.lit("overall").alias("scope"), "*")
            .unionByName(each.select(F.lit(per).alias("scope"), "*")))


def score_topn(papers: DataFrame, as_of, top_n: int = 3, per: str | None = None, **vocabulary) -> DataFrame:
    """Best papers overall, or of every group of column ``per``; ties by id."""
    scored = with_score(papers, as_of, **vocabulary)
    order = [F.desc("score"), F.col("pmid")]
    if per is None:
        return scored.orderBy(*order).limit(top_n)
    # Spark cuts each group to top_n before the shuffle (window group limit).
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy(per).orderBy(*order)))
    return ranked.filter(F.col("rank") <= top_n)
