"""Physical plans of queries that must stay narrow, pruned or pre-limited."""

import io
from contextlib import redirect_stdout

import pytest

from checks import bindings as B
from checks.registry import QUERIES
from paperlake.operators import rules

SF = "/root/testdata/sf0.001"


def plan_of(spark, name):
    out = io.StringIO()
    with redirect_stdout(out):
        QUERIES[name](spark, SF).explain("formatted")
    return out.getvalue()


JOINING = ["append_log", "cluster_summary", "contradiction_pairs", "evidence_candidates", "fallback_recent",
           "first_rule_match", "is_processed", "nearest_centroid", "pick_theme", "recommendations",
           "related_all", "related_papers", "replace_index_rows", "shared_terms", "similar_topk", "topic_pairs",
           "unused_papers", "upsert_embeddings", "upsert_index_front", "upsert_papers"]


@pytest.mark.parametrize("name", JOINING)
def test_no_cross_joins(spark, name):
    plan = plan_of(spark, name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_best_of_groups_are_cut_before_the_shuffle(spark):
    """The query writes this step and takes the overall best from it."""
    papers = B.papers(spark, SF)
    plan = rules.score_topn(papers, B.AS_OF, 3, "category")._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and plan.count("FileScan") == 1


@pytest.mark.parametrize("name", ["upsert_papers", "replace_index_rows", "cluster_summary"])
def test_groups_are_cut_before_the_shuffle(spark, name):
    assert "WindowGroupLimit" in plan_of(spark, name)


@pytest.mark.parametrize("name, parser", [("parse_paper_xml", "from_xml("), ("read_search_index", "from_json(")])
def test_documents_are_parsed_once(spark, name, parser):
    assert plan_of(spark, name).count(parser) == 1


@pytest.mark.parametrize("name", ["repair_json", "extract_pages", "product_match"])
def test_projections_do_not_shuffle(spark, name):
    plan = plan_of(spark, name)
    assert plan.count("Exchange") == plan.count("BroadcastExchange")


@pytest.mark.parametrize("name, absent", [("category_trend", "text"), ("papers_with_embeddings", "text"),
                                          ("category_trend_orders", "o_totalprice"), ("used_ids", "quality")])
def test_columns_are_pruned(spark, name, absent):
    schemas = [line for line in plan_of(spark, name).splitlines() if line.startswith("ReadSchema")]
    assert schemas and not any(absent + ":" in line for line in schemas)


def test_filters_reach_the_files(spark):
    assert "EqualTo(lang,fr)" in plan_of(spark, "papers_by_category")
    assert "EqualTo(toxic,1)" in plan_of(spark, "used_ids")
    assert "o_orderdate" in [line for line in plan_of(spark, "category_trend_orders").splitlines() if "PushedFilters" in line][0]


@pytest.mark.parametrize("name", ["month_key", "slug", "relevance_score", "fill_template"])
def test_scalars_join_nothing(spark, name):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert "Join" not in plan_of(spark, name)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", ["parse_paper_xml", "embed_text", "embed_papers", "focus_ratio"])
def test_texts_are_not_shuffled(spark, name):
    plan = plan_of(spark, name)
    for block in plan.split("\n\n"):
        if "Exchange" in block.split("\n")[0]:
            assert "text#" not in block and "abstract#" not in block
