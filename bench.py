"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the number of local cores.
Each query runs once to warm up and is then timed writing to a no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.registry import QUERIES  # noqa: E402
from paperlake.runtime import build_session  # noqa: E402

HEADLINE = [
    "category_trend", "keyword_trend", "trending_topics", "focus_ratio", "score_topn", "first_rule_match",
    "product_match", "related_papers", "recommendations", "related_all", "ann_topk", "topic_sizes", "topic_pairs",
    "contradiction_pairs", "pick_theme", "nearest_centroid", "cluster_summary", "embed_papers", "upsert_papers",
    "upsert_embeddings", "upsert_index_front", "load_articles", "extract_pages", "parse_paper_xml",
    "flatten_sources", "repair_json", "check_constraints",
]


def run(spark, name: str, sf: str) -> float:
    spark.catalog.clearCache()
    start = time.perf_counter()
    QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", int(cpus), "bench", **{
        "spark.driver.memory": "12g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        run(spark, name, sf)
        times[name] = round(run(spark, name, sf), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
