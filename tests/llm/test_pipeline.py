import collections

import corpus_pipeline as C
from paperlake.llm import mixing

from .test_op3 import counts
from .test_op4 import by_hand
from .test_op7 import want

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def write_tables(spark, tmp_path, docs, items, labels):
    base = str(tmp_path / "tables")
    spark.createDataFrame(docs, DOCS).write.parquet(base + "/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(base + "/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(base + "/labels.parquet")
    return base


def test_stages_against_brute_force(spark, tmp_path, prose):
    item = prose(900, 40)
    texts = [prose(i, 30 + i) for i in range(40)]
    texts += [texts[3], texts[5] + " extra", texts[7] + " more words", "too short", None, "", "a b c d e f g h " * 9, prose(1, 20) + " " + item + " " + prose(2, 20)]
    docs = [(i, t, "en", "big" if i % 4 else "small", len(t or "")) for i, t in enumerate(texts)]
    sf = write_tables(spark, tmp_path, docs, [(1, item)], [(i, 1, 0) for i in range(40)])
    frame = spark.read.parquet(sf + "/documents.parquet")
    kept = {i: t for i, t, *_ in docs if not counts(t)[-1]}
    stage = {name: f for name, f in C.STAGES}
    names = list(stage)
    assert names == ["quality_rules", "near_copies", "benchmark_leaks", "source_mixture", "token_file"]
    out = stage["quality_rules"](spark, frame, sf)
    assert {r["doc_id"]: r["text"] for r in out.collect()} == kept and out.columns == frame.columns
    firsts = {c for _, _, c in by_hand(list(kept.items()))}
    out = stage["near_copies"](spark, frame.filter(frame.doc_id.isin(list(kept))), sf)
    assert {r["doc_id"] for r in out.collect()} == firsts and out.columns == frame.columns
    assert len(firsts) == len(kept) - 3
    clean = {i for i in firsts if item not in kept[i]}
    out = stage["benchmark_leaks"](spark, frame.filter(frame.doc_id.isin(list(firsts))), sf)
    assert {r["doc_id"] for r in out.collect()} == clean and out.columns == frame.columns
    left = frame.filter(frame.doc_id.isin(list(clean)))
    out = stage["source_mixture"](spark, left, sf)
    rows = out.collect()
    assert out.columns == frame.columns and len({r["doc_id"] for r in rows}) == len(rows) and {r["doc_id"] for r in rows} <= clean
    plan = mixing.plan_mixture(left, entropy=C.ENTROPY)
    quota = {r["source_key"][1:]: r["weight"] * plan.budget for r in plan.sources.collect()}
    used, have = collections.Counter(), collections.Counter()
    for r in rows:
        used[r["source"]] += len(r["text"].split())
    for i in clean:
        have[docs[i][3]] += len(docs[i][1].split())
    assert used["small"] == have["small"] and quota["big"] - 80 < used["big"] <= quota["big"] < have["big"]
    final = sorted(map(tuple, C.run(spark, sf).collect()))
    assert final == want(sorted((r["doc_id"], r["text"]) for r in rows))


def test_empty_tables(spark, tmp_path):
    sf = write_tables(spark, tmp_path, [], [], [])
    assert C.run(spark, sf).count() == 0
