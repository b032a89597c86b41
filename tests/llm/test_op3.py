import re

import pytest
from pyspark.sql import functions as F

from paperlake.llm import risk_rules as R

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    grams = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    seen = {}
    for g in grams:
        seen[g] = seen.get(g, 0) + 1
    hit = {j for i, g in enumerate(grams) if seen[g] > 1 for j in range(i, i + 8)}
    failed = len(words) < 20 or 100 * len(hit) > 30 * len(words)
    return (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit), failed)


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_counts(spark, prose):
    run = prose(5, 12)
    texts = [prose(1, 50), run + " " + prose(2, 30) + " " + run, (run + "\n") * 4, "a b c d e f g h " * 3, "a " * 30, "x\n\n \nx\ny\nx", "##$$ <b>| %&", None, "",
             " \t ", "\u00a0 \u2003 ß", prose(3, 19), prose(3, 20), "a b c d e f g h", (run + " ") * 2 + prose(8, 200), "q " * 8 + prose(9, 40) + " " + "q " * 9]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: tuple(r[n] for n in NAMES) for r in R.measure(frame, "doc_id").collect()}
    assert got == {i: counts(t) for i, t in enumerate(texts)}


def test_exact_binomial_tail(spark):
    from math import comb

    cases = [(0, 10), (1, 50), (3, 400), (5, 1000), (2, 5), (0, 0)]
    frame = spark.createDataFrame(cases, "k long, n long").select("k", "n", R.binomial_tail(F.col("k"), F.col("n"), 0.02).alias("p"))
    for r in frame.collect():
        want = 1.0 if r["k"] >= 0.02 * r["n"] else sum(comb(r["n"], i) * 0.02 ** i * 0.98 ** (r["n"] - i) for i in range(r["k"] + 1))
        assert r["p"] == pytest.approx(want, rel=1e-9)


def test_cutoffs_keep_their_promise(spark):
    """3000 good documents, a tenth of a percent with symbols; bad ones full of them: certified in en, not in the small stratum."""
    rows = [(i, "en" if i < 3900 else "de", int(i % 4 != 0), 100) for i in range(4000)]
    frame = spark.createDataFrame(rows, "doc_id long, stratum string, quality int, n_words long").withColumn(
        "n_symbols", F.when(F.col("quality") == 0, 40).when(F.col("doc_id") % 1000 == 1, 40).otherwise(1).cast("long")).selectExpr(
        "*", "500L word_chars", "0L n_upper", "5L n_lines", "0L n_dup_lines", "0L n_repeat_words", "false base_failed")
    chosen = {(r["stratum"], r["rule"]): r for r in R.choose_cutoffs(frame, frame.select("doc_id", "quality")).collect()}
    assert set(chosen) == {("en", "symbols")}
    r = chosen["en", "symbols"]
    assert r["cutoff"] == 0.3 and r["good_rejected"] == 4 and r["bad_rejected"] == 975
    judged = R.apply_cutoffs(frame, R.choose_cutoffs(frame, frame.select("doc_id", "quality")))
    assert judged.filter("not kept and quality = 0 and stratum = 'en'").count() == 975
    assert judged.filter("not kept and quality = 1").count() == 4 and judged.filter("not kept and stratum = 'de'").count() == 0


def test_no_python_in_the_plan(spark, odd_documents):
    plan = R.judge(odd_documents, spark.createDataFrame([(1, 1)], "doc_id long, quality int"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_odd_documents(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(1, 1), (None, 1), (5, None), (6, 0), (6, 1)], "doc_id long, quality int")
    got = R.judge(odd_documents, labels).collect()
    texts = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    assert sorted((r["doc_id"] or 0, *(r[n] for n in NAMES)) for r in got) == sorted((i or 0, *counts(t)) for i, t in texts)
    assert all(r["kept"] == (not r["base_failed"]) for r in got)
    kept = R.reject(odd_documents, labels)
    assert kept.columns == odd_documents.columns and kept.count() == sum(not counts(t)[-1] for _, t in texts)
    assert R.judge(no_documents, labels.limit(0)).count() == 0 and R.reject(no_documents, labels).count() == 0
