import re

from checks.compare import connect, spark_rows, sql_rows
from paperlake.llm import line_runs as L
from paperlake.llm import queries as Q

WORD = re.compile(r"[^\x20\x09-\x0D]")


def by_hand(docs, m):
    """Deletes lines covered by runs of ``m`` lines that occur earlier; docs in order."""
    seen, out = set(), {}
    for i, text in docs:
        lines = (text or "").split("\n")
        at = [k for k, line in enumerate(lines) if WORD.search(line)]
        gone = set()
        for j in range(len(at) - m + 1):
            gram = tuple(lines[k] for k in at[j:j + m])
            if gram in seen:
                gone |= set(range(j, j + m))
            seen.add(gram)
        out[i] = (len(at), len(gone), sum(j - 1 not in gone for j in gone), "\n".join(x for k, x in enumerate(lines) if k not in {at[j] for j in gone}))
    return out


def test_equals_brute_force(spark, prose):
    a, b, c, d, e = (prose(i, 6) for i in range(5))
    docs = [(1, "\n".join([a, b, c, d])), (2, "\n".join([e, b, c, d, "", a])), (3, "\n".join([a, b, c, d, a, b, c, d])), (4, "\n".join([a, "", b, " ", c])),
            (5, "\n".join([a] * 9)), (6, a), (7, ""), (8, None), (9, "\n".join([d, c, b, a])), (10, "\n\n"), (11, "\n".join([e, b, e, b, e, b]))]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for m in (1, 2, 3, 4, 5):
        got = {r["doc_id"]: (r["n_lines"], r["n_deleted"], r["n_runs"], r["kept_text"] or "") for r in L.remove_runs(frame, m).collect()}
        assert got == by_hand(docs, m), m


def test_maximal_runs_and_their_sources(spark, prose):
    lines = [prose(i, 5) for i in range(12)]
    docs = [(1, "\n".join(lines[:8])), (2, "\n".join(["x", *lines[2:7], "y", *lines[0:3]]))]
    runs = L.repeated_runs(L.line_table(spark.createDataFrame(docs, "doc_id long, text string")), 3).collect()
    assert sorted((r["doc"], r["pos"], r["n"], r["src_doc"], r["src_pos"]) for r in runs) == [(2, 1, 5, 1, 2), (2, 7, 3, 1, 0)]


def test_odd_documents(spark, odd_documents, no_documents):
    rows = L.remove_runs(odd_documents).collect()
    assert len(rows) == odd_documents.count() and all(r["n_deleted"] == 0 for r in rows)
    assert {r["n_lines"] for r in rows if r["doc_id"] == 5} == {400} and L.remove_runs(no_documents).count() == 0
    assert sum(r["kept_text"] is None for r in rows) == 2


def test_single_lines_go_in_the_query_for_them(spark, tmp_path, prose):
    passage = prose(77, 55)
    docs = [(i, "\n".join([prose(10 * i, 9), passage, prose(10 * i + 1, 9)])) for i in range(1, 5)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: (r["n_deleted"], r["n_runs"]) for r in Q.QUERIES["op6_line_runs_single"](spark, str(tmp_path)).collect()}
    assert got == {1: (0, 0), 2: (1, 1), 3: (1, 1), 4: (1, 1)}


def test_single_lines_equal_their_sql(spark):
    sf = "/root/testdata/sf0.001"
    names, rows = spark_rows(Q.QUERIES["op6_line_runs_single"](spark, sf))
    want_names, want = sql_rows(connect(sf), Q.ORACLES["op6_line_runs_single"])
    assert names == want_names and rows == want
