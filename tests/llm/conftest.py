import random

import pytest
from pyspark.sql import functions as F

WORDS = ("the of and to in is that for with on as was at by this from are or an be river stone light cloud green table winter "
         "summer north south under over again never always small large quick slow bright dark").split()
# names that operators use for their own columns
CLASHING = ("n long, name string, key long, h int, pos int, stratum string, kept boolean, set_id long, component_id long, "
            "place long, source_key string, _row string, _doc long, _h long, n_words long, host string, runs int")


@pytest.fixture(scope="session")
def prose():
    def make(seed, n):
        rng = random.Random(seed)
        out = []
        for i in range(n):
            out.append(rng.choice(WORDS) + str(rng.randrange(50)) * (rng.random() < 0.3))
        return " ".join(out)

    return make


@pytest.fixture(scope="session")
def odd_documents(spark, prose):
    """Nulls in every column, empty and blank texts, a very long one, copies, repeated rows, clashing columns."""
    long = "\n".join(prose(i, 40) for i in range(400))
    rows = [(1, prose(1, 60), "en", "a"), (2, None, "en", "a"), (3, "", "en", None), (4, " \t\n ", None, "a"), (5, long, "en", "b"),
            (6, prose(1, 60), "en", "b"), (7, "word", "de", "b"), (7, "word", "de", "b"), (None, prose(1, 60), "en", "a"),
            (None, None, None, None), (8, "ünïcödé ßtraße 漢字 " * 30, "de", None), (9, prose(9, 30), "xx", "a"), (9, prose(10, 30), "xx", "a")]
    frame = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    extra = [c.split(" ") for c in CLASHING.split(", ")]
    return frame.selectExpr("*", *(f"cast(null as {kind}) {name}" for name, kind in extra))


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)


@pytest.fixture(scope="session")
def clashing_texts(spark):
    """Two different texts, one short and one long, with the same 32-bit hash."""
    made = spark.range(300_000).selectExpr("case when id % 2 = 0 then concat('short ', id) else concat('a much longer text ', id, repeat(' and on', 60)) end text")
    pair = made.selectExpr("text", "hash(text) h", "length(text) < 100 short").groupBy("h").agg(
        F.max_by("text", "short").alias("a"), F.min_by("text", "short").alias("b"), F.count_distinct("short").alias("n")).filter("n = 2").first()
    return pair["a"], pair["b"]
