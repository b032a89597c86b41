import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from paperlake.runtime import build_session

    session = build_session("local[4]", 4, "tests", **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "6g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_papers(spark):
    """Papers from dicts; absent fields get the table's defaults."""
    import datetime as dt

    from paperlake import schemas

    stamp = dt.datetime(2024, 1, 1)
    defaults = {"title": "", "abstract": "", "authors": [], "mesh_terms": [], "created_at": stamp, "updated_at": stamp}

    def make(rows):
        full = [{**{n: None for n in schemas.PAPERS.fieldNames()}, **defaults, **r} for r in rows]
        return spark.createDataFrame([tuple(r[n] for n in schemas.PAPERS.fieldNames()) for r in full], schemas.PAPERS)

    return make


@pytest.fixture(scope="session")
def make_embeddings(spark):
    import datetime as dt

    from paperlake import schemas

    def make(vectors, model="m"):
        rows = [(k, None if v is None else [float(x) for x in v], model, dt.datetime(2024, 1, 1)) for k, v in vectors.items()]
        return spark.createDataFrame(rows, schemas.EMBEDDINGS)

    return make
