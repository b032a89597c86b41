import pytest

from paperlake import vocab
from paperlake.functions.jsontext import repair_json

CASES = [
    ('{"title": "a", "action_items": ["x", "y"]}', "clean", "a"),
    ('Sure!\n```json\n{"title": "a"}\n```\n', "clean", "a"),
    ('{\n "title": "a",\n "action_items": ["x",],\n}', "repaired", "a"),
    ('{"title": "two\nlines"}', "repaired", "two\nlines"),
    ('{"title": "tab\there",}', "repaired", "tab\there"),
    ('{"title": "\x01a"}', "clean", "a"),
    ('{"title": "a', "rejected", None),
    ("no json at all", "rejected", None),
    ('{"title": "a", "action_items": "x"}', "clean", "a"),
]


@pytest.mark.parametrize("raw, status, title", CASES)
def test_repair(spark, raw, status, title):
    row = repair_json(spark.createDataFrame([(raw,)], "raw string"), "raw").first()
    assert row["status"] == status
    assert (row["parsed"]["title"] if row["parsed"] else None) == title


def test_default_record(spark):
    row = repair_json(spark.createDataFrame([("oops",)], "raw string"), "raw", default=vocab.ERROR_COLUMN).first()
    assert row["status"] == "default"
    assert row["parsed"]["title"] == vocab.ERROR_COLUMN["title"]
    assert row["parsed"]["action_items"] == vocab.ERROR_COLUMN["action_items"]
