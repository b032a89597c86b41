"""JSON text at the edges: list codecs and repair of generated JSON."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperlake import schemas


def encode_list(values: Column) -> Column:
    return F.to_json(F.coalesce(values, F.array().cast("array<string>")))


def decode_list(text: Column) -> Column:
    return F.coalesce(F.from_json(text, "array<string>"), F.array().cast("array<string>"))


def extract_object(text: Column) -> Column:
    """Text without code fences and control characters, cut to its outermost braces."""
    # The fence and control-character patterns.
    for pattern in (r"```json\s*", r"```\s*$", r"^```\s*", r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"):
        text = F.regexp_replace(text, pattern, "")
    body = F.regexp_extract(text, r"(?s)\{.*\}", 0)
    return F.when(body != "", body).otherwise(text)


def mend_json(text: Column) -> Column:
    """Drop trailing commas. Raw line breaks and tabs inside strings are left to
    the reader's ``allowUnquotedControlChars``, which spares the ones between
    tokens."""
    return F.regexp_replace(F.regexp_replace(text, r",\s*\}", "}"), r",\s*\]", "]")


def repair_json(df: DataFrame, text_col: str, schema: T.StructType = schemas.GENERATED_COLUMN,
                default: dict | None = None) -> DataFrame:
    """Add ``parsed`` (struct or NULL) and ``status`` (clean, repaired, default, rejected).

    The text is read as a whole first and the fields are taken from it, so a
    field of another type than the schema's is NULL and spoils no record.
    ``default`` fills records no attempt could read, for instance
    ``vocab.ERROR_COLUMN``; without it they stay NULL and are marked rejected.
    """
    cleaned = extract_object(F.col(text_col))
    tried = df.withColumn("_first", F.try_parse_json(cleaned))
    mended = F.from_json(mend_json(cleaned), "variant", {"mode": "PERMISSIVE", "allowUnquotedControlChars": "true"})
    tried = tried.withColumn("_second", F.when(~_is_object("_first"), mended))

    def pick(source: str) -> Column:
        return F.struct(*(F.try_variant_get(source, f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in schema.fields))

    fallback = (F.from_json(F.lit(_dump(default)), schema) if default is not None
                else F.lit(None).cast(schema))
    first, second = _is_object("_first"), _is_object("_second")
    return (tried
            .withColumn("parsed", F.when(first, pick("_first")).when(second, pick("_second")).otherwise(fallback))
            .withColumn("status", F.when(first, "clean").when(second, "repaired")
                        .otherwise("rejected" if default is None else "default"))
            .drop("_first", "_second"))


def _is_object(name: str) -> Column:
    return F.coalesce(F.startswith(F.schema_of_variant(name), F.lit("OBJECT")), F.lit(False))


def _dump(record: dict) -> str:
    return json.dumps(record, ensure_ascii=False)
