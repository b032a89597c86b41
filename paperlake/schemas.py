"""Table schemas. Lists are arrays inside; JSON text only at the edges."""

from pyspark.sql import types as T

_S, _TS = T.StringType(), T.TimestampType()
_STRINGS = T.ArrayType(_S)

PAPERS = T.StructType([
    T.StructField("pmid", _S, False),
    T.StructField("title", _S, False),
    T.StructField("abstract", _S),
    T.StructField("authors", _STRINGS),
    T.StructField("journal", _S),
    T.StructField("pub_date", T.DateType()),
    T.StructField("doi", _S),
    T.StructField("url", _S),
    T.StructField("mesh_terms", _STRINGS),
    T.StructField("category", _S),
    T.StructField("evidence_level", _S),
    T.StructField("created_at", _TS),
    T.StructField("updated_at", _TS),
])

EMBEDDINGS = T.StructType([
    T.StructField("pmid", _S, False),
    T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("model", _S, False),
    T.StructField("created_at", _TS),
])

GENERATION_LOG = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("week", _S, False),
    T.StructField("theme", _S),
    T.StructField("source_pmids", _STRINGS),
    T.StructField("article_slug", _S),
    T.StructField("created_at", _TS),
])

SOURCES = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("category", _S, False),
    T.StructField("name", _S, False),
    T.StructField("url", _S, False),
    T.StructField("created_at", _TS),
])

SEARCH_INDEX = T.StructType([
    T.StructField("slug", _S, False),
    T.StructField("title", _S, False),
    T.StructField("description", _S),
    T.StructField("category", _S),
    T.StructField("tags", _STRINGS),
    T.StructField("pub_date", T.DateType()),
    T.StructField("url", _S),
])

# One search-index file: articles keep their file order.
INDEX_FILE = T.StructType([
    T.StructField("version", _S),
    T.StructField("generated", _S),
    T.StructField("articles", T.ArrayType(T.StructType([
        T.StructField("slug", _S),
        T.StructField("title", _S),
        T.StructField("category", _S),
        T.StructField("cat_name", _S),
        T.StructField("description", _S),
        T.StructField("date", _S),
        T.StructField("read_time", _S),
        T.StructField("tags", _STRINGS),
        T.StructField("url", _S),
    ]))),
])

GENERATED_COLUMN = T.StructType([
    T.StructField("title", _S),
    T.StructField("lead", _S),
    T.StructField("body_html", _S),
    T.StructField("action_items", _STRINGS),
    T.StructField("source_citation", _S),
    T.StructField("disclaimer", _S),
    T.StructField("affiliate_keywords", _STRINGS),
])
