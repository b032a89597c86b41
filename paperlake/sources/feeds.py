"""XML and JSON drops: paper records, nested source lists, search-index files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from paperlake import schemas
from paperlake.operators.numbering import number_by_hash
from paperlake.runtime import cut_lineage

CORRUPT = "_corrupt"

# Markup that may stand inside titles and abstracts. Anything
# else between angle brackets is text ("p < 0.05").
INLINE_TAG = r"</?(?:i|b|u|em|strong|sup|sub|mml:[A-Za-z]+)(?:\s[^<>]*)?/?>"

# The parts of a PubmedArticle element that are read.
PAPER_XML = """
  MedlineCitation STRUCT<
    PMID: STRING,
    Article: STRUCT<
      Journal: STRUCT<Title: STRING, JournalIssue: STRUCT<PubDate: STRUCT<Year: STRING, Month: STRING, Day: STRING>>>,
      ArticleTitle: STRING,
      Abstract: STRUCT<AbstractText: ARRAY<STRING>>>,
    MeshHeadingList: STRUCT<MeshHeading: ARRAY<STRUCT<DescriptorName: STRING>>>>,
  PubmedData STRUCT<ArticleIdList: STRUCT<ArticleId: ARRAY<STRUCT<_VALUE: STRING, _IdType: STRING>>>>,
  _corrupt STRING
"""


def read_paper_xml(spark: SparkSession, path: str) -> DataFrame:
    """Article elements of XML files, one row each; files are split by element."""
    return (spark.read.format("xml").option("rowTag", "PubmedArticle").option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).schema(PAPER_XML).load(path))


def parse_xml_column(df: DataFrame, column: str) -> DataFrame:
    """The same record parsed from a text column holding one article element."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    # behind a generator the parsed value is a column of its own: later filters and fields do not parse again
    parsed = F.explode_outer(F.array(F.from_xml(F.col(column), PAPER_XML, options)))
    return df.select("*", parsed.alias("_a")).select(*df.columns, "_a.*")


def _two_digits(part: Column) -> Column:
    part = F.coalesce(part, F.lit(""))
    return F.when(F.length(part) < 2, F.lpad(part, 2, "0")).otherwise(part)


def parse_paper_xml(rows: DataFrame, url_base: str = "https://pubmed.ncbi.nlm.nih.gov/",
                    all_sections: bool = False, keep: list[str] | None = None) -> DataFrame:
    """Paper records from parsed article elements; see :func:`rejected_papers` for unreadable ones.

    ``pub_date`` also reads months by name; ``raw_pub_date`` is the text the
    recency rule looks at.
    """
    def text(value: Column) -> Column:
        return F.regexp_replace(F.coalesce(value, F.lit("")), INLINE_TAG, "")

    article = F.col("MedlineCitation.Article")
    day = article["Journal"]["JournalIssue"]["PubDate"]
    sections = article["Abstract"]["AbstractText"]
    abstract = F.array_join(sections, "\n") if all_sections else F.get(sections, F.lit(0))
    raw = F.when(F.coalesce(day["Year"], F.lit("")) == "", F.lit("")).otherwise(
        F.concat_ws("-", day["Year"], _two_digits(day["Month"]), _two_digits(day["Day"])))
    ids = F.filter(F.col("PubmedData.ArticleIdList.ArticleId"), lambda i: i["_IdType"] == "doi")
    terms = F.transform(F.col("MedlineCitation.MeshHeadingList.MeshHeading"),
                        lambda m: F.lower(text(m["DescriptorName"])))
    pmid = F.col("MedlineCitation.PMID")
    good = rows.filter(F.col("MedlineCitation").isNotNull() & F.col(CORRUPT).isNull())
    return good.select(
        *(keep or []),
        pmid.alias("pmid"), text(article["ArticleTitle"]).alias("title"), text(abstract).alias("abstract"),
        F.array().cast("array<string>").alias("authors"),
        F.coalesce(article["Journal"]["Title"], F.lit("")).alias("journal"),
        raw.alias("raw_pub_date"),
        F.coalesce(F.try_to_date(raw, "yyyy-MM-dd"), F.try_to_date(raw, "yyyy-MMM-dd")).alias("pub_date"),
        F.coalesce(F.get(ids, F.lit(0))["_VALUE"], F.lit("")).alias("doi"),
        F.concat(F.lit(url_base), pmid, F.lit("/")).alias("url"),
        F.coalesce(F.filter(terms, lambda t: t != ""), F.array().cast("array<string>")).alias("mesh_terms"))


def rejected_papers(rows: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Article elements that :func:`parse_paper_xml` leaves out, as (reason, raw), behind the columns in ``keep``."""
    reason = F.when(F.col(CORRUPT).isNotNull(), "unreadable").when(F.col("MedlineCitation").isNull(), "no citation")
    return rows.select(*(keep or []), reason.alias("reason"), F.col(CORRUPT).alias("raw")).filter(F.col("reason").isNotNull())


def flatten_sources(docs: DataFrame, column: str, doc_key: str) -> DataFrame:
    """(id, category, name, url) from nested JSON documents, ``doc_key`` being unique.

    A category may hold a name-to-link object, a list of objects with ``name``
    and ``url``, or a list of plain names. Ids are dense over all documents.
    """
    spark = docs.sparkSession
    parsed = docs.select(F.col(doc_key).alias("_key_doc"), F.try_parse_json(column).alias("_doc"))
    groups = (parsed.lateralJoin(spark.tvf.variant_explode(F.col("_doc").outer()))
              .select("_key_doc", F.col("key").alias("category"), F.col("value").alias("_items")))
    items = (groups.lateralJoin(spark.tvf.variant_explode(F.col("_items").outer()))
             .select("_key_doc", "category", "pos", F.col("key").alias("_key"), F.col("value").alias("_item")))
    is_object = F.startswith(F.schema_of_variant("_item"), F.lit("OBJECT"))

    def field(path: str) -> Column:
        return F.coalesce(F.try_variant_get("_item", path, "string"), F.lit(""))

    name = (F.when(F.col("_key").isNotNull(), F.col("_key")).when(is_object, field("$.name"))
            .otherwise(field("$")))
    url = (F.when(F.col("_key").isNotNull(), field("$")).when(is_object, field("$.url"))
           .otherwise(F.lit("")))
    rows = items.select("category", name.alias("name"), url.alias("url"),
                        F.concat_ws("|", F.col("_key_doc").cast("string"), "category",
                                    F.col("pos").cast("string")).alias("_entry"))
    # numbering counts and then sorts: the documents are parsed once and the entries written
    return number_by_hash(cut_lineage(rows, "source-entries"), F.col("_entry")).select(
        "id", "category", "name", "url")


def read_search_index(spark: SparkSession, path: str) -> DataFrame:
    """Articles of a JSON index file in file order (``pos``); a missing file gives no rows."""
    try:
        files = spark.read.schema(schemas.INDEX_FILE).option("multiLine", True).json(path)
        return index_articles(files)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return index_articles(spark.createDataFrame([], schemas.INDEX_FILE))


def index_articles(files: DataFrame) -> DataFrame:
    # the outer form keeps Spark from testing the list, and so parsing the text, a second time
    return (files.select(F.posexplode_outer("articles").alias("pos", "_article"))
            .filter(F.col("pos").isNotNull()).select("pos", "_article.*"))


def parse_search_index(docs: DataFrame, column: str) -> DataFrame:
    """The same from a text column holding one index document per row."""
    return index_articles(docs.select(F.from_json(column, schemas.INDEX_FILE).alias("_i")).select("_i.*"))


def index_lines(rows: DataFrame) -> DataFrame:
    """Index rows as JSON lines in ``pos`` order, sorted by range across files."""
    return rows.orderBy("pos").select(F.to_json(F.struct(*[c for c in rows.columns if c != "pos"])).alias("value"))
