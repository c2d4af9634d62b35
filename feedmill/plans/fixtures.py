"""Article-shaped views over the benchmark tables.

The same views as SQL, for DuckDB, are in ``oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

AS_OF = "2024-01-31 00:00:00"
STORE_CUT = "2024-01-16 00:00:00"
PHRASE = "worthless"
TOPICS = (
    ("the", "general", 1, True),
    ("worthless", "markets", 2, True),
    ("und", "economy", 3, True),
    ("les", "economy", 3, False),
    ("est", "general", 5, True),
)


_SCHEMAS: dict[tuple[str, str, str], T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table; its schema is read from the file footer once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    path = f"{sf_dir}/{name}.parquet"
    if key not in _SCHEMAS:
        _SCHEMAS[key] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[key]).parquet(path)


_ROWS: dict[tuple[str, str, str], int] = {}


def rows(spark: SparkSession, sf_dir: str, name: str) -> int:
    """Row count of a base table (from the file footers), read once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _ROWS:
        _ROWS[key] = table(spark, sf_dir, name).count()
    return _ROWS[key]


def host(url: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(url, r"^[^:/?#]+://([^/?#]*)", 1), r"^www[.]", "")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles: several documents share each URL, dates are shuffled relative to ids.

    URL and date are found for the ids alone; the texts move once, to meet them, and are not sorted for it.
    """
    doc = F.col("doc_id")
    docs = table(spark, sf_dir, "documents")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    events = table(spark, sf_dir, "events").select("event_id", F.col("ts").alias("date"))
    spots = docs.select("doc_id").distinct().withColumns(
        {
            "page_id": doc % rows(spark, sf_dir, "pages"),
            "event_id": (doc * 7919) % rows(spark, sf_dir, "events"),
        }
    )
    spots = spots.join(pages, "page_id").join(events, "event_id").select("doc_id", "url", "date")
    via = F.concat("text", F.lit(" via https://www.wire"), (doc % 7).cast("string"), F.lit(".example.com/s"))
    return (
        docs.join(spots.hint("shuffle_hash"), "doc_id")
        .select(
            doc.alias("article_id"),
            "url",
            F.substring_index("text", "\n", 1).alias("title"),
            F.when(doc % 5 == 0, via).otherwise(F.col("text")).alias("body"),
            "date",
            "source",
            F.col("lang").alias("searchKey"),
            F.lit(None).cast("string").alias("image"),
            doc.alias("ingest_seq"),
        )
    )


def topics(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TOPICS, "query string, category string, priority int, active boolean")


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registry of every second host of the pages."""
    hosts = table(spark, sf_dir, "pages").groupBy(host(F.col("url")).alias("host")).agg(
        F.min("page_id").alias("first_page")
    )
    first = F.col("first_page")
    return hosts.where(first % 2 == 0).select(
        F.concat(F.lit("www."), "host").alias("site"),
        F.concat(F.lit("https://"), F.col("host"), F.lit("/rss")).alias("RSS"),
        F.col("host").alias("source"),
        F.when(first % 3 == 0, "finance").otherwise("politics").alias("category"),
        (first % 4 != 0).alias("active"),
    )


def feed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with feed links put in front of their HTML."""
    page = F.col("page_id")
    link = F.concat(
        F.lit('<link rel="alternate" type="application/rss+xml" title="Feed '),
        page.cast("string"),
        F.lit('" href="/feed/'),
        (page % 10).cast("string"),
        F.lit('.xml">'),
    )
    anchor = F.concat(F.lit('<a href="https://feeds.example.com/'), (page % 10).cast("string"), F.lit('">RSS feed</a>'))
    return table(spark, sf_dir, "pages").select(
        page,
        host(F.col("url")).alias("domain"),
        F.concat(
            F.when(page % 3 == 0, link).otherwise(F.lit("")),
            F.when(page % 4 == 0, anchor).otherwise(F.lit("")),
            F.col("html"),
        ).alias("html"),
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A keyed, ordered event log."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("script_id"),
        F.col("ts").alias("start_time"),
        F.col("event_type").alias("line"),
        F.col("event_id").alias("seq"),
    )


def mined_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics that grow with the corpus: the first word of each title, if it has five letters."""
    doc = F.col("doc_id")
    word = F.substring_index(F.substring_index("text", "\n", 1), " ", 1)
    return (
        table(spark, sf_dir, "documents")
        .select(word.alias("query"), "lang", "doc_id")
        .where(F.length("query") >= 5)
        .groupBy("query")
        .agg(F.min("lang").alias("category"), F.min(doc).alias("first"))
        .select(
            "query",
            "category",
            (1 + F.col("first") % 10).cast("int").alias("priority"),
            (F.col("first") % 4 != 0).alias("active"),
        )
    )


OPS = {"view": "toggle", "click": "set_priority", "error": "remove", "purchase": "add", "signup": "set_category"}


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, event = F.col("event_type"), F.col("event_id")
    op = F.lit(None).cast("string")
    for event_type, name in OPS.items():
        op = F.when(kind == event_type, name).otherwise(op)
    return table(spark, sf_dir, "events").select(
        event.alias("seq"),
        op.alias("op"),
        "user_id",
        F.concat(F.lit("c"), (event % 7).cast("string")).alias("category"),
        (event % 10).cast("int").alias("priority"),
        F.when(event % 3 == 1, True).when(event % 3 == 2, False).alias("active"),
        F.col("ts"),
    )


def topic_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A topic change log: every event is one operation on its user's topic."""
    key = F.concat(F.lit("topic "), F.col("user_id").cast("string"))
    return _log(spark, sf_dir).withColumn("query", key).drop("user_id")


def topic_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics of every second user, as they stood before the log."""
    user = F.col("user_id")
    return (
        table(spark, sf_dir, "events")
        .where(user % 2 == 0)
        .groupBy("user_id")
        .agg(F.min("ts").alias("created"))
        .select(
            F.concat(F.lit("topic "), user.cast("string")).alias("query"),
            F.lit("general").alias("category"),
            F.lit(5).alias("priority"),
            (user % 3 != 0).alias("active"),
            "created",
            F.col("created").alias("last_updated"),
        )
    )


def _site(user: Column) -> Column:
    return F.concat(F.lit("www.h"), user.cast("string"), F.lit(".example.com"))


def _rss(user: Column) -> Column:
    return F.concat(F.lit("https://h"), user.cast("string"), F.lit(".example.com/rss"))


def source_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registry change log over the same events; both setters are plain updates here."""
    user, op = F.col("user_id"), F.col("op")
    setter = op.isin("set_priority", "set_category")
    return _log(spark, sf_dir).select(
        "seq",
        F.when(setter, "update").otherwise(op).alias("op"),
        _site(user).alias("site"),
        _rss(user).alias("RSS"),
        F.when(op != "set_category", F.concat(F.lit("s"), F.col("priority").cast("string"))).alias("source"),
        F.when(op != "set_priority", F.col("category")).alias("category"),
        F.when(~setter, F.col("active")).alias("active"),
        "ts",
    )


def source_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.col("user_id")
    return (
        table(spark, sf_dir, "events")
        .where(user % 2 == 0)
        .groupBy("user_id")
        .agg(F.min("ts").alias("added_date"))
        .select(
            _site(user).alias("site"),
            _rss(user).alias("RSS"),
            F.concat(F.lit("name "), user.cast("string")).alias("source"),
            (user % 3 != 0).alias("active"),
            F.lit("finance").alias("category"),
            "added_date",
            F.col("added_date").alias("last_updated"),
        )
    )
