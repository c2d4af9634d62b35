"""Topics: listing, fan-out over articles, and the roll-up per topic."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmill.functions.columns import is_blank
from feedmill.operators.changes import Changes, apply_changes
from feedmill.operators.search import recent, tag_newest
from feedmill.schema import MAX_PER_TOPIC, SEED_TOPICS, TOPIC

TOPIC_CHANGES = Changes(
    keys=("query",),
    fields=("category", "priority"),
    created="created",
    defaults={"category": "general", "priority": 5},
    add_overwrites=True,
    setters={"set_priority": ("priority",), "set_category": ("category",)},
    trim_keys=True,
)


def seed_topics(spark: SparkSession, at: datetime) -> DataFrame:
    """The topics an empty table starts with."""
    rows = [(q, category, 5, True, at, at) for category, names in SEED_TOPICS.items() for q in names]
    return spark.createDataFrame(rows, TOPIC)


def topics(
    df: DataFrame, active_only: bool = True, category: str | None = None, n: int | None = None
) -> DataFrame:
    """Topics by priority, optionally only active ones, one category, or the first ``n``."""
    if active_only:
        df = df.where(F.col("active"))
    if category:
        df = df.where(F.col("category") == category)
    df = df.orderBy("priority", "query")
    return df if n is None else df.limit(n)


def topic_listing(df: DataFrame, category: str | None = None, show_inactive: bool = False) -> DataFrame:
    """Listing view with defaults filled in; a missing flag reads as active."""
    status = F.when(F.coalesce("active", F.lit(True)), "ACTIVE").otherwise("INACTIVE")
    return topics(df, active_only=not show_inactive, category=category).select(
        "query",
        F.coalesce("category", F.lit("general")).alias("category"),
        F.coalesce("priority", F.lit(5)).alias("priority"),
        status.alias("status"),
    )


def tag_by_topic(
    articles: DataFrame,
    topic_table: DataFrame,
    as_of: datetime | str,
    k: int = MAX_PER_TOPIC,
    days: int = 1,
    date_col: str = "date",
    tie: str = "ingest_seq",
    key: Sequence[str] | None = None,
    **bounds: int,
) -> DataFrame:
    """For each active topic the newest ``k`` articles of the last ``days`` that mention it.

    ``searchKey`` holds the topic; an article comes once per topic it mentions. With a ``key`` that tells every
    article from every other, texts are fetched for the result alone.
    """
    active = topic_table.where(F.col("active"))
    window = recent(articles, as_of, days, date_col=date_col)
    return tag_newest(window, active, k, "query", "searchKey", date_col, tie, key, **bounds)


def topic_report(tagged: DataFrame, topic_table: DataFrame, date_col: str = "date") -> DataFrame:
    """Articles, distinct URLs and newest date per category and topic."""
    named = topic_table.select(F.col("query").alias("searchKey"), "category")
    return (
        tagged.join(named, "searchKey")
        .groupBy("category", "searchKey")
        .agg(
            F.count(F.lit(1)).alias("articles"),
            F.count_distinct("url").alias("urls"),
            F.max(date_col).alias("newest"),
        )
    )


def query_set(*tables: DataFrame, col: str = "query") -> DataFrame:
    """Distinct query strings of all tables."""
    out = None
    for table in tables:
        part = table.select(F.col(col).alias("query"))
        out = part if out is None else out.union(part)
    return out.where(~is_blank(F.col("query"))).distinct()


def apply_topic_changes(table: DataFrame, changes: DataFrame, **kw) -> DataFrame:
    """The topic table after an ordered log of add, remove, toggle, set_priority, set_category."""
    return apply_changes(table, changes, TOPIC_CHANGES, **kw)
