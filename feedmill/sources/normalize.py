"""Landed records of each lane to the one article schema."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.functions.columns import quoted
from feedmill.functions.dates import to_utc
from feedmill.schema import ARTICLE, NO_SUMMARY


def _instant(value: datetime | str | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(str(value)).cast("timestamp")


def normalize_search(df: DataFrame, topic_col: str = "topic") -> DataFrame:
    """Search-API records tagged with the topic that fetched them; other fields pass through."""
    return df.withColumn("searchKey", F.col(topic_col)).drop(*({topic_col} - {"searchKey"}))


def normalize_aggregator(
    df: DataFrame, ingest_ts: datetime | str | Column, topic_col: str = "topic"
) -> DataFrame:
    """Aggregator records: dated by arrival, source from the publisher's address."""
    blank = F.lit("")
    kept = df.drop("publisher", "published date", "description", topic_col, "url", "title")
    return df.select(
        *[F.col(f"`{c}`") for c in kept.columns],
        F.coalesce("url", blank).alias("url"),
        F.coalesce("title", blank).alias("title"),
        F.coalesce("description", blank).alias("body"),
        _instant(ingest_ts).alias("date"),
        F.coalesce("publisher.href", blank).alias("source"),
        F.col(topic_col).alias("searchKey"),
    )


def normalize_rss(items: DataFrame, registry: DataFrame, ingest_ts: datetime | str | Column) -> DataFrame:
    """RSS entries of active registry feeds; an entry without link or title is dropped alone.

    Spark broadcasts the registry while it is small and shuffles otherwise.
    """
    feeds = registry.where(F.col("active")).select("RSS", "source")
    whole = items.where(F.col("link").isNotNull() & F.col("title").isNotNull())
    published = F.col("published")
    date = F.when(published.isNull(), _instant(ingest_ts)).otherwise(to_utc(published))
    return whole.join(feeds, "RSS").select(
        F.col("link").alias("url"),
        "title",
        F.coalesce("summary", F.lit(NO_SUMMARY)).alias("body"),
        date.alias("date"),
        "source",
        F.lit(None).cast("string").alias("searchKey"),
        F.lit(None).cast("string").alias("image"),
        *[c for c in ("ingest_seq",) if c in items.columns],
    )


def union_feeds(*lanes: DataFrame) -> DataFrame:
    """All lanes in one frame; columns a lane lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), lanes)


def to_articles(df: DataFrame) -> DataFrame:
    """The article columns in order and type.

    A string date is parsed; unknown columns go to ``extra``, next to what is there already.
    """
    columns = []
    for field in ARTICLE.fields[:-1]:
        if field.name not in df.columns:
            value = F.lit(None)
        elif field.name == "date" and dict(df.dtypes)["date"] == "string":
            value = to_utc(F.col("date"))
        else:
            value = F.col(field.name)
        columns.append(value.cast(field.dataType).alias(field.name))
    unknown = [c for c in df.columns if c not in ARTICLE.fieldNames() and not c.startswith("_")]
    maps = [F.col("extra")] if "extra" in df.columns else []
    if unknown:
        pairs = F.map_from_arrays(
            F.array(*[F.lit(c) for c in unknown]), F.array(*[quoted(c).cast("string") for c in unknown])
        )
        pairs = F.map_filter(pairs, lambda _, v: v.isNotNull())
        maps = [F.coalesce(F.map_concat(pairs, *maps), pairs)]
    extra = maps[0] if maps else F.lit(None)
    return df.select(*columns, extra.cast(ARTICLE["extra"].dataType).alias("extra"))
