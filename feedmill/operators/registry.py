"""The registry of feed sources."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmill.operators.changes import Changes, apply_changes
from feedmill.schema import SEED_SOURCES, SOURCE

SOURCE_CHANGES = Changes(
    keys=("site", "RSS"),
    fields=("source", "category"),
    created="added_date",
    defaults={"category": "general"},
    add_overwrites=False,
    setters={"update": ("source", "category", "active")},
)


def seed_sources(spark: SparkSession, at: datetime) -> DataFrame:
    """The sources a missing registry starts with."""
    rows = [(site, rss, name, True, category, at, None) for site, rss, name, category in SEED_SOURCES]
    return spark.createDataFrame(rows, SOURCE)


def sources(
    df: DataFrame, active_only: bool = False, category: str | None = None, n: int | None = None
) -> DataFrame:
    """Registry rows by category, optionally only active ones, one category, or the first ``n``."""
    if active_only:
        df = df.where(F.col("active"))
    if category:
        df = df.where(F.col("category") == category)
    df = df.orderBy("category", "site", "RSS")
    return df if n is None else df.limit(n)


def source_listing(df: DataFrame, active_only: bool = False, category: str | None = None) -> DataFrame:
    """Listing view: upper-case category, status, ``Unknown`` for missing names, printed date."""
    unknown = F.lit("Unknown")
    status = F.when(F.coalesce("active", F.lit(True)), "ACTIVE").otherwise("INACTIVE")
    listed = sources(df, active_only, category)
    added = (
        F.date_format("added_date", "yyyy-MM-dd HH:mm:ss") if "added_date" in df.columns else F.lit(None).cast("string")
    )
    return listed.select(
        F.upper("category").alias("category"),
        F.coalesce("source", unknown).alias("source"),
        status.alias("status"),
        F.coalesce("site", unknown).alias("site"),
        F.coalesce("RSS", unknown).alias("RSS"),
        added.alias("added"),
    )


def check_unique(df: DataFrame, keys: Sequence[str] = ("site", "RSS")) -> DataFrame:
    """Keys that occur more than once; empty when the composite key is unique."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def apply_source_changes(table: DataFrame, changes: DataFrame, **kw) -> DataFrame:
    """The registry after an ordered log of add (if absent), update, toggle, remove."""
    return apply_changes(table, changes, SOURCE_CHANGES, **kw)
