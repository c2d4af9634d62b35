"""Corpus statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _unique(col: str) -> Column:
    """Groups of ``col``; a null makes one group of its own."""
    null_group = F.coalesce(F.max(F.col(col).isNull().cast("long")), F.lit(0))
    return F.count_distinct(F.col(col)) + null_group


def article_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("articles"))


def unique_urls(df: DataFrame, col: str = "url") -> DataFrame:
    """Number of URL groups; missing URLs count as one."""
    return df.agg(_unique(col).alias("unique_urls"))


def duplication_report(df: DataFrame, col: str = "url") -> DataFrame:
    """Total, unique, duplicates and their shares in percent; shares are null for an empty corpus."""
    base = df.agg(F.count(F.lit(1)).alias("total"), _unique(col).alias("unique"))
    total, unique = F.col("total"), F.col("unique")

    def share(part: Column) -> Column:
        return F.when(total > 0, F.round(part * 100.0 / total, 1))

    return base.select(
        "total",
        "unique",
        (total - unique).alias("duplicates"),
        share(total - unique).alias("duplicate_pct"),
        share(unique).alias("unique_pct"),
    )
