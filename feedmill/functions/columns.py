"""Small column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL_TAG = "n"


def time_literal(df: DataFrame, date_col: str, at: datetime | str) -> Column:
    """``at`` as a constant of the column's own type, so comparisons need no cast and push down."""
    return F.lit(str(at)).cast(df.schema[date_col].dataType)


def cutoff(df: DataFrame, date_col: str, as_of: datetime | str, days: int) -> Column:
    """Start of the look-back window ending at ``as_of``."""
    at = as_of if isinstance(as_of, datetime) else datetime.fromisoformat(str(as_of))
    return time_literal(df, date_col, at - timedelta(days=days))


def quoted(name: str) -> Column:
    """Column by its literal name, dots included."""
    return F.col(f"`{name}`")


def prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[quoted(c).alias(prefix + c) for c in df.columns])


def matches(keys: Iterable[str], prefix: str) -> Column:
    """Null-safe join condition between ``keys`` and the same keys of a ``prefixed`` frame."""
    cond = F.lit(True)
    for i, key in enumerate(keys):
        term = quoted(key).eqNullSafe(quoted(prefix + key))
        cond = term if i == 0 else cond & term
    return cond


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def newest_first(date_col: str, seq_col: str | None) -> list[Column]:
    """Sort order: newest first, null dates last, equal dates in order of arrival."""
    arrival = [quoted(seq_col).asc()] if seq_col else []
    return [quoted(date_col).desc_nulls_last(), *arrival]


def comparable(df: DataFrame, name: str) -> Column:
    """A column in a form that can be compared and grouped: maps as their sorted entries."""
    if isinstance(df.schema[name].dataType, T.MapType):
        return F.array_sort(F.map_entries(quoted(name)))
    return quoted(name)


def fingerprint(df: DataFrame, columns: Iterable[str]) -> Column:
    """SHA-256 over an injective text form of the columns (length-prefixed, nulls marked)."""
    parts = []
    for name in columns:
        nested = isinstance(df.schema[name].dataType, (T.StructType, T.ArrayType, T.MapType))
        value = comparable(df, name)
        text = F.to_json(F.struct(value.alias("v"))) if nested else value.cast("string")
        parts.append(
            F.when(quoted(name).isNull(), F.lit(NULL_TAG)).otherwise(
                F.concat(F.lit("v"), F.length(text).cast("string"), F.lit(":"), text)
            )
        )
    return F.sha2(F.concat(*parts), 256)


def strip_space(text: Column) -> Column:
    """Trim every Unicode white space, not only blanks."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def is_blank(text: Column) -> Column:
    return F.coalesce(strip_space(text), F.lit("")) == ""
