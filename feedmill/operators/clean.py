"""Cleaning and deduplication of collected batches."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedmill.functions.columns import comparable, newest_first, quoted
from feedmill.functions.dates import to_utc
from feedmill.operators.ranking import CHUNK_ROWS, number_newest_first
from feedmill.schema import BOILERPLATE

TECHNICAL = ("level_0", "index")


def keep_one(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """The first row in ``order`` per key; null keys form one group.

    Spark limits each group to one row per task before the shuffle (WindowGroupLimit), so a hot
    key sends one row per task. For wide rows this is twice as fast as an aggregate over structs.
    """
    return _first_of(df, [quoted(k) for k in keys], *order)


def _first_of(df: DataFrame, keys: Sequence[Column], *order: Column) -> DataFrame:
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_copy", F.row_number().over(first)).where(F.col("_copy") == 1).drop("_copy")


def newest_by_key(
    df: DataFrame, keys: Sequence[str] = ("url",), date_col: str = "date", seq_col: str | None = "ingest_seq"
) -> DataFrame:
    """Newest row per key; equal dates keep the one seen first."""
    return keep_one(df, keys, *newest_first(date_col, seq_col))


def dedupe_except(
    df: DataFrame, ignore: Iterable[str] = ("searchKey", "image"), seq_col: str = "ingest_seq"
) -> DataFrame:
    """One row per distinct combination of all columns but ``ignore`` (and the arrival number).

    Of equal rows the first one seen gives the ignored columns.
    """
    loose = {*ignore, seq_col}
    return _first_of(df, [comparable(df, c) for c in df.columns if c not in loose], quoted(seq_col).asc())


def has_boilerplate(phrases: Iterable[str] = BOILERPLATE, body_col: str = "body") -> Column:
    """Whether the body has any of the phrases (case-sensitive); false for a null body."""
    phrases = list(phrases)
    found = F.lit(False)
    for phrase in dict.fromkeys(phrases):
        # A phrase that contains another one adds nothing.
        if not any(other != phrase and other in phrase for other in phrases):
            found = found | F.coalesce(F.col(body_col).contains(phrase), F.lit(False))
    return found


def drop_boilerplate(
    df: DataFrame, phrases: Iterable[str] = BOILERPLATE, body_col: str = "body"
) -> DataFrame:
    """Rows whose body has none of the phrases (case-sensitive); a null body stays."""
    return df.where(~has_boilerplate(phrases, body_col))


def recency_rank(
    df: DataFrame,
    keys: Sequence[str] = ("searchKey",),
    date_col: str = "date",
    seq_col: str = "ingest_seq",
    out_col: str = "recency",
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """0 = newest … n-1 = oldest within each topic's batch."""
    return number_newest_first(df, keys, date_col, seq_col, out_col, chunk_rows)


def parse_dates(df: DataFrame, date_col: str = "date") -> DataFrame:
    """String dates to UTC timestamps; unparseable ones become null and the row stays."""
    if isinstance(df.schema[date_col].dataType, T.StringType):
        return df.withColumn(date_col, to_utc(F.col(date_col)))
    return df


def list_lengths(df: DataFrame, sep: str = ".", columns: Sequence[str] | None = None) -> dict[str, int]:
    """Greatest length of every list in ``df``, or in some columns, lists in lists included, by one aggregation.

    The lists are named as ``flatten`` names them, with ``*`` for any element: ``people.*.ids``.
    """
    longest: dict[str, Column] = {}

    def field_of(name: str):
        return lambda value: value.getField(name)

    def walk(values: Column, name: str, dtype: T.DataType) -> None:
        """``values`` holds what a row has at a place, all elements of the lists above it together."""
        if isinstance(dtype, T.StructType):
            for field in dtype.fields:
                walk(F.transform(values, field_of(field.name)), f"{name}{sep}{field.name}", field.dataType)
        elif isinstance(dtype, T.ArrayType):
            there = F.filter(values, lambda v: v.isNotNull())
            longest[name] = F.coalesce(F.max(F.array_max(F.transform(there, F.size))), F.lit(0))
            walk(F.flatten(there), f"{name}{sep}*", dtype.elementType)

    for field in df.schema.fields:
        if columns is None or field.name in columns:
            walk(F.array(quoted(field.name)), field.name, field.dataType)
    if not longest:
        return {}
    found = df.agg(*[c.alias(f"n{i}") for i, c in enumerate(longest.values())]).first()
    return dict(zip(longest, found))


def flatten(
    df: DataFrame, sep: str = ".", max_items: int | None = 0, columns: Sequence[str] | None = None
) -> DataFrame:
    """Nested records as ``a.b.c`` columns, list elements as ``a.0.b``; all of them, or those in some columns.

    A Spark schema is fixed, so lists need a greatest length: with ``max_items=None`` that of each list is found
    first, by one more pass if there is any list; a list that is empty in all rows then has no column. With 0 lists stay
    as they are. Lists longer than ``max_items`` are an error, never cut.
    """
    lengths = list_lengths(df, sep, columns) if max_items is None else {}

    def leaves(value: Column, name: str, dtype: T.DataType, place: str) -> list[Column]:
        if isinstance(dtype, T.StructType):
            return [
                leaf
                for field in dtype.fields
                for leaf in leaves(
                    value.getField(field.name), f"{name}{sep}{field.name}", field.dataType, f"{place}{sep}{field.name}"
                )
            ]
        items = lengths[place] if max_items is None and isinstance(dtype, T.ArrayType) else max_items
        if isinstance(dtype, T.ArrayType) and (items or max_items is None):
            fits = F.when(
                F.size(value) > items,
                F.raise_error(F.lit(f"list {name} has more than {items} elements")).cast(dtype),
            ).otherwise(value)
            return [
                leaf
                for i in range(items)
                for leaf in leaves(F.get(fits, F.lit(i)), f"{name}{sep}{i}", dtype.elementType, f"{place}{sep}*")
            ]
        return [value.alias(name)]

    return df.select(
        *[
            leaf
            for field in df.schema.fields
            for leaf in (
                leaves(quoted(field.name), field.name, field.dataType, field.name)
                if columns is None or field.name in columns
                else [quoted(field.name)]
            )
        ]
    )


def json_layout(df: DataFrame, column: str) -> T.StructType:
    """The layout of the JSON objects in a text column, found in one pass over all of them.

    A key that has values of several kinds, or nothing but null, is text. Text that is no JSON object is passed over.
    """
    value = F.try_parse_json(quoted(column))
    told = df.agg(F.schema_of_variant_agg(F.when(F.schema_of_variant(value).startswith("OBJECT"), value)).alias("s")).first()["s"]
    if not told or not told.startswith("OBJECT<"):
        return T.StructType()
    names = re.compile(r"`(?:[^`]|``)*`|\b(?:OBJECT(?=<)|VARIANT|VOID)\b")
    plain = {"OBJECT": "STRUCT", "VARIANT": "STRING", "VOID": "STRING"}
    return T._parse_datatype_string(names.sub(lambda m: plain.get(m[0], m[0]), told))


def flatten_json(df: DataFrame, column: str, sep: str = ".") -> DataFrame:
    """The other columns and, as ``a.b.0.c`` columns, all that the JSON objects in a text column hold.

    Nobody has to name the keys or say how long lists get: one pass finds the layout, a second one the lengths of
    lists, where there are any. Columns of ``df`` keep their names; a key of the same name as one of them is an error.
    """
    layout = json_layout(df, column)
    others = [quoted(c) for c in df.columns if c != column]
    if not layout.fields:
        return df.select(*others)
    clash = {f.name for f in layout.fields} & {c for c in df.columns if c != column}
    if clash:
        raise ValueError(f"keys {sorted(clash)} are columns as well")
    read = df.withColumn("_json", F.from_json(quoted(column), layout))
    keys = [f.name for f in layout.fields]
    spread = read.select(*others, *[F.col("_json").getField(k).alias(k) for k in keys])
    return flatten(spread, sep, max_items=None, columns=keys)


def longest_list(df: DataFrame, column: str) -> int:
    """Greatest length of a list column, for ``flatten``."""
    return df.agg(F.max(F.size(F.col(column)))).first()[0] or 0


def clean(
    df: DataFrame,
    phrases: Iterable[str] = BOILERPLATE,
    batch_keys: Sequence[str] = (),
    date_col: str = "date",
    seq_col: str = "ingest_seq",
    rank_col: str | None = None,
) -> DataFrame:
    """The fixed order for API batches: flatten, parse dates, newest per URL, drop boilerplate.

    ``batch_keys`` names what separates one batch from another (the topic), as each batch is
    cleaned alone. Row-level dedupe is left out here: keeping the newest row per URL already
    removes every equal row. Boilerplate goes after the dedupe, so an older clean copy of a URL
    is not brought back. ``rank_col`` adds the recency rank of what is left.
    """
    flat = parse_dates(flatten(df, max_items=None), date_col)
    flat = flat.drop(*[c for c in TECHNICAL if c in flat.columns])
    # A struct is never null and compares null fields as equal: one key for the dedupe and for the join below.
    key = F.struct(*[quoted(k).alias(f"k{i}") for i, k in enumerate([*batch_keys, "url"])])
    judged = flat.withColumn("_bad", has_boilerplate(phrases)).withColumn("_key", key)
    newest = newest_first(date_col, seq_col)
    kept = _first_of(judged, [F.col("_key")], *newest).where(~F.col("_bad")).drop("_bad")
    if not rank_col:
        return kept.drop("_key")
    # Ranks are found on the same rows without their texts, which then meet the texts where the dedupe has put them.
    groups = list(batch_keys) or ["searchKey"]
    narrow = judged.select("_key", "_bad", *[quoted(c) for c in dict.fromkeys([*groups, date_col, seq_col])])
    left = _first_of(narrow, [F.col("_key")], *newest).where(~F.col("_bad"))
    ranks = recency_rank(left, groups, date_col, seq_col, rank_col).select("_key", rank_col)
    return kept.join(ranks, "_key").drop("_key")
