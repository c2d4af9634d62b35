"""Existence checks, insert-new and upsert against the stored corpus.

The store holds one row per URL. Every operator first cuts the batch to one row per URL (with
map-side combine), so a URL that fills the batch never reaches a join as a hot key. Joins are
written with the batch on the build side: Spark broadcasts it when its measured size allows
and shuffles otherwise; a small batch then leaves the store unshuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedmill.functions.columns import fingerprint, matches, prefixed, quoted
from feedmill.functions.dates import to_utc
from feedmill.operators.clean import keep_one
from feedmill.schema import REQUIRED

RUN_ROWS = 1 << 17


def require_columns(df: DataFrame, columns: Sequence[str] = REQUIRED) -> DataFrame:
    """The batch, or none of it when a column is absent; null values are no concern here."""
    return df if set(columns) <= set(df.columns) else df.limit(0)


def last_in_batch(batch: DataFrame, keys: Sequence[str] = ("url",), seq_col: str = "ingest_seq") -> DataFrame:
    """Ordered writes: the last record of a key wins."""
    return keep_one(batch, keys, quoted(seq_col).desc())


def existing_keys(batch: DataFrame, store: DataFrame, key: str = "url") -> DataFrame:
    """Batch keys that the store already has (null counts as a key).

    The store is the streamed side and gives only its key column.
    """
    wanted = prefixed(batch.select(key).distinct(), "_b_")
    return store.select(key).join(wanted, matches([key], "_b_"), "left_semi").distinct()


def insert_new(
    batch: DataFrame, store: DataFrame, key: str = "url", seq_col: str = "ingest_seq"
) -> DataFrame:
    """Rows to append: unseen keys only, last record of each. Stored rows never change."""
    known = prefixed(existing_keys(batch, store, key), "_s_")
    return last_in_batch(batch, [key], seq_col).join(known, matches([key], "_s_"), "left_anti")


def stored_matches(store: DataFrame, batch: DataFrame, keys: Sequence[str] = ("url",)) -> DataFrame:
    """The stored rows that a batch will meet; the store is the streamed side."""
    wanted = prefixed(batch.select(*keys).distinct(), "_b_")
    return store.join(wanted, matches(list(keys), "_b_"), "left_semi")


def upsert(
    store: DataFrame,
    batch: DataFrame,
    keys: Sequence[str] = ("url",),
    seq_col: str = "ingest_seq",
    met: DataFrame | None = None,
) -> DataFrame:
    """The store after an ordered upsert.

    A match takes all batch columns, nulls included, and keeps columns only the store has, as
    well as the keys only its maps have; the rest is inserted. Rows of the store stay in place (left join), inserts are added, so a
    small batch costs no shuffle of the store. ``met``, if at hand, is what ``stored_matches`` gives: the store is then read once.
    """
    keys = list(keys)
    final = last_in_batch(batch, keys, seq_col)
    incoming = prefixed(final, "_b_").withColumn("_hit", F.lit(True))

    def pick(name: str) -> Column:
        if name not in batch.columns:
            return quoted(name)
        new = quoted("_b_" + name)
        if name not in store.columns:
            return new.alias(name)
        if isinstance(store.schema[name].dataType, T.MapType):
            old = F.map_filter(quoted(name), lambda k, _: ~F.coalesce(F.map_contains_key(new, k), F.lit(False)))
            new = F.coalesce(F.map_concat(old, new), new, old)
        return F.when(F.col("_hit"), new).otherwise(quoted(name)).alias(name)

    names = list(store.columns) + [c for c in batch.columns if c not in store.columns]
    kept = store.join(incoming, matches(keys, "_b_"), "left").select(*[pick(n) for n in names])
    known = (stored_matches(store.select(*keys), batch, keys) if met is None else met.select(*keys)).distinct()
    fresh = final.join(prefixed(known, "_s_"), matches(keys, "_s_"), "left_anti")
    return kept.unionByName(fresh, allowMissingColumns=True)


def _writes_per_key(batch: DataFrame, key: str, seq_col: str, run_rows: int) -> DataFrame:
    """Per key: rows, first fingerprint, and writes that differ from the write before them.

    Only fingerprints travel. A key's rows are compared inside runs of ``run_rows`` arrival
    numbers, then run against run, so one key filling the batch is spread over many tasks.
    """
    columns = [c for c in batch.columns if c != seq_col]
    run = F.expr(f"{seq_col} div {run_rows}")
    prints = batch.select(key, seq_col, run.alias("_run"), fingerprint(batch, columns).alias("_fp"))
    in_run = Window.partitionBy(key, "_run").orderBy(seq_col)
    runs = (
        prints.withColumn("_differs", F.col("_fp") != F.lag("_fp").over(in_run))
        .groupBy(key, "_run")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.count_if("_differs").alias("_inside"),
            F.min_by("_fp", seq_col).alias("_first"),
            F.max_by("_fp", seq_col).alias("_last"),
        )
    )
    across = F.col("_first") != F.lag("_last").over(Window.partitionBy(key).orderBy("_run"))
    return (
        runs.withColumn("_across", across)
        .groupBy(key)
        .agg(
            F.sum("_n").alias("_n"),
            (F.sum("_inside") + F.count_if("_across")).alias("_rewrites"),
            F.min_by("_first", "_run").alias("_first"),
        )
    )


def upsert_counts(
    store: DataFrame,
    batch: DataFrame,
    key: str = "url",
    seq_col: str = "ingest_seq",
    run_rows: int = RUN_ROWS,
) -> DataFrame:
    """One row ``upserted, modified, saved`` as the ordered writes would report them.

    The first write of an absent key is an upsert; any other write counts as modified when it
    differs from what it overwrites.
    """
    columns = [c for c in batch.columns if c != seq_col]
    aligned = store.select(
        *[
            (quoted(c) if c in store.columns else F.lit(None)).cast(batch.schema[c].dataType).alias(c)
            for c in columns
        ]
    )
    wanted = prefixed(batch.select(key).distinct(), "_b_")
    stored = aligned.join(wanted, matches([key], "_b_"), "left_semi").select(
        F.col(key).alias("_s_" + key), fingerprint(aligned, columns).alias("_stored")
    )
    met = _writes_per_key(batch, key, seq_col, run_rows).join(stored, matches([key], "_s_"), "left")
    over_stored = F.coalesce(F.col("_first") != F.col("_stored"), F.lit(False)).cast("long")
    return met.agg(
        F.count_if(F.col("_stored").isNull()).alias("upserted"),
        F.coalesce(F.sum(F.col("_rewrites") + over_stored), F.lit(0)).alias("modified"),
    ).withColumn("saved", F.col("upserted") + F.col("modified"))


def insert_counts(
    store: DataFrame,
    batch: DataFrame,
    key: str = "url",
    seq_col: str = "ingest_seq",
    run_rows: int = RUN_ROWS,
) -> DataFrame:
    """One row ``found, skipped, saved`` of the insert-new path."""
    known = prefixed(existing_keys(batch, store, key), "_s_").withColumn("_known", F.lit(True))
    met = _writes_per_key(batch, key, seq_col, run_rows).join(known, matches([key], "_s_"), "left")
    is_new = F.col("_known").isNull()
    return met.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("found"),
        F.coalesce(F.sum(F.when(~is_new, F.col("_n"))), F.lit(0)).alias("skipped"),
        F.coalesce(F.sum(F.when(is_new, F.col("_rewrites") + 1)), F.lit(0)).alias("saved"),
    )


def repair_string_dates(df: DataFrame, raw_col: str = "date_raw", date_col: str = "date") -> DataFrame:
    """Fill ``date_col`` from dates that arrived as strings; what cannot be read stays null."""
    have = F.col(date_col) if date_col in df.columns else F.lit(None).cast("timestamp")
    return df.withColumn(date_col, F.coalesce(have, to_utc(F.col(raw_col))))


def repair_counts(df: DataFrame, raw_col: str = "date_raw", date_col: str = "date") -> DataFrame:
    """One row ``repaired, unreadable``."""
    waiting = F.col(raw_col).isNotNull()
    if date_col in df.columns:
        waiting = waiting & F.col(date_col).isNull()
    parsed = to_utc(F.col(raw_col)).isNotNull()
    return df.agg(
        F.count_if(waiting & parsed).alias("repaired"), F.count_if(waiting & ~parsed).alias("unreadable")
    )
