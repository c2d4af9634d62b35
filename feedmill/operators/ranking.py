"""Exact ranks inside groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Rows of one group with the same date that a single task may have to number.
CHUNK_ROWS = 1 << 20


def number_newest_first(
    df: DataFrame,
    keys: Sequence[str],
    date_col: str,
    seq_col: str,
    out_col: str,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """0-based position within ``keys``, newest first, equal dates in ``seq_col`` order.

    A plain window over ``keys`` would put a hot group on one task. Here rows are numbered
    inside small cells (group, date, run of ``seq_col``) and shifted by the number of rows in
    the cells before. Only counts travel for the shifts: per minute along a group, then per
    cell along a minute, so neither window sees more than a sliver of the rows.
    """
    # Structs are never null and compare null fields as equal: keys for windows and joins alike.
    minute = F.floor(F.unix_micros(F.col(date_col).cast("timestamp")) / 60_000_000)
    spot = F.struct(*[F.col(k) for k in keys], minute.alias("_minute"))
    run = F.expr(f"{seq_col} div {chunk_rows}")
    cell = F.struct(spot.alias("spot"), F.col(date_col).alias("date"), run.alias("run"))
    tagged = df.withColumn("_cell", cell)

    cells = tagged.groupBy("_cell").agg(F.count(F.lit(1)).alias("_n")).withColumn("_spot", F.col("_cell.spot"))
    earlier = (Window.unboundedPreceding, -1)
    in_minute = Window.partitionBy("_spot").orderBy(F.desc_nulls_last("_cell.date"), "_cell.run")
    cells = cells.withColumn("_before", F.sum("_n").over(in_minute.rowsBetween(*earlier)))

    group = [F.col(f"_spot.{k}") for k in keys]
    along_group = Window.partitionBy(*group).orderBy(F.desc_nulls_last("_spot._minute"))
    minutes = cells.groupBy("_spot").agg(F.sum("_n").alias("_n"))
    minutes = minutes.select("_spot", F.sum("_n").over(along_group.rowsBetween(*earlier)).alias("_newer"))

    zero = F.lit(0)
    shifts = cells.join(minutes, "_spot").select(
        "_cell", (F.coalesce("_before", zero) + F.coalesce("_newer", zero)).alias("_shift")
    )
    in_cell = Window.partitionBy("_cell").orderBy(seq_col)
    numbered = tagged.withColumn("_at", F.row_number().over(in_cell) - 1)
    placed = numbered.join(shifts, "_cell")
    return placed.select(*df.columns, (F.col("_at") + F.col("_shift")).cast("long").alias(out_col))
