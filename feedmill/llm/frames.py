"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedmill.functions.columns import quoted
from feedmill.session import scratch_path

DOC = "doc"
ROW_GROUP_BYTES = 16 << 20
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
DEFAULT_BATCH_BYTES = "67108864b"


def packed(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct, so that no name of theirs can clash with a result column."""
    return F.struct(*[quoted(c) for c in df.columns]).alias(DOC)


def unpacked(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns that ``packed`` put away."""
    return df.select(*[F.col(DOC).getField(c).alias(c) for c in schema.fieldNames()])


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: lineage ends there."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remainder(id_col: Column, parts: int) -> Column:
    """crc32 of the id's text modulo ``parts``; a null id has remainder -1, so it is never held out."""
    return F.coalesce(F.crc32(id_col.cast("string")) % parts, F.lit(-1))


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """The values of a string column as UTF-8 bytes; null counts as empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [v or b"" for v in column.cast(kind).to_pylist()]


def gathered(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[list[pa.RecordBatch]]:
    """Batches in lists of about ``most`` bytes."""
    group, total = [], 0
    for batch in batches:
        group.append(batch)
        total += batch.nbytes
        if total >= most:
            yield group
            group, total = [], 0
    if group:
        yield group


def bounded_batches(spark: SparkSession) -> None:
    """Rows of whole documents go to Python in batches of a MB, unless the session already says how large."""
    if spark.conf.get(BATCH_BYTES) == DEFAULT_BATCH_BYTES:
        spark.conf.set(BATCH_BYTES, "1m")


def binary(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary())
