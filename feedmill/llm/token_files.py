"""Token counts of flat token files, by a vectorised scan for separators.

A token file is a plain run of little-endian unsigned 16-bit ids and nothing else: no header, no index, no
lengths. Every document ends in the separator id. A file is read in blocks; in each block the separators are
found by one array comparison, and since a document may begin many blocks before it ends, boundaries
are stitched by a prefix scan: the place of the last separator before a block is the running maximum over the
blocks before it, and the number of documents before it is their running sum.

The ids that Spark writes here are shifted by one, so that the separator is 0. A document may end in a key of
``KEY_IDS`` ids just before its separator, by which its count can be led back to its row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedmill.functions.columns import quoted
from feedmill.llm.frames import binary, bounded_batches, texts_of
from feedmill.llm.words import encoder

SEPARATOR = 0
ID_BYTES = 2
KEY_IDS = 5
KEY_BITS = 15
BLOCK_IDS = 1 << 19


def key_ids(key: int | None) -> bytes:
    """A 64-bit integer, or null, as ``KEY_IDS`` ids none of which is the separator."""
    number = (1 << 64) if key is None else key & ((1 << 64) - 1)
    mask = (1 << KEY_BITS) - 1
    return np.array([(number >> (KEY_BITS * i) & mask) + 1 for i in range(KEY_IDS)], "<u2").tobytes()


def keys_of(ids: np.ndarray) -> list[int | None]:
    """Keys from rows of ``KEY_IDS`` ids."""
    out = []
    for row in (ids.astype(np.int64) - 1).tolist():
        number = sum(v << (KEY_BITS * i) for i, v in enumerate(row))
        out.append(None if number >> 64 else number - (1 << 64) if number >> 63 else number)
    return out


def _streams(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for batch in batches:
            streams = []
            for key, ids in zip(batch.column(0).to_pylist(), encode(texts_of(batch.column(1)))):
                ids = np.frombuffer(ids, "<u4") + 1
                if ids.size and int(ids.max()) >= 1 << (8 * ID_BYTES):
                    raise ValueError("the tokenizer's ids do not fit in two bytes")
                streams.append(ids.astype("<u2").tobytes() + key_ids(key))
            yield pa.RecordBatch.from_arrays([binary(streams)], ["stream"])

    return run


def write_token_files(docs: DataFrame, path: str, tokenizer: str, text_col: str = "text", id_col: str = "doc_id") -> None:
    """Write every document's ids, its key and the separator to flat files, one file per task.

    The text writer puts out the bytes of a row as they are, followed by its line separator, which here is
    the separator id. A null or empty text has no ids, only its key.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(quoted(id_col).cast("long"), quoted(text_col).cast("string"))
    streams = rows.mapInArrow(_streams(tokenizer), "stream binary")
    separator = SEPARATOR.to_bytes(ID_BYTES, "little").decode("ascii")
    streams.select(F.col("stream").cast("string").alias("value")).write.option("lineSep", separator).text(path)


def _scan(separator: int, key_width: int):
    """Places of the separators of each block, and the key before each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends, keys = [], []
            for ids, lead in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist()):
                ids = np.frombuffer(ids, "<u2")
                at = np.flatnonzero(ids[lead:] == separator) + lead
                ends.append((at - lead).tolist())
                wide = np.concatenate([np.zeros(key_width, "<u2"), ids])  # a key never starts before its file
                keys.append(keys_of(wide[at[:, None] + np.arange(key_width)]) if key_width else [None] * at.size)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:3],
                    pa.array(ends, pa.list_(pa.int64())),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                ["file", "block", "first", "ends", "keys"],
            )

    return run


def _blocks(spark: SparkSession, path: str, block_ids: int, key_width: int) -> DataFrame:
    """``(file, block, first, ids, lead)``: a block's ids with the ``lead`` ids that stand before it."""
    width = block_ids * ID_BYTES
    files = spark.read.format("binaryFile").load(path).where(F.col("length") > 0)
    blocks = F.sequence(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / width))
    cut = files.select(F.col("path").alias("file"), "content", F.explode(blocks).alias("block"))
    lead: Column = F.least(F.col("block") * block_ids, F.lit(key_width).cast("long"))
    return cut.select(
        "file",
        "block",
        (F.col("block") * block_ids).alias("first"),
        F.substring(
            "content",
            ((F.col("block") * block_ids - lead) * ID_BYTES + 1).cast("int"),
            ((lead + block_ids) * ID_BYTES).cast("int"),
        ).alias("ids"),
        lead.cast("int").alias("lead"),
    )


def count_tokens(
    spark: SparkSession, path: str, separator: int = SEPARATOR, key_width: int = KEY_IDS, block_ids: int = BLOCK_IDS
) -> DataFrame:
    """``(file, number, key, start, n_tokens)`` of every document in the token files below ``path``.

    ``number`` counts the documents of a file from 0, ``start`` is the place of a document's first id, and
    ``n_tokens`` leaves out separator and key. Ids behind a file's last separator are no document. A file must
    be below 2 GB. With ``key_width`` 0 files of any writer can be read; keys are null then.
    """
    bounded_batches(spark)
    scanned = _blocks(spark, path, block_ids, key_width).mapInArrow(
        _scan(separator, key_width), "file string, block long, first long, ends array<long>, keys array<long>"
    )
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    stitched = scanned.withColumns(
        {
            "number": F.coalesce(F.sum(F.size("ends")).over(before), F.lit(0)).cast("long"),
            "start": F.coalesce(F.max(F.col("first") + F.array_max("ends")).over(before) + 1, F.lit(0)).cast("long"),
        }
    )
    one = stitched.select(
        "file",
        "number",
        "start",
        "first",
        F.concat(F.array(F.col("start") - F.col("first") - 1), F.col("ends")).alias("marks"),
        F.posexplode(F.arrays_zip("ends", "keys")).alias("i", "found"),
    )
    begin = F.col("first") + F.get("marks", F.col("i")) + 1
    return one.select(
        "file",
        (F.col("number") + F.col("i")).alias("number"),
        F.col("found.keys").alias("key"),
        begin.alias("start"),
        (F.col("first") + F.col("found.ends") - begin - key_width).alias("n_tokens"),
    )
