"""An index of the trigrams of stored texts, so that a search for a rare word reads few files.

An entry says that a data file has a trigram (three characters in a row) in some lower-cased title or body. A text can
contain a query of three characters or more only if it has all of the query's trigrams, so files that lack one are
not read. What is read is searched as without the index: candidates are files, never answers. Entries are sorted by
trigram in small row groups, and only those of a query's trigrams are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedmill.schema import ARTICLE
from feedmill.sources.keyindex import LITERALS, ROW_GROUP_BYTES, push_down_lists
from feedmill.sources.parts import BUCKET, VERSION, extend, state, stored_files, uncovered

GRAMS = "grams"
ENTRY = "gram long, file string"
#: Trigrams of a file that a task holds before it gives them out; met again, they are given out again.
HELD_GRAMS = 1 << 20


def trigrams(text: str) -> np.ndarray:
    """The distinct trigrams of a text, each as one number of three code points."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    return np.unique(points[:-2] << 42 | points[1:-1] << 21 | points[2:])


def _entries(spark: SparkSession, places: list[str]) -> DataFrame:
    """Distinct trigrams of data files."""
    name = F.regexp_extract("_metadata.file_path", rf"({BUCKET}=\d+/{VERSION}=\d+/[^/]*)$", 1)
    texts = spark.read.schema("title string, body string").parquet(*places).select(
        name.alias("file"), F.lower("title").alias("title"), F.lower("body").alias("body")
    )

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: dict[str, np.ndarray] = {}

        def emit() -> Iterator[pa.RecordBatch]:
            for file, grams in met.items():
                yield pa.RecordBatch.from_pydict({"gram": pa.array(grams), "file": pa.array([file] * grams.size, pa.string())})
            met.clear()

        fresh: dict[str, list[np.ndarray]] = {}
        waiting = 0
        none = np.zeros(0, np.int64)

        def fold() -> None:
            for file, found in fresh.items():
                met[file] = np.unique(np.concatenate([met.get(file, none), *found]))
            fresh.clear()

        for batch in batches:
            # Row by row: neither the texts of a batch nor their trigrams are held all at once.
            for i in range(batch.num_rows):
                file = batch["file"][i].as_py()
                for column in ("title", "body"):
                    text = batch[column][i].as_py()
                    if text:
                        grams = trigrams(text)
                        fresh.setdefault(file, []).append(grams)
                        waiting += grams.size
                if waiting > HELD_GRAMS:
                    fold()
                    waiting = 0
                    if sum(g.size for g in met.values()) > HELD_GRAMS:
                        yield from emit()
        fold()
        yield from emit()

    return texts.mapInArrow(find, ENTRY)


def _write(entries: DataFrame, place: str) -> None:
    ranged = entries.distinct().repartitionByRange(F.col("gram"), F.col("file")).sortWithinPartitions("gram", "file")
    ranged.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(place)


def maintain_text(spark: SparkSession, path: str, at_least: int = 1) -> bool:
    """Cover the data files that no part covers, if there are ``at_least`` so many; whether it did."""
    return extend(spark, path, GRAMS, lambda places: _entries(spark, places), _write, at_least)


def candidate_files(spark: SparkSession, path: str, query: str) -> list[str]:
    """The stored files, relative to the store, that can have a text with ``query``: no other file does.

    A query of fewer than three characters has no trigram, so all files stay. The names of the files come to the driver, as a
    listing does.
    """
    stored = stored_files(spark, path)
    every = sorted(f for names in stored.values() for f in names)
    low = spark.range(1).select(F.lower(F.lit(query))).first()[0]  # lower-cased by Spark, as the texts are
    wanted = [int(g) for g in trigrams(low)][:LITERALS]  # a longer query is looked up by some of its trigrams
    root = path.rstrip("/")
    _, parts = state(spark, f"{root}/{GRAMS}")
    if not wanted or not parts:
        return every
    push_down_lists(spark)
    places = [f"{root}/{GRAMS}/{p['name']}" for p in parts]
    met = spark.read.schema(ENTRY).parquet(*places).where(F.col("gram").isin(wanted))
    full = met.groupBy("file").agg(F.count_distinct("gram").alias("n")).where(F.col("n") == len(wanted))
    hit = {r["file"] for r in full.select("file").collect()}
    hit |= {f for names in uncovered(stored, parts).values() for f in names}
    return [f for f in every if f in hit]


def read_mentions(spark: SparkSession, path: str, query: str, schema: T.StructType = ARTICLE) -> DataFrame:
    """Stored rows among which are all that mention ``query``, for ``search`` and ``search_widening``."""
    names = candidate_files(spark, path, query)
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path.rstrip('/')}/{n}" for n in names])
