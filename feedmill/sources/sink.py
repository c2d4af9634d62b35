"""The stored corpus: Parquet in buckets of the URL hash, each bucket in its current version.

Files lie in ``bucket=<b>/version=<v>``; a small file beside them says which version of a bucket counts. Inserts
append to the current versions. An upsert, or a compaction, writes the next version of the buckets it touches, once,
and then switches all of them with one new ``_current`` file: readers see the store before it or after it. What an
interrupted one left behind is never read, and the next one writes over it. The version before the current one
stays for readers that are still at it; older ones are removed.
"""

from __future__ import annotations

import hashlib
import json
import random
import time
import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedmill.operators.store import insert_counts, insert_new, repair_string_dates, stored_matches, upsert, upsert_counts
from feedmill.schema import ARTICLE, REQUIRED
from feedmill.sources import files
from feedmill.sources.keyindex import bucket_of, known_urls, maintain
from feedmill.sources.parts import BUCKET, CURRENT, INDEX_FILES, VERSION, current_versions, stored_files

BUCKETS = 64
ASKS, HOLDS = "_writer.asks-", "_writer.holds-"
CLAIM_TRIES = 8


def _switch(spark: SparkSession, path: str, versions: dict[int, int], writer: str) -> None:
    """Make ``versions`` the current ones, if ``writer`` still has the claim. No such file is ever written over."""
    names = files.listed(spark, path, f"{CURRENT}*", rf"{CURRENT}\d+")
    switches = sorted(int(n.removeprefix(CURRENT)) for n in names)
    number = switches[-1] + 1 if switches else 0
    if not has_claim(spark, path, writer):
        raise RuntimeError(f"{path} was taken from {writer}; nothing is switched")
    files.publish(spark, path, f"{CURRENT}{number}", json.dumps(versions))
    for old in switches[:-1]:
        files.remove(spark, path, f"{CURRENT}{old}")


def _write(
    df: DataFrame,
    path: str,
    versions: dict[int, int],
    key: str = "url",
    buckets: int = BUCKETS,
    files_per_bucket: int = 1,
    mode: str = "append",
) -> None:
    """One shuffle puts a bucket's rows into ``files_per_bucket`` tasks, so files stay few and even.

    Rows are in order of date within a file, so that a look-back can skip row groups.
    """
    # One constant list, so that neither the plan nor a row's look-up grows with the number of buckets.
    numbers = F.from_json(F.lit(json.dumps([versions.get(b, 0) for b in range(buckets)])), "array<int>")
    version = F.get(numbers, F.col(BUCKET))
    placed = df.withColumn(BUCKET, bucket_of(F.col(key), buckets)).withColumn(VERSION, version)
    part = F.pmod(F.xxhash64(F.col(key), F.lit(1)), F.lit(files_per_bucket))
    order = [BUCKET, VERSION, *(["date"] if "date" in df.columns else [])]
    (
        placed.repartition(F.col(BUCKET), part)
        .sortWithinPartitions(*order)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(BUCKET, VERSION)
        .parquet(path)
    )


def read_store(
    spark: SparkSession, path: str, schema: T.StructType = ARTICLE, only: Iterable[int] | None = None
) -> DataFrame:
    """The stored rows, or those of ``only`` some buckets; no other bucket is listed or read."""
    stored, versions = stored_files(spark, path), current_versions(spark, path)
    numbers = sorted(stored if only is None else set(stored).intersection(only))
    folders = [f"{path.rstrip('/')}/{BUCKET}={b}/{VERSION}={versions.get(b, 0)}" for b in numbers]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def _claims(spark: SparkSession, path: str, kind: str) -> list[str]:
    """Digests of the writers that ask for a store, or that hold it."""
    return [n.removeprefix(kind) for n in files.listed(spark, path, f"{kind}*", rf"{kind}[0-9a-f]{{32}}")]


def _digest(writer: str) -> str:
    return hashlib.md5(writer.encode(), usedforsecurity=False).hexdigest()


def has_claim(spark: SparkSession, path: str, writer: str) -> bool:
    return files.exists(spark, f"{path.rstrip('/')}/{HOLDS}{_digest(writer)}")


def claim_store(spark: SparkSession, path: str, writer: str, tries: int = CLAIM_TRIES) -> None:
    """Make ``writer`` the one writer of a store; an error if another one is.

    Nothing is asked of the file system but that a listing shows every file closed before it, which object stores
    give too: a writer first puts down that it asks, then lists who does. Whoever finds itself alone holds the store;
    whoever does not takes its own file back. Of two that ask at once at least one sees the other, so never both hold
    it; if both give way, they ask again after a random while. A writer that holds a store may come back after
    a failure under its name. One name must not be used by two jobs at a time.
    """
    mine = _digest(writer)
    for n in range(tries):
        if has_claim(spark, path, writer):
            return
        files.put(spark, path, f"{ASKS}{mine}", writer)
        others = [d for d in _claims(spark, path, ASKS) if d != mine]
        if not others:
            files.put(spark, path, f"{HOLDS}{mine}", writer)
            return
        files.remove(spark, path, f"{ASKS}{mine}")
        holder = [d for d in _claims(spark, path, HOLDS) if d != mine]
        if holder and n + 1 >= min(2, tries):  # a call that is just ending is given one more look
            raise RuntimeError(f"{path} is written by {_name(spark, path, holder[0])}; release_store gives it free")
        time.sleep(random.uniform(0.05, 0.2) * (n + 1))
    raise RuntimeError(f"{path} is asked for by others all the time; release_store removes what a failed one left")


def _name(spark: SparkSession, path: str, digest: str) -> str:
    try:
        return files.text(spark, path, f"{HOLDS}{digest}")
    except Py4JJavaError:  # given up in between
        return "another writer"


def release_store(spark: SparkSession, path: str, writer: str | None = None) -> None:
    """Give up the claim of ``writer``; by default anyone's, for a writer that has stopped for good."""
    for kind in (HOLDS, ASKS):
        for digest in _claims(spark, path, kind) if writer is None else [_digest(writer)]:
            files.remove(spark, path, f"{kind}{digest}")


@contextmanager
def sole_writer(spark: SparkSession, path: str, writer: str | None) -> Iterator[str]:
    """Hold the claim on a store as ``writer``, or for a while as a nameless one; gives the name.

    A nameless claim is given up in the end; only a driver that dies leaves it, for ``release_store``.
    """
    name = writer or f"call {uuid.uuid4().hex}"
    claim_store(spark, path, name)
    try:
        yield name
    finally:
        if not writer:
            release_store(spark, path, name)


def touched(batch: DataFrame, buckets: int) -> list[int]:
    """The buckets that a batch can meet: at most ``buckets`` numbers."""
    return [row[0] for row in batch.select(bucket_of(F.col("url"), buckets)).distinct().collect()]


def append_articles(fresh: DataFrame, path: str, buckets: int = BUCKETS, files_per_bucket: int = 1) -> None:
    """Add rows whose URLs the store does not have; the caller holds the claim."""
    versions = current_versions(fresh.sparkSession, path)
    _write(fresh, path, versions, buckets=buckets, files_per_bucket=files_per_bucket)


def rewrite_buckets(
    rows: DataFrame,
    path: str,
    numbers: Iterable[int],
    writer: str,
    buckets: int = BUCKETS,
    files_per_bucket: int = 1,
) -> None:
    """Put ``rows`` in place of the given buckets, all at once; ``writer`` has the claim, or nothing is switched."""
    spark = rows.sparkSession
    before = current_versions(spark, path)
    after = {**before, **{b: before.get(b, 0) + 1 for b in numbers}}
    _write(rows, path, after, buckets=buckets, files_per_bucket=files_per_bucket, mode="overwrite")
    _switch(spark, path, after, writer)
    for b in numbers:
        if after[b] >= 2:
            files.remove(spark, path, f"{BUCKET}={b}/{VERSION}={after[b] - 2}")


def insert_articles(
    batch: DataFrame,
    path: str,
    schema: T.StructType = ARTICLE,
    required: Sequence[str] = REQUIRED,
    buckets: int = BUCKETS,
    files_per_bucket: int = 1,
    writer: str | None = None,
    index_files: int = INDEX_FILES,
) -> int:
    """Append the unseen URLs of a batch; the number of effective writes.

    An empty batch, or one without the required columns, writes nothing and gives 0. The index of keys is asked
    once, and the batch is held, so that what is counted is what is written. ``index_files`` data files that
    the index does not cover are added to it.
    """
    if not set(required) <= set(batch.columns):
        return 0
    spark = batch.sparkSession
    with sole_writer(spark, path, writer):
        batch = batch.persist()
        known = known_urls(spark, path, batch, buckets).persist()
        try:
            saved = insert_counts(known, batch).first()["saved"]
            if saved:
                append_articles(insert_new(batch, known).select(*schema.fieldNames()), path, buckets, files_per_bucket)
                maintain(spark, path, index_files)
        finally:
            known.unpersist()
            batch.unpersist()
    return saved


def upsert_articles(
    batch: DataFrame,
    path: str,
    schema: T.StructType = ARTICLE,
    required: Sequence[str] = REQUIRED,
    buckets: int = BUCKETS,
    files_per_bucket: int = 1,
    writer: str | None = None,
) -> int:
    """Upsert a batch by URL; the number of effective writes. A bucket it touches is written once and switched."""
    if not set(required) <= set(batch.columns):
        return 0
    spark = batch.sparkSession
    with sole_writer(spark, path, writer) as name:
        batch, met = batch.persist(), None
        try:
            numbers = touched(batch, buckets)
            near = read_store(spark, path, schema, numbers)
            # At most one row for each URL of the batch: counted and matched without reading the buckets again.
            met = stored_matches(near, batch).persist()
            saved = upsert_counts(met, batch).first()["saved"]
            if saved:
                rows = upsert(near, batch, met=met).select(*schema.fieldNames())
                rewrite_buckets(rows, path, numbers, name, buckets, files_per_bucket)
        finally:
            if met is not None:
                met.unpersist()
            batch.unpersist()
    return saved


def compact_store(
    spark: SparkSession,
    path: str,
    schema: T.StructType = ARTICLE,
    only: Iterable[int] | None = None,
    buckets: int = BUCKETS,
    files_per_bucket: int = 1,
    writer: str | None = None,
) -> None:
    """Merge the many files of appended batches into ``files_per_bucket`` for each bucket, in order of date.

    ``only`` names the buckets, by default all of them. ``buckets`` must be what the store was written with.
    """
    with sole_writer(spark, path, writer) as name:
        rows = read_store(spark, path, schema, only)
        numbers = touched(rows, buckets)
        if numbers:
            rewrite_buckets(rows, path, numbers, name, buckets, files_per_bucket)


def repair_store(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    raw_col: str = "date_raw",
    date_col: str = "date",
    buckets: int = BUCKETS,
    files_per_bucket: int = 1,
    writer: str | None = None,
) -> int:
    """Turn stored dates that are still strings into timestamps; the number repaired.

    A first pass reads dates and URLs alone and finds the buckets that hold any; only these are rewritten, and
    switched at once. A repaired row loses its string; one that cannot be read keeps it and counts for nothing, so a
    second call repairs 0 and writes nothing. ``schema`` must have both columns.
    """
    with sole_writer(spark, path, writer) as name:
        rows = read_store(spark, path, schema)
        waiting = F.col(f"`{raw_col}`").isNotNull() & F.col("_before").isNull() & F.col(f"`{date_col}`").isNotNull()
        found = (
            repair_string_dates(rows.withColumn("_before", F.col(f"`{date_col}`")), raw_col, date_col)
            .where(waiting)
            .groupBy(bucket_of(F.col("url"), buckets).alias(BUCKET))
            .agg(F.count(F.lit(1)).alias("n"))
            .collect()
        )
        if not found:
            return 0
        numbers = [r[BUCKET] for r in found]
        near = read_store(spark, path, schema, numbers)
        fixed = repair_string_dates(near.withColumn("_before", F.col(f"`{date_col}`")), raw_col, date_col)
        kept = F.when(~waiting, F.col(f"`{raw_col}`"))
        rewrite_buckets(fixed.withColumn(raw_col, kept).select(*schema.fieldNames()), path, numbers, name, buckets, files_per_bucket)
    return sum(r["n"] for r in found)
