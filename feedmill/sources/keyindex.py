"""An index of the stored URLs, so that a batch is checked without reading the URLs of all it could meet.

A key is the first 16 bytes of the SHA-256 of a URL. Keys lie in parts (``parts``) by bucket and sorted, in small row
groups with a bloom filter in the footer. The keys of a small batch are pushed down to the scan, so row groups
whose range or bloom filter excludes them are never read; a larger batch meets the keys in a semi-join, 16 bytes a
stored URL. Files that no part covers give their URLs. URLs never leave the store, so a key never gets wrong.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmill.sources.parts import BUCKET, extend, state, stored_files, uncovered

KEYS = "keys"
KEY_BYTES = 16
#: Keys of a batch that are pushed down as literals; a larger batch is joined.
LITERALS = 1000
ROW_GROUP_BYTES = 1 << 20
IN_THRESHOLD = "spark.sql.parquet.pushdown.inFilterThreshold"


def bucket_of(key: Column, buckets: int) -> Column:
    """Bucket of a key; a null key hashes like any other."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def key_of(url: Column) -> Column:
    """Key of a URL; that of a null URL, which is one key too, is empty."""
    digest = F.unhex(F.substring(F.sha2(url, 256), 1, 2 * KEY_BYTES))
    return F.when(url.isNull(), F.lit(b"")).otherwise(digest)


def _entries(spark: SparkSession, places: list[str]) -> DataFrame:
    """Keys of data files, with the buckets that the files lie in."""
    bucket = F.regexp_extract("_metadata.file_path", rf"/{BUCKET}=(\d+)/", 1).cast("int")
    return spark.read.schema("url string").parquet(*places).select(key_of(F.col("url")).alias("key"), bucket.alias(BUCKET))


def _write(entries: DataFrame, place: str) -> None:
    (
        entries.repartition(F.col(BUCKET))
        .sortWithinPartitions(BUCKET, "key")
        .write.partitionBy(BUCKET)
        .option("parquet.block.size", ROW_GROUP_BYTES)
        .option("parquet.bloom.filter.enabled#key", "true")
        .option("parquet.bloom.filter.expected.ndv#key", ROW_GROUP_BYTES // KEY_BYTES)
        .parquet(place)
    )


def maintain(spark: SparkSession, path: str, at_least: int = 1) -> bool:
    """Cover the data files that no part covers, if there are ``at_least`` so many; whether it did."""
    return extend(spark, path, KEYS, lambda places: _entries(spark, places), _write, at_least)


def push_down_lists(spark: SparkSession) -> None:
    """Lists of up to ``LITERALS`` values reach the scan value by value, unless the session says how many."""
    if spark.conf.get(IN_THRESHOLD) == "10":
        spark.conf.set(IN_THRESHOLD, str(LITERALS))


def known_urls(spark: SparkSession, path: str, batch: DataFrame, buckets: int, literals: int = LITERALS) -> DataFrame:
    """The URLs of a batch (``url``) that the store has; a null URL is one as any other.

    The batch should be held by the caller, as its URLs are looked at more than once.
    """
    url = F.col("url")
    wanted = batch.select("url").distinct().select("url", key_of(url).alias("key"), bucket_of(url, buckets).alias(BUCKET))
    met = {r[BUCKET]: r["n"] for r in wanted.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("n")).collect()}
    none = wanted.select("url").limit(0)
    if not met:
        return none
    root, stored = path.rstrip("/"), stored_files(spark, path)
    _, parts = state(spark, f"{root}/{KEYS}")
    places = [f"{root}/{KEYS}/{p['name']}/{BUCKET}={b}" for p in parts for b in p["buckets"] if b in met]
    loose = [f"{root}/{f}" for b, names in uncovered(stored, parts).items() if b in met for f in names]
    asked = wanted.select("url", "key").collect() if sum(met.values()) <= literals else None
    if asked is not None:
        push_down_lists(spark)
    found = []
    if places:
        keys = spark.read.schema("key binary").parquet(*places)
        found.append(keys if asked is None else keys.where(F.col("key").isin([bytes(r["key"]) for r in asked])))
    if loose:
        urls = spark.read.schema("url string").parquet(*loose)
        if asked is not None:
            named = url.isin([r["url"] for r in asked if r["url"] is not None])
            urls = urls.where(named | url.isNull() if any(r["url"] is None for r in asked) else named)
        found.append(urls.select(key_of(url).alias("key")))
    if not found:
        return none
    keys = reduce(DataFrame.unionByName, found).join(wanted.select("key"), "key", "left_semi").distinct()
    return wanted.join(keys, "key", "left_semi").select("url")
