"""Readers for landed feed files. Schemas are given, never inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedmill.schema import AGGREGATOR_RECORD, ATOM_ENTRY, RSS_ITEM, SEARCH_RECORD

CORRUPT = "_corrupt_record"
#: Where a record was read: its file's time, its file, and the part of the file that one task reads.
SPOT = "_spot"
#: Numbers that a batch has to itself.
BATCH_SPAN = 1 << 40


def _spot() -> Column:
    fields = ("file_modification_time", "file_path", "file_block_start")
    return F.struct(*[F.col(f"_metadata.{f}").alias(f) for f in fields]).alias(SPOT)


def records(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """JSON lines (``value``) as records of ``schema``.

    Keys the schema lacks are kept in ``extra``; a line that cannot be read is kept apart in
    ``_corrupt_record``, blank lines are none. ``_spot`` tells ``with_arrival`` where a line was read.
    """
    whole = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    record = F.from_json("value", whole, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    every = F.from_json("value", T.MapType(T.StringType(), T.StringType()))
    extra = F.map_filter(every, lambda k, _: ~k.isin(schema.fieldNames()))
    filled = lines.where(F.trim("value") != "")
    return filled.select(record.alias("r"), F.when(F.size(extra) > 0, extra).alias("extra"), _spot()).select(
        "r.*", "extra", SPOT
    )


def read_search(spark: SparkSession, path: str) -> DataFrame:
    return records(spark.read.text(path), SEARCH_RECORD)


def read_aggregator(spark: SparkSession, path: str) -> DataFrame:
    return records(spark.read.text(path), AGGREGATOR_RECORD)


def readable(df: DataFrame) -> DataFrame:
    """Records without the lines that could not be read."""
    return df.where(F.col(CORRUPT).isNull()).drop(CORRUPT) if CORRUPT in df.columns else df


def rejected(df: DataFrame) -> DataFrame:
    """The lines that could not be read, as ``line``."""
    return df.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("line"))


def _feed() -> Column:
    """Feed address from a folder ``feed=…``: URL-encoded there, and once more as a file path."""
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"/feed=([^/]+)/", 1)
    return F.url_decode(F.url_decode(folder)).alias("RSS")


def rss_items(raw: DataFrame) -> DataFrame:
    """RSS <item> rows under feed parser names; a permanent guid stands in for a missing link."""
    lasting = F.coalesce(F.lower("guid._isPermaLink"), F.lit("true")) == "true"
    return raw.select(
        F.coalesce("link", F.when(lasting, F.col("guid._VALUE"))).alias("link"),
        F.col("title"),
        F.coalesce("description", "encoded").alias("summary"),
        F.col("pubDate").alias("published"),
        _feed(),
        _spot(),
    )


def atom_entries(raw: DataFrame) -> DataFrame:
    """Atom <entry> rows under the same names; of several links the alternate one counts."""
    alternate = F.filter("link", lambda l: F.coalesce(l["_rel"], F.lit("alternate")) == "alternate")
    return raw.select(
        F.get(alternate, F.lit(0))["_href"].alias("link"),
        F.col("title"),
        F.coalesce("summary", "content").alias("summary"),
        F.col("published"),
        _feed(),
        _spot(),
    )


def feed_reader(reader, row_tag: str, schema: T.StructType):
    """A batch or stream reader of feed XML."""
    return (
        reader.format("xml")
        .option("rowTag", row_tag)
        .option("mode", "PERMISSIVE")
        .option("ignoreNamespace", "true")
        .option("recursiveFileLookup", "true")
        .schema(schema)
    )


def read_rss(spark: SparkSession, path: str) -> DataFrame:
    """RSS items below ``path``, one row per <item>."""
    return with_arrival(rss_items(feed_reader(spark.read, "item", RSS_ITEM).load(path)))


def read_atom(spark: SparkSession, path: str) -> DataFrame:
    """Atom entries below ``path``, one row per <entry>."""
    return with_arrival(atom_entries(feed_reader(spark.read, "entry", ATOM_ENTRY).load(path)))


def with_arrival(df: DataFrame, seq_col: str = "ingest_seq", batch: int = 0) -> DataFrame:
    """Arrival numbers where the records bring none: in order of batch, file time, file, and place in the file.

    The order is total and does not depend on which task reads what, so a batch that runs again gets the same numbers.
    They come after the largest number that a record of the batch brings. Rows of one part of a file are read by one
    task in order, which gives their places; only counts, one row for each part, are added up over the parts.
    Records without ``_spot`` get numbers that are unique and rise within a task.
    """
    made = F.monotonically_increasing_id()
    if SPOT not in df.columns:
        return df.withColumn(seq_col, F.coalesce(seq_col, made) if seq_col in df.columns else made)
    own = F.col(seq_col) if seq_col in df.columns else F.lit(None).cast("long")
    placed = df.withColumn("_at", made)
    parts = placed.groupBy(SPOT).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"), F.max(own).alias("_own")
    )
    whole = Window.partitionBy()
    before = F.sum("_n").over(whole.orderBy(SPOT).rowsBetween(Window.unboundedPreceding, -1))
    start = F.greatest(F.lit(batch * BATCH_SPAN), F.coalesce(F.max("_own").over(whole), F.lit(-1)) + 1)
    shifts = parts.select(SPOT, (start + F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"))
    # At most one row a task of the scan.
    numbered = placed.join(F.broadcast(shifts), SPOT, "left")
    return numbered.withColumn(seq_col, F.coalesce(own, F.col("_at") + F.col("_shift"))).drop(SPOT, "_at", "_shift")


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    """Log lines ``asctime - LEVEL - message`` with their file's name and line order.

    ``wholetext`` is not used: files stay splittable. ``line_no`` follows the byte order of the
    file's splits, which is what the tail needs.
    """
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.log$", 1)
    raw = spark.read.text(path).where(name != "")
    return raw.select(
        name.alias("log"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line_no"),
        F.col("value").alias("line"),
        F.try_to_timestamp(F.substring("value", 1, 19), F.lit("yyyy-MM-dd HH:mm:ss")).alias("logged_at"),
    )
