"""Continuous and one-shot ingest of landed records into the store."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from feedmill.operators.clean import clean, keep_one
from feedmill.operators.store import insert_counts, insert_new, last_in_batch
from feedmill.schema import AGGREGATOR_RECORD, ARTICLE, ATOM_ENTRY, BOILERPLATE, RSS_ITEM, SEARCH_RECORD
from feedmill.session import use_utc
from feedmill.sources.files import exists
from feedmill.sources.keyindex import known_urls, maintain
from feedmill.sources.landing import (
    CORRUPT, atom_entries, feed_reader, readable, records, rejected, rss_items, with_arrival,
)
from feedmill.sources.normalize import normalize_aggregator, normalize_rss, normalize_search, to_articles
from feedmill.sources.parts import INDEX_FILES
from feedmill.sources.sink import BUCKETS, append_articles, claim_store

POLL = "30 seconds"
LANE = "_lane"
METRICS = T.StructType([T.StructField(n, T.LongType()) for n in ("found", "kept", "skipped", "saved")])


@dataclass(frozen=True)
class Ingest:
    """What an ingest reads and where it writes; all folders belong in shared storage.

    ``lane`` is ``search``, ``aggregator``, ``rss`` or ``atom``; the last two need the source registry.
    ``more`` holds further lanes, as (lane, landing folder): a store has one writer, so collectors that share
    a store are lanes of one ingest, not ingests of their own. Lines that cannot be read go to ``rejects``,
    where it is set.
    """

    landing: str
    store: str
    checkpoint: str
    metrics: str
    lane: str = "search"
    phrases: Sequence[str] = BOILERPLATE
    buckets: int = BUCKETS
    index_files: int = INDEX_FILES
    max_files: int = 1000
    more: Sequence[tuple[str, str]] = ()
    rejects: str | None = None

    def lanes(self) -> list[Ingest]:
        """One ingest for each lane, in the order in which a URL's copies win."""
        return [replace(self, more=()), *(replace(self, lane=lane, landing=path, more=()) for lane, path in self.more)]


def landed(spark: SparkSession, job: Ingest) -> DataFrame:
    """The landing folder as a stream of new files; of several lanes each in a struct of its own."""
    if job.more:
        lanes = [
            landed(spark, one).select(F.lit(i).alias(LANE), F.struct("*").alias(f"{LANE}{i}"))
            for i, one in enumerate(job.lanes())
        ]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), lanes)
    reader = spark.readStream.option("maxFilesPerTrigger", job.max_files)
    if job.lane == "rss":
        return rss_items(feed_reader(reader, "item", RSS_ITEM).load(job.landing))
    if job.lane == "atom":
        return atom_entries(feed_reader(reader, "entry", ATOM_ENTRY).load(job.landing))
    return records(reader.text(job.landing), {"search": SEARCH_RECORD, "aggregator": AGGREGATOR_RECORD}[job.lane])


def lane_records(found: DataFrame, job: Ingest) -> list[tuple[Ingest, DataFrame]]:
    """What was found, lane by lane."""
    if not job.more:
        return [(job, found)]
    return [(one, found.where(F.col(LANE) == i).select(f"{LANE}{i}.*")) for i, one in enumerate(job.lanes())]


def prepare(
    found: DataFrame,
    job: Ingest,
    registry: DataFrame | None = None,
    counters: list[Observation] | None = None,
    batch: int = 0,
) -> DataFrame:
    """The records of all lanes as the articles to save; unreadable lines are left out.

    API lanes are cleaned topic by topic; of a URL found under several topics the first topic's
    copy is kept, as topics are saved one after the other. Feed entries are saved as they come.
    Of a URL found in several lanes the copy of the first lane is kept. ``counters`` receives one observation
    of ``found`` for each lane, which the first run of the result fills. ``batch`` is the number of the micro-batch, from
    which records without an arrival number get theirs.
    """
    parts = []
    for i, (one, mine) in enumerate(lane_records(found, job)):
        mine = with_arrival(mine, batch=batch)
        if counters is not None:
            counters.append(Observation())
            mine = mine.observe(counters[-1], F.count(F.lit(1)).alias("found"))
        part = prepare_lane(mine, one, registry).select(*ARTICLE.fieldNames())
        parts.append(last_in_batch(part).withColumn(LANE, F.lit(i)) if job.more else part)
    return keep_one(reduce(DataFrame.unionByName, parts), ["url"], F.asc(LANE)).drop(LANE) if job.more else parts[0]


def prepare_lane(found: DataFrame, job: Ingest, registry: DataFrame | None = None) -> DataFrame:
    found = readable(found)
    if job.lane in ("rss", "atom"):
        return to_articles(normalize_rss(found, registry, F.current_timestamp()))
    if job.lane == "aggregator":
        articles = to_articles(normalize_aggregator(found, F.current_timestamp()))
    else:
        articles = to_articles(normalize_search(found))
    cleaned = clean(articles, job.phrases, batch_keys=["searchKey"])
    return keep_one(cleaned, ["url"], F.asc("ingest_seq"))


def _save_batch(job: Ingest, registry: DataFrame | None, found: DataFrame, batch_id: int) -> None:
    """Append the unseen URLs of one micro-batch, after noting its counts.

    The landing files are read once, and the index of stored keys is asked once. A stored URL is dropped by an exact anti-join, however long ago it came, so a batch that is
    run again after a failure adds nothing twice. Its counts are taken before the rows are
    written and are kept if they are there already, so they always tell what the batch found
    when it first came.
    """
    spark = found.sparkSession
    counters: list[Observation] = []
    batch = prepare(found, job, registry, counters, batch_id).persist()
    known = known_urls(spark, job.store, batch, job.buckets).persist()
    try:
        noted = f"{job.metrics}/batch={batch_id}"
        if not exists(spark, f"{noted}/_SUCCESS"):
            tally = insert_counts(known, batch).first()
            row = (sum(c.get["found"] for c in counters), tally["found"], tally["skipped"], tally["saved"])
            spark.createDataFrame([row], METRICS).coalesce(1).write.mode("overwrite").parquet(noted)
        if job.rejects:
            lines = [rejected(mine).withColumn("lane", F.lit(one.lane)) for one, mine in lane_records(found, job) if CORRUPT in mine.columns]
            if lines:
                reduce(DataFrame.unionByName, lines).write.mode("overwrite").parquet(f"{job.rejects}/batch={batch_id}")
        append_articles(insert_new(batch, known), job.store, job.buckets)
        maintain(spark, job.store, job.index_files)
    finally:
        known.unpersist()
        batch.unpersist()


def start_ingest(
    spark: SparkSession, job: Ingest, once: bool = False, registry: DataFrame | None = None, poll: str = POLL
) -> StreamingQuery:
    """Poll the landing folders for ever, or with ``once`` take what is there and stop.

    The job claims its store under the name of its checkpoint: a second job on the same store is an error.
    """
    use_utc(spark)
    claim_store(spark, job.store, job.checkpoint)
    writer = (
        landed(spark, job)
        .writeStream.foreachBatch(lambda found, batch_id: _save_batch(job, registry, found, batch_id))
        .option("checkpointLocation", job.checkpoint)
    )
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=poll)).start()


def ingest_metrics(spark: SparkSession, job: Ingest) -> DataFrame:
    """Per micro-batch: records found, kept by cleaning, skipped as known, saved."""
    whole = T.StructType([*METRICS.fields, T.StructField("batch", T.LongType())])
    if not exists(spark, job.metrics):
        return spark.createDataFrame([], whole)
    return spark.read.schema(whole).parquet(job.metrics)


def dedupe_stream(
    articles: DataFrame, horizon: str, date_col: str = "date", keys: Sequence[str] = ("url",), spread: int = 32
) -> DataFrame:
    """Bounded-state variant: a URL is let through once within ``horizon`` of event time.

    Rows whose date is more than ``horizon`` behind the newest date met so far are dropped, and one wrong date in the
    future moves that bar for good. ``start_ingest`` has no such bar.

    Copies are first thinned out in ``spread`` parts per URL, by the task that read them, so that
    a hot URL does not send all its rows to one task; at most ``spread`` of them meet in the end.
    """
    part = F.pmod(F.spark_partition_id(), F.lit(spread))
    thinned = (
        articles.withColumn("_part", part)
        .withWatermark(date_col, horizon)
        .dropDuplicatesWithinWatermark([*keys, "_part"])
        .drop("_part")
    )
    return thinned.dropDuplicatesWithinWatermark(list(keys))
