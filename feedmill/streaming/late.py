"""Dedupe of a stream within a horizon of event time, with the late rows put aside instead of dropped.

The bar of a micro-batch is the newest date of the batches before it less the horizon. It is known before the batch
is looked at, so late rows are told by a filter, wherever they lie, and never shuffled. Of the others one row per key and task is shuffled, and what
was let through before is dropped by an anti-join with the kept keys, which are forgotten a horizon after their date.
Every step writes under the number of its batch, so a batch that runs again after a failure adds nothing twice.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from feedmill.functions.columns import matches, prefixed
from feedmill.operators.clean import keep_one
from feedmill.session import use_utc
from feedmill.sources import files

POLL = "30 seconds"
NEWEST = "_newest."
AT = "_at"


@dataclass(frozen=True)
class Dedupe:
    """Where first copies, late rows and kept keys go; all folders belong in shared storage.

    ``horizon`` is an interval such as ``30 days``. Every ``fold`` batches the keys still needed become one folder.
    """

    out: str
    late: str
    state: str
    checkpoint: str
    horizon: str
    date_col: str = "date"
    keys: Sequence[str] = ("url",)
    fold: int = 16


def _newest(spark: SparkSession, job: Dedupe) -> dict[int, int]:
    """Newest date up to each of the last batches, in microseconds; none as long as no row had a date."""
    names = files.listed(spark, job.state, f"{NEWEST}*", rf"{NEWEST.replace('.', '[.]')}\d+[.]-?\d+")
    return {int(b): int(at) for b, at in (n.removeprefix(NEWEST).split(".") for n in names)}


def _whole(spark: SparkSession, job: Dedupe, kind: str) -> list[int]:
    done = files.listed(spark, job.state, f"{kind}=*/_SUCCESS", rf"{kind}=\d+(?=/_SUCCESS)")
    return sorted(int(name.split("=")[1]) for name in done)


def _kept_keys(found: DataFrame, job: Dedupe, before: int, bar: int | None) -> DataFrame:
    """Keys let through in earlier batches and not forgotten, with the microseconds until which each is kept."""
    spark = found.sparkSession
    folds = [f for f in _whole(spark, job, "fold") if f < before]
    after = folds[-1] if folds else -1
    folders = [f"{job.state}/fold={after}"] * bool(folds)
    folders += [f"{job.state}/batch={b}" for b in _whole(spark, job, "batch") if after < b < before]
    schema = found.select(*job.keys, F.lit(None).cast("long").alias(AT)).schema
    kept = spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)
    return kept if bar is None else kept.where(F.col(AT) > bar)


def _horizon(spark: SparkSession, job: Dedupe) -> int:
    length = F.unix_micros(F.expr(f"timestamp_micros(0) + interval {job.horizon}"))
    return spark.range(1).select(length).first()[0]


def _save_batch(job: Dedupe, found: DataFrame, batch_id: int) -> None:
    spark = found.sparkSession
    if batch_id in _whole(spark, job, "batch"):
        return
    length = _horizon(spark, job)
    newest = _newest(spark, job)
    before = [at for b, at in newest.items() if b < batch_id]
    bar = max(before) - length if before else None
    at = F.unix_micros(F.col(job.date_col).cast("timestamp"))
    is_late = F.lit(False) if bar is None else F.coalesce(at < bar, F.lit(False))
    found = found.persist()
    try:
        here = found.agg(F.max(at)).first()[0]
        top = max((t for t in (here, *before) if t is not None), default=None)
        if top is not None:
            files.put(spark, job.state, f"{NEWEST}{batch_id}.{top}", "")
        known = prefixed(_kept_keys(found, job, batch_id, bar), "_k_")
        first = keep_one(found.where(~is_late), list(job.keys), F.asc_nulls_last(job.date_col))
        fresh = first.join(known, matches(list(job.keys), "_k_"), "left_anti")
        fresh.write.mode("overwrite").parquet(f"{job.out}/batch={batch_id}")
        found.where(is_late).write.mode("overwrite").parquet(f"{job.late}/batch={batch_id}")
    finally:
        found.unpersist()
    # A row without a date counts from the newest date there is.
    default = 0 if top is None else top
    written = spark.read.schema(found.schema).parquet(f"{job.out}/batch={batch_id}")
    until = (F.coalesce(at, F.lit(default)) + length).alias(AT)
    written.select(*job.keys, until).sortWithinPartitions(*job.keys).write.mode("overwrite").parquet(f"{job.state}/batch={batch_id}")
    _forget(spark, job, found, batch_id, bar)


def _forget(spark: SparkSession, job: Dedupe, found: DataFrame, batch_id: int, bar: int | None) -> None:
    """Fold the keys still needed into one folder now and then; the fold before it stays until the next."""
    for b, at in _newest(spark, job).items():
        if b < batch_id - job.fold:
            files.remove(spark, job.state, f"{NEWEST}{b}.{at}")
    if (batch_id + 1) % job.fold:
        return
    kept = _kept_keys(found, job, batch_id + 1, bar)
    kept.groupBy(*job.keys).agg(F.max(AT).alias(AT)).write.mode("overwrite").parquet(f"{job.state}/fold={batch_id}")
    folds = [f for f in _whole(spark, job, "fold") if f < batch_id]
    if folds:
        old = [f"batch={b}" for b in _whole(spark, job, "batch") if b <= folds[-1]]
        for name in [*old, *(f"fold={f}" for f in folds[:-1])]:
            files.remove(spark, job.state, name)


def start_dedupe(rows: DataFrame, job: Dedupe, once: bool = False, poll: str = POLL) -> StreamingQuery:
    """Let a key of the stream ``rows`` through once within ``horizon`` of event time; late rows go to ``job.late``, whole.

    Of copies in one micro-batch the one with the oldest date passes, of equal dates any. A key is forgotten when the bar
    reaches its date plus the horizon. Rows without a date are never late; a null key is a key. Late rows are
    not compared with anything. One wrong date in the future still moves the bar for good, but what it makes late is kept.
    """
    use_utc(rows.sparkSession)
    writer = rows.writeStream.foreachBatch(lambda found, batch_id: _save_batch(job, found, batch_id)).option(
        "checkpointLocation", job.checkpoint
    )
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=poll)).start()
