"""Health of growing logs from kept states: each batch reads its new lines only.

Every micro-batch writes one row per log that it touches, of bounded length, under ``batch=<number>``; every ``fold`` batches all states so far become
one, under ``fold=<number>``. A reader takes the newest whole fold and the batches after it. A batch that runs again after a failure
writes its own state anew unless that is whole, so no line counts twice and no reader loses a file.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from feedmill.operators.health import merge_tails, tail_state
from feedmill.session import use_utc
from feedmill.sources import files

POLL = "30 seconds"


@dataclass(frozen=True)
class LogTails:
    """Where pieces of logs land, as files of JSON lines, and where their states are kept; all in shared storage.

    ``schema`` tells the columns of a landed line: ``key``, those of ``order``, ``text`` and ``time_col``. A file is one
    piece, whole when it appears; pieces may come in any order, as ``order`` decides which lines are the last ``n``.
    """

    landing: str
    state: str
    checkpoint: str
    schema: str
    key: str = "log"
    order: Sequence[str] = ("line_no",)
    text: str = "line"
    time_col: str | None = "logged_at"
    n: int = 10
    fold: int = 16
    max_files: int = 1000


def _state(lines: DataFrame, job: LogTails) -> DataFrame:
    return tail_state(lines, job.key, job.order, job.text, job.time_col, job.n)


def _whole(spark: SparkSession, job: LogTails, kind: str) -> list[int]:
    done = files.listed(spark, job.state, f"{kind}=*/_SUCCESS", rf"{kind}=\d+(?=/_SUCCESS)")
    return sorted(int(name.split("=")[1]) for name in done)


def _states(spark: SparkSession, job: LogTails, until: int | None = None) -> DataFrame:
    """States up to a batch: the newest fold before it, and what came after that fold."""
    folds = [f for f in _whole(spark, job, "fold") if until is None or f < until]
    after = folds[-1] if folds else -1
    batches = [b for b in _whole(spark, job, "batch") if b > after and (until is None or b <= until)]
    schema = _state(spark.createDataFrame([], T.StructType.fromDDL(job.schema)), job).schema
    folders = [f"{job.state}/fold={after}"] * bool(folds) + [f"{job.state}/batch={b}" for b in batches]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def _save_batch(job: LogTails, lines: DataFrame, batch_id: int) -> None:
    spark = lines.sparkSession
    if batch_id not in _whole(spark, job, "batch"):
        _state(lines, job).write.mode("overwrite").parquet(f"{job.state}/batch={batch_id}")
    if (batch_id + 1) % job.fold or batch_id in _whole(spark, job, "fold"):
        return
    merged = merge_tails(_states(spark, job, batch_id), job.key, job.n)
    merged.write.mode("overwrite").parquet(f"{job.state}/fold={batch_id}")
    # What the fold before this one holds is not needed any more; the rest stays for readers that are still at it.
    before = [f for f in _whole(spark, job, "fold") if f < batch_id]
    if before:
        old = [f"batch={b}" for b in _whole(spark, job, "batch") if b <= before[-1]]
        for name in [*old, *(f"fold={f}" for f in before[:-1])]:
            files.remove(spark, job.state, name)


def start_tails(spark: SparkSession, job: LogTails, once: bool = False, poll: str = POLL) -> StreamingQuery:
    """Poll the landing folder for ever, or with ``once`` take what is there and stop."""
    use_utc(spark)
    lines = spark.readStream.schema(job.schema).option("maxFilesPerTrigger", job.max_files).json(job.landing)
    writer = lines.writeStream.foreachBatch(lambda found, batch_id: _save_batch(job, found, batch_id)).option(
        "checkpointLocation", job.checkpoint
    )
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=poll)).start()


def read_tails(spark: SparkSession, job: LogTails) -> DataFrame:
    """One state per log; ``operators.health.state_health`` makes status records of them."""
    return merge_tails(_states(spark, job), job.key, job.n)
