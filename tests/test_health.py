from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from feedmill.operators import health as H
from feedmill.operators import stats as M

AS_OF = "2024-01-31 00:00:00"


def test_stats(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "url string")
    assert M.article_count(df).first()[0] == 5
    assert M.unique_urls(df).first()[0] == 3  # missing URLs are one group
    assert tuple(M.duplication_report(df).first()) == (5, 3, 2, 40.0, 60.0)
    empty = df.limit(0)
    assert M.unique_urls(empty).first()[0] == 0
    assert tuple(M.duplication_report(empty).first()) == (0, 0, 0, None, None)


def test_tail(spark):
    lines = [("hot", i, f"line {i}" + (" ERROR" if i == 980 else "")) for i in range(1000)]
    lines += [("short", i, "error" if i else None) for i in range(3)]
    df = spark.createDataFrame(lines, "log string, n int, line string")
    ten = {r.log: r for r in H.tail_health(df, "log", "n").collect()}
    assert ten["hot"].last_lines == [f"line {i}" for i in range(990, 1000)] and not ten["hot"].has_errors
    assert ten["short"].last_lines == [None, "error", "error"] and not ten["short"].has_errors
    assert {r.log: r.has_errors for r in H.tail_health(df, "log", "n", n=20).collect()} == {"hot": True, "short": False}


def test_status_and_staleness(spark):
    df = spark.createDataFrame(
        [("a", 1, "xé", datetime(2024, 1, 30, 23, 0)), ("a", 2, "y ERROR", datetime(2024, 1, 30, 23, 57, 1))],
        "log string, n int, line string, at timestamp",
    )
    row = H.log_status(df, "log", "n", "at").first()
    assert (row["size"], row.lines, row.has_errors, row.last_lines) == (12, 2, True, ["xé", "y ERROR"])
    assert H.staleness(df, "log", "at", AS_OF).first().minutes_ago == 2
    assert H.staleness(df, "log", "at", "2024-01-31 00:00:00.9").first().minutes_ago == 2
    assert H.staleness(df, "log", "at", "2024-01-31 00:00:01").first().minutes_ago == 3


def test_uptime_and_runs(spark):
    cases = {0: "0s", 59: "59s", 60: "1m", 3600: "1h", 86400: "1d", 93784: "1d 2h 3m 4s", 86460: "1d 1m", -1: "-1d 23h 59m 59s"}
    df = spark.createDataFrame([(s,) for s in cases] + [(None,)], "s long").select("s", H.uptime(F.col("s")).alias("u"))
    assert {r.s: r.u for r in df.collect()} == {**cases, None: "unknown"}

    runs = spark.createDataFrame(
        [("a", "2024-01-29T22:00:00", "2024-01-30T23:59:00"), ("a", "2024-01-01T00:00:00", "2024-01-30T23:59:59"),
         ("d", "2024-01-30T23:58:00.5", "2024-01-30T23:55:00"),
         ("b", "bad", "2024-01-30T10:00:00"), ("c", None, None)],
        "script string, start_time string, last_active string",
    )
    got = {r.script: (r.status, r.uptime) for r in H.run_status(runs, AS_OF).collect()}
    assert got == {"a": ("RUNNING", "1d 2h"), "d": ("RUNNING", "1m 59s"), "b": ("STOPPED", "unknown"), "c": ("STOPPED", "unknown")}


def test_kept_tails_equal_those_of_whole_logs(spark, tmp_path):
    from feedmill.streaming.tails import LogTails, _save_batch, read_tails, start_tails

    schema = "log string, line_no long, line string, logged_at timestamp"
    job = LogTails(*[str(tmp_path / name) for name in ("landing", "state", "checkpoint")], schema, n=5, fold=3)
    lines = [("hot", i, f"line {i}" + (" ERROR" if i == 990 else ""), datetime(2024, 1, 1, 0, i // 60, i % 60)) for i in range(1000)]
    lines += [("short", 1, None, None), (None, 2, "no name ERROR", None), (None, 2, "twice", None), ("hot", None, "no place", None)]
    assert read_tails(spark, job).count() == 0
    for wave in range(8):
        # Out of order, with a log that fills every wave and one that comes once.
        spark.createDataFrame(lines[7 - wave :: 8], schema).coalesce(1).write.mode("append").json(job.landing)
        start_tails(spark, job, once=True).awaitTermination()
    want = {r.log: r for r in H.log_status(spark.createDataFrame([x for x in lines if x[0]], schema), "log", "line_no", "logged_at", n=5).collect()}
    states = read_tails(spark, job)
    got = {r.log: r for r in H.state_health(states).collect()}
    for log in ("hot", "short"):
        assert got[log].asDict() == want[log].asDict()
    assert not got["hot"].has_errors and got["hot"].last_lines[-1] == "line 999" and got["hot"].lines == 1001
    assert got[None].has_errors and got[None].last_lines == ["no name ERROR", "twice"] and got[None].lines == 2
    assert {p.name for p in (tmp_path / "state").iterdir()} == {"fold=2", "fold=5", *(f"batch={b}" for b in (3, 4, 5, 6, 7))}
    # The last batch once more, after a failure before and after its state was whole: nothing counts twice.
    kept = sorted(map(repr, states.collect()))
    for lost in (False, True):
        if lost:
            (tmp_path / "state" / "batch=7" / "_SUCCESS").unlink()
            assert sorted(map(repr, read_tails(spark, job).collect())) != kept
        _save_batch(job, spark.createDataFrame(lines[0::8], schema), 7)
        assert sorted(map(repr, read_tails(spark, job).collect())) == kept
