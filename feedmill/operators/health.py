"""Health of keyed logs and runs."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedmill.functions.columns import matches, prefixed, time_literal
from feedmill.operators.clean import keep_one


def tail_health(
    lines: DataFrame,
    key: str,
    order: Sequence[str] | str,
    text: str = "line",
    n: int = 10,
    marker: str = "ERROR",
) -> DataFrame:
    """Per log: its last ``n`` lines in order and whether any has the (case-sensitive) marker.

    Only n lines per log and task are shuffled, and only n are ever collected.
    """
    order = [order] if isinstance(order, str) else list(order)
    newest = Window.partitionBy(key).orderBy(*[F.desc(c) for c in order])
    tail = lines.select(key, *order, text, F.row_number().over(newest).alias("_back")).where(F.col("_back") <= n)
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("_back")).alias("at"), F.col(text).alias("line"))))
    return tail.groupBy(key).agg(
        F.bool_or(F.coalesce(F.col(text).contains(marker), F.lit(False))).alias("has_errors"),
        F.transform(ordered, lambda e: e["line"]).alias("last_lines"),
    )


def log_sizes(lines: DataFrame, key: str, text: str = "line", time_col: str | None = None) -> DataFrame:
    """Per log: lines, bytes (with line ends) and, if known, when it was last written."""
    aggs = [
        F.count(F.lit(1)).alias("lines"),
        F.sum(F.octet_length(text) + 1).cast("long").alias("size"),
    ]
    if time_col:
        aggs.append(F.max(time_col).alias("last_modified"))
    return lines.groupBy(key).agg(*aggs)


def log_status(
    lines: DataFrame,
    key: str,
    order: Sequence[str] | str,
    time_col: str,
    text: str = "line",
    n: int = 10,
    marker: str = "ERROR",
) -> DataFrame:
    """The status record of each log: size, last write, tail and error flag."""
    return log_sizes(lines, key, text, time_col).join(tail_health(lines, key, order, text, n, marker), key)


def tail_state(
    lines: DataFrame, key: str, order: Sequence[str] | str, text: str = "line", time_col: str | None = None, n: int = 10
) -> DataFrame:
    """Per log what is worth keeping of these lines: lines, size, last write and the last ``n``, with their order.

    States of parts of a log are put together by ``merge_tails``. Lines of one place are told apart by their text, so the
    result does not depend on which task read them. A null key is a log like any other.
    """
    order = [order] if isinstance(order, str) else list(order)
    newest = Window.partitionBy(key).orderBy(*[F.desc(c) for c in (*order, text)])
    last = lines.select(key, *order, text, F.row_number().over(newest).alias("_back")).where(F.col("_back") <= n)
    entry = F.struct(*[F.col(c).alias(f"at{i}") for i, c in enumerate(order)], F.col(text).alias("line"))
    tails = last.groupBy(key).agg(F.sort_array(F.collect_list(entry)).alias("tail"))
    sizes = log_sizes(lines, key, text, time_col)
    return sizes.join(prefixed(tails, "_t_"), matches([key], "_t_")).select(*sizes.columns, F.col("_t_tail").alias("tail"))


def merge_tails(states: DataFrame, key: str, n: int = 10) -> DataFrame:
    """States of parts of logs as one state per log; a group has as many rows as parts, of at most ``n`` lines each."""
    newest = F.sort_array(F.flatten(F.collect_list("tail")), asc=False)
    aggs = [F.sum("lines").alias("lines"), F.sum("size").alias("size")]
    if "last_modified" in states.columns:
        aggs.append(F.max("last_modified").alias("last_modified"))
    return states.groupBy(key).agg(*aggs, F.reverse(F.slice(newest, 1, n)).alias("tail"))


def state_health(states: DataFrame, marker: str = "ERROR") -> DataFrame:
    """Per log the status record that ``log_status`` gives, from kept states."""
    rest = [c for c in states.columns if c != "tail"]
    marked = F.exists("tail", lambda e: F.coalesce(e["line"].contains(marker), F.lit(False)))
    return states.select(*rest, marked.alias("has_errors"), F.transform("tail", lambda e: e["line"]).alias("last_lines"))


def _seconds_between(then: Column, now: Column) -> Column:
    """Whole seconds, rounded down; both instants may have fractions."""
    micros = F.unix_micros(now.cast("timestamp")) - F.unix_micros(then.cast("timestamp"))
    return F.floor(micros / 1_000_000)


def staleness(lines: DataFrame, key: str, time_col: str, as_of: datetime | str, text: str = "line") -> DataFrame:
    """Per log: size, last write and whole minutes since then."""
    age = _seconds_between(F.col("last_modified"), time_literal(lines, time_col, as_of))
    return log_sizes(lines, key, text, time_col).withColumn("minutes_ago", F.floor(age / 60))


def uptime(seconds: Column) -> Column:
    """``1d 2h 3m 4s`` without zero parts; ``0s`` if all are zero; ``unknown`` for null."""
    days = F.floor(seconds / 86400)
    rest = F.pmod(seconds, F.lit(86400))
    parts = [
        (days, "d"),
        (F.floor(rest / 3600), "h"),
        (F.floor(F.pmod(rest, F.lit(3600)) / 60), "m"),
        (F.pmod(rest, F.lit(60)), "s"),
    ]
    shown = F.concat_ws(" ", *[F.when(v != 0, F.concat(v.cast("string"), F.lit(u))) for v, u in parts])
    return F.when(seconds.isNull(), "unknown").when(shown == "", "0s").otherwise(shown)


def run_status(
    runs: DataFrame,
    as_of: datetime | str,
    key: str = "script",
    start_col: str = "start_time",
    active_col: str = "last_active",
    alive_minutes: int = 5,
) -> DataFrame:
    """Latest run per script with its label and uptime.

    A script is RUNNING while its last sign of life is at most ``alive_minutes`` old. Start
    times may be ISO strings; one that cannot be read leaves the uptime unknown.
    """
    names = list(dict.fromkeys([key, start_col, active_col]))
    seen = runs.select(*names)
    start, active = F.col(start_col).try_cast("timestamp"), F.col(active_col).try_cast("timestamp")
    now = F.lit(str(as_of)).cast("timestamp")
    latest = keep_one(seen, [key], start.desc_nulls_last(), active.desc_nulls_last())
    alive = F.coalesce(_seconds_between(active, now) <= alive_minutes * 60, F.lit(False))
    return latest.select(
        *names,
        F.when(alive, "RUNNING").otherwise("STOPPED").alias("status"),
        uptime(_seconds_between(start, now)).alias("uptime"),
    )
