"""Ordered change logs folded into a keyed table.

Each log entry is a small function on "the row of this key, or its absence". Such functions
compose, and the composite has a fixed size, so a log is folded in levels: entries are combined
within runs of sequence numbers, the results within runs of runs, and so on. No task ever holds
more than one run of a key, however often that key changes.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.functions.columns import is_blank, matches, prefixed, strip_space

FAN_IN = 4096


@dataclass(frozen=True)
class Changes:
    """How a log's operations act on a table."""

    keys: tuple[str, ...]
    fields: tuple[str, ...]
    created: str
    defaults: Mapping[str, object] = field(default_factory=dict)
    # add on a present key: overwrite its fields, or leave it alone
    add_overwrites: bool = True
    # operation -> the columns it may set (null in the log means "not given")
    setters: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    trim_keys: bool = False


def _row(spec: Changes, values: Mapping[str, Column]) -> Column:
    names = (*spec.fields, "active", spec.created, "last_updated")
    return F.struct(*[values[n].alias(n) for n in names])


def _patched(spec: Changes, row: Column, patch: Column) -> Column:
    """``row`` with a patch applied; turns are 0 none, 1 odd, 2 even number of flips."""
    was = F.coalesce(row["active"], F.lit(True))
    active = (
        F.when(patch["active"].isNotNull(), patch["active"])
        .when(patch["turns"] == 1, ~was)
        .when(patch["turns"] == 2, was)
        .otherwise(row["active"])
    )
    values = {f: F.coalesce(patch[f], row[f]) for f in spec.fields}
    values |= {
        "active": active,
        spec.created: row[spec.created],
        "last_updated": F.coalesce(patch["last_updated"], row["last_updated"]),
    }
    return _row(spec, values)


def _merged(spec: Changes, one: Column, two: Column) -> Column:
    """The patch that acts like ``one`` and then ``two``."""
    was = one["active"]
    active = (
        F.when(two["active"].isNotNull(), two["active"]).when(two["turns"] == 1, ~was).otherwise(was)
    )
    both = F.when((one["turns"] + two["turns"]) % 2 == 1, 1).otherwise(2)
    turns = (
        F.when(active.isNotNull(), 0)
        .when(two["turns"] == 0, one["turns"])
        .when(one["turns"] == 0, two["turns"])
        .otherwise(both)
    )
    return F.struct(
        *[F.coalesce(two[f], one[f]).alias(f) for f in spec.fields],
        active.alias("active"),
        turns.alias("turns"),
        F.coalesce(two["last_updated"], one["last_updated"]).alias("last_updated"),
    )


def _act(spec: Changes, step: Column, row: Column) -> Column:
    """Result of a step on a present row (null = gone)."""
    return F.when(step["settled"], step["present"]).otherwise(_patched(spec, row, step["patch"]))


def _then(spec: Changes, one: Column, two: Column) -> Column:
    """The step that acts like ``one`` and then ``two``."""
    absent = F.when(one["absent"].isNull(), two["absent"]).otherwise(_act(spec, two, one["absent"]))
    present = (
        F.when(one["settled"] & one["present"].isNull(), two["absent"])
        .when(one["settled"], _act(spec, two, one["present"]))
        .when(two["settled"], two["present"])
    )
    return F.struct(
        (one["settled"] | two["settled"]).alias("settled"),
        present.alias("present"),
        absent.alias("absent"),
        _merged(spec, one["patch"], two["patch"]).alias("patch"),
    )


def _step(spec: Changes, table: DataFrame) -> Column:
    """A log entry as a step: ``settled`` once the result no longer hangs on the row before,
    which is then ``present``; ``absent`` is the result for an absent key."""
    op = F.col("op")
    types = {n: table.schema[n].dataType for n in (*spec.fields, "active", spec.created, "last_updated")}
    stamp = F.col("ts").cast(types["last_updated"])
    added = {f: F.coalesce(F.col(f), F.lit(spec.defaults.get(f))).cast(types[f]) for f in spec.fields}
    added["active"] = F.coalesce(F.col("active"), F.lit(True))
    row = _row(spec, {**added, spec.created: F.col("ts").cast(types[spec.created]), "last_updated": stamp})
    none = F.lit(None)

    def given(name: str) -> Column:
        value = F.when(op.isin([o for o, cols in spec.setters.items() if name in cols]), F.col(name))
        if spec.add_overwrites:
            value = F.when(op == "add", added[name]).otherwise(value)
        return value.cast(types[name])

    active = given("active")
    active = F.when(op == "toggle", F.col("active")).otherwise(active)
    touching = ["toggle", *spec.setters] + (["add"] if spec.add_overwrites else [])
    patch = F.struct(
        *[given(f).alias(f) for f in spec.fields],
        active.alias("active"),
        F.when((op == "toggle") & F.col("active").isNull(), 1).otherwise(0).alias("turns"),
        F.when(op.isin(touching), stamp).otherwise(none).alias("last_updated"),
    )
    gone = F.when(F.lit(False), row)
    return F.struct(
        (op == "remove").alias("settled"),
        gone.alias("present"),
        F.when(op == "add", row).alias("absent"),
        patch.alias("patch"),
    )


def apply_changes(table: DataFrame, changes: DataFrame, spec: Changes, fan_in: int = FAN_IN) -> DataFrame:
    """``table`` after the log ``changes`` (``seq, op, keys…, fields…, active, ts``)."""
    keys = list(spec.keys)
    if spec.trim_keys:
        changes = changes.withColumns({k: strip_space(F.col(k)) for k in keys})
        table = table.withColumns({k: strip_space(F.col(k)) for k in keys})
    for key in keys:
        changes = changes.where(~is_blank(F.col(key)))

    low, high = changes.agg(F.min("seq"), F.max("seq")).first()
    if low is None:
        return table
    nodes = changes.select(*keys, (F.col("seq") - low).alias("_at"), _step(spec, table).alias("_step"))
    width = high - low + 1
    while True:
        width = -(-width // fan_in)
        entries = F.array_sort(F.collect_list(F.struct("_at", "_step")))
        nodes = nodes.groupBy(*keys, F.expr(f"_at div {fan_in}").alias("_run")).agg(entries.alias("_entries"))
        steps = F.transform("_entries", lambda e: e["_step"])
        folded = F.aggregate(
            F.slice(steps, F.lit(2), F.size(steps)), F.get(steps, F.lit(0)), lambda a, b: _then(spec, a, b)
        )
        nodes = nodes.select(*keys, F.col("_run").alias("_at"), folded.alias("_step"))
        if width <= 1:
            break

    steps = prefixed(nodes.drop("_at"), "_c_")
    held = table.withColumn("_held", F.lit(True))
    both = held.join(steps, matches(keys, "_c_"), "full_outer")
    now = _row(spec, {n: F.col(n) for n in (*spec.fields, "active", spec.created, "last_updated")})
    step = F.col("_c__step")
    outcome = (
        F.when(step.isNull(), now)
        .when(F.col("_held"), _act(spec, step, now))
        .otherwise(step["absent"])
    )
    merged = both.withColumn("_row", outcome).where(F.col("_row").isNotNull())
    carried = {n: F.col("_row")[n] for n in (*spec.fields, "active", spec.created, "last_updated")}
    carried |= {k: F.coalesce(F.col(k), F.col(f"_c_{k}")) for k in keys}
    return merged.select(*[carried.get(c, F.col(c)).alias(c) for c in table.columns])
