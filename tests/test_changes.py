"""Change logs against a one-by-one replay."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest

from feedmill.operators import registry as R
from feedmill.operators import topics as T
from feedmill.schema import SOURCE, SOURCE_CHANGE, TOPIC, TOPIC_CHANGE

START = datetime(2024, 1, 1)


def at(n):
    return START + timedelta(minutes=n)


def replay_topics(table, log):
    docs = {q.strip(): dict(category=c, priority=p, active=a, created=cr, last_updated=u) for q, c, p, a, cr, u in table}
    for seq, op, query, category, priority, active, ts in sorted(log):
        key = (query or "").strip()
        if not key:
            continue
        if op == "add":
            new = dict(category=category or "general", priority=5 if priority is None else priority,
                       active=True if active is None else active, last_updated=ts)
            docs.setdefault(key, {"created": ts}).update(new)
        elif op == "remove":
            docs.pop(key, None)
        elif key in docs:
            doc = docs[key]
            if op == "toggle":
                doc["active"] = (not (True if doc["active"] is None else doc["active"])) if active is None else active
            elif op == "set_priority":
                doc["priority"] = priority
            elif op == "set_category":
                doc["category"] = category
            doc["last_updated"] = ts
    return {k: (d["category"], d["priority"], d["active"], d["created"], d["last_updated"]) for k, d in docs.items()}


def replay_sources(table, log):
    docs = {(s, r): dict(source=n, active=a, category=c, added=ad, updated=u) for s, r, n, a, c, ad, u in table}
    for seq, op, site, rss, name, category, active, ts in sorted(log):
        key = (site, rss)
        if op == "add":
            docs.setdefault(key, dict(source=name, active=True if active is None else active,
                                      category=category or "general", added=ts, updated=ts))
        elif op == "remove":
            docs.pop(key, None)
        elif key in docs:
            doc = docs[key]
            if op == "toggle":
                doc["active"] = (not (True if doc["active"] is None else doc["active"])) if active is None else active
            elif op == "update":
                given = dict(source=name, category=category, active=active)
                doc.update({k: v for k, v in given.items() if v is not None})
            doc["updated"] = ts
    return {k: (d["source"], d["active"], d["category"], d["added"], d["updated"]) for k, d in docs.items()}


def topic_rows(df):
    return {r.query: (r.category, r.priority, r.active, r.created, r.last_updated) for r in df.collect()}


def source_rows(df):
    return {(r.site, r.RSS): (r.source, r.active, r.category, r.added_date, r.last_updated) for r in df.collect()}


@pytest.mark.parametrize("fan_in", [2, 16, 4096])
def test_topics_random_log_with_a_hot_key(spark, fan_in):
    rng = random.Random(fan_in)
    table = [(f"t{i}", "base", i, [True, False, None][i % 3], at(-9), at(-9)) for i in range(6)]
    log = []
    for seq in range(600):
        key = rng.choice(["t0", "t0", "t0", *[f"t{i}" for i in range(30)], " t3 ", "  ", None])
        op = rng.choice(["add", "remove", "toggle", "toggle", "toggle", "set_priority", "set_category", "unknown"])
        if op == "unknown":
            op = "toggle"
        log.append((seq, op, key, rng.choice(["x", "y"]), rng.randint(1, 9), rng.choice([True, False, None]), at(seq)))
    rng.shuffle(log)
    got = T.apply_topic_changes(
        spark.createDataFrame(table, TOPIC), spark.createDataFrame(log, TOPIC_CHANGE), fan_in=fan_in
    )
    assert got.columns == TOPIC.fieldNames()
    assert topic_rows(got) == replay_topics(table, log)


@pytest.mark.parametrize("fan_in", [3, 4096])
def test_sources_random_log(spark, fan_in):
    rng = random.Random(fan_in)
    table = [(f"s{i}", "r", f"n{i}", [True, False, None][i % 3], "base", at(-9), None) for i in range(6)]
    log = []
    for seq in range(500):
        op = rng.choice(["add", "remove", "toggle", "toggle", "update", "update"])
        log.append((seq, op, rng.choice(["s0", "s0", *[f"s{i}" for i in range(20)]]), rng.choice(["r", "r2"]),
                    rng.choice(["a", "b", None]), rng.choice(["x", None]), rng.choice([True, False, None]), at(seq)))
    got = R.apply_source_changes(
        spark.createDataFrame(table, SOURCE), spark.createDataFrame(log, SOURCE_CHANGE), fan_in=fan_in
    )
    assert source_rows(got) == replay_sources(table, log)


def test_topics_named_cases(spark):
    table = [("gold", "commodities", 3, True, at(-5), at(-5))]

    def after(*log):
        full = [(i, *entry, at(i)) for i, entry in enumerate(log)]
        return topic_rows(T.apply_topic_changes(
            spark.createDataFrame(table, TOPIC), spark.createDataFrame(full, TOPIC_CHANGE)))

    assert after() == {"gold": ("commodities", 3, True, at(-5), at(-5))}
    # add overwrites but keeps the creation time
    assert after(("add", " gold ", None, None, None)) == {"gold": ("general", 5, True, at(-5), at(0))}
    assert after(("remove", "gold", None, None, None)) == {}
    assert after(("remove", "gold", None, None, None), ("add", "gold", "x", 1, False)) == {
        "gold": ("x", 1, False, at(1), at(1))
    }
    # unknown keys and blank keys do nothing
    assert after(("toggle", "tin", None, None, None), ("add", "  ", "x", 1, True)).keys() == {"gold"}
    assert after(*[("toggle", "gold", None, None, None)] * 3)["gold"][2] is False


def test_seeds_and_listing(spark):
    seeds = T.seed_topics(spark, START)
    sizes = {r.category: r["count"] for r in seeds.groupBy("category").count().collect()}
    assert sizes == {"markets": 16, "economy": 16, "geopolitics": 7, "commodities": 7, "currencies": 12}
    assert R.seed_sources(spark, START).count() == 10
    table = spark.createDataFrame(
        [("b", "x", 2, True), ("a", None, None, None), ("c", "x", 1, False)],
        "query string, category string, priority int, active boolean",
    )
    assert [r.query for r in T.topics(table).collect()] == ["b"]
    assert [tuple(r) for r in T.topic_listing(table, show_inactive=True).collect()] == [
        ("a", "general", 5, "ACTIVE"), ("c", "x", 1, "INACTIVE"), ("b", "x", 2, "ACTIVE"),
    ]
    assert [r.query for r in T.topics(table, active_only=False, category="x", n=1).collect()] == ["c"]
    assert sorted(r.query for r in T.query_set(table, table).collect()) == ["a", "b", "c"]


def test_source_listing_and_uniqueness(spark):
    table = spark.createDataFrame(
        [("s", "r", None, None, "fin", START, None), ("s", "r", "n", False, "abc", None, None),
         (None, "q", "n", True, "fin", START, None)],
        SOURCE,
    )
    assert [tuple(r) for r in R.source_listing(table).collect()] == [
        ("ABC", "n", "INACTIVE", "s", "r", None),
        ("FIN", "n", "ACTIVE", "Unknown", "q", "2024-01-01 00:00:00"),
        ("FIN", "Unknown", "ACTIVE", "s", "r", "2024-01-01 00:00:00"),
    ]
    assert [tuple(r) for r in R.check_unique(table).collect()] == [("s", "r", 2)]
    assert [r.site for r in R.sources(table, active_only=True, category="fin", n=5).collect()] == [None]
