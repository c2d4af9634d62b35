from __future__ import annotations

import random
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from feedmill.operators import store as K
from feedmill.schema import ARTICLE
from feedmill.sources import files, sink
from feedmill.sources.sink import compact_store, insert_articles, read_store, upsert_articles

COLS = "url string, title string, image string, ingest_seq long"


def frame(spark, rows, schema=COLS):
    return spark.createDataFrame(rows, schema)


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_require_columns(spark):
    df = frame(spark, [("a", "t", None, 1)])
    assert K.require_columns(df, ["url", "image"]).count() == 1  # null values are no concern
    assert K.require_columns(df, ["url", "date"]).count() == 0


def test_existing_and_insert_with_null_urls(spark):
    store = frame(spark, [("a", "s", None, 0), (None, "s", None, 0)])
    batch = frame(spark, [("a", "b", None, 1), (None, "b", None, 2), ("c", "b1", None, 3), ("c", "b2", None, 4)])
    assert rows(K.existing_keys(batch, store), "url") == sorted([("a",), (None,)], key=repr)
    assert rows(K.insert_new(batch, store), "url", "title") == [("c", "b2")]
    both = store.unionByName(K.insert_new(batch, store))
    assert K.insert_new(batch, both).count() == 0  # a second time changes nothing
    without_null = store.where("url is not null")
    assert (None, "b") in rows(K.insert_new(batch, without_null), "url", "title")


def test_upsert_overwrites_with_nulls_and_keeps_store_columns(spark):
    store = frame(
        spark, [("a", "old", "i", 0, "x"), ("z", "zz", "i", 0, "y"), (None, "n", "i", 0, "w")], COLS + ", note string"
    )
    batch = frame(
        spark, [("a", "one", "j", 1), ("a", "two", None, 2), ("new", "n1", None, 4), (None, "n2", None, 3)]
    )
    got = K.upsert(store, batch)
    assert rows(got, "url", "title", "image", "note") == sorted(
        [("a", "two", None, "x"), ("z", "zz", "i", "y"), (None, "n2", None, "w"), ("new", "n1", None, None)], key=repr
    )
    # order decides: with the numbers swapped the other record wins
    swapped = batch.withColumn("ingest_seq", -F.col("ingest_seq"))
    assert ("a", "one", "j", "x") in rows(K.upsert(store, swapped), "url", "title", "image", "note")


def replay(store, batch):
    """Ordered upserts on a dict, counting as a document store would."""
    docs, upserted, modified = {u: dict(d) for u, d in store.items()}, 0, 0
    for url, doc in batch:
        if url not in docs:
            docs[url] = dict(doc)
            upserted += 1
        else:
            before = dict(docs[url])
            docs[url].update(doc)
            modified += before != docs[url]
    return upserted, modified


@pytest.mark.parametrize("run", [1, 5, 1 << 17])
def test_write_counts_against_replay(spark, run):
    n = 400
    store = {f"u{i}": {"title": f"t{i % 2}", "image": None} for i in range(8)}
    batch = []
    for i in range(n):
        url = "hot" if i % 3 == 0 else None if i % 13 == 0 else f"u{(i * 7) % 20}"
        batch.append((url, {"title": f"t{(i * i) % 3 % 2}", "image": "x" if i % 11 == 0 else None}))
    stored = frame(spark, [(u, d["title"], d["image"], -1) for u, d in store.items()])
    sent = frame(spark, [(u, d["title"], d["image"], i) for i, (u, d) in enumerate(batch)])
    got = K.upsert_counts(stored, sent, run_rows=run).first()
    want = replay(store, batch)
    assert (got.upserted, got.modified, got.saved) == (*want, sum(want))

    fresh = [(u, d) for u, d in batch if u not in store]
    counts = K.insert_counts(stored, sent, run_rows=run).first()
    assert (counts.found, counts.skipped, counts.saved) == (n, n - len(fresh), sum(replay({}, fresh)))


def test_counts_of_an_empty_batch(spark):
    store, none = frame(spark, [("a", "s", None, 0)]), frame(spark, [])
    assert tuple(K.upsert_counts(store, none).first()) == (0, 0, 0)
    assert tuple(K.insert_counts(store, none).first()) == (0, 0, 0)


def test_fingerprint_tells_null_from_text(spark):
    store = frame(spark, [("a", "n", None, 0)])
    for title, image in [(None, "n"), ("", None), ("n", "")]:
        assert K.upsert_counts(store, frame(spark, [("a", title, image, 1)])).first().modified == 1
    assert K.upsert_counts(store, frame(spark, [("a", "n", None, 1)])).first().modified == 0


def test_repair(spark):
    df = spark.createDataFrame(
        [(1, "2024-01-02T00:00:00Z", None), (2, "soon", None), (3, None, datetime(2024, 1, 3)), (4, None, None)],
        "i int, date_raw string, date timestamp",
    )
    got = {r.i: r.date for r in K.repair_string_dates(df).collect()}
    assert got == {1: datetime(2024, 1, 2), 2: None, 3: datetime(2024, 1, 3), 4: None}
    assert tuple(K.repair_counts(df).first()) == (1, 1)


def articles(spark, *records):
    whole = [
        (url, title, "b", datetime(2024, 1, 1), "s", None, None, seq, {"k": title}) for url, title, seq in records
    ]
    return spark.createDataFrame(whole, ARTICLE)


def test_sink(spark, tmp_path):
    path = str(tmp_path / "store")
    assert read_store(spark, path).count() == 0
    assert insert_articles(articles(spark), path) == 0
    assert insert_articles(articles(spark, ("a", "1", 1)).drop("body"), path) == 0
    assert not list((tmp_path / "store").rglob("*.parquet"))  # nothing was written

    first = articles(spark, ("a", "1", 1), ("b", "1", 2), (None, "1", 3), ("b", "2", 4))
    assert insert_articles(first, path, buckets=4) == 4  # the rewrite of b counts too
    assert insert_articles(first, path, buckets=4) == 0
    assert rows(read_store(spark, path), "url", "title") == sorted([("a", "1"), ("b", "2"), (None, "1")], key=repr)

    second = articles(spark, ("a", "9", 5), ("c", "1", 6), (None, "7", 7), ("b", "2", 8))
    assert upsert_articles(second, path, buckets=4) == 3
    want = sorted([("a", "9"), ("b", "2"), ("c", "1"), (None, "7")], key=repr)
    assert rows(read_store(spark, path), "url", "title") == want
    assert upsert_articles(second, path, buckets=4) == 0
    assert upsert_articles(articles(spark), path, buckets=4) == 0
    assert rows(read_store(spark, path), "url", "title") == want


def test_sink_upsert_leaves_other_buckets_alone(spark, tmp_path):
    path = tmp_path / "store"
    insert_articles(articles(spark, *[(f"u{i}", "1", i) for i in range(40)]), str(path), buckets=8)
    before = {f: f.stat().st_mtime_ns for f in path.rglob("*.parquet")}
    upsert_articles(articles(spark, ("u3", "2", 99)), str(path), buckets=8)
    after = {f: f.stat().st_mtime_ns for f in path.rglob("*.parquet")}
    assert all(after.get(f) == at for f, at in before.items())  # the version before the switch stays for its readers
    assert len({f.parent.parent.name for f in after if f not in before}) == 1
    assert read_store(spark, str(path)).count() == 40


@pytest.mark.parametrize("step", ["_write", "_switch"])
def test_a_failed_upsert_changes_nothing_and_can_be_run_again(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "store")
    insert_articles(articles(spark, *[(f"u{i}", "1", i) for i in range(20)]), path, buckets=4)
    before = rows(read_store(spark, path), "url", "title")
    batch = articles(spark, *[(f"u{i}", "2", 100 + i) for i in range(10, 30)])
    work = getattr(sink, step)

    def fail(*args, **kw):
        if step == "_write":
            work(*args, **kw)  # all is written when it fails
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(sink, step, fail)
        with pytest.raises(OSError):
            upsert_articles(batch, path, buckets=4)
    assert rows(read_store(spark, path), "url", "title") == before
    assert upsert_articles(batch, path, buckets=4) == 20
    want = sorted([(f"u{i}", "1" if i < 10 else "2") for i in range(30)])
    assert rows(read_store(spark, path), "url", "title") == want


def test_compaction_merges_files_and_old_versions_go(spark, tmp_path):
    path = tmp_path / "store"
    for n in range(3):
        insert_articles(articles(spark, *[(f"u{n}-{i}", "1", i) for i in range(20)]), str(path), buckets=2)
    before = rows(read_store(spark, str(path)), "url", "title")
    assert len(list(path.rglob("*.parquet"))) == 6
    for n in range(3):
        compact_store(spark, str(path), buckets=2)
        assert rows(read_store(spark, str(path)), "url", "title") == before
        assert len(read_store(spark, str(path)).inputFiles()) == 2
    assert sorted({f.parent.name for f in path.rglob("*.parquet")}) == ["version=2", "version=3"]
    assert insert_articles(articles(spark, ("new", "1", 1), ("u1-1", "1", 2)), str(path), buckets=2) == 1
    assert read_store(spark, str(path)).count() == 61


def test_only_touched_buckets_are_listed(spark, tmp_path):
    path = str(tmp_path / "store")
    insert_articles(articles(spark, *[(f"u{i}", "1", i) for i in range(200)]), path, buckets=16)
    numbers = sink.touched(articles(spark, ("u3", "2", 1)), 16)
    assert len(numbers) == 1
    files = read_store(spark, path, only=numbers).inputFiles()
    assert files and all(f"/bucket={numbers[0]}/" in f for f in files)


def test_a_claimed_store_is_written_by_nobody_else(spark, tmp_path):
    path = str(tmp_path / "store")
    sink.claim_store(spark, path, "job")
    for write in (insert_articles, upsert_articles):
        with pytest.raises(RuntimeError, match="is written by job"):
            write(articles(spark, ("a", "1", 1)), path, buckets=2)
    assert insert_articles(articles(spark, ("a", "1", 1)), path, buckets=2, writer="job") == 1
    sink.release_store(spark, path)
    assert upsert_articles(articles(spark, ("a", "2", 2)), path, buckets=2) == 1


def test_two_that_ask_at_once_never_both_hold_a_store(spark, tmp_path, monkeypatch):
    """A file system of which nothing is exclusive: files are simply put, late, and renames write over."""
    from concurrent.futures import ThreadPoolExecutor

    put = files.put

    def late(*args):
        time.sleep(random.random() / 50)
        put(*args)
        time.sleep(random.random() / 50)

    monkeypatch.setattr(files, "put", late)
    for n in range(6):
        path = str(tmp_path / f"store{n}")

        def ask(name, path=path):
            try:
                sink.claim_store(spark, path, name)
            except RuntimeError:
                return None
            return name

        with ThreadPoolExecutor(6) as pool:
            won = [name for name in pool.map(ask, [f"job {i}" for i in range(6)]) if name]
        assert len(won) <= 1
        sink.release_store(spark, path)
        assert ask("later") == "later" and ask("later") == "later" and ask("other") is None


def test_what_a_failed_asker_left_is_removed_by_release(spark, tmp_path):
    path = str(tmp_path / "store")
    files.put(spark, path, sink.ASKS + sink._digest("dead"), "dead")
    with pytest.raises(RuntimeError, match="release_store"):
        sink.claim_store(spark, path, "job", tries=2)
    sink.claim_store(spark, path, "dead")  # it may come back itself
    sink.release_store(spark, path)
    sink.claim_store(spark, path, "job")


def test_a_writer_whose_claim_was_taken_switches_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    insert_articles(articles(spark, ("a", "1", 1)), path, buckets=2)
    write = sink._write

    def taken(*args, **kw):
        write(*args, **kw)
        sink.release_store(spark, path)
        sink.claim_store(spark, path, "next")

    monkeypatch.setattr(sink, "_write", taken)
    with pytest.raises(RuntimeError, match="was taken"):
        upsert_articles(articles(spark, ("a", "2", 2)), path, buckets=2)
    assert rows(read_store(spark, path), "url", "title") == [("a", "1")]
    assert sink.has_claim(spark, path, "next")


def test_a_published_file_is_whole_and_never_written_over(spark, tmp_path):
    files.publish(spark, str(tmp_path), "_one", "first")
    with pytest.raises(RuntimeError, match="already"):
        files.publish(spark, str(tmp_path), "_one", "second")
    assert files.text(spark, str(tmp_path), "_one") == "first"
    assert [f.name for f in tmp_path.iterdir() if not f.name.startswith(".")] == ["_one"]


def test_upsert_keeps_keys_only_the_store_has(spark):
    schema = "url string, extra map<string,string>, ingest_seq long"
    store = spark.createDataFrame([("a", {"x": "1", "y": "1"}, 0), ("b", None, 0), ("c", {"z": "1"}, 0)], schema)
    batch = spark.createDataFrame([("a", {"y": "2"}, 1), ("b", {"n": "2"}, 2), ("c", None, 3)], schema)
    got = {r.url: r.extra for r in K.upsert(store, batch).collect()}
    assert got == {"a": {"x": "1", "y": "2"}, "b": {"n": "2"}, "c": {"z": "1"}}
    assert K.upsert_counts(store, batch).first().modified == 3
    assert K.upsert_counts(store, store).first().modified == 0


def test_repair_in_the_store_rewrites_only_what_waits(spark, tmp_path):
    path = str(tmp_path / "store")
    schema = "url string, title string, body string, date timestamp, date_raw string, ingest_seq long"
    when = datetime(2024, 1, 1)
    rows_in = [(f"u{i}", "t", "b", when, None, i) for i in range(40)]
    rows_in[3] = ("u3", "t", "b", None, "2024-01-05T00:00:00Z", 3)
    rows_in[4] = ("u4", "t", "b", when, "2024-01-06", 4)  # has a date already
    rows_in += [(None, "t", "b", None, "2024-01-07 10:00:00", 50), ("u99", "t", "b", None, "soon", 51)]
    df = spark.createDataFrame(rows_in, schema)
    insert_articles(df, path, df.schema, buckets=8)
    before = {f for f in (tmp_path / "store").rglob("*.parquet")}
    assert sink.repair_store(spark, path, df.schema, buckets=8) == 2
    fresh = {f.parent.parent.name for f in (tmp_path / "store").rglob("*.parquet") if f not in before}
    assert 1 <= len(fresh) <= 2
    got = {r.url: (r.date, r.date_raw) for r in read_store(spark, path, df.schema).collect()}
    assert got["u3"] == (datetime(2024, 1, 5), None) and got[None] == (datetime(2024, 1, 7, 10), None)
    assert got["u4"] == (when, "2024-01-06") and got["u99"] == (None, "soon") and len(got) == 42
    files = sorted(f for f in (tmp_path / "store").rglob("*.parquet"))
    assert sink.repair_store(spark, path, df.schema, buckets=8) == 0
    assert sorted(f for f in (tmp_path / "store").rglob("*.parquet")) == files
    assert sink.repair_store(spark, str(tmp_path / "none"), df.schema, buckets=8) == 0


def test_batches_of_a_store_compute_its_rows_once(spark):
    from feedmill.plans.queries import batches

    met = spark.sparkContext.accumulator(0)

    def note(seq):
        met.add(1)
        return f"u{seq}"

    rows = spark.range(30).select(F.udf(note, "string")("id").alias("url"), F.col("id").alias("ingest_seq"), F.lit(1).alias("article_id"))
    got = [sorted(r.ingest_seq for r in part.collect()) for part in batches(rows, 4)]
    assert got == [list(range(part, 30, 4)) for part in range(4)] and met.value == 30


def test_texts_of_articles_are_shuffled_once(spark, sf):
    from feedmill.plans import fixtures as fx

    def moved(plan):
        """Exchanges that carry texts, in a plan before it runs."""
        if plan.nodeName() == "AdaptiveSparkPlan":
            return moved(plan.executedPlan())
        own = plan.nodeName() == "Exchange" and "text#" in plan.output().mkString(",")
        return own + sum(moved(plan.children().apply(i)) for i in range(plan.children().size()))

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as tables of any size are joined
    try:
        articles = fx.articles(spark, sf)
        assert moved(articles._jdf.queryExecution().executedPlan()) == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    twice = fx.table(spark, sf, "documents").count()
    assert articles.count() == articles.select("article_id").distinct().count() == twice
