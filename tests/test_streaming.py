from __future__ import annotations

import json
from datetime import datetime
from urllib.parse import quote

import pytest

from feedmill.operators.registry import seed_sources
from feedmill.schema import BOILERPLATE
from feedmill.sources.sink import read_store
from feedmill.streaming import ingest as I


def job(tmp_path, lane="search", **kw):
    for name in ("landing", "store"):
        (tmp_path / name).mkdir(exist_ok=True)
    folders = {n: str(tmp_path / n) for n in ("landing", "store", "checkpoint", "metrics")}
    return I.Ingest(**folders, lane=lane, buckets=2, **kw)


def land(job, name, *records):
    with open(f"{job.landing}/{name}.json", "w") as out:
        out.writelines((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in records)


def record(url, topic, seq, date="2024-01-02T00:00:00Z", body="b", **kw):
    return {"url": url, "title": f"t{seq}", "body": body, "date": date, "source": "s", "topic": topic, "ingest_seq": seq, **kw}


def stored(spark, job):
    return sorted((r.url, r.title, r.searchKey) for r in read_store(spark, job.store).collect())


def metrics(spark, job):
    return [tuple(r) for r in I.ingest_metrics(spark, job).select("batch", "found", "kept", "skipped", "saved").orderBy("batch").collect()]


FIRST = [
    record("a", "gold", 1),
    record("a", "gold", 2, date="2024-01-03T00:00:00Z"),
    record("b", "gold", 3, body=BOILERPLATE[0]),
    record("a", "tin", 4, date="2024-01-09T00:00:00Z"),  # gold was saved before tin
    record("c", "tin", 5, relative_time="1h", nested={"a": [1]}),
    "{broken",
    "  ",
]
SECOND = [record("a", "gold", 6), record("d", "gold", 7), record("d", "gold", 8, date="2023-01-01")]


def test_one_shot(spark, tmp_path):
    j = job(tmp_path)
    land(j, "1", *FIRST)
    I.start_ingest(spark, j, once=True).awaitTermination()
    assert stored(spark, j) == [("a", "t2", "gold"), ("c", "t5", "tin")]
    assert read_store(spark, j.store).where("url = 'c'").first().extra == {"relative_time": "1h", "nested": '{"a":[1]}'}
    I.start_ingest(spark, j, once=True).awaitTermination()  # nothing new
    land(j, "2", *SECOND)
    I.start_ingest(spark, j, once=True).awaitTermination()
    assert stored(spark, j) == [("a", "t2", "gold"), ("c", "t5", "tin"), ("d", "t7", "gold")]
    assert metrics(spark, j) == [(0, 6, 2, 0, 2), (1, 3, 2, 1, 1)]


def test_unreadable_lines_are_kept(spark, tmp_path):
    j = job(tmp_path, rejects=str(tmp_path / "rejects"))
    land(j, "1", *FIRST)
    I.start_ingest(spark, j, once=True).awaitTermination()
    assert [(r.line, r.lane) for r in spark.read.parquet(j.rejects).collect()] == [("{broken", "search")]
    assert metrics(spark, j) == [(0, 6, 2, 0, 2)]


def test_continuous_gives_the_same_store(spark, tmp_path):
    j = job(tmp_path)
    query = I.start_ingest(spark, j, poll="200 milliseconds")
    try:
        for name, records in (("1", FIRST), ("2", SECOND)):
            land(j, name, *records)
            query.processAllAvailable()
    finally:
        query.stop()
    assert stored(spark, j) == [("a", "t2", "gold"), ("c", "t5", "tin"), ("d", "t7", "gold")]


def test_a_batch_run_again_adds_nothing(spark, tmp_path):
    j = job(tmp_path)
    land(j, "1", *FIRST)
    found = I.records(spark.read.text(j.landing), I.SEARCH_RECORD)
    for _ in range(2):
        I._save_batch(j, None, found, 0)
    assert read_store(spark, j.store).count() == 2
    assert metrics(spark, j) == [(0, 6, 2, 0, 2)]  # still what the first run found


def test_aggregator_and_rss_lanes(spark, tmp_path):
    (tmp_path / "agg").mkdir()
    a = job(tmp_path / "agg", "aggregator")
    land(a, "1", {"url": "x", "title": "t", "description": "d", "publisher": {"href": "h"}, "topic": "gold"})
    I.start_ingest(spark, a, once=True).awaitTermination()
    row = read_store(spark, a.store).first()
    assert (row.url, row.body, row.source, row.searchKey) == ("x", "d", "h", "gold") and row.date is not None

    (tmp_path / "rss").mkdir()
    r = job(tmp_path / "rss", "rss")
    feed = "https://www.politico.eu/rss"
    folder = tmp_path / "rss" / "landing" / f"feed={quote(feed, safe='')}"
    folder.mkdir(parents=True)
    item = "<item><title>T{0}</title><link>https://p.eu/{1}</link><pubDate>Tue, 02 Jan 2024 03:04:05 GMT</pubDate></item>"
    (folder / "1.xml").write_text("<rss><channel>" + item.format(1, 1) + item.format(2, 1) + item.format(3, 2) + "</channel></rss>")
    I.start_ingest(spark, r, once=True, registry=seed_sources(spark, datetime(2024, 1, 1))).awaitTermination()
    got = sorted((x.url, x.title, x.source, x.date) for x in read_store(spark, r.store).collect())
    when = datetime(2024, 1, 2, 3, 4, 5)
    # the RSS lane is not cleaned: the last entry of a URL wins
    assert got == [("https://p.eu/1", "T2", "PoliticoEurope", when), ("https://p.eu/2", "T3", "PoliticoEurope", when)]


def test_bounded_dedupe(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [("a", datetime(2024, 1, 1)), ("a", datetime(2024, 1, 2)), ("b", datetime(2024, 1, 2)), (None, datetime(2024, 1, 2))]
    df = spark.createDataFrame(rows * 25, "url string, date timestamp")
    (tmp_path / "in").mkdir()
    stream = I.dedupe_stream(spark.readStream.schema(df.schema).parquet(source), "30 days", spread=3)
    for later in (df, df.union(spark.createDataFrame([("c", datetime(2024, 1, 3))] * 9, df.schema))):
        later.repartition(6).write.mode("append").parquet(source)
        writer = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp"))
        writer.trigger(availableNow=True).start(out).awaitTermination()
        got = sorted((r.url for r in spark.read.parquet(out).collect()), key=repr)
        assert got == (["a", "b", None] if later is df else ["a", "b", "c", None])


@pytest.mark.parametrize("master, ok", [("local[4]", True), ("local", True), ("yarn", False), ("spark://h:7077", False)])
def test_no_machine_local_scratch_on_a_cluster(monkeypatch, master, ok):
    from types import SimpleNamespace

    from feedmill import session

    conf = {}
    fake = SimpleNamespace(
        conf=SimpleNamespace(get=lambda k, d=None: conf.get(k, d), set=conf.__setitem__),
        sparkContext=SimpleNamespace(master=master),
    )
    if ok:
        assert session.scratch_root(fake) == conf[session.CHECKPOINT_DIR]
    else:
        with pytest.raises(RuntimeError):
            session.scratch_root(fake)
        conf[session.CHECKPOINT_DIR] = "hdfs:///shared"
        assert session.scratch_path(fake, "x").startswith("hdfs:///shared/x-")


def rss_landing(path, feed, links):
    folder = path / f"feed={quote(feed, safe='')}"
    folder.mkdir(parents=True)
    items = "".join(f"<item><title>rss</title><link>{u}</link><pubDate>Tue, 02 Jan 2024 03:04:05 GMT</pubDate></item>" for u in links)
    (folder / "1.xml").write_text(f"<rss><channel>{items}</channel></rss>")


def test_several_lanes_into_one_store(spark, tmp_path):
    for name in ("agg", "rss"):
        (tmp_path / name).mkdir()
    j = job(tmp_path, more=(("aggregator", str(tmp_path / "agg")), ("rss", str(tmp_path / "rss"))))
    registry = seed_sources(spark, datetime(2024, 1, 1))
    land(j, "1", *[record(f"u{i}", "gold", i) for i in range(20)])
    with open(tmp_path / "agg" / "1.json", "w") as out:
        out.writelines(json.dumps({"url": f"u{i}", "title": "agg", "description": "d", "publisher": {"href": "h"}, "topic": "tin"}) + "\n" for i in range(10, 30))
    rss_landing(tmp_path / "rss", "https://www.politico.eu/rss", [f"u{i}" for i in range(25, 40)] + ["u39"])
    for _ in range(2):
        I.start_ingest(spark, j, once=True, registry=registry).awaitTermination()
    got = {r.url: r.title for r in read_store(spark, j.store).collect()}
    assert read_store(spark, j.store).count() == 40
    assert got == {f"u{i}": f"t{i}" if i < 20 else "agg" if i < 30 else "rss" for i in range(40)}
    assert metrics(spark, j) == [(0, 56, 40, 0, 40)]


def test_a_second_writer_is_refused(spark, tmp_path):
    from dataclasses import replace

    from feedmill.sources.sink import release_store

    j = job(tmp_path)
    land(j, "1", record("a", "gold", 1))
    I.start_ingest(spark, j, once=True).awaitTermination()
    other = replace(j, checkpoint=str(tmp_path / "other"))
    with pytest.raises(RuntimeError, match="is written by"):
        I.start_ingest(spark, other, once=True)
    I.start_ingest(spark, j, once=True).awaitTermination()
    release_store(spark, j.store)
    I.start_ingest(spark, other, once=True).awaitTermination()
    assert stored(spark, j) == [("a", "t1", "gold")]


def test_late_rows_are_put_aside(spark, tmp_path):
    """Every wave against a plain replay; a hot URL, null URLs and dates, forgotten keys, folds, a batch run again."""
    from datetime import timedelta

    from feedmill.streaming.late import Dedupe, _save_batch, start_dedupe

    source, out, late, state, cp = (str(tmp_path / n) for n in ("in", "out", "late", "state", "cp"))
    job = Dedupe(out, late, state, cp, "5 days", fold=2)
    schema = "url string, date timestamp, n long"
    day = lambda d: datetime(2024, 1, 1) + timedelta(days=d)
    waves = [
        [("hot", day(1)), ("a", day(2)), ("a", day(1)), (None, day(2)), ("none", None)] + [("hot", day(1))] * 50,
        [("b", day(10)), ("a", day(3)), ("c", day(-9)), (None, None)],
        [("hot", day(4)), ("hot", day(6)), ("a", day(8)), ("b", day(9)), ("none", None)] + [("hot", day(0))] * 30,
        [("none", None), ("b", day(30)), (None, day(5))],
        [("b", day(26)), ("z", day(24)), ("z", None)],
    ]
    horizon, bar, kept = timedelta(days=5), None, {}
    want_out, want_late = [], []
    top = None
    for i, wave in enumerate(waves):
        rows = [(u, d, i * 100 + k) for k, (u, d) in enumerate(wave)]
        spark.createDataFrame(rows, schema).repartition(3).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        start_dedupe(stream, job, once=True).awaitTermination()

        bar = None if top is None else top - horizon
        kept = {u: t for u, t in kept.items() if bar is None or t > bar}
        dates = [d for _, d in wave if d] + ([top] if top else [])
        top = max(dates)
        firsts = {}
        for u, d, n in rows:
            if d is not None and bar is not None and d < bar:
                want_late.append((u, d, n))
            elif u not in firsts or (d or datetime.max) < (firsts[u] or datetime.max):
                firsts[u] = d
        for u, d in firsts.items():
            if u not in kept:
                want_out.append((u, d))
                kept[u] = (d or top) + horizon
        got = [(r.url, r.date) for r in spark.read.schema(schema).parquet(out).collect()]
        assert sorted(map(repr, got)) == sorted(map(repr, want_out)), i
        aside = [(r.url, r.date, r.n) for r in spark.read.schema(schema).parquet(late).collect()]
        assert sorted(map(repr, aside)) == sorted(map(repr, want_late)), i
    assert len(want_late) == 33 and ("b", day(26)) in want_out  # forgotten by then
    # The last batch once more, after its keys were lost half-written: the same rows.
    (tmp_path / "state" / "batch=4" / "_SUCCESS").unlink()
    _save_batch(job, spark.createDataFrame([(u, d, 400 + k) for k, (u, d) in enumerate(waves[4])], schema), 4)
    got = [(r.url, r.date) for r in spark.read.schema(schema).parquet(out).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want_out))
    assert {p.name for p in (tmp_path / "state").iterdir() if not p.name.startswith(("_", "."))} == {"fold=1", "fold=3", "batch=2", "batch=3", "batch=4"}
