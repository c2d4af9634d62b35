from __future__ import annotations

import json
import os
from datetime import datetime

from pyspark.sql import functions as F

from feedmill.operators.registry import seed_sources
from feedmill.schema import ARTICLE
from feedmill.sources import landing as L
from feedmill.sources import normalize as N

NOW = datetime(2024, 1, 31)

RSS = """<?xml version="1.0"?><rss version="2.0" xmlns:media="http://search.yahoo.com/mrss/" xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel><title>Feed</title>
<item><title>One &amp; two</title><link>https://a.com/1</link><description><![CDATA[<p>body</p>]]></description>
<pubDate>Tue, 02 Jan 2024 03:04:05 +0200</pubDate><media:content url="x"/></item>
<item><title>No date</title><link>https://a.com/2</link></item>
<item><title>Bad date</title><link>https://a.com/3</link><description>d</description><pubDate>soon</pubDate></item>
<item><title>No link</title><description>d</description><guid isPermaLink="false">https://a.com/no</guid></item>
<item><title>By guid</title><guid>https://a.com/6</guid><content:encoded>long</content:encoded></item>
<item><link>https://a.com/5</link></item>
</channel></rss>"""


def land(folder, feed, text, name="0.xml"):
    from urllib.parse import quote

    path = folder / f"feed={quote(feed, safe='')}"
    path.mkdir(parents=True)
    (path / name).write_text(text)


def registry(spark):
    return seed_sources(spark, NOW).unionByName(
        spark.createDataFrame(
            [("a", "https://a.com/rss?x=1", "A", True, "fin", NOW, None), ("b", "https://off.com/rss", "B", False, "fin", NOW, None)],
            "site string, RSS string, source string, active boolean, category string, added_date timestamp, last_updated timestamp",
        )
    )


def test_rss(spark, tmp_path):
    land(tmp_path, "https://a.com/rss?x=1", RSS)
    land(tmp_path, "https://off.com/rss", RSS)
    land(tmp_path, "https://unknown.com/rss", RSS)
    items = L.read_rss(spark, str(tmp_path))
    assert {r.RSS for r in items.collect()} == {"https://a.com/rss?x=1", "https://off.com/rss", "https://unknown.com/rss"}
    got = N.to_articles(N.normalize_rss(items, registry(spark), NOW)).orderBy("url").collect()
    assert [(r.url, r.title, r.body, r.date, r.source, r.searchKey, r.image) for r in got] == [
        ("https://a.com/1", "One & two", "<p>body</p>", datetime(2024, 1, 2, 1, 4, 5), "A", None, None),
        ("https://a.com/2", "No date", "No Summary Available", NOW, "A", None, None),
        ("https://a.com/3", "Bad date", "d", None, "A", None, None),
        ("https://a.com/6", "By guid", "long", NOW, "A", None, None),
    ]


ATOM = """<?xml version="1.0"?><feed xmlns="http://www.w3.org/2005/Atom"><title>F</title><link href="https://a.com/"/>
<entry><title type="html">One</title><link rel="self" href="https://a.com/self"/><link href="https://a.com/1"/>
<summary>s</summary><published>2024-01-02T03:04:05+02:00</published></entry>
<entry><title>Two</title><link rel="alternate" href="https://a.com/2"/><content type="html">c</content></entry>
<entry><title>None</title><link rel="edit" href="https://a.com/3"/></entry></feed>"""


def test_atom(spark, tmp_path):
    land(tmp_path, "https://a.com/rss?x=1", ATOM)
    got = N.normalize_rss(L.read_atom(spark, str(tmp_path)), registry(spark), NOW).orderBy("url").collect()
    assert [(r.url, r.title, r.body, r.date) for r in got] == [
        ("https://a.com/1", "One", "s", datetime(2024, 1, 2, 1, 4, 5)), ("https://a.com/2", "Two", "c", NOW),
    ]


def test_json_lanes(spark, tmp_path):
    search, aggregator = tmp_path / "s.json", tmp_path / "a.json"
    search.write_text(
        json.dumps({"url": "u", "title": "t", "body": "b", "date": "2024-01-02T00:00:00+00:00", "topic": "gold", "ingest_seq": 1})
        + "\n{broken\n"
    )
    aggregator.write_text(
        json.dumps({"url": "v", "title": "t", "description": "d", "published date": "x", "publisher": {"href": "h", "title": "p"}, "topic": "tin"})
        + "\n" + json.dumps({"topic": "tin"}) + "\n"
    )
    one = L.read_search(spark, str(search))
    assert [r._corrupt_record for r in one.collect()] == [None, "{broken"]
    tagged = N.normalize_search(L.readable(one))
    assert tagged.first().searchKey == "gold" and "topic" not in tagged.columns
    two = N.normalize_aggregator(L.with_arrival(L.read_aggregator(spark, str(aggregator))), NOW)
    assert not {"publisher", "published date", "description", "topic"} & set(two.columns)
    rows = {r.url: r for r in two.collect()}
    assert (rows["v"].body, rows["v"].source, rows["v"].date) == ("d", "h", NOW)
    assert (rows[""].title, rows[""].body, rows[""].source, rows[""].searchKey) == ("", "", "", "tin")

    both = N.union_feeds(N.to_articles(tagged), N.to_articles(two))
    assert both.select(*ARTICLE.fieldNames()).schema.simpleString() == ARTICLE.simpleString()
    assert {r.url: r.date for r in both.collect()} == {"u": datetime(2024, 1, 2), "v": NOW, "": NOW}


def test_unknown_columns_are_kept(spark):
    df = spark.createDataFrame([("u", 7, None)], "url string, `a.b` int, other string")
    row = N.to_articles(df).first()
    assert row.extra == {"a.b": "7"} and row.title is None
    more = df.withColumn("extra", F.create_map(F.lit("k"), F.lit("v")))
    assert N.to_articles(more).first().extra == {"a.b": "7", "k": "v"}


def test_search_lane_may_be_tagged_already(spark):
    df = spark.createDataFrame([("u", "k")], "url string, searchKey string")
    assert N.normalize_search(df, "searchKey").first().searchKey == "k"


def test_logs(spark, tmp_path):
    (tmp_path / "Api.log").write_text("2024-01-02 03:04:05,678 - INFO - start\n  traceback\n2024-01-02 03:05:05,678 - ERROR - no\n")
    (tmp_path / "notes.txt").write_text("x\n")
    df = L.read_logs(spark, str(tmp_path))
    assert [(r.log, r.line[-5:]) for r in df.orderBy("block", "line_no").collect()] == [
        ("Api", "start"), ("Api", "eback"), ("Api", " - no"),
    ]
    assert df.agg(F.max("logged_at")).first()[0] == datetime(2024, 1, 2, 3, 5, 5)


def test_tail_of_a_log_read_in_many_splits(spark, tmp_path):
    from feedmill.operators.health import tail_health

    lines = [f"2024-01-02 03:04:05,678 - INFO - {i}" for i in range(3000)]
    (tmp_path / "Big.log").write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        df = L.read_logs(spark, str(tmp_path))
        assert df.select("block").distinct().count() > 10
        assert tail_health(df, "log", ["block", "line_no"]).first().last_lines == lines[-10:]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_arrival_is_total_and_repeatable(spark, tmp_path):
    """Files of different sizes, times and names; some records bring numbers of their own."""
    landing, want = tmp_path / "landing", []
    landing.mkdir()
    sizes = [1, 400, 3, 50, 0, 120]
    for n, size in enumerate(sizes):
        path = landing / f"{'zyxwvu'[n]}.json"  # names run against the times
        rows = [{"url": f"f{n}-{i}", "title": "x" * (i * 37 % 90)} | ({"ingest_seq": 10 + n} if n == 3 and i == 7 else {}) for i in range(size)]
        path.write_text("".join(json.dumps(r) + "\n" for r in rows))
        os.utime(path, (1_700_000_000 + n // 2, 1_700_000_000 + n // 2))  # two files share each time
    order = sorted(range(6), key=lambda n: (n // 2, f"{'zyxwvu'[n]}"))
    want = [f"f{n}-{i}" for n in order for i in range(sizes[n])]
    want.remove("f3-7")
    conf = "spark.sql.files.maxPartitionBytes"
    before, seen = spark.conf.get(conf), []
    try:
        for limit in ("2k", "1g"):  # many tasks, splits within files; few tasks, several files each
            spark.conf.set(conf, limit)
            got = L.with_arrival(L.read_search(spark, str(landing)), batch=2).select("url", "ingest_seq").collect()
            numbers = {r.url: r.ingest_seq for r in got}
            assert numbers.pop("f3-7") == 13 and len(numbers) == len(got) - 1
            assert sorted(numbers, key=numbers.get) == want
            assert min(numbers.values()) == 2 * L.BATCH_SPAN
            seen.append(numbers)
    finally:
        spark.conf.set(conf, before)
    assert seen[0] == seen[1]
    first = L.with_arrival(L.read_search(spark, str(landing))).agg(F.min("ingest_seq"), F.count_distinct("ingest_seq")).first()
    assert tuple(first) == (13, sum(sizes))


def test_the_last_rss_entry_wins_by_file_order(spark, tmp_path):
    folder = tmp_path / "rss" / "feed=https%3A%2F%2Fx.org%2Frss"
    folder.mkdir(parents=True)
    for n, name in enumerate("cab"):
        items = "".join(f"<item><title>{name}{i}</title><link>https://x.org/{i}</link></item>" for i in range(3))
        (folder / f"{name}.xml").write_text(f"<rss><channel>{items}</channel></rss>")
        os.utime(folder / f"{name}.xml", (1_700_000_000 + n, 1_700_000_000 + n))
    rows = L.read_rss(spark, str(tmp_path / "rss")).orderBy("ingest_seq").collect()
    assert [r.title for r in rows] == [f"{name}{i}" for name in "cab" for i in range(3)]
    assert [r.ingest_seq for r in rows] == list(range(9))
