from __future__ import annotations

import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from feedmill.operators import search as Q
from feedmill.operators import topics as T

AS_OF = "2024-01-31 00:00:00"
NOW = datetime.fromisoformat(AS_OF)
SCHEMA = "url string, title string, body string, date timestamp, source string, searchKey string, ingest_seq long"


def ago(days):
    return NOW - timedelta(days=days)


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [
        ("u1", "Élan vital", "none", ago(0.5), "s1", "k", 1),
        ("u2", "plain", "about a+b (c)", ago(2), "s2", "k", 2),
        ("u3", None, "GOLD rises", ago(3), "s1", "k", 3),
        ("u4", "gold", None, ago(6), "s3", "k", 4),
        ("u5", "gold", "gold", ago(20), "s1", "k", 5),
        ("u6", "gold", "gold", None, "s1", "k", 6),  # a null date never matches
        ("u7", "gold", "gold", ago(7), "s1", "k", 7),  # the cutoff itself is in
        (None, None, None, ago(1), None, None, 8),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def urls(df):
    return [r.url for r in df.collect()]


def test_search(corpus):
    assert urls(Q.search(corpus, "gold", AS_OF)) == ["u3", "u4", "u7"]
    assert urls(Q.search(corpus, "éLAN", AS_OF)) == ["u1"]
    assert urls(Q.search(corpus, "A+B (", AS_OF)) == ["u2"]  # no pattern, literal text
    assert urls(Q.search(corpus, "", AS_OF)) == []
    assert urls(Q.search(corpus, "gold", AS_OF, limit=1)) == ["u3"]
    assert urls(Q.search(corpus, "gold", AS_OF, sources="s3,s9")) == ["u4"]
    assert urls(Q.search(corpus, "gold", AS_OF, sources=["s1"], days=30)) == ["u3", "u7", "u5"]
    table = corpus.sparkSession.createDataFrame([("s3",), ("s3",)], "name string")
    assert urls(Q.search(corpus, "gold", AS_OF, sources=table)) == ["u4"]


def test_widening(corpus):
    assert urls(Q.search_widening(corpus, "élan", AS_OF)) == ["u1"]
    got = Q.search_widening(corpus, "gold", AS_OF)
    assert [(r.url, r.tier) for r in got.collect()] == [("u3", 7), ("u4", 7), ("u7", 7)]
    old = corpus.where("url = 'u5'")
    assert [(r.url, r.tier) for r in Q.search_widening(old, "gold", AS_OF).collect()] == [("u5", 30)]
    assert urls(Q.search_widening(corpus, "absent", AS_OF)) == []


@pytest.mark.parametrize(
    "bounds",
    [{}, {"shard_queries": 2}, {"shard_queries": 1}, {"shard_chars": 4}],
)
def test_tagging_against_brute_force(spark, bounds):
    words = ["the", "The", "he", "her", "a", "ß", "É", "", None, "there is", "zzz", "a+b", "the"]
    texts = [
        ("There is the hero", "he"), (None, "A+B of é"), ("Straße", None), (None, None), ("x" * 50, "THE END " * 40),
    ]
    df = spark.createDataFrame([(i, t, b) for i, (t, b) in enumerate(texts)], "id int, title string, body string")
    queries = spark.createDataFrame([(w,) for w in words], "query string")
    want = sorted(
        (i, w)
        for i, (t, b) in enumerate(texts)
        for w in {w for w in words if w}
        if w.lower() in (t or "").lower() or w.lower() in (b or "").lower()
    )
    got = sorted((r.id, r.query) for r in Q.tag_matches(df, queries, **bounds).collect())
    assert got == want


def test_tagging_with_no_queries(corpus, spark):
    out = Q.tag_matches(corpus, spark.createDataFrame([], "query string"))
    assert out.count() == 0 and out.columns == [*corpus.columns, "query"]


def test_search_many_top_k_of_a_hot_query(spark):
    n = 500
    i = F.col("id")
    df = spark.range(n).select(
        i.alias("ingest_seq"),
        F.when(i % 50 == 0, "rare and common").otherwise("common").alias("title"),
        F.lit(None).cast("string").alias("body"),
        F.timestamp_seconds(F.lit(int(NOW.timestamp())) - (i * 7919) % 300).alias("date"),
    )
    queries = spark.createDataFrame([("rare",), ("common",)], "query string")
    got = {(r.query, r.ingest_seq) for r in Q.search_many(df, queries, AS_OF, k=5).collect()}
    rows = df.collect()
    order = sorted(rows, key=lambda r: (-r.date.timestamp(), r.ingest_seq))
    want = {("common", r.ingest_seq) for r in order[:5]}
    want |= {("rare", r.ingest_seq) for r in [r for r in order if "rare" in r.title][:5]}
    assert got == want


def test_present(corpus):
    shown = Q.present(corpus.where("ingest_seq in (2, 6, 8)")).orderBy("position").collect()
    assert [tuple(r) for r in shown] == [
        (1, "No title", "Unknown source", "2024-01-30 00:00", "No URL", 3),
        (2, "plain", "s2", "2024-01-29 00:00", "u2", 3),
        (3, "gold", "s1", "Unknown date", "u6", 3),
    ]


def test_recent_reaches_the_scan(spark, corpus, tmp_path):
    path = str(tmp_path / "articles")
    corpus.write.parquet(path)
    plan = Q.recent(spark.read.parquet(path), AS_OF, 7, ["url"])._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(date," in plan
    assert "ReadSchema: struct<url:string,date:timestamp>" in plan


def test_fanout_and_report(spark, corpus):
    table = spark.createDataFrame(
        [("gold", "commodities", 1, True), ("élan", "misc", 2, True), ("plain", "misc", 3, False)],
        "query string, category string, priority int, active boolean",
    )
    tagged = T.tag_by_topic(corpus, table, AS_OF, k=2, days=30)
    assert sorted((r.searchKey, r.url) for r in tagged.collect()) == [("gold", "u3"), ("gold", "u4"), ("élan", "u1")]
    report = {r.searchKey: tuple(r) for r in T.topic_report(tagged, table).collect()}
    assert report["gold"] == ("commodities", "gold", 2, 2, ago(3))


def exchanged(df):
    """Names of the columns that pass the exchanges of a plan."""
    plan = df.sparkSession._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    inputs = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*?)\]\n", plan)
    assert inputs
    return {name.split("#")[0] for part in inputs for name in part.split(", ")}


def test_texts_are_fetched_late(spark, tmp_path, monkeypatch):
    rows = [(i, f"u{i % 7}", f"gold {i}" if i % 2 else None, "x" * 50 + " tin" * (i % 3), datetime(2024, 1, 1 + i % 20), i % 9) for i in range(120)]
    rows += [(None, "n", "gold", "tin", datetime(2024, 1, 2), 1)]
    articles = spark.createDataFrame(rows, "id long, url string, title string, body string, date timestamp, ingest_seq long")
    articles.write.parquet(str(tmp_path / "a"))
    articles = spark.read.parquet(str(tmp_path / "a"))
    queries = spark.createDataFrame([("gold",), ("tin",), ("GOLD",), ("lead",), ("",)], "query string")
    for late in (Q.LATE_ROWS, 0):
        monkeypatch.setattr(Q, "LATE_ROWS", late)
        for k in (1, 5, 500):
            want = Q.search_many(articles, queries, "2024-01-31", days=30, k=k)
            got = Q.search_many(articles, queries, "2024-01-31", days=30, k=k, key=["id"])
            assert sorted(map(tuple, got.select(*want.columns).collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
            if late:
                assert not {"title", "body"} & exchanged(got)
    tagged = T.tag_by_topic(articles, queries.selectExpr("query", "true as active"), "2024-01-31", k=2, days=30, key=["id"])
    assert {"body", "searchKey"} <= set(tagged.columns) and not {"title", "body"} & exchanged(tagged)
    with pytest.raises(ValueError):
        Q.search_many(articles, queries, "2024-01-31", key=["query"])


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_tasks_give_out_few_hits_that_cannot_be_among_the_newest(spark, kind):
    rows = [("u", "gold", None, None if i % 50 == 0 else ago(1 + (i * 37 % 400) / 20), "s", "k", i) for i in range(1000)]
    found = spark.createDataFrame(rows, SCHEMA).coalesce(1).withColumn("date", F.col("date").cast(kind))
    asked = spark.createDataFrame([("gold",), ("absent",)], "query string")
    every, _ = Q._tag_all(found, asked, "query", "query", 10, 100)
    some, _ = Q._tag_all(found, asked, "query", "query", 10, 100, (5, "date"))
    assert every.count() == 1000 and 5 <= some.count() < 300

    def in_order(df):
        return [(r.ingest_seq, r.date, r.query) for r in df.orderBy("ingest_seq").collect()]

    for k in (5, 990):  # dates repeat, and beyond 980 the null ones count
        best = in_order(Q.top_per_query(every, k))
        assert len(best) == k and in_order(Q.tag_newest(found, asked, k)) == best
        assert in_order(Q.tag_newest(found, asked, k, key=["ingest_seq"])) == best
