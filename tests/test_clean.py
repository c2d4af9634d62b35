from __future__ import annotations

import re
from datetime import datetime

import pytest
from pyspark.sql import Row, Window
from pyspark.sql import functions as F

from feedmill.operators import clean as C
from feedmill.schema import BOILERPLATE

SCHEMA = "url string, title string, body string, date timestamp, searchKey string, image string, ingest_seq long"


def day(n, hour=0):
    return datetime(2024, 1, n, hour)


def art(spark, *rows):
    return spark.createDataFrame([tuple(r) for r in rows], SCHEMA)


def urls(df):
    return sorted(((r.url, r.ingest_seq) for r in df.collect()), key=repr)


def test_newest_per_url_ties_nulls(spark):
    df = art(
        spark,
        ("a", "t", "b", day(1), "k", None, 1),
        ("a", "t", "b", day(3), "k", None, 2),
        ("a", "t", "b", day(3), "k", None, 3),  # same date: the first seen stays
        ("a", "t", "b", None, "k", None, 4),  # a null date is oldest
        (None, "t", "b", day(1), "k", None, 5),  # null URLs are one group
        (None, "t", "b", day(2), "k", None, 6),
        ("c", "t", "b", None, "k", None, 7),
    )
    out = C.newest_by_key(df)
    assert urls(out) == sorted([("a", 2), (None, 6), ("c", 7)], key=repr)
    assert urls(C.newest_by_key(out)) == urls(out)


def test_newest_per_url_with_a_hot_key(spark):
    n = 3000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("u"), F.col("id") % 700)).alias("url"),
        F.timestamp_seconds(1_700_000_000 + (F.col("id") * 7919) % n).alias("date"),
        F.col("id").alias("ingest_seq"),
    )
    want = {}
    for r in df.collect():
        if r.url not in want or (r.date, -r.ingest_seq) > want[r.url]:
            want[r.url] = (r.date, -r.ingest_seq)
    got = {r.url: (r.date, -r.ingest_seq) for r in C.newest_by_key(df).collect()}
    assert got == want


def test_dedupe_except_ignores_topic_and_image(spark):
    df = art(
        spark,
        ("a", "t", "b", day(1), "k1", "i1", 2),
        ("a", "t", "b", day(1), "k2", None, 1),
        ("a", "t", "other", day(1), "k1", None, 3),
        (None, None, "b", None, "k1", None, 4),
        (None, None, "b", None, "k9", None, 5),
    )
    got = sorted((r.ingest_seq, r.searchKey, r.image) for r in C.dedupe_except(df).collect())
    assert [(g[0], g[1]) for g in got] == [(1, "k2"), (3, "k1"), (4, "k1")]
    assert C.dedupe_except(df).columns == df.columns


def test_boilerplate_is_case_sensitive_and_keeps_null(spark):
    long, short = BOILERPLATE
    df = art(
        spark,
        ("a", "t", f"x {long} y", day(1), "k", None, 1),
        ("b", "t", f"x {short}.", day(1), "k", None, 2),
        ("c", "t", short.lower(), day(1), "k", None, 3),
        ("d", "t", None, day(1), "k", None, 4),
    )
    assert [u for u, _ in urls(C.drop_boilerplate(df))] == ["c", "d"]
    assert [u for u, _ in urls(C.drop_boilerplate(df, [long]))] == ["b", "c", "d"]


@pytest.mark.parametrize("chunk", [1, 7, 1 << 20])
def test_rank_with_one_hot_topic_and_one_date(spark, chunk):
    """A third of all rows in one topic, most of them with one date; null dates and topics."""
    n = 900
    i = F.col("id")
    df = spark.range(n).select(
        F.when(i % 3 == 0, "hot").when(i % 7 != 0, F.concat(F.lit("t"), i % 5)).alias("searchKey"),
        F.when(i % 3 == 0, F.lit("2024-01-01 00:00:00").cast("timestamp"))
        .when(i % 11 != 0, F.timestamp_seconds(1_700_000_000 + (i * 37) % 400))
        .alias("date"),
        ((i * 7919) % n).alias("ingest_seq"),
    )
    w = Window.partitionBy("searchKey").orderBy(F.desc_nulls_last("date"), "ingest_seq")
    want = {r.ingest_seq: r.x for r in df.withColumn("x", F.row_number().over(w) - 1).collect()}
    got = {r.ingest_seq: r.recency for r in C.recency_rank(df, chunk_rows=chunk).collect()}
    assert got == want


def test_flatten(spark):
    rows = [
        Row(a=Row(b=1, c=Row(d="x")), tags=["p", "q"], people=[Row(name="n", ids=[1, 2])]),
        Row(a=Row(b=2, c=Row(d=None)), tags=["r"], people=[]),
    ]
    df = spark.createDataFrame(rows)
    assert C.longest_list(df, "tags") == 2
    out = C.flatten(df, max_items=2)
    assert out.columns[:4] == ["a.b", "a.c.d", "tags.0", "tags.1"]
    first = out.first().asDict()
    assert first["people.0.name"] == "n" and first["people.0.ids.1"] == 2 and first["people.1.name"] is None
    assert C.flatten(df).columns == ["a.b", "a.c.d", "tags", "people"]
    with pytest.raises(Exception, match="more than 1 elements"):
        C.flatten(df, max_items=1).collect()


def test_flatten_finds_the_lengths_of_lists(spark):
    rows = [
        Row(n=1, people=[Row(name="n", ids=[1, 2, 3]), None], none=[], grid=[[1], None, [2, 3]]),
        Row(n=2, people=[], none=[], grid=[]),
        Row(n=3, people=None, none=None, grid=[None]),
    ]
    schema = "n int, people array<struct<name:string,ids:array<int>>>, none array<struct<x:int>>, grid array<array<int>>"
    df = spark.createDataFrame(rows, schema)
    assert C.list_lengths(df) == {"people": 2, "people.*.ids": 3, "none": 0, "grid": 3, "grid.*": 2}
    out = C.flatten(df, max_items=None)
    assert out.columns == [
        "n", "people.0.name", *(f"people.0.ids.{i}" for i in range(3)), "people.1.name", *(f"people.1.ids.{i}" for i in range(3)),
        *(f"grid.{i}.{j}" for i in range(3) for j in range(2)),
    ]
    first = out.orderBy("n").first().asDict()
    assert (first["people.0.ids.2"], first["people.1.name"], first["grid.2.1"], first["grid.1.0"]) == (3, None, 3, None)
    empty = C.flatten(df.where("n > 9"), max_items=None)
    assert empty.columns == ["n"] and empty.count() == 0


def test_flatten_json(spark):
    texts = [
        '{"a": 1, "b": {"c d": [1, 2, {"x": null}]}, "mixed": 1, "nil": null}',
        '{"mixed": {"y": [1]}, "b": {"e": "t"}, "a": 2.5}',
        "{broken", None, "[1, 2]", "7", "{}",
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, json string")
    out = C.flatten_json(df, "json")
    assert set(out.columns) == {"id", "a", "b.c d.0", "b.c d.1", "b.c d.2", "b.e", "mixed", "nil"}
    got = {r["id"]: r.asDict() for r in out.collect()}
    assert len(got) == 7 and float(got[0]["a"]) == 1 and float(got[1]["a"]) == 2.5
    assert (got[0]["b.c d.0"], got[0]["b.c d.2"], got[1]["b.e"], got[0]["mixed"], got[1]["mixed"]) == ("1", '{"x":null}', "t", "1", '{"y":[1]}')
    assert all(v is None for k, v in got[2].items() if k != "id")
    assert C.flatten_json(df.where("id = 3"), "json").columns == ["id"]
    with pytest.raises(ValueError, match="columns as well"):
        C.flatten_json(df.withColumn("a", F.lit(1)), "json")


def test_texts_pass_one_exchange_in_clean(spark, tmp_path):
    df = art(spark, *[(f"u{i % 5}", "t", f"body {i}", day(1 + i % 9), f"k{i % 2}", None, i) for i in range(50)])
    df.write.parquet(str(tmp_path / "a"))
    plan = C.clean(spark.read.parquet(str(tmp_path / "a")), batch_keys=["searchKey"], rank_col="rank")
    told = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(plan._jdf.queryExecution(), "formatted")
    inputs = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*?)\]\n", told)
    assert sum("body#" in i for i in inputs) == 1


def test_clean_does_not_bring_back_an_older_copy(spark):
    bad = f"x {BOILERPLATE[1]} y"
    df = art(
        spark,
        ("a", "t", "fine", day(1), "k", None, 1),
        ("a", "t", bad, day(2), "k", None, 2),
        ("b", "t", "fine", day(2), "k", None, 3),
        ("b", "t", "fine", day(1), "other", None, 4),  # another topic is another batch
        ("c", "t", "fine", day(5), "k", None, 5),
    )
    assert urls(C.clean(df)) == [("b", 3), ("c", 5)]
    per_topic = C.clean(df, batch_keys=["searchKey"], rank_col="rank")
    assert sorted((r.url, r.searchKey, r.rank) for r in per_topic.collect()) == [
        ("b", "k", 1), ("b", "other", 0), ("c", "k", 0),
    ]


def test_clean_flattens_parses_and_drops_technical_columns(spark):
    df = spark.createDataFrame(
        [("u", "b", "Tue, 02 Jan 2024 03:04:05 +0200", Row(href="h"), 1, 5, 6)],
        "url string, body string, date string, publisher struct<href string>, ingest_seq long, level_0 int, index int",
    )
    row = C.clean(df).first()
    assert row.asDict() == {
        "url": "u", "body": "b", "date": datetime(2024, 1, 2, 1, 4, 5), "publisher.href": "h", "ingest_seq": 1,
    }


DATES = [
    ("Tue, 02 Jan 2024 03:04:05 GMT", datetime(2024, 1, 2, 3, 4, 5)),
    ("Tue, 02 Jan 2024 03:04:05 +0200", datetime(2024, 1, 2, 1, 4, 5)),
    ("2 Jan 2024 03:04 EST", datetime(2024, 1, 2, 3, 4)),
    ("2024-01-02T03:04:05Z", datetime(2024, 1, 2, 3, 4, 5)),
    ("2024-01-02T03:04:05+02:00", datetime(2024, 1, 2, 1, 4, 5)),
    ("2024-01-02T03:04:05.123456-0500", datetime(2024, 1, 2, 8, 4, 5, 123456)),
    ("2024-01-02 03:04:05 UTC", datetime(2024, 1, 2, 3, 4, 5)),
    ("2024-01-02", datetime(2024, 1, 2)),
    ("January 2, 2024 3:04 PM", datetime(2024, 1, 2, 15, 4)),
    ("Jan 2, 2024 03:04:05", datetime(2024, 1, 2, 3, 4, 5)),
    ("1/2/2024 03:04", datetime(2024, 1, 2, 3, 4)),
    ("02-Jan-2024 03:04:05 UTC", datetime(2024, 1, 2, 3, 4, 5)),
    ("20240102", datetime(2024, 1, 2)),
    ("Wednesday, 3 January 2024 10:00:00 +0000 (UTC)", datetime(2024, 1, 3, 10)),
    ("3 March 2024 11:05pm", datetime(2024, 3, 3, 23, 5)),
    ("nonsense", None),
    ("2024-13-45", None),
    ("", None),
    (None, None),
]


def test_dates(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(DATES)], "i int, date string")
    got = [r.date for r in C.parse_dates(df).orderBy("i").collect()]
    assert got == [want for _, want in DATES]


AS_THE_READER_DOES = [
    "2024/01/02 10:00", "20240102T030405Z", "20240102T0304", "Tue, 02 Jan 2024 03:04:05.123 GMT", "02.01.2024 10:00", "13.01.2024",
    "Tue Jan  2 03:04:05 2024", "Tue Jan 2 03:04:05 UTC 2024", "Jan 2, 2024 3pm", "2024-01-02 3:04 PM", "2024-01-02 10:00 Z",
    " 2024-01-02 10:00 UTC", "2024-01-02T03:04:05.678901+05:30", "2 January 2024", "January 2nd, 2024", "2nd of January 2024", "1/2/2024",
    "25/12/2023 8:15", "12-25-2023", "2024.01.02 03:04:05", "2 Jan 24 03:04", "Jan 2 2024 12:00 AM", "Jan 2 2024 12:30 pm", "2024 Jan 2 04:05",
    "Sat, 3 Feb 2024 23:59:59 -0800", "3 Feb 2024 01:02 +02", "Sept 5, 2023 7:08 a.m.", "2024-1-5", "2024-02-29 00:00:00", "5 May 1999 11:12:13",
]


def test_dates_as_an_independent_parser_reads_them(spark):
    from datetime import timezone

    from dateutil import parser

    df = spark.createDataFrame(list(enumerate(AS_THE_READER_DOES)), "i int, date string")
    got = [r.date for r in C.parse_dates(df).orderBy("i").collect()]
    for text, date in zip(AS_THE_READER_DOES, got):
        want = parser.parse(text)
        want = want.astimezone(timezone.utc).replace(tzinfo=None) if want.tzinfo else want
        assert date == want, text


def test_what_is_no_date(spark):
    texts = ["tomorrow", "12", "2024", "10:00", "32 Jan 2024", "2024-02-30", "Jan 2024 or so", "see 2024-01-02 in the paper", "1/2/3/4", "99/99/2024"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, date string")
    assert [r.date for r in C.parse_dates(df).orderBy("i").collect()] == [None] * len(texts)
