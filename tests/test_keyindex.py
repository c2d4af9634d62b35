"""The index of stored URLs: right whatever it covers, and row groups without the keys are not read."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from feedmill.schema import ARTICLE
from feedmill.sources import files, keyindex
from feedmill.sources.keyindex import known_urls, maintain
from feedmill.sources.parts import state, stored_files
from feedmill.sources.sink import compact_store, insert_articles, read_store, upsert_articles


def articles(spark, urls, title="1", start=0):
    when = datetime(2024, 1, 1)
    return spark.createDataFrame([(u, title, "b", when, "s", None, None, start + n, None) for n, u in enumerate(urls)], ARTICLE)


def known(spark, path, urls, **kw):
    batch = spark.createDataFrame([(u,) for u in urls], "url string")
    return sorted((r.url for r in known_urls(spark, path, batch, 2, **kw).collect()), key=repr)


def parts(spark, path):
    return state(spark, f"{path}/keys")[1]


@pytest.mark.parametrize("literals", [0, keyindex.LITERALS])
def test_answers_do_not_depend_on_what_is_covered(spark, tmp_path, literals):
    path = str(tmp_path / "store")
    asked = [f"u{i}" for i in range(0, 60, 3)] + [None, None, "u0", "", "é"]
    assert known(spark, path, asked, literals=literals) == []
    insert_articles(articles(spark, [f"u{i}" for i in range(20)] + [None]), path, buckets=2)
    want = sorted([*(f"u{i}" for i in range(0, 20, 3)), None], key=repr)
    assert known(spark, path, asked, literals=literals) == want  # no index yet
    assert maintain(spark, path) and not maintain(spark, path)
    assert known(spark, path, asked, literals=literals) == want  # all covered
    insert_articles(articles(spark, [f"u{i}" for i in range(15, 40)] + ["é"]), path, buckets=2)
    want = sorted([*(f"u{i}" for i in range(0, 40, 3)), None, "é"], key=repr)
    assert known(spark, path, asked, literals=literals) == want  # a part of it
    upsert_articles(articles(spark, [f"u{i}" for i in range(30, 50)], "2", 100), path, buckets=2)
    want = sorted([*(f"u{i}" for i in range(0, 50, 3)), None, "é"], key=repr)
    assert known(spark, path, asked, literals=literals) == want  # other versions of the buckets
    assert maintain(spark, path)
    assert known(spark, path, asked, literals=literals) == want
    assert known(spark, path, [], literals=literals) == []


def test_an_interrupted_call_is_never_read(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    insert_articles(articles(spark, ["a", "b", None]), path, buckets=2)

    def fail(*args):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(files, "put", fail)
        with pytest.raises(OSError):
            maintain(spark, path)
    assert parts(spark, path) == [] and known(spark, path, ["a", "c"]) == ["a"]
    assert maintain(spark, path)
    assert len(list((tmp_path / "store" / "keys").glob("part=*"))) == 1  # what was left behind is gone
    assert known(spark, path, ["a", "c", None]) == sorted(["a", None], key=repr)


def test_parts_stay_few_and_cover_all(spark, tmp_path):
    path = str(tmp_path / "store")
    for n in range(5):
        insert_articles(articles(spark, [f"u{n}-{i}" for i in range(30)]), path, buckets=2, index_files=1)
        covered = {f for p in parts(spark, path) for f in p["files"]}
        assert covered == {f for names in stored_files(spark, path).values() for f in names}
    assert len(parts(spark, path)) <= 2
    compact_store(spark, path, buckets=2)
    assert maintain(spark, path)
    assert sum(spark.read.parquet(f"{path}/keys/{p['name']}").count() for p in parts(spark, path)) <= 2 * 150
    assert known(spark, path, [f"u{n}-{i}" for n in range(6) for i in (0, 29, 30)]) == sorted(f"u{n}-{i}" for n in range(5) for i in (0, 29))
    assert insert_articles(articles(spark, ["u0-0", "new"]), path, buckets=2, index_files=1) == 1
    assert read_store(spark, path).count() == 151


def rows_scanned(df):
    """Rows that the scans of a plan give to the operators above them."""
    df.collect()
    leaves, total = df._jdf.queryExecution().executedPlan().collectLeaves(), 0
    for i in range(leaves.size()):
        metrics = leaves.apply(i).metrics()
        if metrics.contains("numFiles"):
            total += metrics.apply("numOutputRows").value()
    return total


def test_row_groups_without_the_keys_are_skipped(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    monkeypatch.setattr(keyindex, "ROW_GROUP_BYTES", 16_000)
    urls = spark.range(20_000).selectExpr("concat('https://x.example/', id) as url", "'t' as title", "'b' as body", "id as ingest_seq")
    whole = urls.selectExpr("url", "title", "body", "timestamp'2024-01-01' as date", "'s' as source", "cast(null as string) as searchKey",
                            "cast(null as string) as image", "ingest_seq", "cast(null as map<string,string>) as extra")
    insert_articles(whole, path, buckets=2, index_files=1)
    monkeypatch.undo()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        def scanned(*asked):
            values = list(spark.range(1).select(*[keyindex.key_of(F.lit(a)).alias(f"k{n}") for n, a in enumerate(asked)]).first())
            spark.conf.set(keyindex.IN_THRESHOLD, "1000")
            places = [f"{path}/keys/{p['name']}" for p in parts(spark, path)]
            return rows_scanned(spark.read.schema("key binary").parquet(*places).where(F.col("key").isin([bytes(v) for v in values])))

        one = scanned("https://x.example/7")
        assert 1 <= one <= 4000  # one row group of each file that may have it, of 20,000 rows
        assert scanned("https://nowhere.example/1") == 0  # in the range of a row group, not in its bloom filter
        assert scanned(*[f"https://nowhere.example/{i}" for i in range(40)]) <= 4000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset(keyindex.IN_THRESHOLD)
