"""The trigram index: the same answers with and without it, from fewer files."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest

from feedmill.operators.search import search, search_widening
from feedmill.schema import ARTICLE
from feedmill.sources import textindex
from feedmill.sources.sink import insert_articles, read_store, upsert_articles
from feedmill.sources.textindex import candidate_files, maintain_text, read_mentions, trigrams

AS_OF = "2024-01-31 00:00:00"
WORDS = ["gold", "Gold price", "ÉTÉ", "straße", "uranium", "zz", "a b", "日本語", "xylophone", "no such word", "go", "100%", "x" * 1500]


def articles(spark, seed, n=60):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        text = " ".join(rng.choice(["plain", "text", "of", "no", "word"]) for _ in range(20))
        if i % 9 == 0:
            text += " " + rng.choice(WORDS)
        title, body = (text, None) if i % 2 else (None, text)
        rows.append((f"u{seed}-{i}", title, body, datetime(2024, 1, 31) - timedelta(hours=12 * i), "s", None, None, i, None))
    rows.append((f"rare{seed}", "once the Xylophone", "", datetime(2024, 1, 30), "s", None, None, n, None))
    return spark.createDataFrame(rows if seed == 0 else rows[:-1], ARTICLE)


def urls(df):
    return sorted(r.url for r in df.collect())


def test_trigrams_of_a_text():
    assert trigrams("").size == trigrams("ab").size == 0
    assert trigrams("aaaa").size == 1 and trigrams("abcabc").size == 3
    assert set(trigrams("日本語").tolist()) == {ord("日") << 42 | ord("本") << 21 | ord("語")}


@pytest.mark.parametrize("held", [textindex.HELD_GRAMS, 5])
def test_same_answers_whatever_is_covered(spark, tmp_path, monkeypatch, held):
    monkeypatch.setattr(textindex, "HELD_GRAMS", held)
    path = str(tmp_path / "store")
    assert read_mentions(spark, path, "gold").count() == 0

    def same():
        whole = read_store(spark, path)
        for word in WORDS:
            near = read_mentions(spark, path, word)
            assert urls(search(near, word, AS_OF, days=40, limit=None)) == urls(search(whole, word, AS_OF, days=40, limit=None))
            assert urls(search_widening(near, word, AS_OF)) == urls(search_widening(whole, word, AS_OF))

    insert_articles(articles(spark, 0), path, buckets=4)
    same()
    assert maintain_text(spark, path) and not maintain_text(spark, path)
    same()
    insert_articles(articles(spark, 1), path, buckets=4)
    upsert_articles(articles(spark, 1, 20), path, buckets=4)
    same()
    assert maintain_text(spark, path)
    same()


def test_rare_words_read_few_files(spark, tmp_path):
    path = str(tmp_path / "store")
    for seed in range(2):
        insert_articles(articles(spark, seed), path, buckets=8)
    every = candidate_files(spark, path, "xylophone")
    assert len(every) == 16  # nothing is covered
    maintain_text(spark, path)
    assert candidate_files(spark, path, "no such thing") == []
    rare = candidate_files(spark, path, "the xylophone")
    assert len(rare) == 1 and rare[0] in every
    assert read_mentions(spark, path, "the xylophone").inputFiles()[0].endswith(rare[0])
    assert candidate_files(spark, path, "pl") == every == candidate_files(spark, path, "plain")


def test_trigrams_of_one_batch_are_given_out_in_pieces(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(textindex, "HELD_GRAMS", 50)
    rows = [(" ".join(f"w{i}x{j}" for j in range(20)), None) for i in range(40)]
    place = str(tmp_path / "bucket=0" / "version=0")
    spark.createDataFrame(rows, "title string, body string").coalesce(1).write.parquet(place)
    entries = textindex._entries(spark, [place]).select("gram").collect()
    texts = {int(g) for title, _ in rows for g in trigrams(title)}
    assert {r.gram for r in entries} == texts and len(entries) > len(texts)
