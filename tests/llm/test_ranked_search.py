"""Ranked search against a brute force over all documents."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedmill.llm import ranked_search as rs

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
DOCS = "doc_id long, text string, score string, rank string, query string, id string"
ITEMS = "item_id long, text string, doc_id string, query string, item string"


def terms_of(text):
    return [t.translate(FOLD) for t in TERM.findall(text or "")]


def docs_table(spark, rows):
    """Documents with columns whose names clash with those of results."""
    return spark.createDataFrame([(i, t, "s", "r", "q", "i") for i, t in rows], DOCS).repartition(4)


def items_table(spark, rows):
    return spark.createDataFrame([(i, t, "d", "q", "i") for i, t in rows], ITEMS)


def brute(docs, items, k=10):
    """Every item's documents by score and id, as (item, rank, document, score)."""
    counted = [(i, Counter(terms_of(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    number, total = len(counted), sum(sum(c.values()) for _, c in counted)
    held = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in counted:
            m = 100 - 90 + (90 * sum(c.values()) * number) // total
            score = sum(
                math.floor(1000 * math.log((2 * number + 2) / (2 * held[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in set(terms_of(text))
                if t in c
            )
            if score > 0:
                scored.append((-score, i is not None, i or 0, i))
        out += [(item, n + 1, i, -s) for n, (s, _, _, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def answers(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def random_tables(seed, n_docs=300):
    rng = random.Random(seed)
    common = ["the", "of", "and", "Zeit", "été"]
    rare = [f"w{i}" for i in range(120)]
    word = lambda: rng.choice(common) if rng.random() < 0.7 else rng.choice(rare)
    docs = [(i, " ".join(word() for _ in range(rng.choice([1, 5, 40, 200])))) for i in range(n_docs)]
    docs += [(n_docs, None), (n_docs + 1, ""), (None, "the w1 w2"), (n_docs + 2, "--- !!"), (5, docs[5][1])]
    docs += [(1000 + i, "the W7 w7 of") for i in range(60)]  # a group of copies: ties
    items = [(i, ", ".join(word().upper() for _ in range(rng.choice([1, 3, 30])))) for i in range(25)]
    return docs, items + [(90, None), (91, "..."), (92, "the"), (92, "the"), (None, "w7 the"), (93, "nowhere")]


@pytest.mark.parametrize("limits", [{}, {"block_postings": 20}, {"wave_items": 4}, {"wave_chars": 100, "k": 3}])
def test_against_brute_force(spark, limits):
    docs, items = random_tables(1)
    got = answers(rs.ranked_search(docs_table(spark, docs), items_table(spark, items), **limits))
    assert got == brute(docs, items, limits.get("k", 10))


def test_accumulators_are_limited_and_results_whole():
    rng = np.random.default_rng(0)
    texts = [b"rare " * 3 + b"the of and" if n < 10 else b"the of and " * int(rng.integers(1, 9)) for n in range(500)]
    vocabulary = {w: n for n, w in enumerate([b"rare", b"and", b"of", b"the"])}
    lengths, term, owner, count = rs.postings(texts, vocabulary)
    held = np.bincount(term, minlength=4)
    weights = np.array([rs.weight(600, h) for h in held])
    block = rs.Block(lengths, term, owner, count, weights, 600, int(lengths.sum()))
    found, scores = block.answer([0, 1, 2, 3], 10)
    assert block.made == 10 and sorted(found.tolist()) == list(range(10))
    want = sum(weights[term[owner == 3]] * rs.impact(count[owner == 3], lengths[[3]], 600, int(lengths.sum())))
    assert scores[found.tolist().index(3)] == want
    whole = rs.Block(lengths, term, owner, count, weights, 600, int(lengths.sum()))
    whole.answer([0, 1, 2, 3], 500)
    assert whole.made == 500


def test_equal_bounds_still_make_accumulators():
    """A document that only ties with the kth partial score may win by its id."""
    texts = [b"b", b"a"]
    lengths, term, owner, count = rs.postings(texts, {b"a": 0, b"b": 1})
    block = rs.Block(lengths, term, owner, count, np.array([500, 500]), 2, 2)
    found, scores = block.answer([0, 1], 1)
    assert sorted(found.tolist()) == [0, 1] and len(set(scores.tolist())) == 1


def test_floor_of_other_blocks_skips_only_what_cannot_reach_it():
    texts = [b"a"] * 5 + [b"b"] * 5
    lengths, term, owner, count = rs.postings(texts, {b"a": 0, b"b": 1})
    block = rs.Block(lengths, term, owner, count, np.array([900, 100]), 10, 10)
    top = int(block.answer([0, 1], 5)[1].max())
    assert block.answer([0, 1], 5, floor=top)[0].size == 5
    assert block.answer([0, 1], 5, floor=top + block.bounds[1] + 1)[0].size == 0


def test_very_long_text_and_common_word(spark):
    docs = [(0, "the " * 300_000 + "needle")] + [(i, "the hay") for i in range(1, 400)]
    items = [(1, "the needle"), (2, "the"), (3, "hay")]
    assert answers(rs.ranked_search(docs_table(spark, docs), items_table(spark, items))) == brute(docs, items)


def test_empty_tables(spark):
    docs, items = docs_table(spark, [(0, "x")]), items_table(spark, [(0, "x")])
    none = F.lit(False)
    assert answers(rs.ranked_search(docs.where(none), items)) == []
    empty = rs.ranked_search(docs, items.where(none))
    assert answers(empty) == [] and empty.dtypes == rs.ranked_search(docs, items).dtypes
    assert answers(rs.ranked_search(docs, items_table(spark, [(0, None)]))) == []


def test_other_column_names(spark):
    docs = spark.createDataFrame([("b", "x y"), ("a", "x y")], "key string, body string")
    items = spark.createDataFrame([(1, "x"), (2, "y z")], "n int, q string")
    got = rs.ranked_search(docs, items, text_col="body", id_col="key", query_text_col="q", item_col="n")
    assert [(r["item_id"], r["rank"], r["doc_id"]) for r in got.orderBy("item_id", "rank").collect()] == [
        (1, 1, "a"), (1, 2, "b"), (2, 1, "a"), (2, 2, "b"),
    ]
