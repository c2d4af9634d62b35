"""The corpus pipeline, stage by stage, and the registered queries."""

from __future__ import annotations

import os
import random
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402
from compare import difference, duck  # noqa: E402
from feedmill.llm.simhash import fingerprint_of  # noqa: E402
from feedmill.llm.queries import ORACLE, QUERIES  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean"


@pytest.mark.parametrize("name", ORACLE)
def test_queries_equal_their_sql(spark, sf, name):
    assert difference(QUERIES[name](spark, sf), duck(sf), ORACLE[name]) is None


def test_every_query_is_registered():
    known = entry.queries()
    assert {*QUERIES, "pipeline"} <= set(known)
    assert {n.split("_")[0] for n in QUERIES} == {f"op{n}" for n in range(1, 14)}


@pytest.fixture
def docs(spark):
    long = "the cat and the dog went to the old house by the river and saw a bird in the tree "
    rows = [
        (1, long + "one day in may", "en"), (2, "The cat " + long[8:] + "one day in may", "en"), (3, "der hund und die katze sind im haus am fluss", "de"),
        (4, None, "en"), (5, "", "de"), (6, "123 !!", "en"), (7, "DER Hund und die Katze sind im Haus am Fluss", None), (None, "le chat est sur la table", "fr"),
        (9, long * 300, "en"), (9, long * 300, "en"),
    ]
    return spark.createDataFrame([(i, t, lang, "s", 0, True) for i, t, lang in rows], SCHEMA)


def test_stages(spark, docs):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "exact_dedup", "near_dedup", "packing"]
    told = stages["language_id"](spark, docs, "")
    assert told.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in told.collect()) == [0, 1, 2, 3, 7, 9, 9]
    exact = stages["exact_dedup"](spark, told, "")
    assert exact.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in exact.collect()) == [0, 2, 7, 9]
    near = stages["near_dedup"](spark, exact, "")
    assert near.columns == docs.columns and near.count() <= exact.count()
    packed = stages["packing"](spark, near, "").collect()
    assert {p["doc_id"] for p in packed} == {r["doc_id"] for r in near.collect()}


def test_stages_of_nothing(spark, docs):
    none = docs.where("doc_id < 0")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, "").collect() == []


def kept_by_brute_force(rows):
    """Ids that stay of (doc_id, text): letters, last of equal texts, first of each group of prints within 2 bits."""
    lettered = [(i, t) for i, t in rows if t and any(c.isalpha() for c in t)]
    last = {}
    for i, t in lettered:
        last[t.encode().lower()] = max(i, last.get(t.encode().lower(), i))
    prints = {i: fingerprint_of(t) for t, i in last.items()}
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, i in enumerate(ids):
        for j in ids[:n]:
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i for i in ids if find(i) == i}


def test_run_against_brute_force(spark, sf):
    packed = {r["doc_id"] for r in corpus_pipeline.run(spark, sf).select("doc_id").distinct().collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert packed == kept_by_brute_force([tuple(d) for d in docs])


def test_near_stage_against_brute_force(spark):
    """A thousand variants of one text, and groups of others, by links of their prints."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(500)}" for _ in range(300)]
    rows = []
    for _ in range(1000):
        changed = list(base)
        changed[rng.randrange(len(base))] = f"x{rng.randrange(30)}"
        rows.append(" ".join(changed))
    rows += [" ".join(f"y{rng.randrange(900)}" for _ in range(50)) for _ in range(200)]
    rows = [(i, t) for i, t in enumerate(dict.fromkeys(rows))]
    want = kept_by_brute_force(rows)
    assert 200 < len(want) < 700
    table = spark.createDataFrame([(i, t, "en", "s", 0, True) for i, t in rows], SCHEMA).repartition(3)
    assert {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, table, "").collect()} == want


def test_unlabelled_table_is_kept(spark, docs):
    bare = docs.withColumn("lang", F.lit(None).cast("string"))
    assert sorted(r["doc_id"] or 0 for r in corpus_pipeline.language_id(spark, bare, "").collect()) == [0, 1, 2, 3, 7, 9, 9]


def test_texts_in_an_unlabelled_script_are_kept(spark, docs):
    more = docs.union(spark.createDataFrame([(20, "ოცდაათი", None, "s", 0, True)], SCHEMA))
    assert 20 in {r["doc_id"] for r in corpus_pipeline.language_id(spark, more, "").collect()}
