"""Exact and near duplicates against brute force."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from feedmill.llm import exact_dedup as exact
from feedmill.llm import simhash
from feedmill.llm.components import components

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, row long, kept string, print string, doc string"


def table(spark, rows):
    """Documents with columns whose names clash with those of results."""
    return spark.createDataFrame([(i, t, n, "k", "p", "d") for n, (i, t) in enumerate(rows)], SCHEMA).repartition(5)


def random_rows(seed):
    rng = random.Random(seed)
    texts = ["", None, "A b c", "a B c", "É é", "é É", "x" * 70_000, "X" * 70_000, " a b c"]
    rows = [(rng.choice([None, *range(40)]), rng.choice(texts)) for _ in range(120)]
    return rows + [(1000 + i, f"only {i}") for i in range(60)] + [(7, "same")] * 5


@pytest.mark.parametrize("size", [0, 1, 2, 50])
def test_golomb_codes_come_back(size):
    rng = np.random.default_rng(size)
    for top in (1, 3, 1000, 1 << 40):
        values = np.sort(rng.integers(0, top, size))
        assert (exact.golomb_decode(exact.golomb_encode(values)) == values).all()


def test_golomb_codes_are_short():
    values = np.sort(np.random.default_rng(0).integers(0, 1 << 28, 100_000))
    assert len(exact.golomb_encode(values)) * 8 / values.size < 14  # log2 of the mean gap is 11.4


@pytest.mark.parametrize("limits", [{}, {"owner_rows": 3, "wave_bits": 20}])
def test_exact_dedup_against_brute_force(spark, limits):
    rows = random_rows(1)
    got = exact.exact_dedup(table(spark, rows), **limits).select("doc.*", F.struct("keep_id", "group_size", "kept", "text_sha256").alias("out")).collect()
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(FOLD), []).append(i)
    assert sorted(r["row"] for r in got) == list(range(len(rows)))
    kept = {}
    for r in got:
        folded = (r["text"] or "").translate(FOLD)
        ids = groups[folded]
        known = [i for i in ids if i is not None]
        assert r["out"]["keep_id"] == (max(known) if known else None)
        assert r["out"]["group_size"] == len(ids)
        assert r["out"]["text_sha256"] == hashlib.sha256(folded.encode()).hexdigest()
        if r["out"]["kept"]:
            assert r["doc_id"] == r["out"]["keep_id"]
            kept[folded] = kept.get(folded, 0) + 1
    assert kept == dict.fromkeys(groups, 1)


def test_exact_dedup_of_nothing(spark):
    assert exact.exact_dedup(table(spark, [(1, "a")]).where("doc_id < 0")).collect() == []


def brute_fingerprint(text):
    words = (text or "").translate(FOLD).replace("\t", " ").replace("\n", " ").split(" ")
    words = [w for w in words if w]
    n = min(3, len(words))
    shingles = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] if words else []
    out = 0
    for bit in range(64):
        ones = sum(xxhash.xxh64_intdigest(s.encode(), 42) >> bit & 1 for s in shingles)
        out |= (2 * ones > len(shingles)) << bit
    return out


@pytest.mark.parametrize("text", ["", "one", "One two", "a b c", "a b c a b c a b c d", "é É\tx\ny  z", " lead and trail "])
def test_fingerprints(text):
    assert simhash.fingerprint_of(text.encode()) == brute_fingerprint(text)


def test_golay_keys_meet_within_two_bits():
    tables, rng = simhash.golay_tables(), np.random.default_rng(3)
    words = rng.integers(0, 1 << 23, 3000)
    for flips in (0, 1, 2):
        other = words.copy()
        for i in range(words.size):
            for b in rng.choice(23, flips, replace=False):
                other[i] ^= 1 << int(b)
        a, b = simhash.golay_keys(words, tables), simhash.golay_keys(other, tables)
        assert (a[:, :, None] == b[:, None, :]).any((1, 2)).all()


def roots_of(nodes, edges):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def test_links_connect_what_is_near_and_nothing_else(spark):
    rng = random.Random(5)
    prints = set()
    for _ in range(30):
        base = rng.getrandbits(64)
        for _ in range(12):
            base ^= sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 2, 3])))
            prints.add(base)
    centre = rng.getrandbits(64)
    prints |= {centre ^ 1 << b for b in range(64)} | {0, 1, 2}
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = simhash.near_links(spark.createDataFrame([(p,) for p in signed], "print long").repartition(6)).collect()
    assert all(((r["u"] ^ r["v"]) & (1 << 64) - 1).bit_count() <= 2 for r in links)
    near = [(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 2]
    whole = lambda p: p & (1 << 64) - 1
    assert roots_of(prints, near) == roots_of(prints, [(whole(r["u"]), whole(r["v"])) for r in links])


@pytest.mark.parametrize("split", [2, 7, 100, 1 << 14])
def test_near_pairs_are_the_same_however_divided(split):
    rng = random.Random(split)
    base = rng.getrandbits(64)
    prints = {base ^ sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 3, 9, 12]))) for _ in range(400)}
    prints = sorted(prints)
    near = [(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 2]
    found = [(int(u), int(v)) for u, vs in simhash.near_pairs(np.array(prints, np.uint64), 2, split) for v in vs]
    assert all((u ^ v).bit_count() <= 2 for u, v in found)
    assert roots_of(prints, near) == roots_of(prints, found)


@pytest.mark.parametrize("shape", ["chain", "star", "random", "none"])
def test_components(spark, shape):
    rng = random.Random(shape)
    edges = {
        "chain": [(i, i + 1) for i in range(60)],
        "star": [(500, i) for i in range(100)] + [(3, 900), (901, 902)],
        "random": [(rng.randrange(300), rng.randrange(300)) for _ in range(200)],
        "none": [(4, 4)],
    }[shape]
    edges = [e if rng.random() < 0.5 else e[::-1] for e in edges]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    nodes = {n for a, b in edges if a != b for n in (a, b)}
    assert got == roots_of(nodes, [e for e in edges if e[0] != e[1]])


def test_simhash_dedup_keeps_one_of_each_component(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(900)]
    rows = []
    for i in range(25):
        text = [rng.choice(words) for _ in range(400)]
        rows.append((rng.choice([None, i]), " ".join(text)))
        for j in range(rng.randrange(4)):
            text[rng.randrange(400)] = "changed"
            rows.append((100 * (j + 1) + i, " ".join(text)))
    rows += [(900, ""), (901, None), (902, "  "), (5, "again"), (5, "again"), (None, "no id"), (None, "no id")]
    got = simhash.simhash_dedup(table(spark, rows)).select("doc.*", F.struct("print", "component_id", "kept").alias("out")).collect()
    assert sorted(r["row"] for r in got) == list(range(len(rows)))
    prints = {r["row"]: brute_fingerprint(r["text"]) for r in got}
    assert all(r["out"]["print"] & (1 << 64) - 1 == prints[r["row"]] for r in got)
    distinct = sorted(set(prints.values()))
    roots = roots_of(distinct, [(a, b) for a in distinct for b in distinct if a < b and (a ^ b).bit_count() <= 2])
    members = {}
    for r in got:
        members.setdefault(roots[prints[r["row"]]], []).append(r)
    for rows_of in members.values():
        ids = [r["doc_id"] for r in rows_of if r["doc_id"] is not None]
        assert {r["out"]["component_id"] for r in rows_of} == {min(ids) if ids else None}
        kept = [r for r in rows_of if r["out"]["kept"]]
        assert len(kept) == 1 and kept[0]["doc_id"] == (min(ids) if ids else None)


def test_simhash_dedup_of_nothing(spark):
    assert simhash.simhash_dedup(table(spark, [(1, "a")]).where("doc_id < 0")).collect() == []
