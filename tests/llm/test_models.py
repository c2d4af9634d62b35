"""Language ID, language-model scores and nearest neighbours against plain Python."""

from __future__ import annotations

import collections
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedmill.llm import ann, language_id, lm_score
from feedmill.llm.frames import remainder, staged

SYLLABLES = {"aa": "ka lo mi ne tu".split(), "bb": "schra gnu pfö ßel ätz".split(), "cc": "que çon été oui œuf".split()}


def text_in(lang, rng, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def labelled(spark, n=90):
    rng = random.Random(1)
    rows = []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        rows.append((i, text_in(lang, rng, rng.randint(3, 60)), lang, "x", "y"))
    rows += [(900, None, "aa", "x", "y"), (901, "", "aa", "x", "y"), (902, "12 !? 3", "bb", "x", "y"), (None, "ka lo", None, "x", "y")]
    rows += [rows[0]] * 2
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score string, lang_pred string")


def brute_profile(texts, size):
    counts = collections.Counter()
    for text in texts:
        for word in "".join(c.lower() if c.isalpha() else " " for c in text).split():
            padded = f" {word} "
            counts.update(g for n in (1, 2, 3) for i in range(len(padded) - n + 1) if (g := padded[i : i + n]) != " ")
    code = lambda g: (len(g), [0 if c == " " else ord(c) for c in g])
    return sorted(counts, key=lambda g: (-counts[g], code(g)))[:size]


def test_language_id_against_brute_force(spark):
    docs = labelled(spark)
    training = docs.where(remainder(F.col("doc_id"), 4) != 2)
    got = language_id.detect_languages(docs, training).select("doc.doc_id", "doc.text", "doc.lang", "lang_pred", "score").collect()
    rows = [r for r in training.collect() if r["text"] is not None and r["lang"] is not None]
    profiles = {}
    for lang in {r["lang"] for r in rows}:
        profiles[lang] = {g: i for i, g in enumerate(brute_profile([r["text"] for r in rows if r["lang"] == lang], 300))}
    assert len(got) == docs.count()
    right = total = 0
    for r in got:
        mine = brute_profile([r["text"] or ""], 300)
        if not mine:
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        far = {lang: sum(abs(p[g] - i) if g in p else 300 for i, g in enumerate(mine)) for lang, p in profiles.items()}
        best = min(sorted(far), key=far.get)
        assert r["lang_pred"] == best and math.isclose(r["score"], 1 - far[best] / (300 * len(mine)))
        assert 0 <= r["score"] <= 1
        if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2:
            right, total = right + (best == r["lang"]), total + 1
    assert right / total > 0.95


def test_language_id_without_training_or_rows(spark):
    docs = labelled(spark, 5)
    none = docs.where("doc_id < 0")
    assert {r["lang_pred"] for r in language_id.detect_languages(docs, none).collect()} == {"und"}
    assert language_id.detect_languages(none, docs).collect() == []
    with pytest.raises(ValueError, match="max_languages"):
        language_id.learn_profiles(labelled(spark), max_languages=1)


def lm_rows(spark, n=80):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice("the The cat sat on a mat dog ÉTÉ x,y".split()) for _ in range(rng.randrange(40)))) for i in range(n)]
    rows += [(500, None), (501, ""), (502, " \t\n"), (None, "the cat"), (3, "the cat"), (3, "the cat"), (504, "new words only")]
    rows.append((505, "word " * 5000))
    return spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, score string, held string").repartition(4)


@pytest.mark.parametrize("owner_bytes", [64, 16_000_000])
def test_lm_scores_against_brute_force(spark, owner_bytes):
    docs = lm_rows(spark)
    got = lm_score.score(docs, remainder(F.col("doc_id"), 10) == 0, owner_bytes=owner_bytes).collect()
    counts, n, want = collections.Counter(), 0, []
    for r in docs.collect():
        words = (r["text"] or "").encode().lower().split() + [b"\n"]
        held = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0
        want.append((r["doc_id"], held, words))
        if not held:
            counts.update(words)
            n += len(words)
    assert len(got) == len(want)
    base = lambda words: sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (len(counts) + 1))) for w in words)
    rounded = lambda i, held, k, known, total, b: (i is None, i or 0, held, k, known, total, round(b, 6))
    assert sorted(rounded(r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got) == sorted(
        rounded(i, held, len(words), sum(w in counts for w in words), n, base(words)) for i, held, words in want
    )
    assert all(r["score"] <= 0 for r in got)
    trained = [r for r in got if not r["held_out"]]
    assert sum(r["score"] for r in trained) > sum(r["base_score"] for r in trained)


def test_lm_scores_of_nothing_and_from_nothing(spark):
    docs = lm_rows(spark)
    assert lm_score.score(docs.where("doc_id < 0"), F.lit(False)).collect() == []
    rows = lm_score.score(docs, F.lit(True)).collect()
    assert {r["train_tokens"] for r in rows} == {0} and all(r["base_score"] == 0 == r["score"] for r in rows)


def test_filter_never_misses_a_count():
    rng = np.random.default_rng(0)
    owners = 4
    left, right = rng.integers(0, 1 << 62, (2, 5000))
    keys = np.unique(lm_score.pair_keys(left, right, owners))
    counts = rng.integers(1, 2000, keys.size)
    owner = keys >> lm_score.PAIR_BITS
    segments = {o: lm_score.build_segment(keys[owner == o], counts[owner == o]) for o in range(owners)}
    model = lm_score.LogFrequencyFilter.of(owners, segments)
    assert (model.counts(keys) >= 1 << (lm_score.levels_of(counts) - 1)).all()
    assert (model.counts(keys) == 1 << (lm_score.levels_of(counts) - 1)).mean() > 0.98
    assert (model.counts(keys ^ 1) > 0).mean() < 0.02
    part = lm_score.LogFrequencyFilter.of(owners, {o: segments[o] for o in (1, 3)})
    rest = lm_score.LogFrequencyFilter.of(owners, {o: segments[o] for o in (0, 2)})
    assert (part.counts(keys) + rest.counts(keys) == model.counts(keys)).all()
    assert lm_score.LogFrequencyFilter.of(owners, {}).counts(keys).sum() == 0
    assert (model.counts(keys) >= 1).all()  # no pair is left out, however rare


def test_waves_of_segments():
    assert lm_score._waves([], 10) == []
    assert lm_score._waves([(0, 4), (1, 4), (3, 4), (4, 99), (7, 1)], 10) == [(0, 1), (3, 3), (4, 4), (7, 7)]


def test_scores_do_not_depend_on_the_size_of_a_wave(spark):
    docs = lm_rows(spark)
    told = lambda **kw: sorted((r["doc_id"] or -1, r["n_tokens"], round(r["score"], 9)) for r in lm_score.score(docs, F.lit(False), **kw).collect())
    whole = told(owner_bytes=4000)
    assert told(owner_bytes=4000, filter_bytes=1) == whole == told(owner_bytes=4000, filter_bytes=3000)


def brute_bigram(rows):
    """Scores under the same model with exact counts of pairs, rounded down to powers of two; rows are (words, held)."""
    words, pairs = collections.Counter(), collections.Counter()
    for text, held in rows:
        if not held:
            words.update(text)
            pairs.update(zip([b"\n", *text], text))
    n, v = sum(words.values()), len(words)
    single = lambda c: (c + 0.1) / (n + 0.1 * (v + 1))
    group = lambda c: min((c.bit_length() + 1) // 3, lm_score.CLASSES - 1)
    rounded = {p: 1 << (c.bit_length() - 1) for p, c in pairs.items()}
    evidence = np.zeros((lm_score.CLASSES, lm_score.WEIGHTS.size))
    for (h, w), c in pairs.items():
        ratio = min(1, max(rounded[h, w] - 1, 0) / max(words[h] - 1, 1))
        evidence[group(words[h])] += c * np.log10(lm_score.WEIGHTS * ratio + (1 - lm_score.WEIGHTS) * single(words[w] - 1))
    weight = lm_score.WEIGHTS[evidence.argmax(axis=1)]
    out = []
    for text, _ in rows:
        total = 0.0
        for h, w in zip([b"\n", *text], text):
            ratio = min(1, rounded.get((h, w), 0) / max(words[h], 1))
            share = weight[group(words[h])]
            total += math.log10(share * ratio + (1 - share) * single(words[w]))
        out.append(total)
    return out


def test_score_against_a_brute_force_bigram_model(spark, sf):
    """Held-out texts too; what differs are false hits of the filter, below a hundredth of a decade a token."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rows = [(r["doc_id"], (r["text"] or "").encode().lower().split() + [b"\n"]) for r in docs.collect()]
    held = [zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows]
    want = dict(zip([i for i, _ in rows], brute_bigram([(w, h) for (_, w), h in zip(rows, held)])))
    got = {r["doc_id"]: r for r in lm_score.score(docs, remainder(F.col("doc_id"), 10) == 0).collect()}
    assert got.keys() == want.keys()
    for part in (True, False):
        mine = [r for r in got.values() if r["held_out"] == part]
        apart = sum(abs(r["score"] - want[r["doc_id"]]) for r in mine) / sum(r["n_tokens"] for r in mine)
        assert apart < 0.01, (part, apart)
    gain = [r["score"] - r["base_score"] for r in got.values() if r["held_out"]]
    assert sum(gain) > 0


def vectors(spark, n=700, dim=32, seed=0):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in v], "x", 1) for i, v in enumerate(rng.standard_normal((n, dim)).astype(np.float32))]
    rows += [(9000 + i, rows[40][1], "x", 1) for i in range(30)]  # one very common vector
    nan, inf = float("nan"), float("inf")
    rows += [(20 * i + 20000, v, "x", 1) for i, v in enumerate([None, [0.0] * dim, [nan] * dim, [inf] + [1.0] * (dim - 1), [None] * dim, [1.0], []])]
    rows += [(None, rows[3][1], "x", 1)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string, rank int").repartition(5)


def brute_neighbours(rows, k):
    good = [(r["vec_id"], r["embedding"]) for r in rows if r["vec_id"] is not None and r["embedding"] and None not in r["embedding"]]
    good = [(i, v) for i, v in good if len(v) > 1 and np.isfinite(v).all() and any(v)]
    ids, matrix = np.array([i for i, _ in good]), np.array([v for _, v in good])
    out = {}
    for i, v in good:
        if i % 20 == 0:
            scores = ann.products(np.array(v), matrix)
            order = [int(j) for j in np.lexsort((ids, -scores)) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), float(scores[j])) for j in order]
    return out


def test_ann_recall_and_exact_scores(spark):
    rows = vectors(spark)
    got = {}
    for r in ann.search(rows, rows.where("vec_id % 20 = 0"), block_rows=200, query_rows=20).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = brute_neighbours(rows.collect(), 20)
    assert got.keys() == want.keys()
    scores = {(q, v): s for q, found in brute_neighbours(rows.collect(), 1000).items() for v, s in found}
    hits = 0
    for q, found in got.items():
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 21))
        assert [(-s, v) for _, v, s in found] == sorted((-s, v) for _, v, s in found)
        assert all(s == scores[q, v] for _, v, s in found)
        hits += len({v for _, v, _ in found} & {v for v, _ in want[q]})
    assert hits / (20 * len(want)) >= 0.9


def test_ann_bars_lose_nothing(spark, monkeypatch):
    """Blocks searched after the first ones send home less, and the same neighbours come out, ties and repeats included."""
    rows = vectors(spark)
    rows = rows.union(rows.where("vec_id % 7 = 0")).repartition(4)
    asked = rows.where("vec_id % 20 = 0")
    sent = {}
    for share in (1, 4):
        tables = []
        monkeypatch.setattr(ann, "staged", lambda df, name: tables.append(df) or staged(df, name))
        got = ann.search(rows, asked, radius=64, block_rows=50, query_rows=20, seed_share=share)
        sent[share] = sorted(map(tuple, got.collect()))
        assert len(tables) == (share > 1)
    assert sent[1] == sent[4]
    want = brute_neighbours(rows.collect(), 20)
    scores = {}
    for q, _, _, s in sent[4]:
        scores.setdefault(q, []).append(s)
    assert {q: sorted(s) for q, s in scores.items()} == {q: sorted(s for _, s in found) for q, found in want.items()}


def test_ann_with_few_or_no_candidates(spark):
    rows = vectors(spark, n=41)
    few = rows.where("vec_id in (0, 3, 20)")
    got = ann.search(few, few.where("vec_id % 20 = 0")).collect()
    assert sorted((r["query_id"], r["rank"]) for r in got) == [(0, 1), (0, 2), (20, 1), (20, 2)]
    none = rows.where("vec_id < 0")
    assert ann.search(none, none).collect() == []
    assert ann.search(rows, none).collect() == []


def test_ann_with_repeated_rows(spark):
    rows = vectors(spark, n=41).where("vec_id in (0, 3, 20, 21)")
    several = rows.union(rows.where("vec_id in (0, 3)")).repartition(3)
    got = ann.search(several, several.where("vec_id % 20 = 0"), block_rows=2, query_rows=1).collect()
    found = {q: sorted((r["rank"], r["vec_id"]) for r in got if r["query_id"] == q) for q in (0, 20)}
    assert [r for r, _ in found[0]] == [1, 2, 3, 4] and sorted(v for _, v in found[0]) == [3, 3, 20, 21]
    assert [r for r, _ in found[20]] == [1, 2, 3, 4, 5] and sorted(v for _, v in found[20]) == [0, 0, 3, 3, 21]


@pytest.mark.parametrize("radius", [0, 3, 9, 14, 64])
def test_probing_finds_every_code_within_the_radius(radius):
    rng = np.random.default_rng(radius)
    codes = rng.integers(0, 1 << 63, 4000).astype(np.uint64)
    codes[1::2] = codes[::2] ^ (np.uint64(1) << rng.integers(0, 60, 2000).astype(np.uint64))
    index = ann.MultiIndex(codes)
    for code in codes[:40].tolist():
        want = np.flatnonzero(np.bitwise_count(codes ^ np.uint64(code)) <= radius)
        assert (index.within(code, radius) == want).all()
