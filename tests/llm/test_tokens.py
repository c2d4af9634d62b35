"""Byte-level BPE, packing and token files against the tokenizer libraries."""

from __future__ import annotations

import base64
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from feedmill.llm import byte_bpe, packing, token_files
from feedmill.llm.words import Known, WordEncoder

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " ", "  a", "a   b", "a\n  b", "\n\n a", "it's 'S don't", "<|endoftext|>", "x" * 3000, "ab" * 2000, " " * 500,
    "é" * 800, "\x00\x1c\x85\xa0", "日本語 テキスト", "🙂🙂", "é Å İ Σς", "１２３ 4五", "a.,;:!? b!", " x　y",
]


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def words():
    tokenizer = Tokenizer.from_file(WORDS)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def random_texts(n, seed=0):
    rng = random.Random(seed)
    letters = [chr(c) for c in [*range(0x180), *range(0x3B0, 0x3D0), 0x301, 0x2028, 0x3000, 0x1F600, 0xAC00]]
    letters += [" "] * 90 + ["\n"] * 20 + list("abcdefgh" * 9)
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(n)]


def test_pattern_is_the_published_one():
    assert byte_bpe.PATTERN == public_tokenizers.PATTERN


def test_bpe_equals_the_library(reference):
    bpe = byte_bpe.ByteBpe(RANKS, cache_parts=50)
    for text in [*ODD, *random_texts(1500)]:
        bpe.meet([text])
        ids = bpe.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text)
        assert bpe.decode(ids) == text.encode()


def test_bpe_of_many_parts_at_once(reference):
    bpe, texts = byte_bpe.ByteBpe(RANKS), random_texts(800, 4)
    bpe.meet(texts)
    assert [np.frombuffer(bpe.encode(t), "<u4").tolist() for t in texts] == reference.encode_ordinary_batch(texts)


def test_bpe_one_merge_at_a_time(reference):
    bpe = byte_bpe.ByteBpe(RANKS)
    for text in ("a", "aaaaaaa", "internationalisation", "x" * 500, "été" * 30):
        assert np.frombuffer(bpe._merge_one(text.encode()), "<u4").tolist() == reference._core_bpe.encode_single_piece(text.encode())


def test_bpe_where_a_merge_makes_a_lower_rank(tmp_path):
    """Ranks under which merging all pairs of one rank at once would go wrong."""
    tokens = [bytes([b]) for b in range(256)] + [b"aaaa", b"aa", b"aaa", b"ba", b"aab"]
    path = tmp_path / "ranks"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % r for r, t in enumerate(tokens)))
    bpe = byte_bpe.ByteBpe(str(path))
    library = tiktoken.Encoding("t", pat_str=byte_bpe.PATTERN, mergeable_ranks={t: r for r, t in enumerate(tokens)}, special_tokens={})
    texts = ["a" * n for n in range(1, 30)] + ["b" + "a" * n + "b" for n in range(12)] + ["abaab" * 5]
    bpe.meet(texts)
    assert [np.frombuffer(bpe.encode(t), "<u4").tolist() for t in texts] == library.encode_ordinary_batch(texts)


def table(spark, texts):
    rows = [(None if i == 3 else i, t, "x", "y") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens string").repartition(3)


def test_encode_decode(spark, reference):
    texts = [None, *ODD, *random_texts(50, 2)]
    got = byte_bpe.encode_decode(table(spark, texts), RANKS, keep=("doc_id", "text", "ids")).select("doc.text", "n_tokens", "ids", "decoded").collect()
    assert len(got) == len(texts)
    for r in got:
        want = reference.encode_ordinary(r["text"] or "")
        assert np.frombuffer(r["ids"], "<u4").tolist() == want and r["n_tokens"] == len(want)
        assert bytes(r["decoded"]) == (r["text"] or "").encode()


def test_word_encoder_equals_the_library(words):
    encoder = WordEncoder(WORDS, cache_words=30)
    for text in [*ODD, *random_texts(1500, 1)]:
        assert np.frombuffer(encoder.encode([text.encode()])[0], "<u4").tolist() == words(text)


def test_word_encoder_looks_each_word_up_once(words):
    class Counted(Known):
        asked = 0

        def __missing__(self, word):
            Counted.asked += 1
            return super().__missing__(word)

    encoder = WordEncoder(WORDS)
    encoder.cache = Counted()
    for _ in range(2):  # new words are met as holes, known ones need nothing but the look-up
        for text, ids in zip(["ab cd ab", "cd zq12 cd."], encoder.encode([b"ab cd ab", b"cd zq12 cd."])):
            assert np.frombuffer(ids, "<u4").tolist() == words(text)
        assert Counted.asked == 6 and not encoder.cache.holes
    assert all(type(v) is bytes for v in encoder.cache.values())


@pytest.mark.parametrize("seed", range(5))
def test_windows_are_full_and_hold_every_piece(seed):
    rng = random.Random(seed)
    pieces = [(rng.randint(1, 2047), i, 0) for i in range(rng.choice([0, 1, 2, 40, 200]))]
    parts = {}
    for size, window in packing.fill_windows(pieces, packing.TIERS):
        assert sum(p[0] for p in window) == size and size & (size - 1) == 0 and size <= 2048
        for length, doc, start in window:
            parts.setdefault(doc, []).append((start, length))
    for length, doc, _ in pieces:
        at = 0
        for start, n in sorted(parts[doc]):
            assert start == at
            at += n
        assert at == length


def test_packing(spark, words):
    rng = random.Random(6)
    texts = [None, "", *ODD, *[" ".join(rng.choice(["the", "packing", "xyzzy,"]) for _ in range(rng.randrange(3000))) for _ in range(40)]]
    docs = table(spark, texts)
    pieces = packing.pack(docs, WORDS).collect()
    digests = {(r["sequence_id"], r["offset"]): r["ids_crc32"] for r in packing.digest(packing.pack(docs, WORDS)).collect()}
    sequences, documents = {}, {}
    for p in pieces:
        ids = np.frombuffer(p["ids"], "<u4")
        assert ids.size == p["length"] > 0
        assert zlib.crc32(bytes(p["ids"])) == digests[p["sequence_id"], p["offset"]]
        sequences.setdefault(p["sequence_id"], []).append(p)
        documents.setdefault(p["doc_id"], []).append((p["start"], ids.tolist(), p["doc_tokens"]))
    for parts in sequences.values():
        at = 0
        for p in sorted(parts, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at == parts[0]["window"] and at & (at - 1) == 0 and at <= 2048
        assert len({p["step_id"] for p in parts}) == 1
    for i, text in enumerate(texts):
        got, at = [], 0
        for start, ids, total in sorted(documents[None if i == 3 else i]):
            assert start == at
            at += len(ids)
            got += ids
        assert got == [*words(text or ""), 1] and total == len(got)
    steps = {}
    for parts in sequences.values():
        steps[parts[0]["step_id"], parts[0]["window"]] = steps.get((parts[0]["step_id"], parts[0]["window"]), 0) + parts[0]["window"]
    assert max(steps.values()) <= packing.STEP_TOKENS


def test_packing_of_nothing(spark):
    assert packing.pack(table(spark, ["a"]).where("doc_id < 0"), WORDS).collect() == []


@pytest.mark.parametrize("block_ids", [7, 64, 1 << 19])
def test_token_counts(spark, words, tmp_path, block_ids):
    rng = random.Random(9)
    texts = [None, "", *ODD[:8], *[" ".join(["word"] * rng.randrange(60)) for _ in range(40)]]
    path = f"{tmp_path}/files"
    token_files.write_token_files(table(spark, texts), path, WORDS)
    got = token_files.count_tokens(spark, path, block_ids=block_ids).collect()
    want = {None if i == 3 else i: len(words(t or "")) for i, t in enumerate(texts)}
    assert {r["key"]: r["n_tokens"] for r in got} == want and len(got) == len(texts)
    by_file = {}
    for r in got:
        by_file.setdefault(r["file"], []).append(r)
    for rows in by_file.values():
        rows.sort(key=lambda r: r["number"])
        assert [r["number"] for r in rows] == list(range(len(rows)))
        for a, b in zip(rows, rows[1:]):
            assert b["start"] == a["start"] + a["n_tokens"] + token_files.KEY_IDS + 1


def test_token_counts_of_foreign_files(spark, tmp_path):
    """Files of another writer, without keys, with an unfinished document and with nothing at all."""
    ids = [5, 6, 9, 9, 7, 9, 8, 8]
    (tmp_path / "a").write_bytes(np.array(ids, "<u2").tobytes())
    (tmp_path / "b").write_bytes(b"")
    got = token_files.count_tokens(spark, str(tmp_path), separator=9, key_width=0, block_ids=2).collect()
    assert [(r["number"], r["start"], r["n_tokens"], r["key"]) for r in sorted(got, key=lambda r: r["number"])] == [
        (0, 0, 2, None), (1, 3, 0, None), (2, 4, 1, None)
    ]


@pytest.mark.parametrize("key", [None, 0, 1, -1, 1 << 62, -(1 << 63), (1 << 63) - 1])
def test_keys_come_back(key):
    ids = np.frombuffer(token_files.key_ids(key), "<u2")
    assert (ids != token_files.SEPARATOR).all() and token_files.keys_of(ids[None, :]) == [key]
