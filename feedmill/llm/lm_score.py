"""Language-model scores from a log-frequency Bloom filter.

The model is a bigram model over words. Word counts are exact; counts of word pairs live in a Bloom
filter that stores the logarithm of each count: a pair with count c is put in once for every level up
to floor(log2 c) + 1, under a key that names pair and level, and its count is read back by probing level after level
until one is missing. A filter has no false misses, so a count is never read too low by more than its rounding.

    P(w | h) = l * c(h, w) / c(h) + (1 - l) * (c(w) + 0.1) / (N + 0.1 * (V + 1))

The weight l depends on how often the history h was seen. It is the one, out of ``WEIGHTS``, under which the
training text is most probable when every occurrence is left out of the counts in turn.

A pair of which either word is unknown has no count, and none is read higher than the rarer of its words occurs: this
takes most false hits of the filter, which are fewer than one in a hundred probed pairs.

Texts are turned once into blocks of word numbers and written to shared scratch. A block asks the owners of
word hashes for the counts of its distinct words only, so neither the vocabulary nor the tokens of all documents
ever meet in one place. Owners of pair hashes count the pairs of all blocks and build one segment of the filter
each, as large as its pairs need: the filter grows with the input and no pair is left out. It is broadcast in waves
of segments of at most ``FILTER_BYTES``; blocks probe every wave for the pairs it holds. Hashes travel sorted, as
Golomb codes of their gaps.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.functions.columns import quoted
from feedmill.llm.exact_dedup import golomb_decode, golomb_encode
from feedmill.llm.frames import bounded_batches, gathered, staged, texts_of

BLOCK_BYTES = 8_000_000
OWNER_BYTES = 16_000_000
FILTER_BYTES = 80 << 20
ENTRY_BITS = 10
PROBES = 5
LEVELS = 32
PAIR_BITS = 40
END = b"\n"  # no word holds white space, so this is no word
WEIGHTS = np.array([0.0, 0.02, 0.06, 0.15, 0.3, 0.5, 0.7, 0.9])
CLASSES = 8
MIX = np.uint64(0x9E3779B97F4A7C15)
MIX_TWO = np.uint64(0xC2B2AE3D27D4EB4F)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (multiplications and shifted xors)."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_hash(word: bytes) -> int:
    """63 bits, so that hashes and their gaps are signed integers too."""
    return xxhash.xxh64_intdigest(word) >> 1


def owner_of(hashes: np.ndarray, owners: int) -> np.ndarray:
    """The owner of a word hash, by its high 31 bits: owners of sorted hashes are sorted."""
    return (hashes >> 32) * owners >> 31


def pair_keys(left: np.ndarray, right: np.ndarray, owners: int) -> np.ndarray:
    """Word pairs as their owner, then ``PAIR_BITS`` bits: an owner's million pairs meet one another once in a million."""
    key = mixed(left.astype(np.uint64) * MIX + right.astype(np.uint64))
    owner = (key >> np.uint64(32)) * np.uint64(owners) >> np.uint64(32)
    return (owner << np.uint64(PAIR_BITS) | mixed(key) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)


def squeeze(values: np.ndarray) -> bytes:
    """Integers byte by byte of equal weight, compressed."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unsqueeze(blob: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def addresses(keys: np.ndarray, level: int, probe: int, size: np.ndarray | int) -> np.ndarray:
    """A bit of a segment of ``size`` bits, by double hashing of pair and level."""
    one = mixed(keys.astype(np.uint64) + np.uint64(level * int(MIX_TWO) & 0xFFFFFFFFFFFFFFFF))
    two = mixed(one ^ MIX) | np.uint64(1)
    return ((one + np.uint64(probe) * two) % np.asarray(size, np.uint64)).astype(np.int64)


def build_segment(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A segment with all pairs, packed; it has ``ENTRY_BITS`` bits for every level of a pair."""
    top = levels_of(counts)
    size = max(8, -(-int(top.sum()) * ENTRY_BITS // 8) * 8)
    marks = np.zeros(size, bool)
    for level in range(1, int(top.max(initial=0)) + 1):
        some = keys[top >= level]
        for probe in range(PROBES):
            marks[addresses(some, level, probe, size)] = True
    return np.packbits(marks, bitorder="little")


def levels_of(counts: np.ndarray) -> np.ndarray:
    """The quantised logarithm of a count: floor(log2 c) + 1."""
    return np.frexp(counts.astype(np.float64))[1]


@dataclass(frozen=True)
class LogFrequencyFilter:
    """Segments, one after the other; a pair's key names its owner and so its segment, if that is here."""

    bits: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray

    @classmethod
    def of(cls, owners: int, segments: dict[int, np.ndarray]) -> LogFrequencyFilter:
        """The filter of some owners' segments; starts and sizes are in bits."""
        sizes = np.zeros(owners, np.int64)
        for owner, bits in segments.items():
            sizes[owner] = 8 * bits.size
        whole = np.concatenate([segments[o] for o in sorted(segments)]) if segments else np.zeros(0, np.uint8)
        return cls(whole, np.cumsum(sizes) - sizes, sizes)

    def counts(self, keys: np.ndarray) -> np.ndarray:
        """Counts as the filter holds them: the lowest count of the highest level found, 0 if none is."""
        out = np.zeros(keys.size, np.int64)
        owner = keys >> PAIR_BITS
        size, base = self.sizes[owner], self.starts[owner]
        left = np.flatnonzero(size)
        for level in range(1, LEVELS + 1):
            for probe in range(PROBES):
                if not left.size:
                    return out
                at = base[left] + addresses(keys[left], level, probe, size[left])
                left = left[(self.bits[at >> 3] >> (at & 7)) & 1 == 1]
            out[left] = 1 << (level - 1)
        return out


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of texts as numbers of words, with the hashes of a block's distinct words in order."""
    task, serial = TaskContext.get().partitionId(), 0
    for group in gathered(batches, BLOCK_BYTES):
        numbers: dict[bytes, int] = {END: 0}
        ids, held, sizes, tokens = [], [], [], []
        for batch in group:
            ids += batch.column(0).to_pylist()
            held += batch.column(2).to_pylist()
            for text in texts_of(batch.column(1)):
                words = text.lower().split()  # of bytes: A-Z only, and exactly the six ASCII white-space bytes
                tokens.append(np.array([numbers.setdefault(w, len(numbers)) for w in words] + [0], np.uint32))
                sizes.append(len(words) + 1)
        hashes = np.array([word_hash(w) for w in numbers], np.int64)
        order = np.argsort(hashes)
        place = np.empty(order.size, np.uint32)
        place[order] = np.arange(order.size, dtype=np.uint32)
        stream = place[np.concatenate(tokens)]
        train = np.repeat(~np.array(held, bool), sizes)
        counts = np.bincount(stream[train], minlength=order.size)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([task << 24 | serial], pa.int64()),
                pa.array([ids], pa.list_(batch.schema.field(0).type)),
                pa.array([held], pa.list_(pa.bool_())),
                pa.array([sizes], pa.list_(pa.int64())),
                pa.array([int(place[0])], pa.int64()),
                pa.array([golomb_encode(hashes[order])], pa.binary()),
                pa.array([squeeze(counts.astype("<u4"))], pa.binary()),
                pa.array([squeeze(stream.astype("<u4"))], pa.binary()),
            ],
            ["block", "ids", "held", "sizes", "end", "hashes", "counts", "stream"],
        )
        serial += 1


def _runs(owner: np.ndarray) -> list[tuple[int, int, int]]:
    """``(owner, begin, end)`` of sorted owners."""
    edges = [0, *(np.flatnonzero(np.diff(owner)) + 1).tolist(), owner.size]
    return [(int(owner[a]), a, b) for a, b in zip(edges, edges[1:]) if b > a]


def _requests(owners: int):
    """A block's distinct words and their training counts, to the owners of their hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, hashes, counts in zip(*(batch.column(i).to_pylist() for i in range(3))):
                hashes, counts = golomb_decode(hashes), unsqueeze(counts, "<u4")
                parts = _runs(owner_of(hashes, owners))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([o for o, _, _ in parts], pa.int64()),
                        pa.array([block] * len(parts), pa.int64()),
                        pa.array([golomb_encode(hashes[a:b]) for _, a, b in parts], pa.binary()),
                        pa.array([squeeze(counts[a:b]) for _, a, b in parts], pa.binary()),
                    ],
                    ["owner", "block", "hashes", "counts"],
                )

    return run


def _replies(requests: pa.Table) -> pa.Table:
    """Total counts for each request; the owner's own share of N and V rides on its first reply."""
    hashes = [golomb_decode(b) for b in requests["hashes"].to_pylist()]
    counts = np.concatenate([unsqueeze(b, "<u4") for b in requests["counts"].to_pylist()])
    _, where = np.unique(np.concatenate(hashes), return_inverse=True)
    totals = np.bincount(where, weights=counts).astype(np.int64)
    replies = np.split(totals[where], np.cumsum([h.size for h in hashes])[:-1])
    n = len(replies)
    return pa.table(
        {
            "block": requests["block"],
            "owner": requests["owner"],
            "totals": pa.array([squeeze(r) for r in replies], pa.binary()),
            "tokens": pa.array([int(totals.sum())] + [0] * (n - 1), pa.int64()),
            "words": pa.array([int((totals > 0).sum())] + [0] * (n - 1), pa.int64()),
        }
    )


def _joined(replies: pa.Table) -> pa.Table:
    """A block's counts, from its replies in the order of their owners."""
    parts = sorted(zip(replies["owner"].to_pylist(), replies["totals"].to_pylist()))
    whole = np.concatenate([unsqueeze(t, "<i8") for _, t in parts])
    return pa.table({"block": replies["block"].slice(0, 1), "known": pa.array([squeeze(whole)], pa.binary())})


def _pairs_of(hashes: np.ndarray, stream: np.ndarray, end: int, use: np.ndarray | slice, owners: int):
    """History and word of each token in ``use``, the distinct pairs' keys, and which of them each token has.

    The history of a text's first word is an end.
    """
    before = np.concatenate([[end], stream[:-1]])[use]
    now = stream[use]
    pairs, which = np.unique(before << 32 | now, return_inverse=True)
    return before, now, pair_keys(hashes[pairs >> 32], hashes[pairs & 0xFFFFFFFF], owners), which


def _pairs(owners: int):
    """Training pairs of a block, counted, to the owners of their keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for held, sizes, end, hashes, stream in zip(*(batch.column(i).to_pylist() for i in range(5))):
                train = np.repeat(~np.array(held, bool), sizes)
                stream = unsqueeze(stream, "<u4").astype(np.int64)
                _, _, keys, which = _pairs_of(golomb_decode(hashes), stream, end, train, owners)
                counts = np.bincount(which, minlength=keys.size)
                order = np.argsort(keys)
                keys, counts = keys[order], counts[order].astype("<u4")
                parts = _runs(keys >> PAIR_BITS)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([o for o, _, _ in parts], pa.int64()),
                        pa.array([golomb_encode(keys[a:b]) for _, a, b in parts], pa.binary()),
                        pa.array([squeeze(counts[a:b]) for _, a, b in parts], pa.binary()),
                    ],
                    ["owner", "keys", "counts"],
                )

    return run


def _segment(key: tuple[pa.Scalar, ...], sent: pa.Table) -> pa.Table:
    """The segment of one owner, from the pairs of all blocks."""
    keys = np.concatenate([golomb_decode(b) for b in sent["keys"].to_pylist()])
    counts = np.concatenate([unsqueeze(b, "<u4") for b in sent["counts"].to_pylist()])
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order].astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    bits = build_segment(keys[first], np.add.reduceat(counts, first))
    return pa.table({"owner": pa.array([key[0].as_py()], pa.int64()), "bits": pa.array([bits.tobytes()], pa.binary())})


def _probe(model, owners: int):
    """What one wave of the filter holds of each block's distinct pairs: 0 for those of other waves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, end, hashes, stream in zip(*(batch.column(i).to_pylist() for i in range(4))):
                stream = unsqueeze(stream, "<u4").astype(np.int64)
                keys = _pairs_of(golomb_decode(hashes), stream, end, slice(None), owners)[2]
                found = pa.array([squeeze(model.value.counts(keys))], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), found], ["block", "counts"])

    return run


def _summed(answers: pa.Table) -> pa.Table:
    """A block's pair counts over all waves: each pair is in one of them."""
    whole = sum(unsqueeze(c, "<i8") for c in answers["counts"].to_pylist())
    return pa.table({"block": answers["block"].slice(0, 1), "pairs": pa.array([squeeze(whole)], pa.binary())})


def _waves(sizes: list[tuple[int, int]], most: int) -> list[tuple[int, int]]:
    """First and last owner of waves of segments of at most ``most`` bytes, a larger one alone; sizes come by owner."""
    out, held = [], 0
    for owner, size in sizes:
        if out and held + size <= most:
            out[-1] = (out[-1][0], owner)
            held += size
        else:
            out.append((owner, owner))
            held = size
    return out


@dataclass(frozen=True)
class Totals:
    tokens: int
    words: int

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        return (counts + 0.1) / (self.tokens + 0.1 * (self.words + 1))


def _classes(counts: np.ndarray) -> np.ndarray:
    """The class of a history: how often it was seen, in steps of eight times."""
    return np.minimum((levels_of(counts) + 1) // 3, CLASSES - 1)


def _tables(ratio: np.ndarray, word: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
    """Sums of log probabilities, a row for each group of tokens and a column for each weight."""
    return np.stack([np.bincount(group, np.log10(w * ratio + (1 - w) * word), groups) for w in WEIGHTS], axis=1)


def _scores(model, totals: Totals, owners: int, id_col: str):
    """Per document its base score and, for every class of histories and weight, the sum of log probabilities.

    One more row per block has no number of tokens; its table is over the training tokens, each left out of
    the counts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, held, sizes, end, hashes, stream, known, pairs in zip(*(batch.column(i).to_pylist() for i in range(8))):
                stream, known = unsqueeze(stream, "<u4").astype(np.int64), unsqueeze(known, "<i8")
                before, now, keys, which = _pairs_of(golomb_decode(hashes), stream, end, slice(None), owners)
                counts = model.value.counts(keys) + (unsqueeze(pairs, "<i8") if pairs is not None else 0)
                histories, group = known[before], _classes(known)[before]
                counts = np.minimum(counts[which], np.minimum(histories, known[now]))
                word = totals.unigram(known)[now]
                n = len(ids)
                doc = np.repeat(np.arange(n), sizes)
                seen = np.bincount(doc, known[now] > 0, n)
                base = np.bincount(doc, np.log10(word), n)
                ratio = (counts / np.maximum(histories, 1)).clip(0, 1)
                tables = _tables(ratio, word, doc * CLASSES + group, n * CLASSES).reshape(n, -1)
                train = np.repeat(~np.array(held, bool), sizes)
                ratio = (np.maximum(counts - 1, 0) / np.maximum(histories - 1, 1)).clip(0, 1)[train]
                word = totals.unigram(np.maximum(known - 1, 0))[now[train]]
                evidence = _tables(ratio, word, group[train], CLASSES).reshape(1, -1)
                flat = pa.array(np.concatenate([tables, evidence]).ravel())
                offsets = pa.array(np.arange(n + 2, dtype=np.int32) * CLASSES * WEIGHTS.size)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([*ids, None], batch.schema.field(0).type.value_type),
                        pa.array([*held, None], pa.bool_()),
                        pa.array([*sizes, None], pa.int64()),
                        pa.array([*seen.astype(np.int64).tolist(), None], pa.int64()),
                        pa.array([*base.tolist(), None], pa.float64()),
                        pa.ListArray.from_arrays(offsets, flat),
                    ],
                    [id_col, "held_out", "n_tokens", "n_known", "base_score", "tables"],
                )

    return run


def score(
    docs: DataFrame,
    held_out: Column,
    text_col: str = "text",
    id_col: str = "doc_id",
    filter_bytes: int = FILTER_BYTES,
    owner_bytes: int = OWNER_BYTES,
) -> DataFrame:
    """Log10 probabilities of all texts under a model learnt from the rows that are not ``held_out``.

    Gives the id, held_out, n_tokens (words and one end), n_known, train_tokens, base_score (words by themselves)
    and score (words after the word before them). A null or empty text is its end alone; a null
    ``held_out`` counts as false. With nothing to learn from, every word is equally unlikely.
    Words are told apart by 63-bit hashes.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(quoted(id_col), quoted(text_col).cast("string"), F.coalesce(held_out, F.lit(False)).alias("held"))
    blocks = staged(
        rows.mapInArrow(
            _blocks,
            f"block long, ids array<{id_type}>, held array<boolean>, sizes array<long>, end long,"
            " hashes binary, counts binary, stream binary",
        ),
        "lm-blocks",
    )
    size = blocks.agg(F.sum(F.octet_length("hashes")), F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, b: a + b))).first()
    schema = f"`{id_col}` {id_type}, held_out boolean, n_tokens long, n_known long, base_score double, tables array<double>"
    if size[0] is None:
        none = spark.createDataFrame([], schema)
        return none.select(id_col, "held_out", "n_tokens", "n_known", F.lit(0).cast("long").alias("train_tokens"), "base_score", F.col("base_score").alias("score"))

    word_owners = max(1, -(-size[0] // owner_bytes))
    requests = blocks.select("block", "hashes", "counts").mapInArrow(
        _requests(word_owners), "owner long, block long, hashes binary, counts binary"
    )
    replies = staged(
        requests.groupBy("owner").applyInArrow(_replies, "block long, owner long, totals binary, tokens long, words long"),
        "lm-replies",
    )
    totals = Totals(*(int(x or 0) for x in replies.agg(F.sum("tokens"), F.sum("words")).first()))

    pair_owners = max(1, -(-8 * size[1] // owner_bytes))
    sent = blocks.select("held", "sizes", "end", "hashes", "stream").mapInArrow(
        _pairs(pair_owners), "owner long, keys binary, counts binary"
    )
    built = staged(sent.groupBy("owner").applyInArrow(_segment, "owner long, bits binary"), "lm-filter")

    def wave(first: int, last: int):
        """The segments of some owners, broadcast: at most ``filter_bytes``, or one segment."""
        parts = built.where(F.col("owner").between(first, last)).toLocalIterator()
        segments = {owner: np.frombuffer(bits, np.uint8) for owner, bits in parts}
        return spark.sparkContext.broadcast(LogFrequencyFilter.of(pair_owners, segments))

    sizes = built.select("owner", F.octet_length("bits").alias("n")).orderBy("owner").collect()
    waves = _waves([(r["owner"], r["n"]) for r in sizes], filter_bytes) or [(0, -1)]
    probed = None
    for first, last in waves[:-1]:
        model = wave(first, last)
        asked = blocks.select("block", "end", "hashes", "stream").mapInArrow(_probe(model, pair_owners), "block long, counts binary")
        part = staged(asked, "lm-probes")
        probed = part if probed is None else probed.unionByName(part)
        model.unpersist()
    model = wave(*waves[-1])

    known = replies.groupBy("block").applyInArrow(_joined, "block long, known binary")
    answered = blocks.drop("counts").join(known, "block")
    if probed is None:
        answered = answered.withColumn("pairs", F.lit(None).cast("binary"))
    else:
        answered = answered.join(probed.groupBy("block").applyInArrow(_summed, "block long, pairs binary"), "block")
    scored = staged(
        answered.select("ids", "held", "sizes", "end", "hashes", "stream", "known", "pairs").mapInArrow(
            _scores(model, totals, pair_owners, id_col), schema
        ),
        "lm-scores",
    )
    evidence = np.zeros(CLASSES * WEIGHTS.size)
    sums = scored.where("n_tokens is null").select(F.posexplode("tables").alias("i", "x")).groupBy("i").agg(F.sum("x"))
    for i, x in sums.collect():
        evidence[i] = x
    best = evidence.reshape(CLASSES, WEIGHTS.size).argmax(axis=1)
    chosen = [F.get("tables", F.lit(int(c * WEIGHTS.size + b))) for c, b in enumerate(best)]
    return scored.where("n_tokens is not null").select(
        quoted(id_col),
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(totals.tokens).cast("long").alias("train_tokens"),
        "base_score",
        sum(chosen[1:], chosen[0]).alias("score"),
    )
