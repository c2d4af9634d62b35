"""SimHash near-duplicates, joined by Golay-code fuzzy keys.

A fingerprint has 64 bits, cut into segments of 23, 23 and 18 bits. If two fingerprints differ in at
most two bits, at least one segment is equal in both, and the next segment (in a circle) differs in
at most two bits. The binary Golay code tells apart which segments are that near: two words of 23
bits within two bits of each other always have a codeword in common within distance 4 of both,
and a word has at most six such codewords. So a fingerprint gets up to 18 keys (an equal segment and
a codeword of the next), fingerprints that share a key are compared, and no pair within two bits is missed.

Work is done on distinct fingerprints. A key's fingerprints are linked by a spanning forest of the
pairs that were verified, never by all pairs, and components are found over those links.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.llm.components import components
from feedmill.llm.frames import DOC, bounded_batches, packed, staged, texts_of

WORDS = 3
SEED = 42
DISTANCE = 2
SPLIT_PRINTS = 1 << 14
SEGMENTS = ((0, 23), (23, 23), (46, 18))
GENERATOR = 0b110001110101  # of the binary Golay code: x^11+x^10+x^6+x^5+x^4+x^2+1


def shingle_hashes(text: bytes, words: int = WORDS, seed: int = SEED) -> np.ndarray:
    """Hashes of the word shingles of a text, in order; a text of fewer words is one shingle, one without words none."""
    parts = text.lower().split()  # of bytes: A-Z only, and exactly the six ASCII white-space bytes
    if not parts:
        return np.zeros(0, "<u8")
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    span = min(words, len(parts)) - 1
    digest = xxhash.xxh64_intdigest
    return np.array(
        [digest(joined[a:b], seed) for a, b in zip(starts[: len(parts) - span].tolist(), ends[span:].tolist())], "<u8"
    )


def fingerprint_of(text: bytes, words: int = WORDS, seed: int = SEED) -> int:
    """SimHash over the word shingles of a text; 0 if it has no word."""
    hashes = shingle_hashes(text, words, seed)
    if not hashes.size:
        return 0
    counts = np.zeros(64, np.int64)
    for at in range(0, hashes.size, 65536):
        part = hashes[at : at + 65536]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > hashes.size).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprint(text: Column, words: int = WORDS, seed: int = SEED) -> Column:
    """The fingerprint as a signed 64-bit integer."""

    @F.arrow_udf("long")
    def simhash(values: pa.Array) -> pa.Array:
        prints = np.array([fingerprint_of(v, words, seed) for v in texts_of(values)], np.uint64)
        return pa.array(prints.view(np.int64))

    return simhash(text)


def _remainder(word: int) -> int:
    for bit in range(22, 10, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - 11)
    return word


def golay_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the high 12 and of the low 11 bits, and per syndrome the error patterns of weight up to 4.

    Unused places of a syndrome repeat its first pattern.
    """
    syndrome_of_bit = [_remainder(1 << b) for b in range(23)]

    def syndromes(low: int, bits: int) -> np.ndarray:
        out = np.zeros(1 << bits, np.int64)
        for b in range(bits):
            out[1 << b : 2 << b] = out[: 1 << b] ^ syndrome_of_bit[low + b]
        return out

    found: list[list[int]] = [[] for _ in range(2048)]
    for weight in range(5):
        for places in combinations(range(23), weight):
            syndrome, pattern = 0, 0
            for b in places:
                syndrome, pattern = syndrome ^ syndrome_of_bit[b], pattern | 1 << b
            found[syndrome].append(pattern)
    patterns = np.array([(f + f[:1] * 6)[:6] for f in found], np.int64)
    return syndromes(11, 12), syndromes(0, 11), patterns


def golay_keys(words: np.ndarray, tables) -> np.ndarray:
    """Indices of the codewords within distance 4 of each 23-bit word; six columns, repeats at the end."""
    high, low, patterns = tables
    errors = patterns[high[words >> 11] ^ low[words & 0x7FF]]
    return (words[:, None] ^ errors) >> 11


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The up to 18 keys of every fingerprint."""
    tables = golay_tables()
    for batch in batches:
        prints = np.asarray(batch["print"]).view(np.uint64)
        segments = [((prints >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
        for kind in range(3):
            near = golay_keys(segments[(kind + 1) % 3], tables)
            keys = (kind << 35) | (segments[kind] << 12)[:, None] | near
            fresh = np.ones(near.shape, bool)
            fresh[:, 1:] = near[:, 1:] != near[:, :1]
            rows = np.nonzero(fresh)[0]
            yield pa.RecordBatch.from_pydict(
                {"key": pa.array(keys[fresh]), "print": pa.array(prints[rows].view(np.int64))}
            )


def spanning(prints: np.ndarray, distance: int) -> Iterator[tuple[int, np.ndarray]]:
    """A spanning forest of the pairs within ``distance`` bits: (a print, prints newly linked to it)."""
    rest = prints
    while rest.size > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and rest.size:
            one = queue.pop()
            near = np.bitwise_count(rest ^ one) <= distance
            if near.any():
                found = rest[near]
                yield one, found
                queue.extend(found)
                rest = rest[~near]


def near_pairs(prints: np.ndarray, distance: int, split: int = SPLIT_PRINTS) -> Iterator[tuple[int, np.ndarray]]:
    """Links that connect all distinct prints within ``distance`` bits of each other, like ``spanning``.

    More than ``split`` prints are first divided: of the bits in which they vary, cut into ``distance`` + 1 parts, near
    prints agree in at least one whole part. So comparing those with an equal part, part after part, misses none.
    """
    varying = int(np.bitwise_or.reduce(prints ^ prints[0]))
    places = [b for b in range(64) if varying >> b & 1]
    if prints.size <= split or len(places) <= distance + 1:
        yield from spanning(prints, distance)
        return
    for i in range(distance + 1):
        part = prints & np.uint64(sum(1 << b for b in places[i :: distance + 1]))
        order = np.argsort(part, kind="stable")
        edges = np.flatnonzero(np.diff(part[order])) + 1
        for same in np.split(prints[order], edges):
            if same.size > 1:
                yield from near_pairs(same, distance, split)


def _links(distance: int):
    """Links within each key; the rows come sorted by key."""

    def emit(key: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        edges = np.flatnonzero(np.diff(key)) + 1
        starts, ends = np.concatenate([[0], edges]), np.concatenate([edges, [key.size]])
        sizes = ends - starts
        two = starts[sizes == 2]
        near = np.bitwise_count(prints[two] ^ prints[two + 1]) <= distance
        us, vs = [prints[two][near]], [prints[two + 1][near]]
        for a, b in zip(starts[sizes > 2].tolist(), ends[sizes > 2].tolist()):
            for one, found in near_pairs(prints[a:b], distance):
                us.append(np.full(found.size, one, np.uint64))
                vs.append(found)
        u, v = np.concatenate(us).view(np.int64), np.concatenate(vs).view(np.int64)
        return pa.RecordBatch.from_pydict({"u": pa.array(u), "v": pa.array(v)})

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, prints = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            keys = np.concatenate([keys, np.asarray(batch["key"])])
            prints = np.concatenate([prints, np.asarray(batch["print"]).view(np.uint64)])
            if keys.size and keys[0] != keys[-1]:
                cut = int(np.searchsorted(keys, keys[-1]))  # the last key may go on in the next batch
                yield emit(keys[:cut], prints[:cut])
                keys, prints = keys[cut:], prints[cut:]
        if keys.size:
            yield emit(keys, prints)

    return links


def near_links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links ``(u, v)`` that connect all distinct ``print`` values within ``distance`` (at most 2) bits."""
    if distance > DISTANCE:
        raise ValueError("the fuzzy keys are complete for two differing bits at most")
    keyed = prints.select("print").mapInArrow(_keys, "key long, print long")
    shared = keyed.repartition("key").sortWithinPartitions("key")
    return shared.mapInArrow(_links(distance), "u long, v long")


def simhash_dedup(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    words: int = WORDS,
    distance: int = DISTANCE,
) -> DataFrame:
    """Every input row as struct ``doc``, with its print (long), component_id and kept.

    component_id is the smallest id reachable over links of at most ``distance`` differing bits, the row's own
    included (null only if no id there is set). A null or empty text has print 0 and is linked like any
    other. One row of each component is kept: one with the smallest id.
    """
    bounded_batches(docs.sparkSession)
    doc_id = F.col(DOC).getField(id_col)
    rows = docs.select(packed(docs)).withColumn("print", fingerprint(F.col(DOC).getField(text_col), words))
    rows = staged(rows.withColumn("row", F.monotonically_increasing_id()), "simhash")
    narrow = rows.select("row", "print", doc_id.alias("id"))
    by_print = staged(
        narrow.groupBy("print").agg(
            F.min("id").alias("id"), F.min_by("row", "id").alias("row"), F.min("row").alias("any_row")
        ),
        "simhash-prints",
    )
    return keep_first(rows, by_print, near_links(by_print, distance))


def keep_first(rows: DataFrame, by_print: DataFrame, links: DataFrame) -> DataFrame:
    """Rows with their component over ``links`` of prints; kept is one of each component, with the smallest id."""
    roots = components(links)
    labelled = by_print.join(roots, by_print["print"] == roots["node"], "left").select(
        "print", "id", "row", "any_row", F.coalesce("root", "print").alias("root")
    )
    best = labelled.groupBy("root").agg(
        F.min("id").alias("component_id"),
        F.coalesce(F.min_by("row", "id"), F.min("any_row")).alias("keep_row"),
    )
    labels = labelled.select("print", "root").join(best, "root").select("print", "component_id", "keep_row")
    return rows.join(labels, "print").select(
        DOC, "print", "component_id", (F.col("row") == F.col("keep_row")).alias("kept")
    )
