"""Approximate nearest neighbours by multi-index hashing.

Vectors become binary codes: a rotation, learnt on a bounded sample so that signs lose as little as
possible (PCA followed by iterative quantisation), turns every vector into ``BITS`` signs. Codes are cut
into substrings and each substring has an index of its own. Two codes within Hamming radius r agree to within
floor(r / m) bits in at least one of m substrings, so probing every index with that smaller radius retrieves
every code within r. The found codes are checked and ranked by the inner products of the vectors themselves.

The rows are dealt into blocks, each with its own index in one task; a query visits every block and
brings its best home: the best ``k`` of the blocks searched first, of the others what can still be among them. In a block the radius grows until ``k`` vectors are found, so no query comes back short.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedmill.functions.columns import quoted
from feedmill.llm.frames import staged

BITS = 64
SUBSTRINGS = 4
SAMPLE = 20_000
SAMPLE_QUERIES = 256
SHARE = 0.97
ROTATIONS = 30
BLOCK_BYTES = 8 << 20
QUERY_BYTES = 16 << 20
SEED_SHARE = 16
SCORE_SLACK = 1e-9


@dataclass(frozen=True)
class Codes:
    """The learnt map from vectors to codes."""

    matrix: np.ndarray  # dimension by bits

    def encode(self, vectors: np.ndarray) -> np.ndarray:
        """Codes as unsigned 64-bit integers."""
        signs = vectors @ self.matrix > 0
        out = np.zeros((signs.shape[0], 64), np.uint8)
        out[:, : signs.shape[1]] = signs
        return np.packbits(out, axis=1, bitorder="little").view("<u8").ravel()


def learn_codes(sample: np.ndarray, bits: int = BITS, rounds: int = ROTATIONS, seed: int = 7) -> Codes:
    """PCA and a rotation that brings the projected sample near the corners of a cube."""
    bits = min(bits, 64, sample.shape[1])
    _, _, axes = np.linalg.svd(sample, full_matrices=False) if sample.shape[0] >= bits else (0, 0, np.eye(sample.shape[1]))
    axes = axes[:bits].T
    projected = sample @ axes
    rotation, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((bits, bits)))
    for _ in range(rounds):
        corners = np.where(projected @ rotation > 0, 1.0, -1.0)
        u, _, v = np.linalg.svd(projected.T @ corners)
        rotation = u @ v
    return Codes(axes @ rotation)


def learn_radius(sample: np.ndarray, codes: Codes, k: int, share: float = SHARE, asked: int = SAMPLE_QUERIES) -> int:
    """The radius that holds ``share`` of the true ``k`` nearest of some rows of the sample.

    Neighbours are nearer in the whole than in a sample of it, so the radius is wide enough there too.
    """
    coded, found = codes.encode(sample), []
    for i in range(min(asked, sample.shape[0])):
        scores = sample @ sample[i]
        scores[i] = -np.inf
        best = np.argsort(-scores)[: min(k, sample.shape[0] - 1)]
        found.append(np.bitwise_count(coded[best] ^ coded[i]))
    distances = np.concatenate(found) if found else np.zeros(0)
    return int(np.ceil(np.quantile(distances, share))) if distances.size else 64


def substring_spans(bits: int = 64, count: int = SUBSTRINGS) -> list[tuple[int, int]]:
    """``(start, width)`` of each substring."""
    cuts = [bits * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


@cache
def _masks(width: int, near: int) -> np.ndarray:
    """All words of ``width`` bits with at most ``near`` bits set."""
    return np.array([sum(1 << b for b in p) for n in range(near + 1) for p in combinations(range(width), n)], np.uint64)


class MultiIndex:
    """The indexes of one block: for each substring its values in order, and which of them each row holds."""

    def __init__(self, codes: np.ndarray, count: int = SUBSTRINGS):
        self.codes = codes
        self.spans = substring_spans(64, count)
        parts = [(codes >> np.uint64(start)) & np.uint64((1 << width) - 1) for start, width in self.spans]
        self.tables = [np.unique(part, return_inverse=True) for part in parts]

    def within(self, code: int, radius: int) -> np.ndarray:
        """All rows whose code is within ``radius`` bits of ``code``, in order."""
        hit = np.zeros(self.codes.size, bool)
        count = len(self.spans)
        for i, ((start, width), (values, held)) in enumerate(zip(self.spans, self.tables)):
            # The first r mod m + 1 substrings are probed with floor(r / m), the others with one bit less.
            near = radius // count - (i > radius % count)
            if near >= 0:
                hit |= self._buckets(values, np.uint64(code >> start & (1 << width) - 1), near, width)[held]
        found = np.flatnonzero(hit)
        return found[np.bitwise_count(self.codes[found] ^ np.uint64(code)) <= radius]

    @staticmethod
    def _buckets(values: np.ndarray, mine: np.uint64, near: int, width: int) -> np.ndarray:
        """Which buckets in use are within ``near`` bits of ``mine``.

        Few neighbours are enumerated and looked up; when they outnumber the buckets in use, those are tested instead.
        """
        if sum(comb(width, n) for n in range(near + 1)) >= values.size:
            return np.bitwise_count(values ^ mine) <= near
        wanted = _masks(width, near) ^ mine
        at = np.minimum(np.searchsorted(values, wanted), values.size - 1)
        out = np.zeros(values.size, bool)
        out[at[values[at] == wanted]] = True
        return out


def products(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products summed component by component, so that equal vectors always score alike."""
    total = np.zeros(vectors.shape[0])
    for d in range(query.size):
        total += query[d] * vectors[:, d]
    return total


def nearest_in_block(
    index: MultiIndex, ids: np.ndarray, vectors: np.ndarray, query_id: int, query: np.ndarray, code: int, k: int, radius: int
) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the best ``k`` found in a block for one query, the query's own rows left out."""
    wanted = min(k, int((ids != query_id).sum()))
    while True:
        found = index.within(code, radius)
        found = found[ids[found] != query_id]
        if found.size >= wanted or radius >= 64:
            break
        radius = min(64, radius + max(1, radius // 8))
    if not found.size:
        return found, np.zeros(0)
    rough = vectors[found] @ query
    if found.size > k:
        bar = np.partition(rough, found.size - k)[found.size - k]
        found = found[rough >= bar - SCORE_SLACK * (1 + abs(bar))]
    exact = products(query, vectors[found])
    order = np.lexsort((ids[found], -exact))[:k]
    return ids[found][order], exact[order]


def _searcher(codes, k: int, radius: int, count: int):
    """Search of one block for one part of the queries; what is below a query's bar stays where it is."""

    def search(key: tuple[pa.Scalar, ...], queries: pa.Table, rows: pa.Table) -> pa.Table:
        out_q, out_v, out_s = [], [], []
        if queries.num_rows and rows.num_rows:
            ids, vectors = np.asarray(rows["id"]), _matrix(rows["vector"])
            index = MultiIndex(codes.value.encode(vectors), count)
            asked, wanted = np.asarray(queries["id"]), _matrix(queries["vector"])
            bars = np.asarray(queries["bar"])
            for one, vector, code, bar in zip(asked.tolist(), wanted, codes.value.encode(wanted).tolist(), bars):
                found, scores = nearest_in_block(index, ids, vectors, one, vector, code, k, radius)
                found, scores = found[scores >= bar], scores[scores >= bar]
                out_q += [one] * found.size
                out_v += found.tolist()
                out_s += scores.tolist()
        return pa.table(
            {"query_id": pa.array(out_q, pa.int64()), "vec_id": pa.array(out_v, pa.int64()), "score": pa.array(out_s, pa.float64())}
        )

    return search


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    lists = column.combine_chunks()
    flat = np.asarray(lists.flatten(), np.float64)
    return flat.reshape(len(lists), -1)


def usable(vector: Column) -> Column:
    """Not null, not zero, and without null or non-finite components."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce(F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


def search(
    base: DataFrame,
    queries: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 20,
    radius: int | None = None,
    substrings: int = SUBSTRINGS,
    sample: int = SAMPLE,
    block_rows: int | None = None,
    query_rows: int | None = None,
    seed_share: int = SEED_SHARE,
) -> DataFrame:
    """The ``k`` largest inner products found for each query: query_id, rank (from 1), vec_id, score.

    ``queries`` and ``base`` share their columns; a query never finds rows of its own id. Ties go to the
    smaller id. An id that is asked several times is asked once, with its smallest vector; as rows to be found, repeated
    ids are rows of their own. Vectors that are null, zero, or hold null or non-finite components take no part, nor do
    rows with a null id or with another length than most vectors have. The rotation and, unless given, the radius are
    learnt on at most ``sample`` rows (those with the smallest hash of their id); every row is indexed.

    Blocks and parts of the queries hold as many vectors as fit in ``BLOCK_BYTES`` and ``QUERY_BYTES``. One in
    ``seed_share`` blocks is searched first: the k-th best score found there is a bar that none of the k nearest can
    miss, so the other blocks send home only what reaches it, on average some ``k * seed_share`` rows a query
    however many blocks there are.
    """
    spark = base.sparkSession

    def cleaned(df: DataFrame) -> DataFrame:
        picked = df.select(quoted(id_col).cast("long").alias("id"), quoted(vector_col).cast("array<double>").alias("vector"))
        return picked.where(F.col("id").isNotNull() & usable(F.col("vector")))

    schema = "query_id long, rank int, vec_id long, score double"
    rows, asked = cleaned(base), cleaned(queries)
    lengths = rows.groupBy(F.size("vector").alias("length")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "length").first()
    if lengths is None:
        return spark.createDataFrame([], schema)
    rows, asked = (df.where(F.size("vector") == lengths["length"]) for df in (rows, asked))
    asked = asked.groupBy("id").agg(F.min("vector").alias("vector"))
    learnt = rows.orderBy(F.xxhash64("id"), "id").limit(sample).select("vector").toArrow()
    vectors = _matrix(learnt["vector"])
    learnt_codes = learn_codes(vectors)
    radius = learn_radius(vectors, learnt_codes, k) if radius is None else radius
    codes = spark.sparkContext.broadcast(learnt_codes)

    width = 8 * max(1, lengths["length"])
    block_rows = block_rows or max(1, BLOCK_BYTES // width)
    query_rows = query_rows or max(1, QUERY_BYTES // width)
    blocks = max(1, -(-lengths["n"] // block_rows))
    groups = max(1, -(-asked.count() // query_rows))
    # Rows are dealt by their place as well as their id, so that no id can fill a block with its rows.
    spread = F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(blocks)).cast("int")
    dealt = F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int")
    placed = rows.withColumn("block", spread)

    def found_in(first: int, last: int, bars: DataFrame) -> DataFrame:
        every = lambda low, high: F.explode(F.sequence(F.lit(low), F.lit(high)))
        near = placed.where(F.col("block").between(first, last))
        base_side = near.select("id", "vector", "block", every(0, groups - 1).alias("part"))
        query_side = bars.select("id", "vector", "bar", every(first, last).alias("block"), dealt.alias("part"))
        return (
            query_side.groupBy("block", "part")
            .cogroup(base_side.groupBy("block", "part"))
            .applyInArrow(_searcher(codes, k, radius, substrings), "query_id long, vec_id long, score double")
        )

    lowest = F.lit(float("-inf"))
    seeds = -(-blocks // seed_share) if blocks > 1 else 1
    found = found_in(0, seeds - 1, asked.withColumn("bar", lowest))
    if seeds < blocks:
        found = staged(found, "ann-seeds")
        place = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score")))
        bars = found.withColumn("place", place).where(F.col("place") == k).select(F.col("query_id").alias("id"), "score")
        barred = asked.join(bars, "id", "left").withColumn("bar", F.coalesce("score", lowest))
        found = found.unionByName(found_in(seeds, blocks - 1, barred))
    ranked = found.withColumn(
        "rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")).cast("int")
    )
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
