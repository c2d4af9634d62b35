"""Hierarchical multi-length packing of tokenised documents.

Every task packs the documents it reads; no row is shuffled. A document first fills whole windows of
the longest context size by itself. What is left is routed to the tier of its length, the context sizes
being powers of two. Each tier is packed in turn, the longest first: a piece opens a window
of its tier, the gap is filled by the largest pieces of shorter tiers that fit, and the last piece is cut to
close it. When the pieces run out, the open window is cut into windows of powers of two, so no
sequence holds padding. Windows of a tier are dealt into step groups of equal token counts.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedmill.functions.columns import quoted
from feedmill.llm.frames import bounded_batches, gathered, texts_of
from feedmill.llm.words import encoder

TIERS = (256, 512, 1024, 2048)
END_ID = 1
POOL_TOKENS = 2_000_000
STEP_TOKENS = 65_536
SEQUENCE_BITS = 40

# A piece: its length, its document's number in the batch, where it starts there.
Piece = tuple[int, int, int]


def fill_windows(pieces: list[Piece], tiers: Sequence[int]) -> Iterator[tuple[int, list[Piece]]]:
    """Windows ``(size, pieces)`` that hold all ``pieces``, each full to its size, a power of two."""
    pools: list[list[Piece]] = [[] for _ in tiers]  # each sorted by length

    def route(piece: Piece) -> None:
        pool = pools[bisect_left(tiers, piece[0])]
        pool.insert(bisect_left(pool, piece), piece)

    for piece in sorted(pieces):
        pools[bisect_left(tiers, piece[0])].append(piece)
    for tier in range(len(tiers) - 1, -1, -1):
        while pools[tier]:
            window, gap = [pools[tier].pop()], tiers[tier]
            gap -= window[0][0]
            while gap:
                near = [(p[bisect_right(p, (gap, math.inf)) - 1][0], t) for t, p in enumerate(pools[: tier + 1]) if p and p[0][0] <= gap]
                if near:  # the largest piece that fits
                    pool = pools[max(near)[1]]
                    piece = pool.pop(bisect_right(pool, (gap, math.inf)) - 1)
                else:  # cut the shortest piece that does not
                    pool = next((p for p in pools[: tier + 1] if p), None)
                    if pool is None:
                        break
                    length, doc, start = pool.pop(0)
                    piece = (gap, doc, start)
                    route((length - gap, doc, start + gap))
                window.append(piece)
                gap -= piece[0]
            yield from ((tiers[tier], window),) if not gap else _split(window, tiers[tier] - gap)


def _split(window: list[Piece], total: int) -> Iterator[tuple[int, list[Piece]]]:
    """A window that cannot be filled, as full windows of falling powers of two."""
    rest = window[::-1]
    while total:
        size = 1 << (total.bit_length() - 1)
        total -= size
        part, gap = [], size
        while gap:
            length, doc, start = rest.pop()
            if length > gap:
                rest.append((length - gap, doc, start + gap))
                length = gap
            part.append((length, doc, start))
            gap -= length
        yield size, part


def _packer(path: str, tiers: tuple[int, ...], end_id: int, pool_tokens: int, step_tokens: int, fields: list[str]):
    end = np.array([end_id], "<u4").tobytes()
    top = tiers[-1]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        first = TaskContext.get().partitionId() << SEQUENCE_BITS
        made: dict[int, int] = {}  # windows of a size so far

        def flush(keys: pa.Array, docs: list[bytes], pieces: list[Piece], whole: list[tuple[int, list[Piece]]]):
            rows: dict[str, list] = {n: [] for n in fields[1:]}
            picked = []
            for size, window in [*whole, *fill_windows(pieces, tiers)]:
                number = sum(made.values())
                step = made.get(size, 0) * size // step_tokens
                made[size] = made.get(size, 0) + 1
                offset = 0
                for length, doc, start in window:
                    picked.append(doc)
                    for name, value in zip(
                        fields[1:],
                        (start, length, docs[doc][4 * start : 4 * (start + length)], len(docs[doc]) // 4, first + number, offset, size, first + step),
                    ):
                        rows[name].append(value)
                    offset += length
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays(
                [keys.take(pa.array(picked, pa.int64())), *(pa.array(rows[n], k) for n, k in zip(fields[1:], kinds))], fields
            )

        for group in gathered(batches, 2 * pool_tokens):
            for part in pa.Table.from_batches(group).combine_chunks().to_batches():
                docs = [ids + end for ids in encode(texts_of(part.column(1)))]
                pieces, whole = [], []
                for i, ids in enumerate(docs):
                    n = len(ids) // 4
                    whole += [(top, [(top, i, at)]) for at in range(0, n - n % top, top)]
                    if n % top:
                        pieces.append((n % top, i, n - n % top))
                yield flush(part.column(0), docs, pieces, whole)

    return pack


def pack(
    docs: DataFrame,
    tokenizer: str,
    text_col: str = "text",
    id_col: str = "doc_id",
    tiers: Sequence[int] = TIERS,
    end_id: int = END_ID,
    pool_tokens: int = POOL_TOKENS,
    step_tokens: int = STEP_TOKENS,
) -> DataFrame:
    """One row per piece of a document in a sequence.

    Columns: the id, start (ids of its document before it), length, ids (little-endian unsigned 32-bit),
    doc_tokens (``end_id`` included), sequence_id, offset (in the sequence), window (the sequence's size) and
    step_id (windows of one size whose tokens make up one step). A null or empty text is its ``end_id`` alone.
    ``tokenizer`` is a file for ``tokenizers``; about ``pool_tokens`` ids (two bytes of text each) are packed together.
    """
    bounded_batches(docs.sparkSession)
    tiers = tuple(sorted(tiers))
    if any(t & (t - 1) for t in tiers):
        raise ValueError("context sizes must be powers of two")
    fields = [id_col, "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "window", "step_id"]
    kinds = [docs.schema[id_col].dataType, T.LongType(), T.LongType(), T.BinaryType(), *[T.LongType()] * 5]
    schema = T.StructType([T.StructField(n, k) for n, k in zip(fields, kinds)])
    narrow = docs.select(quoted(id_col), quoted(text_col).cast("string"))
    return narrow.mapInArrow(_packer(tokenizer, tiers, end_id, pool_tokens, step_tokens, fields), schema)


def digest(pieces: DataFrame) -> DataFrame:
    """Pieces with the crc32 of their ids in place of the ids."""
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
