"""Exact de-duplication by an exchange of Golomb-coded fingerprints.

Every task that wrote a part of the documents is a *sender*. It keeps its rows sorted by a
fingerprint of the normalised text and sends only the gaps between fingerprints, Golomb coded, to
the *owners* of the fingerprint ranges. An owner answers each sender with one bit per
fingerprint: met more than once or not. Only rows whose bit is set are shuffled with their texts and
compared byte by byte, so false suspects cost a little and a missed copy is impossible.

Texts are equal when identical after lower-casing A-Z; null counts as empty. Of equal texts the row
with the largest id stays, null ids being smallest; of rows repeated with that same id, or of a
group whose ids are all null, exactly one stays.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.llm.frames import DOC, bounded_batches, packed, staged, texts_of

OWNER_ROWS = 4_000_000
SPARE_BITS = 8
WAVE_BITS = 1 << 30
ROW_BITS = 33


def _folded(text: Column) -> Column:
    """The text with A-Z lower-cased; null becomes empty."""
    return F.translate(F.coalesce(text, F.lit("")), ascii_uppercase, ascii_lowercase)


def _digest(text: Column) -> Column:
    """SHA-256 of the folded text, lowercase hex."""

    @F.arrow_udf("string")
    def digest(values: pa.Array) -> pa.Array:
        return pa.array([hashlib.sha256(v.lower()).hexdigest() for v in texts_of(values)], pa.string())

    return digest(text)


def golomb_encode(values: np.ndarray) -> bytes:
    """Sorted non-negative integers as Golomb codes of their gaps (parameter a power of two).

    Layout: count (4 bytes), parameter's exponent (1), first value (8), length of the quotient part (4),
    all quotients in unary, all remainders in binary.
    """
    gaps = np.diff(values)
    mean = float(gaps.mean()) if gaps.size else 0.0
    k = max(0, math.ceil(math.log2(0.69 * mean))) if mean > 1.45 else 0
    q, r = gaps >> k, gaps & ((1 << k) - 1)
    unary = np.ones(int(q.sum()) + gaps.size, np.uint8)
    unary[np.cumsum(q + 1) - 1] = 0
    low = ((r[:, None] >> np.arange(k)) & 1).astype(np.uint8).ravel()
    first = int(values[0]) if values.size else 0
    head = values.size.to_bytes(4, "little") + bytes([k]) + first.to_bytes(8, "little") + unary.size.to_bytes(4, "little")
    return head + np.packbits(unary).tobytes() + np.packbits(low).tobytes()


def golomb_decode(blob: bytes) -> np.ndarray:
    n, k = int.from_bytes(blob[:4], "little"), blob[4]
    first, size = int.from_bytes(blob[5:13], "little"), int.from_bytes(blob[13:17], "little")
    if not n:
        return np.zeros(0, np.int64)
    cut = 17 + (size + 7) // 8
    unary = np.unpackbits(np.frombuffer(blob, np.uint8, cut - 17, 17), count=size)
    q = np.diff(np.flatnonzero(unary == 0), prepend=-1) - 1
    low = np.unpackbits(np.frombuffer(blob, np.uint8, -1, cut), count=(n - 1) * k).reshape(n - 1, k)
    r = low.astype(np.int64) @ (1 << np.arange(k, dtype=np.int64))
    return first + np.concatenate([[0], np.cumsum((q << k) + r)]).astype(np.int64)


def _send(owner_shift: int):
    """Sorted fingerprints of a sender, cut into runs, as one coded message per run and owner."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sender, position, print_ = (np.asarray(batch[c]) for c in ("sender", "position", "print"))
            owner = print_ >> owner_shift
            broken = (np.diff(sender) != 0) | (np.diff(position) != 1) | (np.diff(owner) != 0) | (np.diff(print_) < 0)
            edges = [0, *(np.flatnonzero(broken) + 1).tolist(), sender.size]
            runs = [(a, b) for a, b in zip(edges, edges[1:]) if b > a]
            yield pa.RecordBatch.from_pydict(
                {
                    "owner": pa.array([int(owner[a]) for a, _ in runs], pa.int64()),
                    "sender": pa.array([int(sender[a]) for a, _ in runs], pa.int32()),
                    "start": pa.array([int(position[a]) for a, _ in runs], pa.int64()),
                    "codes": pa.array([golomb_encode(print_[a:b]) for a, b in runs], pa.binary()),
                }
            )

    return send


def _answer(messages: pa.Table) -> pa.Table:
    """One owner: which of the fingerprints sent to it came more than once."""
    prints = [golomb_decode(c) for c in messages["codes"].to_pylist()]
    whole = np.concatenate(prints)
    _, where, counts = np.unique(whole, return_inverse=True, return_counts=True)
    repeated = np.split(counts[where] > 1, np.cumsum([p.size for p in prints])[:-1])
    return pa.table(
        {
            "sender": messages["sender"],
            "start": messages["start"],
            "n": pa.array([p.size for p in prints], pa.int64()),
            "bits": pa.array([np.packbits(b).tobytes() for b in repeated], pa.binary()),
        }
    )


def _suspect(bits: dict[int, list[tuple[int, int, bytes]]], spark) -> Column:
    """Whether a row's bit is set; ``bits`` holds the answers of at most one wave."""
    maps = {}
    for sender, parts in bits.items():
        whole = np.zeros(max(s + n for s, n, _ in parts), np.uint8)
        for start, n, packed_bits in parts:
            whole[start : start + n] = np.unpackbits(np.frombuffer(packed_bits, np.uint8), count=n)
        maps[sender] = np.packbits(whole)
    shared = spark.sparkContext.broadcast(maps)

    @F.arrow_udf("boolean")
    def suspect(sender: pa.Array, position: pa.Array) -> pa.Array:
        sender, position = np.asarray(sender), np.asarray(position)
        out = np.zeros(sender.size, bool)
        for s in np.unique(sender).tolist():
            mine = sender == s
            at = position[mine]
            out[mine] = (shared.value[s][at >> 3] >> (7 - (at & 7))) & 1
        return pa.array(out)

    return suspect(F.col("sender"), F.col("position"))


def exact_dedup(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    owner_rows: int = OWNER_ROWS,
    wave_bits: int = WAVE_BITS,
) -> DataFrame:
    """Every input row as struct ``doc``, with keep_id, group_size, kept and text_sha256.

    ``owner_rows`` is the mean number of fingerprints an owner holds. Answers are broadcast in waves of
    ``wave_bits`` rows, so a broadcast never exceeds an eighth of that in bytes plus one sender's share,
    whatever the input; more rows make more waves.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    text = F.col(DOC).getField(text_col)
    whole = docs.select(packed(docs))
    whole = whole.withColumn("text_sha256", _digest(text))
    # 60 bits of the digest now; the exchange sends only as many as the number of rows asks for.
    whole = whole.withColumn("print", F.conv(F.substring("text_sha256", 1, 15), 16, 10).cast("long"))
    ordered = whole.sortWithinPartitions("print").withColumn("row", F.monotonically_increasing_id())
    rows = staged(ordered, "exact-dedup").withColumns(
        {
            "sender": F.shiftrightunsigned("row", ROW_BITS).cast("int"),
            "position": F.col("row").bitwiseAND((1 << ROW_BITS) - 1),
        }
    )

    n = rows.count()
    bits = min(60, max(1, n).bit_length() + SPARE_BITS)
    owner_shift = max(0, bits - max(0, math.ceil(math.log2(max(1, n / owner_rows)))))
    narrow = rows.select("sender", "position", F.shiftright("print", 60 - bits).alias("print"))
    messages = narrow.mapInArrow(_send(owner_shift), "owner long, sender int, start long, codes binary")
    answers = staged(
        messages.groupBy("owner").applyInArrow(_answer, "sender int, start long, n long, bits binary"), "exact-answers"
    )

    waves: list[list[int]] = [[0, -1, 0]]
    for sender, count in sorted(answers.groupBy("sender").agg(F.sum("n")).collect()):
        if waves[-1][2] + count > wave_bits and waves[-1][2]:
            waves.append([sender, sender, 0])
        waves[-1] = [waves[-1][0], sender, waves[-1][2] + count]
    marked = None
    for low, high, _ in waves:
        near = F.col("sender").between(low, high)
        bits_of: dict[int, list] = {}
        for sender, start, size, packed_bits in answers.where(near).collect():
            bits_of.setdefault(sender, []).append((start, size, bytes(packed_bits)))
        part = rows.where(near).withColumn("suspect", _suspect(bits_of, spark))
        marked = part if marked is None else marked.unionByName(part)

    doc_id = F.col(DOC).getField(id_col)
    single = marked.where(~F.col("suspect")).select(
        DOC, doc_id.alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256"
    )
    suspects = marked.where("suspect").withColumn("folded", _folded(text))
    groups = suspects.groupBy("text_sha256", "folded").agg(
        F.max(doc_id).alias("keep_id"),
        F.coalesce(F.max_by("row", doc_id), F.min("row")).alias("keep_row"),
        F.count("*").alias("group_size"),
    )
    verified = suspects.join(groups, ["text_sha256", "folded"]).select(
        DOC, "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256"
    )
    return single.unionByName(verified)
