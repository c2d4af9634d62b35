"""Byte-level BPE by a hierarchical-bitmap rank queue.

Encoding a pre-token means merging, again and again, the adjacent pair whose joined bytes have the lowest
rank, leftmost first. The queue keeps one bucket of linked-list positions per rank and a bitmap of
three levels over the ranks, so that the lowest rank in use is found by three find-first-set steps
whatever the length. Positions whose pair has changed since they were queued are stale and are skipped
when their bucket is opened. All pre-tokens that a worker has not met before share one queue, laid end to
end with a break between them: a bucket is then opened once for all of them, and its merges are done
together as array operations.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.llm.frames import DOC, binary, bounded_batches, gathered, packed, texts_of

CACHE_PARTS = 400_000
MERGE_PARTS = 250_000
GATHER_BYTES = 24_000_000
#: The pattern that splits a text into pre-tokens before the merges (a fixed value of the rank files).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Code points of white space.
SPACES = "".join(map(chr, (*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


class RankQueue:
    """Buckets by rank under a three-level bitmap of the ranks in use."""

    def __init__(self, ranks: int):
        self.buckets: list[list] = [[] for _ in range(ranks)]
        self.leaves = [0] * ((ranks >> 6) + 1)
        self.middle = [0] * ((ranks >> 12) + 1)
        self.root = 0

    def mark(self, rank: int) -> None:
        self.leaves[rank >> 6] |= 1 << (rank & 63)
        self.middle[rank >> 12] |= 1 << (rank >> 6 & 63)
        self.root |= 1 << (rank >> 12)

    def unmark(self, rank: int) -> None:
        self.leaves[rank >> 6] &= ~(1 << (rank & 63))
        if not self.leaves[rank >> 6]:
            self.middle[rank >> 12] &= ~(1 << (rank >> 6 & 63))
            if not self.middle[rank >> 12]:
                self.root &= ~(1 << (rank >> 12))

    def first(self) -> int:
        """The lowest rank in use, by a find-first-set on each level; -1 if there is none."""
        if not self.root:
            return -1
        top = (self.root & -self.root).bit_length() - 1
        mid = top << 6 | ((self.middle[top] & -self.middle[top]).bit_length() - 1)
        return mid << 6 | ((self.leaves[mid] & -self.leaves[mid]).bit_length() - 1)

    def push(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        """Queue many positions."""
        if not ranks.size:
            return
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        starts = [0, *(np.flatnonzero(np.diff(ranks)) + 1).tolist()]
        for rank, a, b in zip(ranks[starts].tolist(), starts, [*starts[1:], ranks.size]):
            self.buckets[rank].append(positions[a:b])
            self.mark(rank)

    def pop(self, rank: int) -> np.ndarray:
        """All positions queued for a rank, in order and once each."""
        found, self.buckets[rank] = self.buckets[rank], []
        self.unmark(rank)
        return np.unique(np.concatenate(found))


class ByteBpe:
    """Encoder and decoder for a file of ranks (one token in base 64 and its rank a line)."""

    def __init__(self, path: str, pattern: str = PATTERN, cache_parts: int = CACHE_PARTS):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in lines if line.strip())}
        self.size = max(self.ranks.values()) + 1
        self.tokens = [b""] * self.size
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        sides = [
            (self.ranks[t[:i]], self.ranks[t[i:]], r)
            for t, r in self.ranks.items()
            for i in range(1, len(t))
            if t[:i] in self.ranks and t[i:] in self.ranks
        ]
        left, right, joined = np.array(sides or [(0, 0, -1)], np.int64).T
        self.stop = self.size  # stands for a break; no pair holds it
        keys = left * (self.size + 1) + right
        order = np.argsort(keys)
        self.pair_keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.pair_ranks = np.append(joined[order], -1)
        # Tokens that may be merged on at a lower rank than they were made at.
        self.hasty = np.zeros(self.size, bool)
        self.hasty[left[joined < left]] = True
        self.hasty[right[joined < right]] = True
        self.split = regex.compile(pattern).findall
        self.cache: dict[str, bytes] = {}
        self.cache_parts = cache_parts

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each joined pair, -1 where the joined bytes are no token or a side is a break."""
        keys = left * (self.size + 1) + right
        at = np.searchsorted(self.pair_keys, keys)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], -1)

    def merge(self, parts: list[bytes]) -> list[bytes]:
        """Ids of each pre-token, as little-endian unsigned 32-bit integers."""
        sizes = np.array([len(p) for p in parts], np.int64)
        data = np.frombuffer(b"\0".join(parts) + b"\0", np.uint8)
        n = data.size
        breaks = np.cumsum(sizes + 1) - 1
        token = self.of_byte[data]
        token[breaks] = self.stop
        token = np.concatenate([token, [self.stop]])  # place n: a break after the end, and before the start
        following = np.arange(1, n + 2)
        following[n] = n
        previous = np.arange(-1, n)
        previous[0] = n
        # The rank of the pair that starts at a place; -1 if there is none to merge.
        pair = self._rank(token, token[following])
        queue = RankQueue(self.size)
        start = np.flatnonzero(pair >= 0)
        queue.push(pair[start], start)
        alive = np.ones(n + 1, bool)
        alive[breaks] = alive[n] = False
        alone: dict[int, bytes] = {}
        while (rank := queue.first()) >= 0:
            at = queue.pop(rank)
            at = at[pair[at] == rank]  # the others are stale
            if not at.size:
                continue
            # In a run of overlapping pairs every other one is merged, from the left.
            starts_run = np.ones(at.size, bool)
            starts_run[1:] = following[at[:-1]] != at[1:]
            index = np.arange(at.size)
            left = at[(index - np.maximum.accumulate(np.where(starts_run, index, 0))) & 1 == 0]
            early = self._early(token, following, previous, left, rank) if self.hasty[rank] else None
            if early is not None and early.any():
                # A merge makes a pair that must go before the other merges of this rank: such a
                # pre-token is taken out and merged one pair at a time.
                owners = np.unique(np.searchsorted(breaks, left[early]))
                for owner in owners.tolist():
                    alone[owner] = self._merge_one(parts[owner])
                    pair[breaks[owner] - sizes[owner] : breaks[owner]] = -1
                left = left[~np.isin(np.searchsorted(breaks, left), owners)]
            if left.size:
                self._apply(token, following, previous, pair, alive, queue, left, rank)
        live = np.flatnonzero(alive)
        counts = np.diff(np.searchsorted(live, np.concatenate([[0], breaks])))
        whole = token[live].astype("<u4").tobytes()
        ends = (4 * np.cumsum(counts)).tolist()
        out = [whole[a:b] for a, b in zip([0, *ends[:-1]], ends)]
        for owner, ids in alone.items():
            out[owner] = ids
        return out

    def _merge_one(self, part: bytes) -> bytes:
        """A single pre-token, one merge after the other: the buckets are heaps of positions."""
        n = len(part)
        token = self.of_byte[np.frombuffer(part, np.uint8)].tolist()
        first = np.array(token, np.int64)
        pair = [*self._rank(first[:-1], first[1:]).tolist(), -1]
        following, previous = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = RankQueue(self.size)
        for at, rank in enumerate(pair):
            if rank >= 0:
                queue.buckets[rank].append(at)
                queue.mark(rank)
        ranks, tokens = self.ranks, self.tokens
        while (rank := queue.first()) >= 0:
            bucket = queue.buckets[rank]
            at = heapq.heappop(bucket)
            if not bucket:
                queue.unmark(rank)
            if pair[at] != rank:
                continue
            gone = following[at]
            after = following[gone]
            token[at], token[gone], pair[gone], following[at] = rank, -1, -1, after
            if after < n:
                previous[after] = at
            for start, end in ((previous[at], at), (at, after)):
                if start >= 0:
                    new = ranks.get(tokens[token[start]] + tokens[token[end]], -1) if end < n else -1
                    pair[start] = new
                    if new >= 0:
                        heapq.heappush(queue.buckets[new], start)
                        queue.mark(new)
        return np.array([t for t in token if t >= 0], "<u4").tobytes()

    def _early(self, token, following, previous, left, rank) -> np.ndarray:
        """Merges that, done in turn, would make a pair of lower rank than their own."""
        merged = np.full(left.size, rank)
        before, after = token[previous[left]], token[following[following[left]]]
        low = np.zeros(left.size, bool)
        for ranks in (self._rank(before, merged), self._rank(merged, after)):
            low |= (ranks >= 0) & (ranks < rank)
        twice = self._rank(merged[:1], merged[:1])[0]
        if 0 <= twice < rank:
            low[1:] |= following[following[left[:-1]]] == left[1:]
        return low

    def _apply(self, token, following, previous, pair, alive, queue, left, rank) -> None:
        gone = following[left]
        after = following[gone]
        token[left] = rank
        alive[gone] = False
        pair[gone] = -1
        following[left] = after
        previous[after] = left
        before = previous[left]
        changed = np.concatenate([before, left])
        new = self._rank(token[changed], token[following[changed]])
        pair[changed] = new
        pair[-1] = -1
        keep = new >= 0
        queue.push(new[keep], changed[keep])

    def _learn(self, fresh: list[str]) -> None:
        """Put the ids of new parts (stretches that split on their own) into the cache."""
        split: list[list[str]] = []
        for part in fresh:
            # Letters and the punctuation behind them need no pattern.
            core = part.rstrip(".,;:!?")
            if core.isalpha() or (core[:1] == " " and core[1:].isalpha()):
                split.append([core, part[len(core) :]] if len(core) < len(part) else [part])
            else:
                split.append(self.split(part))
        known = {w: self.ranks.get(w.encode(), -1) for w in set(chain.from_iterable(split))}
        rest = [w for w, rank in known.items() if rank < 0]
        known = {w: rank.to_bytes(4, "little") for w, rank in known.items() if rank >= 0}
        for at in range(0, len(rest), MERGE_PARTS):
            some = rest[at : at + MERGE_PARTS]
            known.update(zip(some, self.merge([w.encode() for w in some])))
        self.cache.update((p, b"".join(map(known.__getitem__, pieces))) for p, pieces in zip(fresh, split))

    def _parts(self, text: str) -> list[str]:
        """Stretches of a text that can be split into pre-tokens one by one.

        A pre-token holds a blank only as its first character, unless white space stands before the blank.
        So a text is cut before each blank, save where white space precedes one; then pre-tokens are cut themselves.
        """
        if any(s + " " in text for s in SPACES):
            return self.split(text)
        first, *rest = text.split(" ")
        return [first, *(" " + p for p in rest)]

    def meet(self, texts: Iterable[str]) -> None:
        """Learn all parts of some texts that are not in the cache."""
        if len(self.cache) > self.cache_parts:
            self.cache.clear()
        fresh: set[str] = set()
        for text in texts:
            fresh.update(set(self._parts(text)).difference(self.cache))
        if fresh:
            self._learn(list(fresh))

    def encode(self, text: str) -> bytes:
        """Ids of a text whose parts have been met, as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.cache.__getitem__, self._parts(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_CODECS: dict[str, ByteBpe] = {}


def codec(path: str) -> ByteBpe:
    """The worker's codec for a rank file."""
    if path not in _CODECS:
        _CODECS[path] = ByteBpe(path)
    return _CODECS[path]


def _coder(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path)
        for group in gathered(batches, GATHER_BYTES):
            bpe.meet(t.decode() for batch in group for t in texts_of(batch.column(1)))
            for batch in group:
                ids = [bpe.encode(t.decode()) for t in texts_of(batch.column(1))]
                counts = pa.array([len(i) // 4 for i in ids], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), counts, binary(ids), binary([bpe.decode(i) for i in ids])],
                    [DOC, "n_tokens", "ids", "decoded"],
                )

    return run


def encode_decode(docs: DataFrame, ranks: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns of every row as struct ``doc``, with n_tokens, ids and the decoded bytes.

    ``ids`` are little-endian unsigned 32-bit integers; special tokens are never made. A null or
    empty text has no ids. ``ranks`` is a file of base-64 tokens and ranks that has all 256 bytes.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(packed(docs.select(*keep)), F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = f"{DOC} {rows.schema[DOC].dataType.simpleString()}, n_tokens long, ids binary, decoded binary"
    return rows.mapInArrow(_coder(ranks), schema)
