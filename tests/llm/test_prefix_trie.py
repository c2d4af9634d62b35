"""The trie of conversation prefixes against a brute force over all sequences."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedmill.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string, turns string, node string, depth string"
WORD = re.compile("[^\x20\x09-\x0d]+")


def table(spark, rows):
    """Turns with columns whose names clash with those of results."""
    return spark.createDataFrame([(*r, "t", "n", "d") for r in rows], SCHEMA).repartition(4)


def digest_of(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]


def rebuilt(rows):
    """Every conversation's turns (role, text) after the exchange of first turns."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn, role or "", text or ""))
    for turns in own.values():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, digest_of(*t[1:])))
    out = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 4
        first = conv - conv % 20
        out[conv] = [t[1:] for t in own.get(first, [])[:h]] + [t[1:] for t in turns[h:]]
    return out


def brute(conversations):
    """All nodes: sequences of first turns with their members."""
    members = {}
    for conv, turns in conversations.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(conv)
    out = []
    for path, convs in members.items():
        below = [p for p in members if p[: len(path)] == path]
        with_children = {p[:-1] for p in members if p}
        ends = sorted(c for c in convs if len(conversations[c]) == len(path))
        out.append(
            (
                min(convs),
                len(path),
                min(members[path[:-1]]) if path else None,
                len(convs),
                sum(len(p) == len(path) + 1 for p in below),
                sum(p not in with_children for p in below),
                sum((len(members[p]) - 1) * len(WORD.findall(p[-1][1])) for p in below if p),
                hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return sorted(out, key=repr)


def nodes(df):
    return sorted(map(tuple, df.select(*pt.RESULT).collect()), key=repr)


def random_turns(seed, convs=120):
    rng = random.Random(seed)
    rows = []
    for conv in rng.sample(range(400), convs):
        for turn in range(rng.choice([1, 1, 2, 3, 6])):
            role, text = rng.choice([("user", "a b"), ("user", "c\td\x0be f"), (None, None), ("", ""), ("é", "ü  ß")])
            rows.append((conv, rng.choice([turn, turn, None]), role, text))
    return rows + [(None, 0, "user", "lost")] * 3 + rows[:5]


@pytest.mark.parametrize("shard_turns", [pt.SHARD_TURNS, 60, 7, 1])
def test_against_brute_force(spark, shard_turns):
    rows = random_turns(5)
    got = nodes(pt.prefix_trie(pt.rebuilt(pt.conversations_of(table(spark, rows))), shard_turns))
    assert got == brute(rebuilt(rows))


@pytest.mark.parametrize("block", [1, 2, 3, 8, 256])
def test_find_close_against_a_stack(block):
    rng = random.Random(block)
    for size in (1, 2, 5, 40, 700):
        opens, depth, left = [True], 1, size - 1
        while left or depth > 1:
            go_down = left and (depth == 1 or rng.random() < rng.choice([0.2, 0.5, 0.9]))
            opens.append(bool(go_down))
            depth += 1 if go_down else -1
            left -= 1 if go_down else 0
        opens.append(False)
        tree = pt.Parentheses(np.array(opens), block)
        stack, close = [], {}
        for at, up in enumerate(opens):
            if up:
                stack.append(at)
            else:
                close[stack.pop()] = at
        places = np.flatnonzero(tree.opens)
        assert tree.find_close(places).tolist() == [close[p] for p in places.tolist()]
        pairs = [at for at in range(len(opens) - 1) if opens[at] and not opens[at + 1]]
        assert tree.pairs.tolist() == [sum(p < at for p in pairs) for at in range(len(opens) + 1)]


def test_shared_turns():
    one, other = b"a" * 16 + b"b" * 16 + b"c" * 16, b"a" * 16 + b"b" * 16 + b"d" * 16 + b"e" * 16
    assert pt.shared_turns(one, other) == 2
    assert pt.shared_turns(one[:32], one) == 2 and pt.shared_turns(b"", one) == 0
    assert pt.shared_turns(b"x" * 16 + one, one) == 0 and pt.shared_turns(one, one) == 3


@pytest.mark.parametrize("shard_turns", [pt.SHARD_TURNS, 50])
def test_hot_conversation_and_hot_first_turn(spark, shard_turns):
    """Copies of one conversation, and a first turn that most share, over many shards."""
    hot = {c: [("user", "hello there"), ("assistant", "general")] for c in range(0, 900, 3)}
    fan = {c: [("user", "hello there"), ("user", f"x{c} y")] for c in range(1, 900, 3)}
    plain = {c: [("user", f"only {c}")] * (c % 4) for c in range(2, 900, 3)}
    convs = {**hot, **fan, **plain}
    rows = [(c, turns) for c, turns in convs.items()]
    df = spark.createDataFrame(
        [(c, [(bytes.fromhex(digest_of(*t)), len(WORD.findall(t[1]))) for t in turns]) for c, turns in rows],
        "conv_id long, turns array<struct<digest:binary,words:int>>",
    ).repartition(5)
    assert nodes(pt.prefix_trie(df, shard_turns)) == brute(convs)


def test_long_conversation_and_long_text(spark):
    rows = [(1, n, "user", f"turn {n}") for n in range(3000)] + [(2, n, "user", f"turn {n}") for n in range(1500)]
    rows += [(20, 0, "user", "w " * 200_000), (21, 0, "user", "w " * 200_000)]
    got = nodes(pt.prefix_trie(pt.conversations_of(table(spark, rows)), 500))
    assert len(got) == 1 + 3000 + 1
    root = next(r for r in got if r[1] == 0)
    assert root[3:7] == (4, 2, 2, 1500 * 2 + 200_000)


def test_conversation_without_turns_is_a_member_of_the_root(spark):
    lone = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(lone, 0, "user", "gone")]
    got = nodes(pt.prefix_trie(pt.rebuilt(pt.conversations_of(table(spark, rows)))))
    assert got == [(lone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest())] == brute(rebuilt(rows))


def test_empty_table(spark):
    none = table(spark, [(0, 0, "user", "x")]).where(F.lit(False))
    assert nodes(pt.prefix_trie(pt.rebuilt(pt.conversations_of(none)))) == []
    only_null = table(spark, [(None, 0, "user", "x")])
    assert nodes(pt.prefix_trie(pt.rebuilt(pt.conversations_of(only_null)))) == []


def test_hashes_of_ends_over_batches():
    import pyarrow as pa

    def batch(rows):
        return pa.RecordBatch.from_pydict({"node": pa.array([r[0] for r in rows], pa.binary()), "ends": [r[1] for r in rows]})

    batches = [batch([(b"", "1,2"), (b"a", "3")]), batch([(b"a", "4")]), batch([]), batch([(b"a", "5"), (b"b", "6")])]
    got = {n: h for b in pt._hash_ends(iter(batches)) for n, h in zip(b["node"].to_pylist(), b["hash"].to_pylist())}
    want = {b"": "1,2", b"a": "3,4,5", b"b": "6"}
    assert got == {n: hashlib.sha256(e.encode()).hexdigest() for n, e in want.items()}
