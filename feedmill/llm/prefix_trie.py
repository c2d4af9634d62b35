"""The trie of conversation prefixes, as balanced parentheses in shards.

A turn is known by the first 16 bytes of the SHA-256 of its role and text, a conversation by its *path*, the turns' digests
one after the other. Conversations are ordered by path, then id, and cut by range into shards of bounded size, so the
copies of one conversation, and the conversations that share a first turn, spread over as many shards as they need.

In a shard the paths, each once and in order, are a trie in preorder: for every path the nodes that it does not share
with the one before are opened, after those that end there are closed. That gives a row of parentheses. A tree of
block minima of its excess (opened less closed) finds the close of every node (``findclose``), which delimits its subtree.
The number of ``()`` pairs before a place is a cumulative count (``rank``), so a subtree's leaves are a difference of
two; so are its savings, from the nodes' savings summed up in preorder.

Only nodes on the first or last path of a shard, its *spines*, can go on in another shard. All others are whole
and are put out at once; so are spine nodes that only one shard has. The rest, at most the turns that neighbouring
shards share, are merged by node: their counts add up, and so does what hangs off them inside the shards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.llm.frames import staged

DIGEST = 16
#: Turns of a shard, at most (a longer conversation is a shard alone) and where there are few.
SHARD_TURNS = 1_000_000
LEAST_TURNS = 4096
BLOCK = 256
WORD = "[^\\x20\\x09-\\x0D]+"
#: Conversations of a group start with turns of its first one: with fewer than ``HEAD`` of them.
GROUP, HEAD = 20, 4
#: What a shard says of a node. ``node`` names a spine node, ``all_*`` are sums over its whole subtree in the shard,
#: the other sums are of what hangs off it besides further spine nodes.
PART = (
    "node binary, parent binary, shard long, depth long, conv_id long, parent_conv_id long, n_convs long, words long,"
    " n_children long, n_leaves long, saved_tokens long, all_children long, all_leaves long, all_saved long,"
    " ends_sha256 string, ends string"
)
MERGED = (
    "node binary, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long,"
    " saved_tokens long"
)
RESULT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
NO_ENDS = hashlib.sha256(b"").hexdigest()


class Parentheses:
    """Balanced parentheses with a tree of block minima of the excess."""

    def __init__(self, opens: np.ndarray, block: int = BLOCK):
        self.opens = opens
        self.excess = np.cumsum(np.where(opens, 1, -1))
        self.block = block
        top = np.iinfo(np.int64).max
        padded = np.full(-(-max(opens.size, 1) // block) * block, top)
        padded[: opens.size] = self.excess
        self.inside = padded.reshape(-1, block)
        self.minima = [self.inside.min(axis=1)]
        while self.minima[-1].size > 1:
            level = self.minima[-1]
            level = np.append(level, top) if level.size % 2 else level
            self.minima[-1] = level
            self.minima.append(level.reshape(-1, 2).min(axis=1))
        #: Number of "()" pairs whose "(" stands before each place.
        pair = np.zeros(opens.size + 1, np.int64)
        if opens.size > 1:
            pair[1:-1] = np.cumsum(opens[:-1] & ~opens[1:])
            pair[-1] = pair[-2]
        self.pairs = pair

    def _in_block(self, places: np.ndarray, block: np.ndarray, after: np.ndarray, target: np.ndarray) -> np.ndarray:
        """First place in each ``block``, from ``after`` on, whose excess is ``target``; -1 if none."""
        out = np.full(places.size, -1, np.int64)
        step = max(1, (1 << 21) // self.block)
        for at in range(0, places.size, step):
            part = slice(at, at + step)
            hit = self.inside[block[part]] == target[part, None]
            hit &= np.arange(self.block) >= after[part, None]
            first = hit.argmax(axis=1)
            ok = hit[np.arange(first.size), first]
            out[part] = np.where(ok, block[part] * self.block + first, -1)
        return out

    def find_close(self, places: np.ndarray) -> np.ndarray:
        """Where each of the given opening parentheses is closed: the first later place with one less excess."""
        target = self.excess[places] - 1
        block = places // self.block
        close = self._in_block(places, block, places % self.block + 1, target)
        open_ = np.flatnonzero(close < 0)
        if open_.size:
            block = self._next_block(block[open_] + 1, target[open_])
            close[open_] = self._in_block(open_, block, np.zeros(open_.size, np.int64), target[open_])
        return close

    def _next_block(self, block: np.ndarray, target: np.ndarray) -> np.ndarray:
        """First block from ``block`` on that goes down to ``target``: up the tree, then down again."""
        node, level = block.copy(), np.full(block.size, -1)
        for up, minima in enumerate(self.minima):
            # A left child looks at its parent next, which holds its sibling as well.
            look = (level < 0) & (node < minima.size) & ((node % 2 == 1) | (minima.size == 1))
            hit = np.zeros(block.size, bool)
            hit[look] = minima[node[look]] <= target[look]
            level[hit] = up
            climb = level < 0
            node[climb] = (node[climb] + 1) // 2
        for down in range(len(self.minima) - 1, 0, -1):
            on = level == down
            left = node[on] * 2
            node[on] = np.where(self.minima[down - 1][left] <= target[on], left, left + 1)
            level[on] = down - 1
        return node


def shared_turns(one: bytes, other: bytes, digest: int = DIGEST) -> int:
    """How many first turns two paths share."""
    most = min(len(one), len(other)) // digest
    if one[: most * digest] == other[: most * digest]:
        return most
    low, high = 0, most - 1
    while low < high:  # the turns up to the first that differs are equal, so halving finds it
        mid = (low + high + 1) // 2
        if one[: mid * digest] == other[: mid * digest]:
            low = mid
        else:
            high = mid - 1
    return low


class Trie:
    """The trie of sorted paths as balanced parentheses; node 0 is the root, nodes are in preorder."""

    def __init__(self, paths: list[bytes], block: int = BLOCK):
        bits: list[np.ndarray] = [np.ones(1, bool)]
        owner, depth, fresh = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], []
        before = b""
        for n, path in enumerate(paths):
            same = shared_turns(before, path)
            closed, opened = len(before) // DIGEST - same, len(path) // DIGEST - same
            bits += [np.zeros(closed, bool), np.ones(opened, bool)]
            owner.append(np.full(opened, n, np.int64))
            depth.append(np.arange(same + 1, same + opened + 1))
            fresh.append(opened)
            before = path
        bits.append(np.zeros(len(before) // DIGEST + 1, bool))
        tree = Parentheses(np.concatenate(bits), block)
        self.depth = np.concatenate(depth)
        #: The first path that has a node.
        self.first = np.concatenate(owner)
        self.opened = np.concatenate([[0], np.cumsum(fresh)]) + 1
        places = np.flatnonzero(tree.opens)
        close = tree.find_close(places)
        self.leaves = tree.pairs[close + 1] - tree.pairs[places]
        #: Preorder number behind a node's subtree: the nodes opened before its close.
        self.past = np.searchsorted(places, close)
        self.parent = self._parents()
        self.children = np.bincount(self.parent[1:], minlength=self.depth.size)

    def _parents(self) -> np.ndarray:
        """A node's parent is the last node before it of one depth less."""
        out, spine = np.full(self.depth.size, -1, np.int64), {}
        for n, d in enumerate(self.depth.tolist()):
            out[n] = spine.get(d - 1, -1)
            spine[d] = n
        return out

    def subtree_sums(self, values: np.ndarray) -> np.ndarray:
        """The sum of ``values`` over each node's subtree, from sums in preorder."""
        before = np.concatenate([[0], np.cumsum(values)])
        return before[self.past] - before[: self.depth.size]

    def path_of(self, path: int, paths: list[bytes]) -> np.ndarray:
        """The nodes of a path, from the root."""
        out = np.zeros(len(paths[path]) // DIGEST + 1, np.int64)
        node = self.opened[path + 1] - 1 if self.opened[path + 1] > self.opened[path] else None
        if node is None:  # the path ends at a node that an earlier one has opened
            raise ValueError("paths must be distinct")
        for d in range(out.size - 1, -1, -1):
            out[d] = node
            node = self.parent[node]
        return out


def chain(path: bytes) -> list[bytes]:
    """Names of the nodes of a path, each made from the name before it, the root's empty."""
    out = [b""]
    for at in range(0, len(path), DIGEST):
        out.append(hashlib.sha256(out[-1] + path[at : at + DIGEST]).digest()[:DIGEST])
    return out


def shard_parts(shard: int, paths: list[bytes], ids: np.ndarray, words: list[list[int]]) -> dict[str, list]:
    """What one shard says of its nodes; its conversations come sorted by path and id."""
    starts = [0, *[n for n in range(1, len(paths)) if paths[n] != paths[n - 1]]]
    distinct = [paths[n] for n in starts]
    rootless = bool(distinct) and not distinct[0]
    trie = Trie(distinct[1:] if rootless else distinct)
    nodes = trie.depth.size
    # The path at which a node was opened names its turns; conversations of the trie's paths follow the turnless ones.
    shift = int(rootless)
    first_row = np.array([*starts, len(paths)], np.int64)
    own_words = np.zeros(nodes, np.int64)
    ends_at = np.zeros(nodes, np.int64)  # conversations that end at a node
    end_row = np.zeros(nodes, np.int64)
    for n in range(shift, len(starts)):
        a, b = trie.opened[n - shift], trie.opened[n - shift + 1]
        own_words[a:b] = words[starts[n]][len(words[starts[n]]) - (b - a) :]
        ends_at[b - 1] = first_row[n + 1] - first_row[n]
        end_row[b - 1] = first_row[n]
    if rootless:
        ends_at[0] = first_row[1]
    convs = trie.subtree_sums(ends_at)
    # Members of a node are a run of rows: from the first path that has it, as many as end in its subtree.
    row = first_row[trie.first + shift]
    row[0] = 0
    bounds = np.stack([row, row + convs], axis=1).ravel()
    padded = np.append(ids, np.iinfo(np.int64).max)
    least = np.minimum.reduceat(padded, bounds)[::2]

    spine = np.zeros(nodes, bool)
    spine[0] = True
    names: dict[int, bytes] = {0: b""}
    if len(distinct) > shift:
        for at in (0, len(distinct) - shift - 1):
            on = trie.path_of(at, distinct[shift:])
            spine[on] = True
            names.update(zip(on.tolist(), chain(distinct[shift + at])))

    inner = ~spine
    all_saved = trie.subtree_sums((convs - 1) * own_words)
    saved = trie.subtree_sums(np.where(inner, (convs - 1) * own_words, 0))
    leaf = (trie.children == 0) & inner
    leaves = np.where(inner, trie.leaves, trie.subtree_sums(leaf))
    above = trie.parent
    inner_children = np.bincount(above[1:][inner[1:]], minlength=nodes)
    # A spine node hands on only what hangs off itself: what is below the next spine node is that node's own.
    for values in (saved, leaves):
        below = np.zeros(nodes, np.int64)
        on = np.flatnonzero(spine & (above >= 0))
        np.add.at(below, above[on], values[on])
        values[spine] -= below[spine]

    text = [str(i) for i in ids.tolist()]
    ends = [",".join(text[r : r + n]) if n else "" for r, n in zip(end_row.tolist(), ends_at.tolist())]
    whole = inner.tolist()
    up = above.tolist()
    return {
        "node": [None if w else names[n] for n, w in enumerate(whole)],
        "parent": [names.get(p) if p >= 0 else None for p in up],
        "shard": [shard] * nodes,
        "depth": trie.depth.tolist(),
        "conv_id": least.tolist(),
        "parent_conv_id": [int(least[p]) if w and not spine[p] else None for p, w in zip(up, whole)],
        "n_convs": convs.tolist(),
        "words": own_words.tolist(),
        "n_children": np.where(inner, trie.children, inner_children).tolist(),
        "n_leaves": leaves.tolist(),
        "saved_tokens": saved.tolist(),
        "all_children": trie.children.tolist(),
        "all_leaves": trie.leaves.tolist(),
        "all_saved": all_saved.tolist(),
        "ends_sha256": [hashlib.sha256(e.encode()).hexdigest() if w else None for e, w in zip(ends, whole)],
        "ends": [None if w else e for e, w in zip(ends, whole)],
    }


PART_KIND = pa.schema(
    [
        ("node", pa.binary()),
        ("parent", pa.binary()),
        *[(c, pa.int64()) for c in ("shard", "depth", "conv_id", "parent_conv_id", "n_convs", "words", "n_children")],
        *[(c, pa.int64()) for c in ("n_leaves", "saved_tokens", "all_children", "all_leaves", "all_saved")],
        ("ends_sha256", pa.string()),
        ("ends", pa.string()),
    ]
)


def _shard(table: pa.Table) -> pa.Table:
    """All nodes of one shard."""
    table = table.sort_by([("path", "ascending"), ("conv_id", "ascending")])
    ids = table["conv_id"].to_numpy()
    found = shard_parts(table["shard"][0].as_py(), table["path"].to_pylist(), ids, table["words"].to_pylist())
    return pa.Table.from_pydict(found, PART_KIND)


def _merge(table: pa.Table) -> pa.Table:
    """Counts over the subtrees of the nodes that several shards share."""
    names, parents = table["node"].to_pylist(), table["parent"].to_pylist()
    depth = table["depth"].to_numpy()
    place = {name: n for n, name in enumerate(names)}
    up = np.array([place[p] if p is not None else -1 for p in parents], np.int64)
    n_children = table["n_children"].to_numpy().copy()
    np.add.at(n_children, up[up >= 0], 1)
    n_convs, least = table["n_convs"].to_numpy(), table["conv_id"].to_numpy()
    saved = table["saved_tokens"].to_numpy() + (n_convs - 1) * table["words"].to_numpy()
    leaves = table["n_leaves"].to_numpy() + (n_children == 0)
    order = np.argsort(-depth, kind="stable")
    for at in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):  # children are whole before they are added
        if depth[at[0]]:
            np.add.at(saved, up[at], saved[at])
            np.add.at(leaves, up[at], leaves[at])
    return pa.Table.from_pydict(
        {
            "node": table["node"],
            "depth": depth,
            "conv_id": least,
            "parent_conv_id": pa.array([int(least[p]) if p >= 0 else None for p in up.tolist()], pa.int64()),
            "n_convs": n_convs,
            "n_children": n_children,
            "n_leaves": leaves,
            "saved_tokens": saved,
        }
    )


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's ids, which come in pieces sorted by node and shard and are never put together."""
    node, running = None, None

    def done(names: list, hashes: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"node": pa.array(names, pa.binary()), "hash": pa.array(hashes, pa.string())})

    for batch in batches:
        names, hashes = [], []
        for name, ends in zip(batch["node"].to_pylist(), batch["ends"].to_pylist()):
            if name != node or running is None:
                if running is not None:
                    names.append(node)
                    hashes.append(running.hexdigest())
                node, running = name, hashlib.sha256(ends.encode())
            else:
                running.update(b"," + ends.encode())
        yield done(names, hashes)
    if running is not None:
        yield done([node], [running.hexdigest()])


def conversations_of(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """``conv_id, turns``: every conversation's turns in order, as structs of digest and number of words.

    Null turns come first, equal ones in order of their digest; null role or text is empty. Rows without a conversation
    belong to none. Texts stay where they are read: 16 bytes and a number of each turn travel, and a
    conversation's own come together in one row.
    """
    role, text = (F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in (role_col, text_col))
    known = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    one = F.struct(
        F.col(f"`{turn_col}`").alias("turn"),
        F.unhex(F.substring(F.sha2(known, 256), 1, 2 * DIGEST)).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).alias("words"),
    )
    own = turns.where(F.col(f"`{conv_col}`").isNotNull()).select(F.col(f"`{conv_col}`").cast("long").alias("conv_id"), one.alias("t"))
    ordered = own.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    return ordered.select("conv_id", F.transform("turns", lambda t: F.struct(t["digest"], t["words"])).alias("turns"))


def rebuilt(conversations: DataFrame, group: int = GROUP, head: int = HEAD) -> DataFrame:
    """Every conversation c with its first h turns taken from conversation c - c % ``group``: all it has if fewer,
    none if it is absent; h is crc32 of c's decimal digits modulo ``head``."""
    conv = F.col("conv_id")
    taken = (F.crc32(conv.cast("string")) % head).cast("int")
    firsts = conversations.where(conv % group == 0).select(
        conv.alias("_first"), F.slice("turns", 1, head - 1).alias("_head")
    )
    base = F.coalesce(F.slice("_head", F.lit(1), taken), F.slice("turns", 1, 0))
    rest = F.slice("turns", taken + 1, F.size("turns"))
    met = conversations.join(firsts, conv - conv % group == F.col("_first"), "left")
    return met.select("conv_id", F.concat(base, rest).alias("turns"))


def prefix_trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row for each distinct sequence of first turns that conversations (``conv_id``, ``turns``) share.

    A node is known by its smallest member (``conv_id``) and its ``depth``; the root, of depth 0, has no turn. ``n_convs``
    counts its members, ``n_children`` its children, ``n_leaves`` the childless nodes of its subtree, itself included;
    ``saved_tokens`` sums (n_convs - 1) times the words of a node's last turn over its subtree; ``ends_sha256`` is the SHA-256
    of the ids, ascending and joined by commas, of the members that have no further turn. Conversations without
    turns end at the root. No conversations, no nodes. Ids must be distinct and not null.
    """
    spark = conversations.sparkSession
    digests = F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), "")
    narrow = conversations.select(
        "conv_id", F.unhex(digests).alias("path"), F.transform("turns", lambda t: t["words"].cast("int")).alias("words")
    )
    narrow = staged(narrow, "trie-paths")
    turns = narrow.agg(F.coalesce(F.sum(F.size("words")), F.lit(0))).first()[0]
    few = min(int(spark.conf.get("spark.sql.shuffle.partitions")), turns // LEAST_TURNS)
    shards = max(1, few, -(-turns // shard_turns))
    ranged = narrow.repartitionByRange(shards, "path", "conv_id").withColumn("shard", F.spark_partition_id().cast("long"))
    parts = staged(ranged.groupBy("shard").applyInArrow(_shard, PART), "trie-parts")

    spines = parts.where(F.col("node").isNotNull())
    sums = ("n_convs", "n_children", "n_leaves", "saved_tokens")
    same = ("parent", "depth", "words", "all_children", "all_leaves", "all_saved")
    by_node = staged(
        spines.groupBy("node").agg(
            F.count(F.lit(1)).alias("shards"),
            F.min("conv_id").alias("conv_id"),
            *[F.sum(c).alias(c) for c in sums],
            *[F.max(c).alias(c) for c in same],
        ),
        "trie-spines",
    )
    alone = by_node.where("shards = 1")
    handed = alone.where(F.col("parent").isNotNull()).groupBy("parent").agg(
        F.count(F.lit(1)).alias("_children"), F.sum("all_leaves").alias("_leaves"), F.sum("all_saved").alias("_saved")
    )

    def plus(column: str, more: str) -> Column:
        return (F.col(column) + F.coalesce(F.col(more), F.lit(0))).alias(column)

    shared = by_node.where("shards > 1").join(handed.withColumnRenamed("parent", "node"), "node", "left").select(
        "node", "parent", "depth", "conv_id", "n_convs", "words",
        plus("n_children", "_children"), plus("n_leaves", "_leaves"), plus("saved_tokens", "_saved"),
    )
    merged = shared.withColumn("_all", F.lit(0)).groupBy("_all").applyInArrow(_merge, MERGED)

    pieces = spines.where("ends <> ''").select("node", "shard", "ends")
    hashes = pieces.repartition("node").sortWithinPartitions("node", "shard").mapInArrow(_hash_ends, "node binary, hash string")
    least = by_node.select(F.col("node").alias("parent"), F.col("conv_id").alias("_parent"))
    known = alone.select(
        "node", "parent", "depth", "conv_id", "n_convs", F.col("all_children").alias("n_children"),
        F.col("all_leaves").alias("n_leaves"), F.col("all_saved").alias("saved_tokens"),
    ).join(least, "parent", "left").withColumnRenamed("_parent", "parent_conv_id")
    spine_rows = known.drop("parent").unionByName(merged).join(hashes, "node", "left")
    whole = parts.where(F.col("node").isNull())
    inside = whole.where(F.col("parent").isNull())  # the parent is whole too, and was met in the shard
    below_spine = whole.where(F.col("parent").isNotNull()).drop("parent_conv_id").join(least, "parent", "left")
    rows = (
        inside,
        below_spine.withColumnRenamed("_parent", "parent_conv_id"),
        spine_rows.withColumn("ends_sha256", F.coalesce("hash", F.lit(NO_ENDS))),
    )
    return reduce(DataFrame.unionByName, [r.select(*RESULT) for r in rows])


def oracle_sql() -> str:
    """The same rows by plain SQL: every turn is handed to all nodes above it."""
    steps = (
        "list_reduce(list_prepend(4294967295::bigint, range(8 * strlen(conv_id::varchar))), lambda crc, i: "
        "case when (xor(crc, case when i % 8 = 0 then ascii(substr(conv_id::varchar, i // 8 + 1, 1)) else 0 end) & 1) = 1 "
        "then xor(xor(crc, case when i % 8 = 0 then ascii(substr(conv_id::varchar, i // 8 + 1, 1)) else 0 end) >> 1, 3988292384) "
        "else xor(crc, case when i % 8 = 0 then ascii(substr(conv_id::varchar, i // 8 + 1, 1)) else 0 end) >> 1 end)"
    )
    return f"""
with said as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    where conv_id is not null
),
keyed as (
    select conv_id, turn, left(sha256(strlen(role) || ':' || role || text), 32) as key,
        len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) as words
    from said
),
turns as (
    select conv_id, key, words, row_number() over (partition by conv_id order by turn nulls first, key) as pos from keyed
),
convs as (
    select conv_id, conv_id - conv_id % {GROUP} as first, xor({steps}, 4294967295) % {HEAD} as h
    from (select distinct conv_id from turns)
),
rebuilt as (
    select c.conv_id, t.pos, t.key, t.words from convs c join turns t on t.conv_id = c.first and t.pos <= c.h
    union all
    select c.conv_id, least(c.h, coalesce(f.n, 0)) + t.pos - c.h, t.key, t.words
    from convs c join turns t on t.conv_id = c.conv_id and t.pos > c.h
    left join (select conv_id, count(*) as n from turns group by conv_id) f on f.conv_id = c.first
),
paths as (
    select conv_id, pos as depth, words, string_agg(key, '') over (partition by conv_id order by pos) as path from rebuilt
    union all select conv_id, 0, 0, '' from convs
),
nodes as (
    select path, depth, min(conv_id) as conv_id, count(*) as n_convs, max(words) as words from paths group by path, depth
),
children as (
    select left(path, 32 * (depth - 1)) as path, count(*) as n_children from nodes where depth > 0 group by all
),
above as (
    select n.*, coalesce(n_children, 0) as n_children, unnest(range(depth + 1)) as d from nodes n left join children using (path)
),
sums as (
    select left(path, 32 * d) as path, sum(case when n_children = 0 then 1 else 0 end)::bigint as n_leaves,
        sum((n_convs - 1) * words)::bigint as saved_tokens
    from above group by all
),
ends as (
    select path, string_agg(conv_id::varchar, ',' order by conv_id) as ids from (
        select conv_id, max_by(path, depth) as path from paths group by conv_id
    ) group by path
)
select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(n_children, 0) as n_children, n_leaves,
    saved_tokens, sha256(coalesce(ids, '')) as ends_sha256
from nodes n join sums using (path) left join children using (path) left join ends using (path)
left join nodes p on n.depth > 0 and p.path = left(n.path, 32 * (n.depth - 1))
"""
