"""Ranked search of whole texts for a table of queries, term at a time with limited accumulators.

A first pass counts: documents, terms, and for each term of a query the documents that hold it. Weights follow from
these counts alone, so every task scores as it would over the whole table. In the second pass each task indexes its
documents block by block and answers all queries on a block, a query's terms rarest first. A document that a term
meets gets an accumulator. As soon as the bounds of the terms left sum up to less than the kth best score so
far, no new accumulator can reach the first k, so none is made; those that exist are updated with every
term left, so their scores are exact. The best k of each query in each task then meet in one top k.

Texts are neither shuffled nor joined with queries. Queries go to the executors in lists of bounded size, each list
in passes of its own. Blocks hold a bounded number of terms; a document of more terms is a block of its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedmill.llm import terms
from feedmill.llm.frames import bounded_batches, staged, texts_of

K = 10
#: Queries, and characters of queries, that go to the executors at a time.
WAVE_ITEMS = 20_000
WAVE_CHARS = 16_000_000
#: Postings of one block of documents.
BLOCK_POSTINGS = 1 << 21
SCALE, SLOPE, BASE, LENGTH = 1_000_000_000, 8, 10, 90
ROW = "_row"


def weight(documents: int, holding: int) -> int:
    """Weight of a term that ``holding`` of ``documents`` hold."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def impact(count: np.ndarray, length: np.ndarray, documents: int, total: int) -> np.ndarray:
    """What a unit of weight adds to the score of documents of ``length`` terms that hold a term ``count`` times."""
    m = BASE + LENGTH * length * documents // total
    return SCALE * count // (1000 * count + SLOPE * m)


def query_terms(text: str | None) -> list[bytes]:
    """The distinct terms of a query, in order of their bytes."""
    return sorted({w for part in terms.words((text or "").encode()) for w in part})


def waves(queries: DataFrame, item_col: str, text_col: str, most_items: int, most_chars: int) -> Iterator[list[tuple]]:
    """Queries with their numbers as lists of bounded size; sizes are measured before anything is collected."""
    row = F.struct(F.col(f"`{item_col}`").alias("item"), F.col(f"`{text_col}`").alias("text"))
    asked = staged(queries.select(row.alias("q")).withColumn(ROW, F.monotonically_increasing_id()), "queries")
    count, chars = asked.agg(F.count("*"), F.coalesce(F.sum(F.length("q.text")), F.lit(0))).first()
    parts = max(1, -(-count // most_items), -(-chars // most_chars))
    for part in range(parts):
        mine = asked if parts == 1 else asked.where(F.pmod(F.xxhash64(ROW), F.lit(parts)) == part)
        wave = [(r[ROW], r["q"]["text"]) for r in mine.orderBy(ROW).collect()]
        if wave:
            yield asked.select(ROW, F.col("q.item").alias("item")), wave


def postings(texts: list[bytes], vocabulary: dict[bytes, int]) -> tuple[np.ndarray, ...]:
    """Per document its number of terms; and (term, document, count) sorted by term and document."""
    lengths, keys, counts, owners = np.zeros(len(texts), np.int64), [], [], []
    for n, text in enumerate(texts):
        met = terms.numbers(text, vocabulary)
        lengths[n] = met.size
        ids, times = np.unique(met[met >= 0], return_counts=True)
        keys.append(ids)
        counts.append(times)
        owners.append(np.full(ids.size, n, np.int64))
    term = np.concatenate(keys) if keys else np.zeros(0, np.int32)
    owner = np.concatenate(owners) if owners else np.zeros(0, np.int64)
    order = np.argsort(term, kind="stable")
    count = np.concatenate(counts).astype(np.int64) if counts else np.zeros(0, np.int64)
    return lengths, term[order], owner[order], count[order]


def statistics(docs: DataFrame, vocabulary: dict[bytes, int], text_col: str) -> tuple[int, int, np.ndarray]:
    """Documents with a term, their terms, and the documents that hold each term of a bounded vocabulary."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, documents, total = np.zeros(len(vocabulary), np.int64), 0, 0
        for batch in batches:
            for text in texts_of(batch["text"]):
                met = terms.numbers(text, vocabulary)
                documents += met.size > 0
                total += met.size
                held[np.unique(met[met >= 0])] += 1
        met = np.flatnonzero(held)
        yield pa.RecordBatch.from_pydict(
            {
                "term": pa.array(np.concatenate([[-2, -1], met]).astype(np.int32)),
                "n": pa.array(np.concatenate([[documents, total], held[met]]).astype(np.int64)),
            }
        )

    parts = docs.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(count, "term int, n long")
    sums = {r["term"]: r["n"] for r in parts.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    held = np.zeros(len(vocabulary), np.int64)
    for term, n in sums.items():
        if term >= 0:
            held[term] = n
    return sums.get(-2, 0), sums.get(-1, 0), held


class Block:
    """A block of documents, indexed by term."""

    def __init__(self, lengths, term, owner, count, weights: np.ndarray, documents: int, total: int):
        self.size = lengths.size
        starts = np.flatnonzero(np.diff(term, prepend=-1))
        self.spans = dict(zip(term[starts].tolist(), zip(starts.tolist(), [*starts[1:].tolist(), term.size])))
        self.owner = owner
        self.gain = weights[term] * impact(count, lengths[owner], documents, total)
        tops = np.maximum.reduceat(self.gain, starts) if starts.size else starts
        self.bounds = dict(zip(term[starts].tolist(), tops.tolist()))
        self.made = 0

    def answer(self, query: list[int], k: int, floor: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Documents and exact scores among which are all that score above 0 and are of the best ``k`` of the block.

        ``query`` holds the terms rarest first. What cannot reach ``floor``, the kth best score met elsewhere, may
        be missing. An accumulator is not made when the bounds of the terms left, this one included, are
        below the kth best partial score: equal scores could still win by their id.
        """
        here = [t for t in query if t in self.spans]
        left = sum(self.bounds[t] for t in here)
        score, open_ = np.zeros(self.size, np.int64), np.zeros(self.size, bool)
        making = True
        for term in here:
            a, b = self.spans[term]
            owner, gain = self.owner[a:b], self.gain[a:b]
            if making:
                held = score[open_]
                kth = int(np.partition(held, -k)[-k]) if held.size >= k else 0
                making = left >= max(kth, floor, 1)
            if not making:
                mine = open_[owner]
                owner, gain = owner[mine], gain[mine]
            score[owner] += gain
            open_[owner] = True
            left -= self.bounds[term]
        self.made += int(open_.sum())
        found = np.flatnonzero(open_ & (score > 0))
        return found, score[found]


def _searcher(queries: list[tuple[int, list[int]]], vocabulary, weights, documents, total, k: int, most: int):
    def merged(best, query: int, ids: list, scores: np.ndarray) -> None:
        """Keep the best ``k`` of a query, and all that share the kth place's score and id."""
        both = [*best.get(query, ()), *zip(scores.tolist(), ids)]
        both.sort(key=lambda x: (-x[0], x[1] is not None, x[1] if x[1] is not None else 0))
        best[query] = both[:k]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple[int, object]]] = {}
        kind = pa.int64()

        def flush(group: list[tuple]) -> None:
            lengths = np.concatenate([g[0] for g in group])
            shift = np.cumsum([0, *[g[0].size for g in group[:-1]]])
            term = np.concatenate([g[1] for g in group])
            order = np.argsort(term, kind="stable")
            owner = np.concatenate([g[2] + s for g, s in zip(group, shift)])[order]
            block = Block(lengths, term[order], owner, np.concatenate([g[3] for g in group])[order], weights, documents, total)
            ids = pa.concat_arrays([g[4] for g in group])
            for query, wanted in queries:
                kept = best.get(query, ())
                found, scores = block.answer(wanted, k, kept[-1][0] if len(kept) == k else 0)
                if found.size > k:  # all of the kth best score are needed, as the smallest ids win
                    some = scores >= np.partition(scores, -k)[-k]
                    found, scores = found[some], scores[some]
                if found.size:
                    merged(best, query, ids.take(pa.array(found)).to_pylist(), scores)

        group, size = [], 0
        for batch in batches:
            ids = batch["id"]
            kind = ids.type
            texts = texts_of(batch["text"])
            at = 0
            while at < len(texts):
                end, room = at, 0
                while end < len(texts) and (end == at or room < most):
                    room += len(texts[end]) // 2
                    end += 1
                part = postings(texts[at:end], vocabulary)
                group.append((*part, ids.slice(at, end - at)))
                size += part[1].size
                at = end
                if size >= most:
                    flush(group)
                    group, size = [], 0
        if group:
            flush(group)
        rows = [(q, i, s) for q, kept in best.items() for s, i in kept]
        yield pa.RecordBatch.from_pydict(
            {
                "query": pa.array([r[0] for r in rows], pa.int64()),
                "id": pa.array([r[1] for r in rows], kind),
                "score": pa.array([r[2] for r in rows], pa.int64()),
            }
        )

    return search


def ranked_search(
    docs: DataFrame,
    queries: DataFrame,
    k: int = K,
    text_col: str = "text",
    id_col: str = "doc_id",
    query_text_col: str = "text",
    item_col: str = "item_id",
    wave_items: int = WAVE_ITEMS,
    wave_chars: int = WAVE_CHARS,
    block_postings: int = BLOCK_POSTINGS,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents of highest score above 0 for every row of ``queries``.

    Equal scores come by ascending id, a null id first. Rows are documents each, and queries each, so repeated rows
    of either are ranked and answered as often as they come. A null or empty text holds no term: such a query has no
    answer, such a document is none, and counts for nothing. Empty tables give an empty result. Other columns
    are not read; the result's names are ``item_id`` and ``doc_id`` whatever the columns are called.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    narrow = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()
    answers, items = [], None
    for items, wave in waves(queries, item_col, query_text_col, wave_items, wave_chars):
        asked = [(row, query_terms(text)) for row, text in wave]
        vocabulary = {t: n for n, t in enumerate(sorted({t for _, ts in asked for t in ts}))}
        documents, total, held = statistics(narrow, vocabulary, "text")
        weights = np.array([weight(documents, h) for h in held.tolist()], np.int64)
        plans = [(row, sorted((vocabulary[t] for t in ts), key=lambda t: (held[t], t))) for row, ts in asked]
        plans = [(row, [t for t in ts if weights[t] and held[t]]) for row, ts in plans]
        search = _searcher(plans, vocabulary, weights, documents, max(total, 1), k, block_postings)
        answers.append(narrow.mapInArrow(search, f"query long, id {kind}, score long"))
    if items is None:
        return docs.limit(0).select(
            F.lit(None).cast(queries.schema[item_col].dataType).alias("item_id"),
            F.lit(0).alias("rank"),
            F.col(f"`{id_col}`").alias("doc_id"),
            F.lit(0).cast("long").alias("score"),
        )
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.asc("id"))
    ranked = reduce(DataFrame.unionByName, answers).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.join(items, ranked["query"] == items[ROW]).select(
        F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score"
    )


def oracle_sql() -> str:
    """The same rows by plain SQL over all pairs of an item's term and a document that holds it."""
    fold = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    cut = f"unnest(regexp_extract_all({fold}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'))"
    return f"""
with asked as (select distinct item_id, {cut} as term from benchmark),
spots as (select doc_id, {cut} as term from documents),
lengths as (select doc_id, count(*) as n from spots group by doc_id),
totals as (select count(*) as docs, sum(n)::bigint as total from lengths),
counts as (select doc_id, term, count(*) as tf from spots where term in (select term from asked) group by all),
weights as (
    select term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::bigint as w
    from counts, totals group by term, docs
),
gains as (
    select doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * docs) // total)))) as gain
    from counts join lengths using (doc_id) join weights using (term), totals
),
scored as (
    select item_id, doc_id, sum(gain)::bigint as score from asked join gains using (term)
    group by all having sum(gain) > 0
),
ranked as (
    select item_id, row_number() over (partition by item_id order by score desc, doc_id) as rank, doc_id, score from scored
)
select item_id, rank::int as rank, doc_id, score from ranked where rank <= 10
"""
