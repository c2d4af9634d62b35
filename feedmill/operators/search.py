"""Keyword search over the corpus: one query, or a table of queries in one job."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import datetime
from heapq import heappush, heapreplace

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedmill.functions.columns import cutoff, matches, prefixed

# Bounds of one list of queries sent to the executors; more queries take more passes.
SHARD_QUERIES = 100_000
SHARD_CHARS = 16_000_000
# Hits (key and query, no texts) that may be broadcast to fetch their rows; more are joined by a shuffle.
LATE_ROWS = 1_000_000
# Dates that a task keeps to tell which hits cannot be among the newest; lists that would need more are not thinned.
HELD_DATES = 2_000_000
OLDEST = -(1 << 63)


def recent(
    df: DataFrame, as_of: datetime | str, days: int = 30, columns: Sequence[str] | None = None, date_col: str = "date"
) -> DataFrame:
    """Articles of the last ``days``; a null date never matches. Filter and columns reach the scan."""
    hit = df.where(F.col(date_col) >= cutoff(df, date_col, as_of, days))
    return hit.select(*columns) if columns else hit


def mentions(query: str, *columns: str) -> Column:
    """Literal, case-insensitive containment in any of the columns."""
    term = F.lower(F.lit(query))
    found = F.lit(False)
    for name in columns:
        found = found | F.coalesce(F.lower(F.col(name)).contains(term), F.lit(False))
    return found


def in_sources(df: DataFrame, sources: Sequence[str] | str | DataFrame | None, col: str = "source") -> DataFrame:
    """Optional source filter: a list, a comma-separated string, or a table of names."""
    if sources is None or (not isinstance(sources, DataFrame) and not sources):
        return df
    if isinstance(sources, DataFrame):
        return df.join(sources.select(F.col(sources.columns[0]).alias(col)).distinct(), col, "left_semi")
    names = sources.split(",") if isinstance(sources, str) else list(sources)
    return df.where(F.col(col).isin(names))


def newest_k(df: DataFrame, k: int, date_col: str = "date", tie: str = "ingest_seq") -> DataFrame:
    return df.orderBy(F.col(date_col).desc_nulls_last(), F.col(tie)).limit(k)


def search(
    df: DataFrame,
    query: str,
    as_of: datetime | str,
    days: int = 7,
    sources: Sequence[str] | str | DataFrame | None = None,
    limit: int | None = 20,
    date_col: str = "date",
    tie: str = "ingest_seq",
) -> DataFrame:
    """Newest articles of the last ``days`` that mention ``query`` in title or body."""
    if not query:
        return df.limit(0)
    hits = in_sources(recent(df, as_of, days, date_col=date_col), sources).where(mentions(query, "title", "body"))
    return hits if limit is None else newest_k(hits, limit, date_col, tie)


def search_widening(
    df: DataFrame,
    query: str,
    as_of: datetime | str,
    tiers: Sequence[int] = (1, 7, 30),
    limit: int = 20,
    date_col: str = "date",
    tie: str = "ingest_seq",
) -> DataFrame:
    """Search the shortest look-back that has any match; one scan for all tiers.

    The matches of a shorter look-back lead the newest-first list of a longer one. So the newest
    ``limit`` matches of the longest look-back hold the answer, and the newest row says which
    tier it is. The window below sees at most ``limit`` rows.
    """
    tiers = sorted(tiers)
    top = search(df, query, as_of, tiers[-1], limit=limit, date_col=date_col, tie=tie)
    tier = F.lit(tiers[-1])
    for days in reversed(tiers[:-1]):
        tier = F.when(F.col(date_col) >= cutoff(df, date_col, as_of, days), F.lit(days)).otherwise(tier)
    return (
        top.withColumn("tier", tier)
        .withColumn("_best", F.min("tier").over(Window.partitionBy()))
        .where(F.col("tier") == F.col("_best"))
        .drop("_best")
    )


def _shards(queries: DataFrame, col: str, shard_queries: int, shard_chars: int) -> Iterator[list[str]]:
    """Distinct non-empty queries as lists of bounded size.

    Sizes are measured first; a table within bounds is one list, a larger one is split by hash
    (the queries are distinct, so the parts are even).
    """
    wanted = queries.where(F.col(col) != "").select(F.col(col).alias("q")).distinct()
    count, chars = wanted.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("q")), F.lit(0))).first()
    parts = max(1, -(-count // shard_queries), -(-chars // shard_chars))
    for part in range(parts):
        mine = wanted if parts == 1 else wanted.where(F.pmod(F.xxhash64("q"), F.lit(parts)) == part)
        yield [row.q for row in mine.orderBy("q").collect()]


def _instant(df: DataFrame, date_col: str) -> Column:
    """A date as a number in the same order; null stays null, and values of other types are all alike."""
    kind, date = df.schema[date_col].dataType, F.col(f"`{date_col}`")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(date)
    if isinstance(kind, T.TimestampNTZType):  # not by way of the session's zone, whose hours may come twice
        since = date - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return (since.cast("decimal(20,6)") * 1_000_000).cast("long")
    return F.unix_date(date).cast("long") if isinstance(kind, T.DateType) else F.lit(0).cast("long")


def _tag_automaton(df: DataFrame, words: list[str], out: str, newest: tuple[int, str] | None = None) -> DataFrame:
    """All queries found in one pass over each text, so the cost does not grow with their number.

    With ``newest``, a number ``k`` and a date column, a task gives out no hit that is older than ``k`` others of its query that
    it has given out before: the newest ``k`` of a query are all there, and few besides.
    """
    spark = df.sparkSession
    # Lower-case with Spark, as the texts are.
    pairs = spark.createDataFrame([(w,) for w in words], "q string").select("q", F.lower("q").alias("low"))
    shipped = spark.sparkContext.broadcast([(row.low, row.q) for row in pairs.collect()])

    k, date_col = newest or (0, "")
    if k * len(words) > HELD_DATES:
        k = 0

    def find(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        spellings: dict[str, list[str]] = {}
        for low, query in shipped.value:
            spellings.setdefault(low, []).append(query)
        machine = ahocorasick.Automaton()
        for low, names in spellings.items():
            machine.add_word(low, names)
        machine.make_automaton()
        kept: dict[str, list[int]] = {}  # by query, a heap of the dates of its newest hits

        def new(query: str, date: int) -> bool:
            dates = kept.setdefault(query, [])
            if len(dates) < k:
                heappush(dates, date)
            elif date > dates[0]:
                heapreplace(dates, date)
            else:
                return date == dates[0]
            return True

        for titles, bodies, dates in batches:
            hits = (
                {q for text in pair if text for _, names in machine.iter(text) for q in names}
                for pair in zip(titles, bodies)
            )
            yield pd.Series([[q for q in found if not k or new(q, date)] for found, date in zip(hits, dates.tolist())])

    finder = F.pandas_udf(find, "array<string>")
    date = F.coalesce(_instant(df, date_col), F.lit(OLDEST)) if k else F.lit(0)
    found = finder(F.lower("title"), F.lower("body"), date.cast("long"))
    return df.select(*[c for c in df.columns if c != out], F.explode(found).alias(out))


def _tag_all(
    df: DataFrame,
    queries: DataFrame,
    query_col: str,
    out: str,
    shard_queries: int,
    shard_chars: int,
    newest: tuple[int, str] | None = None,
) -> tuple[DataFrame, int]:
    """``tag_matches``, and the number of distinct queries; ``newest`` as for ``_tag_automaton``."""
    tagged, total = None, 0
    for words in _shards(queries, query_col, shard_queries, shard_chars):
        if not words:
            continue
        total += len(words)
        part = _tag_automaton(df, words, out, newest)
        tagged = part if tagged is None else tagged.unionByName(part)
    if tagged is None:
        names = [c for c in df.columns if c != out]
        tagged = df.limit(0).select(*names, F.lit("").alias(out))
    return tagged, total


def tag_matches(
    df: DataFrame,
    queries: DataFrame,
    query_col: str = "query",
    out: str = "query",
    shard_queries: int = SHARD_QUERIES,
    shard_chars: int = SHARD_CHARS,
) -> DataFrame:
    """One row per article and query it mentions, with the query in ``out``.

    Articles are never shuffled or joined for this: every list, short or long, goes through a
    multi-pattern automaton. A list beyond the bounds that keep the automaton small takes another pass.
    """
    return _tag_all(df, queries, query_col, out, shard_queries, shard_chars)[0]


def top_per_query(
    df: DataFrame, k: int, query_col: str = "query", date_col: str = "date", tie: str = "ingest_seq"
) -> DataFrame:
    """Newest ``k`` rows per query. Spark keeps only k per query and task before the shuffle."""
    newest = Window.partitionBy(query_col).orderBy(F.col(date_col).desc_nulls_last(), F.col(tie))
    return df.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") <= k).drop("_rank")


def fetch_rows(df: DataFrame, hits: DataFrame, key: Sequence[str], out: str, at_most: int) -> DataFrame:
    """The rows of ``df`` named by ``hits`` (``key`` and ``out``), one for each hit.

    There are ``at_most`` hits. Up to ``LATE_ROWS`` they go to where the rows are, so no text is shuffled.
    """
    wanted = prefixed(hits.select(*key, out), "_h_")
    near = F.broadcast(wanted) if at_most <= LATE_ROWS else wanted
    columns = [F.col(f"`{c}`") for c in df.columns if c != out]
    return df.join(near, matches(key, "_h_")).select(*columns, F.col(f"`_h_{out}`").alias(out))


def tag_newest(
    df: DataFrame,
    queries: DataFrame,
    k: int,
    query_col: str = "query",
    out: str = "query",
    date_col: str = "date",
    tie: str = "ingest_seq",
    key: Sequence[str] | None = None,
    shard_queries: int = SHARD_QUERIES,
    shard_chars: int = SHARD_CHARS,
) -> DataFrame:
    """The newest ``k`` articles for each query that they mention, with the query in ``out``.

    ``key`` names columns that together tell every article from every other. With it only key, date and tie of a
    hit are ranked, and titles and bodies are fetched for the first ``k`` alone; without it whole rows are ranked.
    """
    if key and out in key:
        raise ValueError(f"{out} holds the query and cannot be part of the key")
    if not key:
        tagged, _ = _tag_all(df, queries, query_col, out, shard_queries, shard_chars, (k, date_col))
        return top_per_query(tagged, k, out, date_col, tie)
    narrow = list(dict.fromkeys([*key, date_col, tie]))
    tagged, count = _tag_all(
        df.select(*dict.fromkeys([*narrow, "title", "body"])), queries, query_col, "_query", shard_queries, shard_chars, (k, date_col)
    )
    hits = top_per_query(tagged.select(*narrow, "_query"), k, "_query", date_col, tie)
    return fetch_rows(df, hits.withColumnRenamed("_query", out), key, out, k * count)


def search_many(
    df: DataFrame,
    queries: DataFrame,
    as_of: datetime | str,
    days: int = 7,
    k: int = 20,
    query_col: str = "query",
    date_col: str = "date",
    tie: str = "ingest_seq",
    key: Sequence[str] | None = None,
    **bounds: int,
) -> DataFrame:
    """The newest ``k`` matches for each query of a table; ``key`` as for ``tag_newest``."""
    window = recent(df, as_of, days, date_col=date_col)
    return tag_newest(window, queries, k, query_col, "query", date_col, tie, key, **bounds)


def present(df: DataFrame, date_col: str = "date", tie: str = "ingest_seq") -> DataFrame:
    """Display rows of an already limited result, numbered from 1, with the result count."""
    shown = Window.partitionBy().orderBy(F.col(date_col).desc_nulls_last(), F.col(tie))
    stamp = F.date_format(F.col(date_col), "yyyy-MM-dd HH:mm")
    return df.select(
        F.row_number().over(shown).cast("long").alias("position"),
        F.coalesce("title", F.lit("No title")).alias("title"),
        F.coalesce("source", F.lit("Unknown source")).alias("source"),
        F.coalesce(stamp, F.lit("Unknown date")).alias("date"),
        F.coalesce("url", F.lit("No URL")).alias("url"),
        F.count(F.lit(1)).over(Window.partitionBy()).alias("results"),
    )
