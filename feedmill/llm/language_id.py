"""Language identification by rank-order profiles.

A profile is the list of the most frequent character n-grams (one to three letters, words padded with a
blank), most frequent first. A document's own profile is compared with each language's by the
out-of-place distance: the sum over its n-grams of how far apart the two ranks are, an n-gram that the
language's profile lacks counting as out of place by a whole profile length.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedmill.functions.columns import quoted
from feedmill.llm.frames import DOC, bounded_batches, packed, texts_of

PROFILE = 300
MAX_LANGUAGES = 2_000
UNKNOWN = "und"
MERGE_ROWS = 500_000


@cache
def letters() -> np.ndarray:
    """Lower-cased code point of every letter, 0 for all other code points."""
    out = np.zeros(0x110000, np.uint64)
    for cp in range(0x110000):
        ch = chr(cp)
        if unicodedata.category(ch)[0] == "L":
            low = ch.lower()
            out[cp] = ord(low) if len(low) == 1 else cp
    return out


def ngrams(text: bytes) -> np.ndarray:
    """Codes of all n-grams of a UTF-8 text, in no order; empty if it has no letter."""
    points = letters()[np.frombuffer(text.decode().encode("utf-32-le"), "<u4")]
    inside = points != 0
    if not inside.any():
        return np.zeros(0, np.uint64)
    before = np.concatenate([[False], inside[:-1]])
    a = np.concatenate([[0], points[inside | before], [0]]).astype(np.uint64)  # words with one blank between
    one, shift, tag = a[a != 0], np.uint64(18), np.uint64(1 << 60)
    two = a[:-1] << shift | a[1:]
    two = two[two != 0]
    middle = a[1:-1] != 0
    three = (a[:-2] << np.uint64(36) | a[1:-1] << shift | a[2:])[middle]
    return np.concatenate([one, two + tag, three + tag + tag])


def profile_of(text: bytes, size: int = PROFILE) -> np.ndarray:
    """A text's most frequent n-grams in order of rank; ties go to the smaller code."""
    codes, counts = np.unique(ngrams(text), return_counts=True)
    return codes[np.argsort(-counts, kind="stable")[:size]]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """N-gram counts by language within a task."""
    waiting: dict[str, list[np.ndarray]] = {}
    total = 0

    def emit() -> Iterator[pa.RecordBatch]:
        for lang, parts in waiting.items():
            codes, counts = np.unique(np.concatenate(parts), return_counts=True)
            for at in range(0, codes.size, 100_000):
                c, n = codes[at : at + 100_000].view(np.int64), counts[at : at + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * c.size, pa.string()), pa.array(c), pa.array(n)], ["lang", "gram", "n"]
                )
        waiting.clear()

    for batch in batches:
        for text, lang in zip(texts_of(batch.column(0)), batch.column(1).to_pylist()):
            grams = ngrams(text)
            waiting.setdefault(lang, []).append(grams)
            total += grams.size
            if total > MERGE_ROWS:
                yield from emit()
                total = 0
    yield from emit()


@dataclass(frozen=True)
class Profiles:
    """Ranks of every profile's n-grams: one row per language, ``size`` where an n-gram is missing."""

    languages: tuple[str, ...]
    grams: np.ndarray
    ranks: np.ndarray
    size: int

    def predict(self, text: bytes) -> tuple[str, float]:
        """The nearest language and a score: 1 for an identical profile, 0 if nothing is shared.

        A text without letters is ``und`` with score 0; of equally near languages the first by name wins.
        """
        mine = profile_of(text, self.size)
        if not mine.size or not self.languages:
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(self.grams, mine), max(0, self.grams.size - 1))
        known = self.grams[at] == mine
        ranks = self.ranks[:, at[known]]
        apart = np.where(ranks == self.size, self.size, np.abs(ranks - np.flatnonzero(known)))
        out = apart.sum(axis=1) + self.size * int((~known).sum())
        best = int(np.argmin(out))
        return self.languages[best], float(1.0 - out[best] / (self.size * mine.size))


def learn_profiles(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    size: int = PROFILE,
    max_languages: int = MAX_LANGUAGES,
) -> Profiles:
    """Profiles of all languages named in ``docs``, from all of its rows with a text and a language.

    Only ``size`` n-grams per language reach the driver; more than ``max_languages`` languages are an error.
    """
    known = docs.select(quoted(text_col).cast("string").alias("text"), quoted(lang_col).cast("string").alias("lang"))
    counts = known.where("text is not null and lang is not null").mapInArrow(_count, "lang string, gram long, n long")
    ranked = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")).withColumn(
        "rank", F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    )
    top = ranked.where(F.col("rank") <= size).limit(size * max_languages + 1).collect()
    if len(top) > size * max_languages or len({r["lang"] for r in top}) > max_languages:
        raise ValueError(f"more than {max_languages} languages; raise max_languages if they are real")
    languages = tuple(sorted({r["lang"] for r in top}))
    grams = np.unique(np.array([r["gram"] for r in top], np.int64)).view(np.uint64)
    ranks = np.full((len(languages), grams.size), size, np.int64)
    row = {lang: i for i, lang in enumerate(languages)}
    for r in top:
        ranks[row[r["lang"]], np.searchsorted(grams, np.uint64(r["gram"]))] = r["rank"] - 1
    return Profiles(languages, grams, ranks, size)


def identify(text: Column, profiles: Profiles, spark) -> Column:
    """Struct ``(lang_pred, score)`` of a text; the profiles are broadcast (at most 2,000 languages by 300 n-grams)."""
    shared = spark.sparkContext.broadcast(profiles)

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def predict(values: pa.Array) -> pa.Array:
        found = [shared.value.predict(v) for v in texts_of(values)]
        return pa.StructArray.from_arrays(
            [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
            ["lang_pred", "score"],
        )

    return predict(text)


def detect_languages(docs: DataFrame, training: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Every row of ``docs`` as struct ``doc`` with lang_pred and score, by profiles learnt from ``training``.

    Null and empty texts, and texts without any letter, are ``und`` with score 0. Without any labelled
    training text every document is ``und``.
    """
    bounded_batches(docs.sparkSession)
    profiles = learn_profiles(training, text_col, lang_col)
    found = identify(F.col(DOC).getField(text_col).cast("string"), profiles, docs.sparkSession)
    return docs.select(packed(docs)).withColumn("found", found).select(DOC, "found.lang_pred", "found.score")
