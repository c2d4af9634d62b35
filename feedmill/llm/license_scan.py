"""License notices in whole texts, by an exact set-similarity join of text blocks with templates.

A text is cut into overlapping blocks of words: for templates of up to ``w`` words (``w`` a power of two) block k
holds words k*w to (k+2)*w, so every run of ``w`` words lies whole in some block. A block matches a template when it
contains at least the template's threshold of the template's distinct words.

Words are ordered by how often they occur in all texts, rarest first. A match must share ``need`` words, so it shares
one of the first ``size - need + 1`` words of the template (prefix filter); a block with fewer than ``need`` words of
any template is no match (length filter); and a shared word so late in either order that fewer than ``need``
words are left proves nothing (positional filter). What passes is verified on the whole sets. The filters
only skip what cannot match, so the result does not depend on the order.

Texts are never shuffled: the templates, of checked size, go to the texts, in several passes if they are many.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.llm import terms
from feedmill.llm.frames import DOC, bounded_batches, packed, texts_of

THRESHOLD = 0.8
#: Notices of fewer distinct words must be contained whole: one word less may be another license.
SHORT_WORDS = 16
LEAST_WIDTH = 8
#: Words of the templates that go to the executors at a time.
WAVE_WORDS = 1_000_000
MATCH = "struct<label:string,template:int,first_word:long,n_words:int,overlap:int,containment:double,covered:boolean>"
FOUND = f"struct<n_words:long,places:array<struct<label:string,at:long>>,matches:array<{MATCH}>>"

#: Phrases whose places are counted, with their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: Labels and the publicly known wording of notices.
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction, including without limitation the rights to "
        "use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions",
    ),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    (
        "apache",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at",
    ),
    (
        "apache",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
        "See the License for the specific language governing permissions and limitations under the License",
    ),
    ("gpl", "licensed under the GNU General Public License"),
    ("gpl", "licensed under the GNU GPL"),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version",
    ),
    ("lgpl", "licensed under the GNU Lesser General Public License"),
    ("agpl", "licensed under the GNU Affero General Public License"),
    ("bsd", "licensed under the BSD License"),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies",
    ),
    ("mpl", "licensed under the Mozilla Public License"),
    (
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at",
    ),
    ("epl", "licensed under the Eclipse Public License"),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means",
    ),
    ("cc0", "licensed under CC0"),
    ("cc-by", "licensed under CC BY 4.0"),
    ("cc-by-nc", "licensed under CC BY-NC 4.0"),
    ("cc-by-nd", "licensed under CC BY-ND 4.0"),
    ("cc-by-sa", "licensed under CC BY-SA 4.0"),
    ("cc-by-nc-sa", "licensed under CC BY-NC-SA 4.0"),
    ("cc-by-nc-nd", "licensed under CC BY-NC-ND 4.0"),
    ("cc", "licensed under a Creative Commons License"),
)


@dataclass(frozen=True)
class Template:
    """A template as a set: ``need`` of its distinct words make a match in blocks of twice ``width`` words."""

    number: int
    label: str
    words: tuple[bytes, ...]
    need: int
    width: int


def as_templates(texts: Sequence[tuple[str, str]], threshold: float = THRESHOLD) -> list[Template]:
    """Templates as sets; one without a word can match nothing and is an error."""
    out = []
    for number, (label, text) in enumerate(texts):
        found = [w for part in terms.words(text.encode()) for w in part]
        distinct = tuple(sorted(set(found)))
        if not distinct:
            raise ValueError(f"template {number} ({label}) has no word")
        part = 1.0 if len(distinct) < SHORT_WORDS else threshold
        width = max(LEAST_WIDTH, 1 << (len(found) - 1).bit_length())
        out.append(Template(number, label, distinct, math.ceil(round(part * len(distinct), 9)), width))
    return out


def waves(templates: Sequence[Template], most: int = WAVE_WORDS) -> Iterator[list[Template]]:
    """Templates in lists of at most ``most`` words, a larger one alone."""
    wave, size = [], 0
    for template in templates:
        if wave and size + len(template.words) > most:
            yield wave
            wave, size = [], 0
        wave.append(template)
        size += len(template.words)
    if wave:
        yield wave


def frequencies(docs: DataFrame, vocabulary: Sequence[bytes], text_col: str = "text") -> dict[bytes, int]:
    """How often each word of a bounded vocabulary occurs in all texts; only these counts come to the driver."""
    known = {w: n for n, w in enumerate(vocabulary)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(known), np.int64)
        for batch in batches:
            for text in texts_of(batch["text"]):
                met = terms.numbers(text, known)
                total += np.bincount(met[met >= 0], minlength=len(known))
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"word": pa.array(met.astype(np.int32)), "n": pa.array(total[met])})

    parts = docs.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(count, "word int, n long")
    met = {vocabulary[r["word"]]: r["n"] for r in parts.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    return {w: met.get(w, 0) for w in vocabulary}


class BlockJoin:
    """The join of the blocks of one text with templates, through an index of their prefixes."""

    def __init__(self, templates: Sequence[Template], order: Sequence[bytes], phrases: Sequence[tuple[str, str]] = ()):
        """``order`` is every word of templates and phrases, rarest first: a word's number is its rank."""
        self.rank = {w: n for n, w in enumerate(order)}
        self.templates = {t.number: t for t in templates}
        self.sets = {t.number: np.sort(np.array([self.rank[w] for w in t.words], np.int32)) for t in templates}
        self.larger = {
            t.number: {o.number for o in templates if set(t.words) < set(o.words)} for t in templates
        }
        self.phrases = [([self.rank[w.encode()] for w in phrase.split()], label) for phrase, label in phrases]
        self.prefix: dict[int, dict[int, list[tuple[int, int]]]] = {}
        self.starts: dict[int, np.ndarray] = {}
        self.member: dict[int, np.ndarray] = {}
        for t in templates:
            words = self.sets[t.number]
            # One place more than there are words: number -1, an unknown word, reads as the last, false.
            index = self.prefix.setdefault(t.width, {})
            starts = self.starts.setdefault(t.width, np.zeros(len(order) + 1, bool))
            member = self.member.setdefault(t.width, np.zeros(len(order) + 1, bool))
            for i, word in enumerate(words[: words.size - t.need + 1].tolist()):
                index.setdefault(word, []).append((t.number, i))
                starts[word] = True
            member[words] = True

    def places(self, words: np.ndarray) -> list[dict]:
        """Where the words of a phrase stand one after the other."""
        out = []
        for phrase, label in self.phrases:
            span = max(0, words.size - len(phrase) + 1)
            here = np.ones(span, bool)
            for i, word in enumerate(phrase):
                here &= words[i : i + span] == word
            out += [{"label": label, "at": at} for at in np.flatnonzero(here).tolist()]
        return out

    def candidates(self, block: np.ndarray, width: int) -> set[int]:
        """Templates that the filters let pass for a block, given as the sorted ranks of its words of this width."""
        found, index = set(), self.prefix[width]
        for j, word in enumerate(block.tolist()):
            for number, i in index.get(word, ()):
                need = self.templates[number].need
                if min(self.sets[number].size - i, block.size - j) >= need:
                    found.add(number)
        return found

    def matches(self, words: np.ndarray) -> list[dict]:
        """Every pair of a block and a template in it, by block and template."""
        out = []
        for width, starts in self.starts.items():
            last = max(0, -(-words.size // width) - 2)
            near = np.flatnonzero(starts[words]) // width
            for k in np.unique(np.clip(np.concatenate([near, near - 1]), 0, last)).tolist():
                span = words[k * width : (k + 2) * width]
                block = np.unique(span[self.member[width][span]])
                for number in self.candidates(block, width):
                    overlap = int(np.isin(block, self.sets[number], assume_unique=True).sum())
                    if overlap >= self.templates[number].need:
                        out.append(
                            {
                                "label": self.templates[number].label,
                                "template": number,
                                "first_word": k * width,
                                "n_words": span.size,
                                "overlap": overlap,
                                "containment": overlap / self.sets[number].size,
                            }
                        )
        for m in out:
            m["covered"] = any(
                o["template"] in self.larger[m["template"]]
                and o["first_word"] < m["first_word"] + m["n_words"]
                and m["first_word"] < o["first_word"] + o["n_words"]
                for o in out
            )
        return sorted(out, key=lambda m: (m["template"], m["first_word"]))

    def scan(self, text: bytes) -> dict:
        words = terms.numbers(text, self.rank)
        return {"n_words": words.size, "places": self.places(words), "matches": self.matches(words)}


def _scanner(join: BlockJoin):
    kind = pa.struct(
        [
            ("n_words", pa.int64()),
            ("places", pa.list_(pa.struct([("label", pa.string()), ("at", pa.int64())]))),
            (
                "matches",
                pa.list_(
                    pa.struct(
                        [
                            ("label", pa.string()),
                            ("template", pa.int32()),
                            ("first_word", pa.int64()),
                            ("n_words", pa.int32()),
                            ("overlap", pa.int32()),
                            ("containment", pa.float64()),
                            ("covered", pa.bool_()),
                        ]
                    )
                ),
            ),
        ]
    )

    @F.arrow_udf(FOUND)
    def scan(values: pa.Array) -> pa.Array:
        return pa.array([join.scan(text) for text in texts_of(values)], kind)

    return scan


def scan_licenses(
    docs: DataFrame,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    phrases: Sequence[tuple[str, str]] = PHRASES,
    text_col: str = "text",
    threshold: float = THRESHOLD,
    wave_words: int = WAVE_WORDS,
) -> DataFrame:
    """Every input row as struct ``doc``, with ``n_words``, ``places`` of phrases and ``matches`` of templates.

    ``templates`` and ``phrases`` are (label, text) and (phrase, label). A match is a block (its first word and how
    many words it has) with the template it contains, the number of distinct words they share, and that number as
    part of the template; it is ``covered`` if a template of the same pass with all these words and more matches a block that
    overlaps this one. A null or empty text has no words, places or matches; repeated rows are scanned
    each by itself, and an empty table gives an empty result.
    """
    bounded_batches(docs.sparkSession)
    text = F.col(DOC).getField(text_col)
    found = docs.select(packed(docs))
    parts: list[Column] = []
    for n, wave in enumerate(waves(as_templates(templates, threshold), wave_words)):
        own = phrases if n == 0 else ()
        vocabulary = sorted({w for t in wave for w in t.words} | {w.encode() for p, _ in own for w in p.split()})
        often = frequencies(docs, vocabulary, text_col)
        join = BlockJoin(wave, sorted(vocabulary, key=lambda w: (often[w], w)), own)
        found = found.withColumn(f"wave{n}", _scanner(join)(text))
        parts.append(F.col(f"wave{n}"))
    if not parts:
        raise ValueError("no template to look for")
    return found.select(
        DOC,
        parts[0]["n_words"].alias("n_words"),
        parts[0]["places"].alias("places"),
        F.concat(*[p["matches"] for p in parts]).alias("matches"),
    )


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Places and labels of each document: labels distinct, sorted and joined by commas, empty if none.

    A covered match gives no label: a notice that names BY-NC also has all words of one that names BY.
    ``score`` is the greatest part of a template that a block contains, 1 where a phrase stands, else 0.
    """
    at = F.transform("places", lambda p: p["at"])
    base = F.transform("places", lambda p: p["label"])
    own = F.transform(F.filter("matches", lambda m: ~m["covered"]), lambda m: m["label"])
    best = F.coalesce(F.array_max(F.transform("matches", lambda m: m["containment"])), F.lit(0.0))
    return found.select(
        F.col(DOC).getField(id_col).alias(id_col),
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(at).alias("first_word"),
        F.array_max(at).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base, own))), ",").alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(best).alias("score"),
    )


def oracle_sql() -> str:
    """The same rows by plain SQL over all blocks and templates, without order or filters."""
    templates = as_templates(TEMPLATES)

    def text(word: bytes) -> str:
        return "'" + word.decode().replace("'", "''") + "'"

    words = ", ".join(
        f"({t.number}, '{t.label}', {t.width}, {t.need}, {len(t.words)}, {text(w)})" for t in templates for w in t.words
    )
    places = " union all ".join(
        f"select doc_id, '{label}' as label, unnest(list_filter(range(len(w)), lambda i: "
        + " and ".join(f"w[i + {n + 1}] = '{word}'" for n, word in enumerate(phrase.split()))
        + ")) as pos from words"
        for phrase, label in PHRASES
    )
    return f"""
with words as (
    select doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
    from documents
),
template(number, label, width, need, size, word) as (values {words}),
spots as (select doc_id, len(w) as n, unnest(w) as word, unnest(range(len(w))) as pos from words),
met as (
    select s.doc_id, s.n, s.pos, t.* from spots s join template t using (word)
),
hits as (
    select number, label, width, need, size, n, doc_id, k, count(distinct word) as overlap from (
        select *, unnest([pos // width, pos // width - 1]) as k from met
    ) where k >= 0 and k < greatest(1, (n + width - 1) // width - 1)
    group by all having count(distinct word) >= need
),
larger(small, large) as (
    select a.number, b.number from template a join template b using (word)
    group by a.number, b.number, a.size, b.size having count(*) = a.size and b.size > a.size
),
blocks as (select *, k * width as first, least(n, (k + 2) * width) as past from hits),
shown as (
    select distinct doc_id, label from blocks a where not exists (
        select 1 from blocks b join larger on larger.large = b.number
        where larger.small = a.number and b.doc_id = a.doc_id and b.first < a.past and a.first < b.past
    )
),
places as ({places}),
base as (
    select doc_id, count(*) as n_base, min(pos) as first_word, max(pos) as last_word,
        string_agg(distinct label, ',' order by label) as base_labels
    from places group by doc_id
),
labels as (
    select doc_id, string_agg(distinct label, ',' order by label) as labels
    from (select doc_id, label from places union all select doc_id, label from shown) group by doc_id
),
best as (select doc_id, max(overlap / size) as score from hits group by doc_id)
select doc_id, len(w) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word,
    coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels,
    case when n_base > 0 then 1.0::double else coalesce(score, 0.0)::double end as score
from words left join base using (doc_id) left join labels using (doc_id) left join best using (doc_id)
"""
