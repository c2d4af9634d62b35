"""License notices against a brute force over all blocks and templates."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from feedmill.llm import license_scan as scan
from feedmill.llm import terms

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
SCHEMA = "doc_id long, text string, matches string, places string, n_words string, doc string"
MIT = scan.TEMPLATES[2][1]
APACHE = scan.TEMPLATES[4][1]


def words_of(text):
    return WORD.findall((text or "").translate(FOLD))


def table(spark, rows):
    """Documents with columns whose names clash with those of results."""
    return spark.createDataFrame([(i, t, "m", "p", "n", "d") for i, t in rows], SCHEMA).repartition(5)


def brute(text, templates=scan.TEMPLATES, threshold=scan.THRESHOLD):
    """Places of phrases, and (template, first word, words, shared words) of every block that matches."""
    words = words_of(text)
    places = [
        (label, at)
        for phrase, label in scan.PHRASES
        for at in range(len(words))
        if words[at : at + len(phrase.split())] == phrase.split()
    ]
    matches = []
    for number, (_, template) in enumerate(templates):
        wanted = words_of(template)
        size = len(set(wanted))
        width = scan.LEAST_WIDTH
        while width < len(wanted):
            width *= 2
        need = size if size < scan.SHORT_WORDS else threshold * size - 1e-9
        for first in range(0, max(1, len(words) - width), width):
            block = words[first : first + 2 * width]
            shared = len(set(block) & set(wanted))
            if shared and shared >= need:
                matches.append((number, first, len(block), shared))
    return places, matches


def found(df):
    return {
        r["doc"]["doc_id"]: (
            r["n_words"],
            [(p["label"], p["at"]) for p in r["places"]],
            [(m["template"], m["first_word"], m["n_words"], m["overlap"]) for m in r["matches"]],
        )
        for r in df.collect()
    }


def with_noise(rng, text, drop):
    """The words of a text with a part of them left out, in prose."""
    kept = [w for w in text.split() if rng.random() >= drop]
    prose = [rng.choice(["the", "of", "software", "any", "x1", "Émile", "use", "license"]) for _ in range(rng.randrange(200))]
    at = rng.randrange(len(prose) + 1)
    return rng.choice([" ", "\n", ", "]).join(prose[:at] + kept + prose[at:])


def random_texts(seed):
    rng = random.Random(seed)
    texts = [with_noise(rng, rng.choice(scan.TEMPLATES)[1], rng.choice([0, 0.1, 0.2, 0.25])) for _ in range(150)]
    return texts + [None, "", " ", "...", MIT, MIT.upper(), "MIT License, MIT license", "mit", "a" * 100_000]


@pytest.mark.parametrize("wave_words", [scan.WAVE_WORDS, 40])
def test_against_brute_force(spark, wave_words):
    texts = random_texts(3)
    got = found(scan.scan_licenses(table(spark, list(enumerate(texts))), wave_words=wave_words))
    hits = 0
    for i, text in enumerate(texts):
        places, matches = brute(text)
        assert got[i][0] == len(words_of(text))
        assert sorted(got[i][1]) == sorted(places)
        assert sorted(got[i][2]) == sorted(matches), text
        hits += len(matches)
    assert hits > 100


def test_result_does_not_depend_on_the_order(spark):
    templates = scan.as_templates(scan.TEMPLATES)
    vocabulary = sorted({w for t in templates for w in t.words})
    rng = random.Random(0)
    for seed in range(5):
        rng.shuffle(vocabulary)
        join = scan.BlockJoin(templates, vocabulary)
        for text in random_texts(seed)[:40]:
            got = [(m["template"], m["first_word"], m["n_words"], m["overlap"]) for m in join.scan((text or "").encode())["matches"]]
            assert got == sorted(brute(text)[1])


def test_filters_skip_but_never_lose():
    templates = scan.as_templates([("x", " ".join(f"w{i}" for i in range(20)))])
    join = scan.BlockJoin(templates, list(templates[0].words))
    assert len(join.prefix[32]) == 20 - 16 + 1  # any 16 shared words hold one of the rarest 5
    near = [f"w{i}" for i in range(4, 20)]
    assert [m["overlap"] for m in join.scan(" ".join(near).encode())["matches"]] == [16]
    assert not join.scan(" ".join(near[1:]).encode())["matches"]


def test_labels_of_given_notices(spark):
    rows = [
        (0, "Prose. Licensed under CC BY-NC 4.0."),
        (1, "Released under the MIT License. Under the Apache License"),
        (2, "This work is licensed under the GNU General Public License, version 3."),
        (3, "Released under the BSD license of the house"),
        (4, f"Foreword {MIT[:-30]}"),
        (5, "Licensed under the Mozilla License, Version 2.0"),
        (6, None),
        (7, "the license of the general public is not the mit's license"),
    ]
    got = {r["doc_id"]: r for r in scan.digest(scan.scan_licenses(table(spark, rows))).collect()}
    assert [got[i]["labels"] for i in range(8)] == ["cc-by-nc", "apache,mit", "gpl", "", "mit", "", "", ""]
    assert [got[i]["base_labels"] for i in range(8)] == ["", "apache,mit", "gpl", "", "", "", "", ""]
    assert [got[i]["score"] == 0 for i in range(8)] == [False, False, False, True, False, True, True, True]
    assert 0.8 <= got[4]["score"] <= 1 and got[0]["score"] == 1
    assert (got[1]["first_word"], got[1]["last_word"], got[1]["n_base"]) == (3, 7, 2)
    assert got[6]["first_word"] is None and got[6]["n_words"] == 0


def test_repeated_rows_null_ids_and_hot_text(spark):
    rows = [(1, APACHE)] * 300 + [(None, APACHE), (None, None), (2, "prose")]
    got = scan.digest(scan.scan_licenses(table(spark, rows))).groupBy("doc_id", "labels").count().collect()
    assert sorted((str(r["doc_id"]), r["labels"], r["count"]) for r in got) == [
        ("1", "apache", 300), ("2", "", 1), ("None", "", 1), ("None", "apache", 1),
    ]


def test_very_long_text(spark):
    text = "filler words here, " * 200_000 + MIT
    ((n, places, matches),) = found(scan.scan_licenses(table(spark, [(0, text)]))).values()
    assert n == 600_000 + len(words_of(MIT)) and not places
    assert {m[0] for m in matches} == {2}
    parts = list(terms.words(text.encode()))
    assert len(parts) > 2 and sum(map(len, parts)) == n


def test_empty_table_and_empty_template(spark):
    empty = table(spark, [(0, "x")]).where(F.lit(False))
    assert scan.digest(scan.scan_licenses(empty)).count() == 0
    with pytest.raises(ValueError):
        scan.as_templates([("none", " .,; ")])
    with pytest.raises(ValueError):
        scan.scan_licenses(empty, templates=())
