"""Labels of templates against a plain search of every place, and what is no license."""

from __future__ import annotations

import random

import pytest

from lamina.llm import licenses
from lamina.llm.words import find_words

NO_LICENSE = "licensed under a under cc b cc by c by nc d nc 4 e 4 0"


def plain_scores(text: str | None) -> dict[str, float]:
    """The best share of each label that matches, over every diagonal of every template."""
    words, best = licenses.words_of(text or ""), {}
    for label, template, base in [*((a, b, True) for a, b in licenses.PHRASES), *((a, b, False) for a, b in licenses.TEMPLATES)]:
        own = licenses.words_of(template)
        k = 3 if not base and len(own) >= 12 else 2
        voting = [a for a in range(len(own) - k + 1) if base or not set(own[a : a + k]) <= licenses.COMMON]
        for d in range(-len(own), len(words)):
            last, n = -1, 0
            for a in voting:
                places = [a + d + e for e in range(1 if base else 3) if a + d + e >= 0 and words[a + d + e : a + d + e + k] == own[a : a + k]]
                if places:
                    n += places[0] > last
                    last = max(last, places[0])
            share = n / len(voting)
            on_diagonal = any(words[a + d : a + d + k] == own[a : a + k] for a in voting if a + d >= 0)
            if on_diagonal and share >= (1 if base else 0.85):
                best[label] = max(best.get(label, 0.0), share)
    return best


def changed(rng: random.Random, text: str) -> str:
    words = text.split()
    for _ in range(rng.randint(0, 3)):
        at = rng.randrange(len(words))
        words[at : at + rng.randint(0, 1)] = [rng.choice(("x", "the", "license", "under"))] * rng.randint(0, 1)
        words = words or ["x"]
    return " ".join(words)


def test_labels_equal_a_plain_search(spark):
    rng = random.Random(1)
    texts = [t for _, t in (*licenses.TEMPLATES, *licenses.PHRASES)]
    docs = [changed(rng, rng.choice(texts)) + rng.choice((" ", ", and ", " x y z ")) + changed(rng, rng.choice(texts)) for _ in range(250)]
    docs += [NO_LICENSE, "", None, "mit", "license apache license " * 30, " ".join(reversed(texts[0].split())), texts[3] + " " + texts[3], "a" * 5000]
    got = licenses.scan(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(4)).collect()
    several = 0
    for r in got:
        want = plain_scores(docs[r.doc_id])
        assert r.labels == ",".join(sorted(want)) and r.score == pytest.approx(max(want.values(), default=0.0)), docs[r.doc_id]
        several += len(want) > 1
    assert len(got) == len(docs) and several > 50


def test_words_in_between_make_no_license(spark):
    r = licenses.scan(spark.createDataFrame([(1, NO_LICENSE, 1, 2)], "doc_id long, text string, template int, hash int")).first()
    assert (r.labels, r.n_base) == ("cc-by", 1)  # the phrase of two words stands there


def test_hashes_roll_over_texts():
    import pyarrow as pa

    places, hashes = licenses.rolled(find_words(pa.array(["a b c", None, "b c", "c"])), 2)
    assert places.tolist() == [0, 1, 3] and hashes[1] == hashes[2] != hashes[0]
    assert licenses.rolled(find_words(pa.array(["a b"])), 3)[1].tolist() == []
