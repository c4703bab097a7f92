import random

import numpy as np
import pytest

from cellweave.llm import leakage
from tests.helpers import rows

DOC = "doc_id long, text string, id int, h string"
ITEM = "item_id long, item_text string, before int"


def run(spark, docs, items, **options):
    d = spark.createDataFrame([(*x, 1, "x") for x in docs], DOC).repartition(3)
    i = spark.createDataFrame([(*x, 1) for x in items], ITEM)
    return leakage.shared_passages(d, i, **options)


def brute(docs, items, n):
    grams = lambda w: {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
    sides = [[(k, grams(f(t or ""))) for k, t in rows_] for rows_, f in ((docs, leakage.cue_words), (items, leakage.item_words))]
    return {(d, i) for d, a in sides[0] for i, b in sides[1] if a & b}


@pytest.mark.parametrize("max_words", [1, 1 << 20])
@pytest.mark.parametrize("shared,gram", [(13, 7), (5, 2), (4, 4)])
def test_against_brute_force(spark, shared, gram, max_words):
    rnd = random.Random(7)
    words = [f"w{i}" for i in range(12)]
    items = [(i, " ".join(rnd.choices(words, k=rnd.randint(3, 30)))) for i in range(30)]
    docs = []
    for d in range(60):
        part = rnd.choice(items)[1].split()
        at = rnd.randint(0, len(part) - 1)
        docs.append((d, " ".join(rnd.choices(words, k=rnd.randint(0, 15)) + part[at : at + rnd.randint(1, 20)] + rnd.choices(words, k=rnd.randint(0, 15)))))
    docs += docs[:5] + [(100, None), (101, "")]
    items += [(50, None), (51, "")] + items[:3]
    assert rows(run(spark, docs, items, shared=shared, gram=gram, max_filter_words=max_words), "doc_id", "item_id") == brute(docs, items, shared)


def test_passage_across_cues(spark):
    item = "One two three four five six seven eight nine ten eleven twelve thirteen"
    doc = "\ufeff1\r\n00:00:01,000 --> 00:00:02,000\r\n<i>One two three</i> {b}four\r\n\r\n2\r\n00:00:03.000 --> 0l:00:04.000\r\n[door] five (noise) six ѕeven\r\nEIGHT ni\u00adne ten eleven\r\n\r\n3\r\n00:05.000\u00a0--> 00:06.000\r\ntwelve thirteen\r\n"
    assert rows(run(spark, [(1, doc)], [(1, item), (2, item.rsplit(" ", 1)[0])])) == {(1, 1, 13, 0, 0)}


def test_digits_that_are_text_stay():
    assert leakage.cue_words("1\n00:01 --> 00:02\nin\n1984\nit was\n\n2\n00:03 --> 00:04\nWEBVTT here") == ["in", "1984", "it", "was"]
    assert leakage.cue_words("WEBVTT\n\n1\n00:01 --> 00:02\na < b\n> c") == ["a", "b", "c"]


def test_empty_tables(spark):
    item = [(1, "a b c d e f g h i j k l m")]
    assert run(spark, [], item).count() == 0
    assert run(spark, item, []).count() == 0


def test_a_passage_quoted_by_very_many(spark):
    text = " ".join(f"q{i}" for i in range(15))
    found = run(spark, [(d, f"x{d} {text} y{d}") for d in range(3000)], [(1, text), (2, text + " z")])
    assert found.count() == 6000


def test_long_document(spark):
    words = [f"u{i % 997}" for i in range(200_000)]
    words[150_000:150_013] = [f"k{i}" for i in range(13)]
    assert rows(run(spark, [(1, " ".join(words))], [(1, " ".join(f"k{i}" for i in range(13)))])) == {(1, 1, 13, 150_000, 0)}


def test_every_shared_span_keeps_a_common_fingerprint():
    rnd = np.random.default_rng(1)
    for _ in range(100):
        a, b = (rnd.integers(0, 2**63, 60).astype(np.uint64) for _ in range(2))
        i, j = rnd.integers(0, 47, 2)
        b[j : j + 13] = a[i : i + 13]
        one, two = (set(leakage.winnow(x, np.array([60]), 7, 7)[1].tolist()) for x in (a, b))
        assert one & two


def longest_span(a, b):
    """(words, first in a, first in b) of the longest common run, by the table of common endings."""
    best, ends = (0, 0, 0), [0] * (len(b) + 1)
    for i, x in enumerate(a):
        new = [0] * (len(b) + 1)
        for j, y in enumerate(b):
            if x == y:
                new[j + 1] = ends[j] + 1
                best = max(best, (new[j + 1], -(i + 1 - new[j + 1]), -(j + 1 - new[j + 1])))
        ends = new
    return best[0], -best[1], -best[2]


def test_whole_spans(spark):
    rnd = random.Random(11)
    long = [f"w{rnd.randint(0, 400)}" for _ in range(200)]
    docs = [(1, " ".join(["x"] * 7 + long + ["y"] * 9)), (2, " ".join(long[50:] + ["z"] + long[:49]))]
    docs += [(10 + i, " ".join([f"n{i}"] * rnd.randint(0, 5) + long[(a := rnd.randint(0, 150)) : a + rnd.randint(13, 60)] + ["m"] + long[:20])) for i in range(30)]
    found = {(r.doc_id, r.item_id): r for r in run(spark, docs, [(1, " ".join(long))]).collect()}
    assert found[1, 1].words == 200 and (found[1, 1].doc_from, found[1, 1].item_from) == (7, 0)
    for d, text in docs:
        words, at, of = longest_span(text.split(), long)
        row = found[d, 1]
        assert row.words == words and text.split()[row.doc_from : row.doc_from + words] == long[row.item_from : row.item_from + words]


def test_letters_of_rarer_scripts(spark):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen"
    doc = item.replace("one", "\u2c9fne").replace("three", "th\u1d26ee").replace("ten", "te\u0578")  # Coptic, Greek and Armenian letters
    assert rows(run(spark, [(1, doc)], [(1, item)]), "doc_id", "item_id", "words") == {(1, 1, 13)}
