import collections
import random
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cellweave.llm import lookalike
from tests.helpers import rows

LETTERS = {p[1]: p[0] for p in lookalike.LOOKALIKES}
DOC = "doc_id long, text string, form string, own int"


def reference_form(text, letters=LETTERS):
    """Decompose, drop, replace one by one, compose."""
    plain = unicodedata.normalize("NFKD", text)
    kept = (" " if unicodedata.category(c) == "Zs" else letters.get(c, c) for c in plain if not lookalike.is_invisible(c))
    return unicodedata.normalize("NFC", "".join(kept))


SAME = ["café", "cafe\u0301", "саfе\u0301", "ｃａfé", "ca\u200bfé", "c\u00adafé"]


def frame(spark, data):
    return spark.createDataFrame([(*d, "x", 1) for d in data], DOC).repartition(3)


def test_pairs(spark):
    data = [(i + 1, s) for i, s in enumerate(SAME)] + [(20, "Café"), (21, "cafe"), (22, "café!"), (23, "café"), (24, None), (25, ""), (26, ""), (27, "\u200b"), (28, "a b"), (29, "a\u00a0b"), (30, "a  b"), (31, "a\nb")]
    wanted = {(i, j) for i in range(1, 7) for j in range(i + 1, 7)} | {(i, 23) for i in range(2, 7)} | {(25, 27), (26, 27), (28, 29)}
    found = lookalike.look_alike_pairs(frame(spark, data))
    assert rows(found) == wanted
    assert found.count() == len(wanted)


def test_classes_and_texts(spark):
    data = [(i + 1, s) for i, s in enumerate(SAME)] + [(7, "other"), (8, None)]
    got = {r.doc_id: (r.class_id, r.n_spellings, r.n_docs) for r in lookalike.look_alike_classes(frame(spark, data)).collect()}
    assert got == {**{i: (1, 6, 6) for i in range(1, 7)}, 7: (7, 1, 1)}
    texts = {r.doc_id: (r.text, r.changed) for r in lookalike.consistent_texts(frame(spark, data), "doc_id", "text").collect()}
    assert {texts[i][0] for i in range(1, 7)} == {"café"}
    assert texts[1] == ("café", False) and texts[3][1] and texts[8] == (None, False)


def test_empty_table(spark):
    assert lookalike.look_alike_pairs(frame(spark, [])).count() == 0


def test_many_copies_make_no_pairs(spark):
    data = [(i, "copy" * 50) for i in range(500)] + [(1000, "cоpy" + "copy" * 49)]
    assert rows(lookalike.look_alike_pairs(frame(spark, data))) == {(i, 1000) for i in range(500)}


def test_representative_is_the_most_frequent():
    table = lookalike.rewriting({"о": 10, "o": 3, "x": 1, "х": 0})
    assert table["o"] == "о" and table["х"] == "x"


def test_transitive_classes():
    root = lookalike.classes([("a", "b"), ("c", "d"), ("b", "c"), ("e", "f")])
    assert root["a"] == root["d"] and root["a"] != root["e"]


def test_longest_pattern_first():
    rewrite = lookalike.rewriter({"vv": "w", "vvv": "m", "\u00a0": " "})
    assert rewrite("avvvb vvc\u00a0v") == "amb wc v"


ALPHABET = "abeoxXHvéñ.,-3 \n" + "аеохХНѕһԁ" + "ονΧΝ" + "ｅＡ．３" + "\u0301\u0308\u0323\u200b\u00ad\ufeff\u00a0\u3000" + "ﬁ½…¨µμйё"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=12), min_size=2, max_size=6))
def test_forms_split_texts_as_the_reference_does(texts):
    corpus = lookalike.rewriter(lookalike.rewriting(collections.Counter("".join(texts))))
    for form in (corpus, lookalike.plain_form()):
        for a in texts:
            for b in texts:
                assert (form(a) == form(b)) == (reference_form(a) == reference_form(b)), (a, b)
        assert all(form(form(t)) == form(t) for t in texts)


def test_long_text():
    text = "аbc\u200b " * 200_000
    assert lookalike.plain_form()(text) == "abc " * 200_000


def test_frequencies(spark):
    rnd = random.Random(3)
    texts = ["".join(rnd.choice(ALPHABET) for _ in range(40)) for _ in range(30)] + [None, ""]
    found = lookalike.code_point_frequencies(frame(spark, list(enumerate(texts))), "text")
    assert {chr(r.code_point): r.n for r in found.collect()} == dict(collections.Counter("".join(t or "" for t in texts)))


@pytest.mark.parametrize("latin,other", [("Y", "\u0423"), ("Y", "\u04ae"), ("y", "\u04af"), ("I", "\u04c0"), ("c", "\u03f2"), ("C", "\u03f9")])
def test_capital_and_variant_letters(latin, other):
    assert lookalike.plain_form()(f"ab{other}d") == f"ab{latin}d"
    assert lookalike.rewriting({latin: 9, other: 1}).get(other) == latin
    assert not {"\u03c2", "\u03a3"} & lookalike.rewriting({latin: 9, other: 1, "\u03c2": 1, "\u03a3": 1}).keys()


def test_letters_of_the_library(spark):
    letters = lookalike.look_alike_letters(spark)
    assert len(letters) > 280 and LETTERS.items() <= letters.items()
    assert {"\ua4ee": "A", "\u2c9f": "o", "\u2c9e": "O", "\u0399": "I", "\u1d26": "r", "\u04d4": "AE", "\u04d5": "ae", "\ua4f2": "I"}.items() <= letters.items()
    assert not any(unicodedata.name(c).startswith("LATIN") for c in letters)
    assert not {"\u0437", "\u0436", "\u4e00", "\uac00", "m", "I"} & letters.keys()
    table = lookalike.plain_table(letters)
    rewrite = lookalike.rewriter(table)
    assert all(rewrite(c) == x for c, x in letters.items())
    assert rewrite("\u04d4x \u0435\u0301 rn vv ll 1l") == "AEx é rn vv ll 1l"
    assert sum(len(p) > 1 for p in table) > 500  # strings are patterns too
    text = "".join(c for c in letters if unicodedata.normalize("NFKD", c) == c)
    assert reference_form(text, letters) == rewrite(text)


def test_strings_are_patterns():
    table = lookalike.rewriting(collections.Counter("caf\u00e9 e\u0301 \u0435\u0301"))
    assert table["e\u0301"] == "é" and table["\u0435"] == "e"
    extra = [("m", "rn"), ("w", "vv"), ("rn", "nn")]
    table = lookalike.rewriting(collections.Counter("modern www"), extra=extra)
    rewrite = lookalike.rewriter(table)
    assert rewrite("modern") == rewrite("rnodenn") == rewrite("nnodem") and rewrite("wow") == rewrite("vvovv")


def test_chains_are_followed_to_their_end():
    chain = [(chr(0xE000 + i), chr(0xE001 + i) + "x") for i in range(40)]  # each stands for the next and a letter more
    rewrite = lookalike.rewriter(lookalike.rewriting(dict.fromkeys("x", 1), extra=chain))
    assert rewrite("\ue000") == "\ue028" + "x" * 40
    loop = lookalike.rewriter(lookalike.rewriting(dict.fromkeys("ab", 1), extra=[("a", "bb"), ("b", "aa")]))
    assert loop("ab")
