"""One consistent form for texts that look the same and differ in their characters.

Nodes are the code points that occur in the corpus and the strings they stand for: compatibility and
composed characters for their decomposition, every kind of space for the plain space, invisible
characters for the empty string, look-alike letters for the Latin letter or letters. Union-find over these pairs
gives transitive classes (a full-width Cyrillic-looking letter, its plain form and the Latin letter fall
together). Each class is written as one representative: the empty string or the string of a class that
has one with several characters (only that direction rewrites the same way in every context), and else its most
frequent code point in the corpus (of equally frequent ones, a plain one before a compatibility form); what that gives is composed. Code points
and strings are the patterns of a multi-pattern automaton, which rewrites texts from left to right, longest pattern first; the rest is left to
Unicode composition.

Which letters look alike is taken from Unicode's data of confusable characters in the ICU library that Spark carries, and from a short
list of letters on which that data takes another view.
"""

from __future__ import annotations

import re
import string
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scratch import saved

# Letters of other scripts that look like a Latin letter, Latin letter first. They come before those of ICU.
LOOKALIKES = (
    # Cyrillic, small
    "aа cс dԁ eе hһ iі jј lӏ oо pр qԛ sѕ vѵ wԝ xх yу yү "
    # Cyrillic, capital
    "AА BВ CС EЕ HН IІ JЈ KК MМ OО PР QԚ SЅ TТ VѴ WԜ XХ YУ YҮ IӀ "
    # Greek
    "oο vν pρ jϳ cϲ AΑ BΒ EΕ ZΖ HΗ IΙ KΚ MΜ NΝ OΟ PΡ TΤ YΥ XΧ JͿ CϹ "
    # Armenian and Cherokee letters that are drawn as Latin ones
    "oօ hհ uս qզ gց nո OՕ SՏ LԼ UՍ DᎠ RᎡ TᎢ AᎪ JᎫ EᎬ WᎳ MᎷ HᎻ GᏀ ZᏃ SᏚ VᏙ KᏦ PᏢ LᏞ CᏟ BᏴ"
).split()
# Invisible characters that Unicode does not class as format characters.
INVISIBLE = "\u034f\u115f\u1160\u17b4\u17b5\u180b\u180c\u180d\u3164\uffa0"


def is_invisible(c: str) -> bool:
    """Format characters, variation selectors and fillers: nothing is drawn for them."""
    return unicodedata.category(c) == "Cf" or c in INVISIBLE or "\ufe00" <= c <= "\ufe0f" or "\U000e0100" <= c <= "\U000e01ef"


def _script_letters() -> Iterator[str]:
    """Assigned letters of other scripts than Latin that stand for themselves; ideographs and syllable blocks look like no letter."""
    for i in range(0x80, 0x20000):
        c = chr(i)
        if unicodedata.category(c)[0] == "L" and not (0x3400 <= i < 0xA000 or 0xAC00 <= i < 0xD7B0):
            if not unicodedata.name(c, "LATIN").startswith("LATIN") and unicodedata.normalize("NFKD", c) == c:
                yield c


def look_alike_letters(spark: SparkSession) -> dict[str, str]:
    """Letters of other scripts with the Latin letter, or letters of one case, that look the same.

    Two letters look the same if Unicode's skeletons of them, as the ICU library in Spark's driver makes them, are equal. Of several such Latin letters, I
    and l, the one of the letter's own case is taken, the capital for letters without case. Only the driver asks ICU, once for all letters.
    """
    own = {pair[1]: pair[0] for pair in LOOKALIKES}
    checker = spark.sparkContext._jvm.com.ibm.icu.text.SpoofChecker.Builder().build()
    skeletons = lambda chars: checker.getSkeleton("\n".join(chars)).split("\n")
    latin = dict(zip(string.ascii_letters, skeletons(string.ascii_letters), strict=True))
    found = {}
    letters = list(_script_letters())
    for c, skeleton in zip(letters, skeletons(letters), strict=True):
        of_case = string.ascii_lowercase if c.islower() else string.ascii_uppercase
        other = of_case.swapcase()
        single = [x for x in of_case + other if latin[x] == skeleton]
        if single:
            found[c] = single[0]
        elif len(skeleton) > 1 and skeleton.isascii() and skeleton.isalpha():
            spelled = [next((x for x in of_case if latin[x] == part), None) for part in skeleton]
            if None not in spelled:
                found[c] = "".join(spelled)
    return {**found, **own}


def pairs_of(code_points: Iterable[str], extra: Iterable[tuple[str, str]] = (), letters: dict[str, str] | None = None) -> Iterator[tuple[str, str]]:
    """Pairs (character, string that looks the same). `letters` as `look_alike_letters` gives them; without it the short list."""
    letters = {pair[1]: pair[0] for pair in LOOKALIKES} if letters is None else letters
    for c in code_points:
        if is_invisible(c):
            yield c, ""
        elif unicodedata.category(c) == "Zs":
            yield c, " "
        elif c in letters:  # the lunate sigmas decompose to letters that look otherwise
            yield c, letters[c]
        elif not "\uac00" <= c <= "\ud7a3":  # syllable blocks are left to Unicode composition
            plain = unicodedata.normalize("NFKD", c)
            if plain != c:
                yield c, plain
            for letter in plain:
                if letter in letters:
                    yield letter, letters[letter]
    yield from extra


def classes(pairs: Iterable[tuple[str, str]]) -> dict[str, str]:
    """Root of each string's class, by union-find with path halving."""
    parent: dict[str, str] = {}

    def root(s: str) -> str:
        parent.setdefault(s, s)
        while parent[s] != s:
            parent[s] = s = parent[parent[s]]
        return s

    for a, b in pairs:
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    return {s: root(s) for s in list(parent)}


def rewriting(frequencies: dict[str, int], extra: Iterable[tuple[str, str]] = (), letters: dict[str, str] | None = None) -> dict[str, str]:
    """What each pattern, a code point or a string, is rewritten to, for a corpus with these code point frequencies."""
    members: dict[str, list[str]] = {}
    for s, r in classes(pairs_of(frequencies, extra, letters)).items():
        members.setdefault(r, []).append(s)
    chosen: dict[str, str] = {}
    for group in members.values():
        if "" in group:
            best = ""
        elif any(len(s) > 1 for s in group):
            best = min(s for s in group if len(s) > 1)
        else:
            best = min(group, key=lambda s: (-frequencies.get(s, 0), unicodedata.normalize("NFKC", s) != s, s))
        chosen.update(dict.fromkeys(group, best))

    def spelled(s: str, within: frozenset[str] = frozenset()) -> str:
        """s with every string in it replaced until nothing changes; a string within itself stays."""
        to = chosen.get(s, s)
        if len(to) < 2 or s in within:
            return to
        return "".join(c if c == s else spelled(c, within | {s}) for c in to)

    compose = lambda s: unicodedata.normalize("NFC", s)
    table = {s: compose(spelled(s)) for s in chosen if s}
    return {s: to for s, to in table.items() if to != s}


class Rewriter:
    """Rewrites texts by a table, from left to right, longest pattern first, and composes them.

    The automaton searches the children of a node one by one, so it holds only patterns whose characters have occurred; `prepare`
    brings in those of many texts at once, and `apply` rewrites a text that is among them. A call does both for one text. Unless a pattern is ASCII
    alone, the automaton is run on the stretches of a text that can hold a pattern, and the rest is skipped.
    """

    def __init__(self, table: dict[str, str]):
        self.table = table
        self.ascii_too = any(p.isascii() for p in table)
        self.special = {c for p in table for c in p if self.ascii_too or not c.isascii()}
        self.known: set[str] = set()
        self.automaton: ahocorasick.Automaton | None = None
        runs = [[len(r) for r in re.split("[^\x00-\x7f]+", p)] for p in table] if not self.ascii_too else []
        self.lead, self.trail = max((r[0] for r in runs), default=0), max((r[-1] for r in runs), default=0)
        self.inner = max([self.lead + self.trail, *(n for r in runs for n in r[1:-1])])  # nearer stretches are one
        self.stretches: re.Pattern | None = None

    def prepare(self, texts: Iterable[str]) -> None:
        whole = "".join(t for t in texts if self.ascii_too or not t.isascii())
        seen = np.flatnonzero(np.bincount(np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)))
        fresh = {chr(c) for c in seen} & self.special - self.known
        if not fresh:
            return
        self.known |= fresh
        missing = self.special - self.known
        made = ahocorasick.Automaton()
        for pattern, to in self.table.items():
            if missing.isdisjoint(pattern):
                made.add_word(pattern, (len(pattern), to))
        if len(made):
            made.make_automaton()
            self.automaton = made
        if not self.ascii_too:
            self.stretches = re.compile("[" + "".join(map(re.escape, sorted(self.known))) + "]+")

    def __call__(self, text: str) -> str:
        self.prepare([text])
        return self.apply(text)

    def apply(self, text: str) -> str:
        if text.isascii() and not self.ascii_too:
            return text
        if self.automaton is None:
            return unicodedata.normalize("NFC", text)
        if self.stretches is None:
            return unicodedata.normalize("NFC", self._run(text))
        made, at, begin, end = [], 0, 0, -1
        for found in self.stretches.finditer(text):
            first, last = found.span()
            if end >= 0 and first - end > self.inner:
                made += [text[at:begin], self._run(text[begin : end + self.trail])]
                at, end = end + self.trail, -1
            if end < 0:
                begin = max(at, first - self.lead)
            end = last
        if end >= 0:
            made += [text[at:begin], self._run(text[begin : end + self.trail])]
            at = end + self.trail
        made.append(text[at:])
        return unicodedata.normalize("NFC", "".join(made))

    def _run(self, text: str) -> str:
        made, at = [], 0
        for end, (size, to) in self.automaton.iter_long(text):
            start = end + 1 - size
            if start > at:
                made.append(text[at:start])
            made.append(to)
            at = end + 1
        made.append(text[at:])
        return "".join(made)


def rewriter(table: dict[str, str]) -> Rewriter:
    """The rewriter of a table."""
    return Rewriter(table)


def plain_table(letters: dict[str, str] | None = None) -> dict[str, str]:
    """A rewriting table over all assigned characters that needs no corpus: every class that has a Latin letter is written with it.

    Used where two texts only have to be compared.
    """
    assigned = (chr(i) for i in range(0x110000) if unicodedata.category(chr(i)) not in ("Cn", "Co", "Cs", "Cc"))
    return rewriting({c: int(c.isascii()) for c in assigned}, letters=letters)


@lru_cache(maxsize=1)
def plain_form() -> Rewriter:
    """The rewriter of `plain_table` with the short list of letters."""
    return rewriter(plain_table())


def code_point_frequencies(texts: DataFrame, text: str) -> DataFrame:
    """(code_point int, n bigint): how often each code point occurs in a column; null texts count nothing."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0x110000, dtype=np.int64)
        for batch in batches:
            joined = "".join(t for t in batch.column(0).to_pylist() if t)
            total += np.bincount(np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32), minlength=0x110000)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["code_point", "n"])

    counted = texts.select(F.col(text)).mapInArrow(count, "code_point int, n bigint")
    return counted.groupBy("code_point").agg(F.sum("n").alias("n"))


def corpus_table(texts: DataFrame, text: str) -> dict[str, str]:
    """The rewriting table of a corpus. Unicode bounds the frequencies that are collected, not the corpus."""
    rows = code_point_frequencies(texts, text).collect()
    return rewriting({chr(r["code_point"]): r["n"] for r in rows}, letters=look_alike_letters(texts.sparkSession))


def consistent_texts(texts: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, text in its consistent form, changed boolean). Null texts stay null; empty ones empty."""
    table = corpus_table(texts, text)

    def rewrite_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rewrite = rewriter(table)
        for batch in batches:
            old = batch.column(1).to_pylist()
            rewrite.prepare(t for t in old if t)
            new = [None if t is None else rewrite.apply(t) for t in old]
            changed = [a is not None and a != b for a, b in zip(old, new, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(new, pa.string()), pa.array(changed)], names=batch.schema.names + ["changed"])

    kind = texts.schema[doc_id].dataType.simpleString()
    return texts.select(doc_id, text).mapInArrow(rewrite_all, f"`{doc_id}` {kind}, `{text}` string, changed boolean")


def text_forms(texts: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, form binary, own binary): 128-bit hashes of a text's consistent form and of the text itself.

    Texts with equal hashes are taken as equal (128 bits; a chance match among 10**12 texts has odds of 10**-15).
    Null texts are left out.
    """
    table = corpus_table(texts, text)

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rewrite = rewriter(table)
        digest = lambda s: xxhash.xxh3_128_digest(s.encode("utf-8", "surrogatepass"))
        for batch in batches:
            own, form = [], []
            texts = batch.column(1).to_pylist()
            rewrite.prepare(texts)
            for t in texts:
                own.append(digest(t))
                made = rewrite.apply(t)
                form.append(own[-1] if made is t else digest(made))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(form, pa.binary()), pa.array(own, pa.binary())], names=["doc_id", "form", "own"])

    kind = texts.schema[doc_id].dataType.simpleString()
    return texts.where(F.col(text).isNotNull()).select(doc_id, text).mapInArrow(hashes, f"doc_id {kind}, form binary, own binary")


def look_alike_pairs(texts: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id_a, doc_id_b), a < b: documents whose texts differ but have one consistent form.

    Exact copies of a text are no pair. They are first reduced to one row per distinct text, so only forms
    with several spellings are joined; a text with many copies but no other spelling is never paired, and
    between spellings only the pairs that the result holds are made.
    """
    forms = saved(text_forms(texts, doc_id, text))
    spellings = forms.groupBy("form", "own").agg(F.count(F.lit(1)).alias("n_docs"))
    several = spellings.groupBy("form").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select("form")
    mixed = spellings.join(several, "form").select("form", "own")
    couples = mixed.alias("a").join(mixed.alias("b"), "form").where(F.col("a.own") < F.col("b.own")).select(F.col("a.own").alias("own_a"), F.col("b.own").alias("own_b"))
    docs = forms.select("own", "doc_id")
    left = docs.select(F.col("own").alias("own_a"), F.col("doc_id").alias("d1"))
    right = docs.select(F.col("own").alias("own_b"), F.col("doc_id").alias("d2"))
    return (
        couples.join(left, "own_a")
        .join(right, "own_b")
        .select(F.least("d1", "d2").alias("doc_id_a"), F.greatest("d1", "d2").alias("doc_id_b"))
    )


def look_alike_classes(texts: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, class_id, n_spellings, n_docs): every document with the smallest doc_id of its form."""
    forms = saved(text_forms(texts, doc_id, text))
    per_form = (
        forms.groupBy("form", "own")
        .agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .groupBy("form")
        .agg(F.min("first").alias("class_id"), F.count(F.lit(1)).alias("n_spellings"), F.sum("n").alias("n_docs"))
    )
    return forms.join(per_form, "form").select("doc_id", "class_id", "n_spellings", "n_docs")
