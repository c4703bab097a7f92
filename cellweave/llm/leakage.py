"""Documents that contain passages of held-out test items: winnowed fingerprints.

Both sides are cut into words and hashed in k-grams; of every `window` consecutive k-grams the smallest
hash is kept (the rightmost of equal ones). A shared run of window + k - 1 words contains a whole window
of equal k-grams, of which both sides keep the same one, so every run of that length is found. Test and
corpus fingerprints are joined and the hits extended word by word to both sides, by as many words as reach the next hit. Hits of
one document and item at the same distance from each other are merged where they overlap, which gives the whole shared span,
however long.

The corpus side is read once and its text is not shuffled: a task drops fingerprints whose bit in a
filter of the test fingerprints is not set (a bounded number of words, whatever the number of items) and
sends the rest with the few words around them that the extension needs.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scratch import saved
from .lookalike import look_alike_letters, plain_form, plain_table, rewriter

#: A shared run of this many words is a leak.
SHARED_WORDS = 13
GRAM = 7
_WORD = re.compile(r"[^\W_]+")
_TIME_LINES = re.compile(r"^(?:[ \t]*[0-9]+[ \t]*\r?\n)?.*-->.*$|^[ \t]*WEBVTT.*$", re.MULTILINE)
_MARKUP = re.compile(r"<[^<>\r\n]*>|\{[^{}\r\n]*\}|\[[^\[\]\r\n]*\]|\([^()\r\n]*\)")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def cue_words(text: str, plain: Callable[[str], str] | None = None) -> list[str]:
    """Words of a subtitle file across its cues, in plain form (`plain`, or that of the short list of letters) and lower case.

    Left out: time lines with the number line before them, a WEBVTT line, markup in <> or {} and
    descriptions in [] or (), each within one line.
    """
    made = (plain or plain_form())(text).replace("\ufeff", "")
    return _WORD.findall(_MARKUP.sub(" ", _TIME_LINES.sub("", made)).lower())


def item_words(text: str, plain: Callable[[str], str] | None = None) -> list[str]:
    """Words of a test item, in plain form and lower case."""
    return _WORD.findall((plain or plain_form())(text).lower())


class _Hashes(dict):
    """64-bit hash of each word met so far; emptied when it grows large."""

    def __missing__(self, word: str) -> int:
        if len(self) > 1_000_000:
            self.clear()
        made = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return made


def winnow(hashes: np.ndarray, sizes: np.ndarray, gram: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Kept k-grams of many texts at once: (position of the k-gram's first word, its hash as int64).

    `hashes` are the word hashes of all texts one after the other, `sizes` the words of each. Texts
    shorter than window + gram - 1 words keep none.
    """
    n = len(hashes)
    span = gram + window - 1
    if n < span:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    with np.errstate(over="ignore"):
        grams = np.zeros(n - gram + 1, np.uint64)
        for j in range(gram):
            grams = grams * _BASE + hashes[j : n - gram + 1 + j]
        grams ^= grams >> np.uint64(29)
        grams *= np.uint64(0xBF58476D1CE4E5B9)
        grams ^= grams >> np.uint64(32)
    m = n - span + 1
    least = grams[:m].copy()
    at = np.arange(m)
    for j in range(1, window):
        other = grams[j : m + j]
        smaller = other <= least
        least[smaller] = other[smaller]
        at[smaller] = np.flatnonzero(smaller) + j
    ends = np.repeat(np.cumsum(sizes), sizes)
    inside = np.arange(m) + span <= ends[:m]  # windows that do not run into the next text
    kept = np.unique(at[inside])
    return kept, grams[kept].view(np.int64)


def _fingerprints(words_of, table: dict[str, str], gram: int, shared: int, bits: np.ndarray | None):
    """mapInArrow function: (id, text) to (id, hash, number of the k-gram's first word, words before, words from the k-gram on)."""
    window = shared - gram + 1
    reach = shared - gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, plain = _Hashes(), rewriter(table)
        for batch in batches:
            raw = batch.column(1).to_pylist()
            plain.prepare(t for t in raw if t)
            texts = [words_of(t, plain.apply) if t else [] for t in raw]
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            hashes = np.fromiter((cache[w] for t in texts for w in t), np.uint64, int(sizes.sum()))
            kept, h = winnow(hashes, sizes, gram, window)
            if bits is not None:
                u = h.view(np.uint64)
                word = (u >> np.uint64(6)) & np.uint64(len(bits) - 1)
                here = (bits[word.astype(np.int64)] >> (u & np.uint64(63))) & np.uint64(1)
                kept, h = kept[here == 1], h[here == 1]
            starts = np.cumsum(sizes) - sizes
            row = np.searchsorted(starts, kept, side="right") - 1
            place = kept - starts[row]
            before, after = [], []
            for r, p in zip(row.tolist(), place.tolist(), strict=True):
                before.append(texts[r][max(0, p - reach) : p][::-1])
                after.append(texts[r][p : p + shared])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), pa.array(h), pa.array(place), pa.array(before, pa.list_(pa.string())), pa.array(after, pa.list_(pa.string()))],
                names=["id", "h", "place", "before", "after"],
            )

    return run


def _common(a: Column, b: Column) -> Column:
    """Number of equal words at the start of two arrays."""
    equal = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    first = F.array_position(equal, False)
    return F.when(first == 0, F.size(equal)).otherwise(first - 1)


def test_filter(prints: DataFrame, max_words: int) -> np.ndarray:
    """Bits of the test fingerprints in 64-bit words: a power of two of them, at most `max_words`, one per fingerprint up to there."""
    n = prints.count()
    words = 1
    while words < max_words and words * 64 < 64 * n:
        words *= 2
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("h").bitwiseAND(F.lit(63)).cast("int"))
    place = F.shiftrightunsigned("h", 6).bitwiseAND(F.lit(words - 1))
    rows = prints.groupBy(place.alias("word")).agg(F.bit_or(bit).alias("bits")).toPandas()
    made = np.zeros(words, np.int64)
    made[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64)
    return made.view(np.uint64)


def shared_passages(
    documents: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "item_text",
    shared: int = SHARED_WORDS,
    gram: int = GRAM,
    max_filter_words: int = 1 << 22,
) -> DataFrame:
    """(doc_id, item_id, words, doc_from, item_from): pairs that share at least `shared` consecutive words.

    `words` is the length of their longest shared span, the others are the numbers of its first word in the document and in the item (of
    equally long ones the first of the document). Null or empty texts and
    items of fewer than `shared` words take no part; repeated rows and passages give one row. Words of the whole
    text count, however long. Either table may be empty. Extra columns are ignored. Different texts under one id count together.

    `max_filter_words` bounds what is sent to each task (8 bytes a word, 32 MB): up to 4 million test fingerprints the filter has 64 bits for each;
    beyond, more corpus fingerprints reach the join; the result is the same. The join is by hash: a
    passage that very many documents quote meets the few items that hold it. Spans are merged per document, item and distance
    between the two, so a group holds no more hits than the item has words.
    """
    i_kind, d_kind = items.schema[item_id].dataType.simpleString(), documents.schema[doc_id].dataType.simpleString()
    shape = "id {}, h bigint, place bigint, before array<string>, after array<string>"
    table = plain_table(look_alike_letters(documents.sparkSession))
    tests = saved(items.select(item_id, item_text).mapInArrow(_fingerprints(item_words, table, gram, shared, None), shape.format(i_kind)))
    bits = test_filter(tests, max_filter_words)
    corpus = documents.select(doc_id, text).mapInArrow(_fingerprints(cue_words, table, gram, shared, bits), shape.format(d_kind))
    back, ahead = _common(F.col("d.before"), F.col("t.before")), _common(F.col("d.after"), F.col("t.after"))
    hits = (
        corpus.distinct()
        .alias("d")
        .join(tests.distinct().alias("t"), F.col("d.h") == F.col("t.h"))
        .select(
            F.col("d.id").alias("doc_id"),
            F.col("t.id").alias("item_id"),
            (F.col("d.place") - F.col("t.place")).alias("apart"),
            (F.col("d.place") - back).alias("start"),
            (F.col("d.place") + ahead).alias("end"),
        )
        .where(F.col("end") - F.col("start") >= gram)  # else two k-grams only share a hash
    )
    in_order = Window.partitionBy("doc_id", "item_id", "apart").orderBy("start", "end")
    fresh = F.coalesce(F.col("start") > F.max("end").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
    spans = (
        hits.withColumn("fresh", fresh.cast("int"))
        .withColumn("span", F.sum("fresh").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("doc_id", "item_id", "apart", "span")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .where(F.col("end") - F.col("start") >= shared)
    )
    longest = F.max(F.struct((F.col("end") - F.col("start")).alias("words"), (-F.col("start")).alias("first"), "apart"))
    return (
        spans.groupBy("doc_id", "item_id")
        .agg(longest.alias("m"))
        .select("doc_id", "item_id", F.col("m.words").cast("int").alias("words"), (-F.col("m.first")).alias("doc_from"), (-F.col("m.first") - F.col("m.apart")).alias("item_from"))
    )
