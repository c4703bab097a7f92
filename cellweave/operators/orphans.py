"""References to records that do not exist.

A reference is a key with the time at which the referring row was loaded. It is an orphan if no parent
row with that key stands at that time: a parent row stands from its start (inclusive) to its end
(exclusive, open if null).

Plan: the parent keys are folded into a Bloom filter of 64-bit words, built by two hash aggregations and packed into arrays. It
has 16 bits a key up to `max_words` words and fewer beyond, so its broadcast size is bounded whatever the number of parents.
Probing it before any shuffle proves most orphans: a key whose bits are missing has no parent at any time; it is reduced to
(table, key, month) and is done. Only what the filter lets through, reduced to distinct (table, key, time), goes into the exact
anti join with the merged times at which each parent stands.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scratch import saved

BITS_PER_KEY = 16
#: Bits set per key, at most, and words per row of the filter.
PROBES, PACK = 5, 256


def _word(key: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(words)).cast("int")


def _mask(key: Column, probes: int) -> Column:
    """`probes` bits of one 64-bit word, from six bits each of a second hash."""
    second = F.xxhash64(key, F.lit(1))
    bits = [
        F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftright(second, 6 * i).bitwiseAND(F.lit(63)).cast("int"))
        for i in range(probes)
    ]
    mask = bits[0]
    for bit in bits[1:]:
        mask = mask.bitwiseOR(bit)
    return mask


def filter_words(n_keys: int, max_words: int) -> int:
    """Words of the filter for `n_keys` keys: a power of two, at most `max_words`."""
    wanted = max(1, n_keys * BITS_PER_KEY // 64)
    return min(max_words, 1 << math.ceil(math.log2(wanted)) if wanted > 1 else 1)


def filter_probes(n_keys: int, words: int) -> int:
    """Bits to set per key: about ln 2 times the bits per key, from 1 to `PROBES`."""
    return max(1, min(PROBES, round(math.log(2) * 64 * words / max(1, n_keys))))


def bloom_filter(keys: DataFrame, key: str, words: int, probes: int = PROBES) -> DataFrame:
    """Bloom filter of column `key` as rows (bf_pack, bf_words array<bigint> of `PACK` words); null keys are left out."""
    held = (
        keys.where(F.col(key).isNotNull())
        .groupBy(_word(F.col(key), words).alias("word"))
        .agg(F.bit_or(_mask(F.col(key), probes)).alias("bits"))
        .groupBy(F.floor(F.col("word") / PACK).cast("int").alias("bf_pack"))
        .agg(F.map_from_entries(F.collect_list(F.struct((F.col("word") % PACK).alias("at"), "bits"))).alias("m"))
    )
    dense = F.transform(F.sequence(F.lit(0), F.lit(PACK - 1)), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0).cast("bigint")))
    return held.select("bf_pack", dense.alias("bf_words"))


def with_maybe(rows: DataFrame, key: str, bloom: DataFrame, words: int, probes: int) -> DataFrame:
    """rows with maybe: false where the filter proves that no parent has the key."""
    word, mask = _word(F.col(key), words), _mask(F.col(key), probes)
    bits = F.get("bf_words", word % PACK)
    probed = rows.withColumn("bf_pack", F.floor(word / PACK).cast("int")).join(F.broadcast(bloom), "bf_pack", "left")
    return probed.withColumn("maybe", F.coalesce(bits.bitwiseAND(mask) == mask, F.lit(False))).drop("bf_pack", "bf_words")


def standing_intervals(keys: DataFrame) -> DataFrame:
    """(p_key, p_start, p_end): disjoint times at which each key stands, per day of their start.

    keys: (p_key, p_start, p_end), an open end being null. Rows without a key or start, or that end before they start, never
    stand. Of rows that end together, those without an end above all, only the earliest start of a day leaves a
    task; the rest is merged per key and day, so no task holds more than a day of a key. A key delivered millions of times so
    meets its references as few rows.
    """
    ended = F.coalesce("p_end", F.lit("9999-12-31").cast("timestamp_ntz"))
    earliest = (
        keys.where(F.col("p_key").isNotNull() & F.col("p_start").isNotNull() & (F.col("p_start") < ended))
        .groupBy("p_key", F.to_date("p_start").alias("p_day"), ended.alias("p_end"))
        .agg(F.min("p_start").alias("p_start"))
    )
    in_order = Window.partitionBy("p_key", "p_day").orderBy("p_start", "p_end")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    apart = F.coalesce(F.col("p_start") > F.max("p_end").over(before), F.lit(True))
    return (
        earliest.withColumn("apart", apart.cast("int"))
        .withColumn("island", F.sum("apart").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("p_key", "p_day", "island")
        .agg(F.min("p_start").alias("p_start"), F.max("p_end").alias("p_end"))
        .select("p_key", "p_start", "p_end")
    )


def orphan_references(
    references: DataFrame,
    parents: DataFrame,
    parent_key: str = "updated_cell_id",
    start: str = "loaded_at",
    end: str = "deleted_at",
    max_words: int = 1 << 24,
) -> DataFrame:
    """Orphans among `references`, with the number of referring rows, per table and month.

    references: (src_table string, ref_key string, ref_time timestamp_ntz); further columns are ignored.
    Result: (src_table, load_month 'yyyy-MM', ref_key, n_rows).

    A null key refers to nothing. A reference without a time cannot be placed and is left out; a parent
    without a start never stands. Repeated rows count in n_rows but give one result row. An empty parent
    table makes every reference an orphan. Keys compare exactly, by code point.

    `max_words` bounds the broadcast (8 bytes a word, 128 MB). Up to 64 million parent rows the filter has the full 16 bits a key;
    beyond, it thins out and more references go through the exact join; the result is
    the same. A hot key is reduced by the distinct step before it is shuffled, and what remains of it in
    the anti join is split by Spark's skew handling. The probed references are kept in a table, since both ways on read them.
    """
    keys = parents.select(F.col(parent_key).alias("p_key"), F.col(start).alias("p_start"), F.col(end).alias("p_end"))
    n_keys = keys.count()
    words = filter_words(n_keys, max_words)
    probes = filter_probes(n_keys, words)
    bloom = bloom_filter(keys, "p_key", words, probes)

    refs = references.select("src_table", "ref_key", "ref_time").where(
        F.col("ref_key").isNotNull() & F.col("ref_time").isNotNull()
    )
    probed = saved(
        with_maybe(refs, "ref_key", bloom, words, probes)
        .groupBy(
            "src_table",
            "ref_key",
            F.date_format("ref_time", "yyyy-MM").alias("load_month"),
            "maybe",
            F.when(F.col("maybe"), F.col("ref_time")).alias("at"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )
    proven = probed.where(~F.col("maybe")).select("src_table", "load_month", "ref_key", F.col("n").alias("n_rows"))
    same = (F.col("ref_key") == F.col("p_key")) & (F.col("at") >= F.col("p_start")) & (F.col("at") < F.col("p_end"))
    orphans = probed.where("maybe").join(standing_intervals(keys), same, "left_anti")
    # a key is proven or not whatever its row, so the two parts share no result row
    return orphans.groupBy("src_table", "load_month", "ref_key").agg(F.sum("n").alias("n_rows")).unionByName(proven)


def orphan_report(orphans: DataFrame) -> DataFrame:
    """Per table and month: distinct orphan keys and the rows that refer to them."""
    return orphans.groupBy("src_table", "load_month").agg(
        F.count(F.lit(1)).alias("n_keys"), F.sum("n_rows").alias("n_rows")
    )
