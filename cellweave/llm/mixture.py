"""Mixing sources to target shares with a low-discrepancy schedule of equal-token blocks.

The documents of a source are shuffled, laid end to end and cut into blocks of equal size in tokens. A
mix is a sequence of slots, each filled with one block. The points of the golden-ratio sequence are
mapped through the cumulative shares of the mix to sources, so every stretch of slots holds each source
close to its share; the r-th slot of a source takes its block r modulo the number of its blocks.

Nothing runs per source or per mix: running sums of tokens and ranks of slots are made in two steps,
inside buckets (or chunks of slots) of bounded size and over the bucket totals.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scratch import saved

# Fixed value: how the public byte-level vocabularies split a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
GOLDEN = (math.sqrt(5) - 1) / 2
CHUNK_BITS = 16
#: Documents, at most about, in one bucket of a source.
BUCKET_DOCS = 20_000


def token_counts(documents: DataFrame, ranks_path: str, text: str = "text") -> DataFrame:
    """`documents` with `text` replaced by n_tokens (bigint) of a byte-level BPE vocabulary.

    `ranks_path`: a file of base64 tokens and ranks, read here and sent to the tasks. Strings of special tokens are
    ordinary text. A null text has 0 tokens. Texts are counted whole.
    """
    spark = documents.sparkSession
    with open(ranks_path, "rb") as f:
        ranks = spark.sparkContext.broadcast({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})
    others = [c for c in documents.columns if c not in (text, "n_tokens")]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        encoder = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks.value, special_tokens={})
        for batch in batches:
            sizes = [len(encoder.encode_ordinary(t)) if t else 0 for t in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in others], pa.array(sizes, pa.int64())], names=[*others, "n_tokens"])

    shape = documents.select(*others, F.lit(0).cast("bigint").alias("n_tokens")).schema
    return documents.select(*others, text).mapInArrow(count, shape)


def _segments(sized: DataFrame, block_tokens: int, seed: int) -> DataFrame:
    """(source, block, doc_id, token_from, token_to): which tokens of which documents make up each block."""
    buckets = max(1, math.ceil(sized.count() / BUCKET_DOCS))
    placed = (
        sized.where(F.col("n_tokens") > 0)
        .withColumn("h", F.xxhash64("doc_id", F.lit(seed)))
        .withColumn("bucket", F.pmod(F.xxhash64("doc_id", F.lit(seed + 1)), F.lit(buckets)))
    )
    totals = placed.groupBy("source", "bucket").agg(F.sum("n_tokens").alias("total"))
    offsets = totals.withColumn(
        "offset", F.sum("total").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)) - F.col("total")
    ).drop("total")
    inside = Window.partitionBy("source", "bucket").orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    laid = (
        placed.withColumn("upto", F.sum("n_tokens").over(inside))
        .join(offsets, ["source", "bucket"])
        .withColumn("start", F.col("offset") + F.col("upto") - F.col("n_tokens"))
    )
    size = F.lit(block_tokens)
    end = F.col("start") + F.col("n_tokens")
    return laid.withColumn(
        "block", F.explode(F.sequence(F.floor(F.col("start") / size), F.floor((end - 1) / size)))
    ).select(
        "source",
        "block",
        "doc_id",
        (F.greatest(F.col("start"), F.col("block") * size) - F.col("start")).alias("token_from"),
        (F.least(end, (F.col("block") + 1) * size) - F.col("start")).alias("token_to"),
    )


def mix_plan(sized: DataFrame, targets: DataFrame, block_tokens: int) -> DataFrame:
    """(mix_name, source, target_share, share, tokens, blocks, cap, slots): one row per mix and wanted source.

    target_share is the weight over the sum of all weights of the mix; share is that over the sources that have
    tokens. cap is the most slots a source can fill; slots the length of the mix: the largest at which every
    source with tokens reaches its share within its cap.
    """
    label = F.lower(F.trim(F.col("source")))
    wanted = (
        targets.where(F.col("mix_name").isNotNull() & F.col("source").isNotNull())
        .groupBy("mix_name", label.alias("source"))
        .agg(F.sum(F.greatest(F.coalesce(F.nanvl("target_weight", F.lit(0.0)), F.lit(0.0)), F.lit(0.0))).alias("w"), F.max(F.greatest(F.coalesce("max_repeats", F.lit(1)), F.lit(0))).alias("repeats"))
    )
    sizes = sized.groupBy("source").agg(F.sum("n_tokens").alias("tokens"))
    mix = Window.partitionBy("mix_name")
    there = F.when((F.col("tokens") > 0) & (F.col("repeats") > 0), F.col("w")).otherwise(0.0)
    total, usable = F.sum("w").over(mix), F.sum(there).over(mix)
    blocks = F.ceil(F.col("tokens") / F.lit(block_tokens))
    return (
        wanted.join(sizes, "source", "left")
        .withColumn("tokens", F.coalesce("tokens", F.lit(0)))
        .withColumn("target_share", F.when(total > 0, F.col("w") / total).otherwise(0.0))
        .withColumn("share", F.when(usable > 0, there / usable).otherwise(0.0))
        .withColumn("blocks", blocks)
        .withColumn("cap", F.col("blocks") * F.col("repeats"))
        .withColumn("slots", F.coalesce(F.min(F.when(F.col("share") > 0, F.floor(F.col("cap") / F.col("share")))).over(mix), F.lit(0)))
        .select("mix_name", "source", "target_share", "share", "tokens", "blocks", "cap", "repeats", "slots")
    )


def _slots(plan: DataFrame) -> DataFrame:
    """(mix_name, slot, source, repeat_no, block) of every slot, made in chunks that spread over tasks.

    The schedule can run ahead of a share by a few slots; a mix ends before the first slot that would take its source over its cap.
    """
    spark = plan.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    upto = F.sum("share").over(Window.partitionBy("mix_name").orderBy("source").rowsBetween(Window.unboundedPreceding, 0))
    bands = (
        plan.where((F.col("share") > 0) & (F.col("slots") > 0))
        .withColumn("upto", upto)
        .groupBy("mix_name", "slots")
        .agg(F.sort_array(F.collect_list(F.struct("upto", "source", "blocks", "cap"))).alias("bands"))
    )
    size = 1 << CHUNK_BITS
    chunks = bands.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("slots") - 1) / size)))).repartition(parts, "mix_name", "chunk")
    low, high = F.col("slot").bitwiseAND(F.lit(size - 1)), F.col("chunk")
    # the golden-ratio point of a slot in two parts, so that no digits are lost for large slot numbers
    point = low * F.lit(GOLDEN) + high * F.lit(size * GOLDEN % 1.0)
    band = F.coalesce(F.filter("bands", lambda b: F.col("u") < b["upto"])[0], F.element_at("bands", -1))
    filled = saved(
        chunks.withColumn("slot", F.explode(F.sequence(F.col("chunk") * size, F.least(F.col("slots"), (F.col("chunk") + 1) * size) - 1)))
        .withColumn("u", point - F.floor(point))
        .withColumn("band", band)
        .select("mix_name", "chunk", "slot", "band.source", "band.blocks", "band.cap")
    )
    own = ["mix_name", "source", "chunk"]
    before = (
        filled.groupBy(*own)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("before", F.sum("n").over(Window.partitionBy("mix_name", "source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n"))
        .drop("n")
    )
    ranked = (
        filled.withColumn("place", F.row_number().over(Window.partitionBy(*own).orderBy("slot")) - 1)
        .join(before, own)
        .withColumn("rank", F.col("before") + F.col("place"))
    )
    # the slot of a source's first rank over its cap lies in one chunk, so only that chunk of a source is ranked for it
    over = before.withColumn("after", F.lead("before").over(Window.partitionBy("mix_name", "source").orderBy("chunk")))
    over = over.join(plan.select("mix_name", "source", "cap"), ["mix_name", "source"]).where((F.col("before") <= F.col("cap")) & (F.col("after").isNull() | (F.col("after") > F.col("cap"))))
    reached = filled.join(over.select(*own, "before"), own).withColumn("place", F.row_number().over(Window.partitionBy(*own).orderBy("slot")) - 1)
    ends = reached.where(F.col("before") + F.col("place") == F.col("cap")).groupBy("mix_name").agg(F.min("slot").alias("end"))
    return (
        ranked.join(ends, "mix_name", "left")
        .where(F.col("end").isNull() | (F.col("slot") < F.col("end")))
        .select(
            "mix_name",
            "slot",
            "source",
            (F.floor(F.col("rank") / F.col("blocks")) + 1).cast("int").alias("repeat_no"),
            (F.col("rank") % F.col("blocks")).alias("block"),
        )
    )


def mixture(sized: DataFrame, targets: DataFrame, block_tokens: int = 256, seed: int = 17) -> DataFrame:
    """(mix_name, slot, source, repeat_no, doc_id, token_from, token_to): what fills each slot of each mix.

    sized: (doc_id, source, n_tokens). Labels match without case and surrounding spaces; documents
    without a source or tokens, and targets without a weight, take no part. Weights of a source that is listed
    twice in a mix add up, its larger max_repeats holds; a missing max_repeats is 1. A mix
    has every slot up to its end, the first at which a source would exceed its cap. A mix none of whose
    sources has tokens has no rows. The last block of a source may be shorter. The result is the same on every run.
    """
    sized = sized.select("doc_id", F.lower(F.trim("source")).alias("source"), "n_tokens").where(F.col("source").isNotNull() & (F.col("source") != ""))
    plan = mix_plan(sized, targets, block_tokens)
    # sorted on both sides: slots compress so well that their shuffled size would invite a broadcast of all of them
    return _slots(plan).hint("merge").join(_segments(sized, block_tokens, seed), ["source", "block"]).select(
        "mix_name", "slot", "source", "repeat_no", "doc_id", "token_from", "token_to"
    )


def mixture_shares(sized: DataFrame, targets: DataFrame, block_tokens: int = 256, seed: int = 17) -> DataFrame:
    """Actual shares: one row per mix and wanted source.

    (mix_name, source, target_share, available_tokens, used_tokens, actual_share, repeats_used, max_repeats). A source
    without documents has share 0; the others then share its weight in proportion.
    """
    clean = sized.select("doc_id", F.lower(F.trim("source")).alias("source"), "n_tokens").where(F.col("source").isNotNull() & (F.col("source") != ""))
    used = (
        mixture(sized, targets, block_tokens, seed)
        .groupBy("mix_name", "source")
        .agg(F.sum(F.col("token_to") - F.col("token_from")).alias("used_tokens"), F.max("repeat_no").alias("repeats_used"))
    )
    total = F.sum("used_tokens").over(Window.partitionBy("mix_name"))
    return (
        mix_plan(clean, targets, block_tokens)
        .join(used, ["mix_name", "source"], "left")
        .withColumn("used_tokens", F.coalesce("used_tokens", F.lit(0)))
        .select(
            "mix_name",
            "source",
            F.round("target_share", 6).alias("target_share"),
            F.col("tokens").alias("available_tokens"),
            "used_tokens",
            F.when(total > 0, F.round(F.col("used_tokens") / total, 6)).otherwise(0.0).alias("actual_share"),
            F.coalesce("repeats_used", F.lit(0)).alias("repeats_used"),
            F.col("repeats").alias("max_repeats"),
        )
    )


def sized_documents(documents: DataFrame, ranks_path: str) -> DataFrame:
    """(doc_id, source, n_tokens) of documents with a source, counted once and kept in the shared folder."""
    labelled = documents.where(F.trim("source") != "").select("doc_id", "source", "text")
    return saved(token_counts(labelled, ranks_path))
