"""Loss of signal per FOV and imaging cycle, against similar places of other FOVs.

An FOV is cut into squares; a square has the mean count per barcode bit (imaging cycle and colour). Each
square is compared with its most similar squares, at most one from each other FOV of the slide; an FOV whose
squares fall short of theirs in total counts, or in a bit, is flagged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..functions.scratch import saved
from ..functions.tails import t_upper_col

#: Colours of a barcode position, in the order of the bits.
COLOURS = ("B", "G", "Y", "R")
NEAREST, PER_SQUARE = 500, 10
BLOCK = 512


def grid_squares(points: DataFrame, side: int = 7, min_cells: int = 10) -> DataFrame:
    """(slide, fov, square, cell_id): squares of equal width over each FOV's own range; ones with few cells are left out.

    Intervals are closed to the right, the lowest also to the left; an FOV without extent has one strip.
    """
    box = points.groupBy("fov").agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))
    at = lambda c: F.when(F.col(f"{c}1") > F.col(f"{c}0"), F.greatest(F.lit(1), F.ceil((F.col(c) - F.col(f"{c}0")) / (F.col(f"{c}1") - F.col(f"{c}0")) * side))).otherwise(1).cast("int")
    placed = points.join(box, "fov").select("slide", "fov", "cell_id", F.concat_ws("_", "fov", at("x"), at("y")).alias("square"))
    kept = placed.groupBy("square").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_cells).select("square")
    return placed.join(kept, "square", "left_semi")


def gene_bits(barcodes: DataFrame) -> DataFrame:
    """(gene, cycle, colour): the cycles in which a gene's barcode has a colour; the colour stands at each even position."""
    cycle = F.explode(F.sequence(F.lit(1), F.floor(F.length("barcode") / 2).cast("int")))
    return (
        barcodes.where(F.length("barcode") >= 2)
        .select("gene", "barcode", cycle.alias("cycle"))
        .select("gene", "cycle", F.call_function("substr", F.col("barcode"), 2 * F.col("cycle"), F.lit(1)).alias("colour"))
        .where(F.col("colour").isin(list(COLOURS)))
    )


def square_bits(squares: DataFrame, counts: DataFrame, bits: DataFrame, cycles: int) -> DataFrame:
    """(slide, fov, square, n_cells, total, bits array<double>): mean count per cell of each bit, all cells counted.

    `total` is the mean count per cell over all given counts. Squares whose bits are all 0 are left out. The array has
    len(COLOURS) entries per cycle.
    """
    size = squares.groupBy("slide", "fov", "square").agg(F.count(F.lit(1)).alias("n_cells"))
    placed = counts.join(squares.select("cell_id", "square"), "cell_id").groupBy("square", "gene").agg(F.sum("count").alias("s"))
    position = (F.col("cycle") - 1) * len(COLOURS) + F.array_position(F.array(*[F.lit(c) for c in COLOURS]), F.col("colour")).cast("int") - 1
    per_bit = placed.join(bits.withColumn("bit", position), "gene").groupBy("square", "bit").agg(F.sum("s").alias("s"))
    as_map = per_bit.groupBy("square").agg(F.map_from_entries(F.collect_list(F.struct("bit", "s"))).alias("m"))
    totals = placed.groupBy("square").agg(F.sum("s").alias("t"))
    dense = F.transform(F.sequence(F.lit(0), F.lit(cycles * len(COLOURS) - 1)), lambda b: F.coalesce(F.try_element_at("m", b), F.lit(0)) / F.col("n_cells"))
    return size.join(as_map, "square").join(totals, "square").select("slide", "fov", "square", "n_cells", (F.col("t") / F.col("n_cells")).alias("total"), dense.alias("bits"))


def normalized_bits(bits: DataFrame) -> DataFrame:
    """bits with each square's bits scaled to the slide's mean sum."""
    total = F.aggregate("bits", F.lit(0.0), lambda a, x: a + x)
    summed = bits.withColumn("row_sum", total)
    mean = summed.groupBy("slide").agg(F.avg("row_sum").alias("mean_sum"))
    return summed.join(mean, "slide").withColumn("bits", F.transform("bits", lambda x: x / F.col("row_sum") * F.col("mean_sum"))).drop("row_sum", "mean_sum")


def comparators(bits: DataFrame, nearest: int = NEAREST, per_square: int = PER_SQUARE) -> DataFrame:
    """(square, other, place): the most similar squares of other FOVs of the slide, one per FOV, in order.

    Only the `nearest` squares of a square are looked at, its own FOV's included. The squares of a slide are
    compared in blocks of about `BLOCK`: all pairs of a block come to one task one after the other, which keeps the `nearest` best of each of its squares, so
    no more than these leave it, however many blocks a slide has.
    """
    size = bits.groupBy("slide").agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / BLOCK)).cast("int").alias("blocks"))
    blocks = saved(
        bits.select("slide", "fov", "square", "bits")
        .join(size, "slide")
        .withColumn("block", F.pmod(F.xxhash64("square"), F.col("blocks")))
        .groupBy("slide", "block")
        .agg(F.collect_list("square").alias("s"), F.collect_list("fov").alias("f"), F.collect_list("bits").alias("b"))
    )
    a = blocks.select("slide", F.col("block").alias("block1"), *[F.col(c).alias(f"{c}1") for c in "sfb"])
    b = blocks.select("slide", *[F.col(c).alias(f"{c}2") for c in "sfb"])

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, best = None, []  # the block at hand, and its squares' best so far: names, FOVs, distances

        def done() -> Iterator[pd.DataFrame]:
            for square, fov, (names, fovs, d) in zip(own[1], own[2], best, strict=True):
                yield pd.DataFrame({"square": square, "fov": fov, "other": names, "other_fov": fovs, "d2": d})

        for batch in batches:
            for r in batch.itertuples(index=False):
                if own is None or own[0] != (r.slide, r.block1):
                    if own is not None:
                        yield from done()
                    own = ((r.slide, r.block1), r.s1, r.f1, np.array([list(v) for v in r.b1]))
                    best = [(np.empty(0, object), np.empty(0, object), np.empty(0))] * len(r.s1)
                y, names, fovs = np.array([list(v) for v in r.b2]), np.array(r.s2, dtype=object), np.array(r.f2, dtype=object)
                for i, x in enumerate(own[3]):
                    d = np.concatenate([best[i][2], np.round(((x - y) ** 2).sum(axis=1), 6)])
                    both, owners = np.concatenate([best[i][0], names]), np.concatenate([best[i][1], fovs])
                    order = np.lexsort((both.astype(str), d))[:nearest]
                    best[i] = (both[order], owners[order], d[order])
        if own is not None:
            yield from done()

    pairs = a.join(b, "slide").repartition("slide", "block1").sortWithinPartitions("slide", "block1")
    near = pairs.select("slide", "block1", "s1", "f1", "b1", "s2", "f2", "b2").mapInPandas(compare, "square string, fov string, other string, other_fov string, d2 double")
    all_near = Window.partitionBy("square").orderBy("d2", "other")
    of_fov = Window.partitionBy("square", "other_fov").orderBy("d2", "other")
    return (
        near.where(F.col("other_fov") != F.col("fov"))
        .withColumn("first", F.row_number().over(of_fov))
        .where(F.col("first") == 1)
        .withColumn("place", F.row_number().over(all_near))
        .where(F.col("place") <= per_square)
        .select("square", "other", "place")
    )


def residuals(bits: DataFrame, pairs: DataFrame) -> DataFrame:
    """(slide, fov, square, total_residual, residuals array): log2 of a square's total, and of each bit + 1, over its comparators' mean."""
    n_bits = F.size(F.first("o.bits"))
    mean_bits = pairs.alias("p").join(bits.alias("o"), F.col("p.other") == F.col("o.square")).groupBy("p.square").agg(
        F.avg("o.total").alias("hat"), F.collect_list("o.bits").alias("all"), n_bits.alias("w")
    ).withColumn(
        "yhat", F.transform(F.sequence(F.lit(0), F.col("w") - 1), lambda i: F.aggregate("all", F.lit(0.0), lambda a, v: a + F.get(v, i)) / F.size("all"))
    )
    return bits.join(mean_bits, "square").select(
        "slide", "fov", "square", F.log2(F.col("total") / F.col("hat")).alias("total_residual"), F.zip_with("bits", "yhat", lambda b, y: F.log2((b + 1) / (y + 1))).alias("residuals")
    )


def low_total_fovs(resid: DataFrame, max_loss: float) -> DataFrame:
    """(slide, fov, share_low, flag_total): flagged where more than three quarters of the squares lose more than `max_loss`."""
    low = F.avg((F.col("total_residual") < F.log2(F.lit(1 - max_loss))).cast("double"))
    return resid.groupBy("slide", "fov").agg(low.alias("share_low")).withColumn("flag_total", F.col("share_low") > 0.75)


def _log2(loss: Column) -> Column:
    return F.log2(1 - loss)


def fov_bias(resid: DataFrame, losses: list[float]) -> DataFrame:
    """(slide, fov, bit, bias, t, df, loss, agree): mean residual per FOV and bit with its t statistic.

    t is that of a regression on FOVs without intercept, with the variance pooled over the FOVs of the slide. agree is the
    share of squares below a third of log2(1 - loss). The residuals are computed once for all losses.
    """
    long = resid.select("slide", "fov", "square", F.posexplode("residuals").alias("bit", "r"))
    sums = long.groupBy("slide", "fov", "bit").agg(
        F.count(F.lit(1)).alias("n"), F.avg("r").alias("bias"), F.sum(F.col("r") * F.col("r")).alias("s2"),
        *[F.avg((F.col("r") < _log2(F.lit(loss)) / 3).cast("double")).alias(f"agree_{i}") for i, loss in enumerate(losses)],
    )
    pooled = sums.groupBy("slide", "bit").agg(
        (F.sum("n") - F.count(F.lit(1))).alias("df"), F.sum(F.col("s2") - F.col("n") * F.col("bias") * F.col("bias")).alias("ss")
    )
    s2 = F.when((F.col("df") > 0) & (F.col("ss") > 1e-12), F.col("ss") / F.col("df"))
    each = F.array(*[F.struct(F.lit(float(loss)).alias("loss"), F.col(f"agree_{i}").alias("agree")) for i, loss in enumerate(losses)])
    return sums.join(pooled, ["slide", "bit"]).select("slide", "fov", "bit", "bias", (F.col("bias") / F.sqrt(s2 / F.col("n"))).alias("t"), "df", F.inline(each))


def bit_flags(bias: DataFrame, alpha: float = 0.01) -> DataFrame:
    """bias with p (two-sided) and flag_bit: bias below log2(1 - loss), p below alpha, half of the squares agreeing."""
    p = F.least(F.lit(1.0), 2 * t_upper_col(F.abs("t"), F.col("df")))
    flag = (F.col("bias") < _log2(F.col("loss"))) & (F.col("p") < alpha) & (F.col("agree") >= 0.5)
    return bias.withColumn("p", p).withColumn("flag_bit", F.coalesce(flag, F.lit(False)))


def cycle_flags(flags: DataFrame) -> DataFrame:
    """(slide, fov, loss, cycle, share, flag_cycle): flagged where half of a cycle's colours are."""
    cycle = (F.floor(F.col("bit") / len(COLOURS)) + 1).cast("int")
    share = F.avg(F.col("flag_bit").cast("double"))
    return flags.groupBy("slide", "fov", "loss", cycle.alias("cycle")).agg(share.alias("share")).withColumn("flag_cycle", F.col("share") >= 0.5)


def flag_sweep(flags: DataFrame, totals: DataFrame) -> DataFrame:
    """(slide, loss, n_bias, n_total, n_flagged): FOVs flagged at each loss, by bias, by total counts and by either."""
    by_fov = cycle_flags(flags).groupBy("slide", "fov", "loss").agg(F.max(F.col("flag_cycle").cast("int")).alias("b"))
    both = by_fov.join(totals.select("fov", F.col("flag_total").cast("int").alias("t")), "fov")
    return both.groupBy("slide", "loss").agg(F.sum("b").alias("n_bias"), F.sum("t").alias("n_total"), F.sum(F.greatest("b", "t")).alias("n_flagged"))


def flagged_genes(cycles: DataFrame, bits: DataFrame) -> DataFrame:
    """(fov, gene): genes whose barcode has a colour in a flagged cycle of the FOV."""
    return cycles.where("flag_cycle").select("fov", "cycle").distinct().join(bits.select("gene", "cycle"), "cycle").select("fov", "gene").distinct()


def flagged_fovs(cycles: DataFrame, totals: DataFrame) -> DataFrame:
    """(slide, fov, flag_bias, flag_total, flagged): flagged in any cycle, for total counts, or for either."""
    bias = cycles.groupBy("slide", "fov").agg(F.max("flag_cycle").alias("flag_bias"))
    both = totals.select("slide", "fov", "flag_total").join(bias, ["slide", "fov"], "left").fillna(False, ["flag_bias"])
    return both.select("slide", "fov", "flag_bias", "flag_total", (F.col("flag_bias") | F.col("flag_total")).alias("flagged"))


def square_boxes(squares: DataFrame, points: DataFrame) -> DataFrame:
    """(fov, square, x_min, x_max, y_min, y_max): the range of a square's cells, to be drawn as a box."""
    held = squares.select("fov", "square", "cell_id").join(points.select("cell_id", "x", "y"), "cell_id")
    return held.groupBy("fov", "square").agg(*[f(c).alias(f"{c}_{n}") for c in "xy" for f, n in ((F.min, "min"), (F.max, "max"))])


def clipped_totals(resid: DataFrame, bound: float = 1.0) -> DataFrame:
    """(square, clipped): total residuals within -bound and bound, for a colour scale."""
    return resid.select("square", (F.greatest(F.lit(-bound), F.least(F.lit(bound), F.col("total_residual"))) + F.lit(0.0)).alias("clipped"))
