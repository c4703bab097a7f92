"""Rows behind plots and exports: projections, heat maps, volcano rows, intensities."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def projected(rows: DataFrame, default: list[str], wanted: list[str]) -> tuple[DataFrame, list[str]]:
    """rows with the default and the wanted columns that are there, and the names of those that are not."""
    names = list(dict.fromkeys([*default, *wanted]))
    return rows.select([c for c in names if c in rows.columns]), [c for c in names if c not in rows.columns]


def renamed(rows: DataFrame, names: dict[str, str], required: bool = False) -> DataFrame:
    """rows with columns renamed (old to new); a column already called so is set aside as new_1."""
    lacking = [old for old in names if old not in rows.columns]
    if required and lacking:
        raise ValueError(f"columns are missing: {', '.join(lacking)}")
    for old, new in names.items():
        if old in rows.columns and old != new:
            if new in rows.columns:
                rows = rows.withColumnRenamed(new, f"{new}_1")
            rows = rows.withColumnRenamed(old, new)
    return rows


def type_order(name: Column, known: list[str]) -> Column:
    """Sort key of cell types: single letters, then known types in their order, then the others."""
    place = F.array_position(F.array(*[F.lit(k) for k in known]), name) if known else F.lit(0)
    return F.when(name.rlike("^[a-z]$"), 0).when(place > 0, place.cast("int")).otherwise(len(known) + 1)


def profile_heat(profiles: DataFrame, row: str, column: str, value: str, floor: float = 0.2) -> DataFrame:
    """(row, column, heat): values over the larger of their row's maximum and `floor`; rows below it are left out."""
    top = F.max(value).over(Window.partitionBy(row))
    return profiles.withColumn("top", top).where(F.col("top") > floor).select(row, column, (F.col(value) / F.greatest("top", F.lit(floor))).alias("heat"))


def standardized(rows: DataFrame, by: str, value: str) -> DataFrame:
    """rows with z: deviation from the mean of a group in its standard deviations; null where nothing varies."""
    w = Window.partitionBy(by)
    sd = F.stddev_samp(value).over(w)
    return rows.withColumn("z", (F.col(value) - F.avg(value).over(w)) / F.when(sd > 0, sd))


def log_counts(totals: DataFrame, cutoff: int, sample: int = 100_000) -> DataFrame:
    """(cell_id, x, y, log_count, below, drawn): log10(n + 1) of each cell, whether n is below the cutoff, and whether the cell is among those to be drawn.

    About `sample` cells are, all of fewer: those whose hash lies in a share of its range, so nothing is sorted and reruns agree.
    """
    n = F.broadcast(totals.agg(F.count(F.lit(1)).alias("n_cells")))
    place = F.conv(F.substring(F.md5("cell_id"), 1, 8), 16, 10).cast("bigint")
    drawn = place < F.lit(float(1 << 32)) * sample / F.col("n_cells")
    return totals.join(n).select("cell_id", "x", "y", F.log10(F.col("n_count") + 1).alias("log_count"), (F.col("n_count") < cutoff).alias("below"), drawn.alias("drawn"))


def volcano(rows: DataFrame, p: str, alpha: float = 0.05) -> DataFrame:
    """rows with minus_log10_p and significant; a p of 0 gives null."""
    return rows.withColumn("minus_log10_p", -F.log10(F.when(F.col(p) > 0, F.col(p)))).withColumn("significant", F.col(p) < alpha)


def group_summary(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """(by, mean, sd): of the values that are there."""
    return rows.groupBy(*by).agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"))


def kernel_intensity(edges: DataFrame, points: DataFrame, subset: str, key: str, sigma: float) -> DataFrame:
    """(subset, key, intensity): Gaussian kernel density at each point, over the neighbours in `edges` and the point itself.

    edges should reach about four sigma. No edge correction.
    """
    peak = 1 / (2 * math.pi * sigma * sigma)
    near = edges.groupBy(F.col("src").alias(key)).agg(F.sum(F.exp(-F.col("dist") * F.col("dist") / (2 * sigma * sigma))).alias("s"))
    return points.select(subset, key).join(near, key, "left").select(subset, key, ((F.coalesce("s", F.lit(0.0)) + 1) * peak).alias("intensity"))


def inhomogeneity(counts: DataFrame, intensity: DataFrame, subset: str) -> DataFrame:
    """(subset, n, chi2, df, vmr, cv): quadrat dispersion and the variation of the kernel intensity."""
    from .spatial import quadrat_test

    sd = F.stddev_samp("intensity")
    cv = intensity.groupBy(subset).agg((sd / F.avg("intensity")).alias("cv"))
    return quadrat_test(counts, subset).join(cv, subset, "left")


def spread_scores(scores: DataFrame, key: str, name: str, value: str, names: list[str]) -> DataFrame:
    """(key, one auc_score_<name> column each)."""
    wide = scores.groupBy(key).pivot(name, names).agg(F.first(value))
    return wide.select(key, *[F.col(f"`{n}`").alias(f"auc_score_{n}") for n in names])
