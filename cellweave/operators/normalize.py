"""Normalization of the count triples, gene moments, variable features, z-scores."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.levels import few


def normalized_counts(counts: DataFrame, min_counts: int, axis: str = "cell") -> DataFrame:
    """counts with norm = count / max(total, min_counts); the total is that of the cell, or with axis='gene' of the gene."""
    key = {"cell": "cell_id", "gene": "gene"}[axis]
    totals = counts.groupBy(key).agg(F.sum("count").alias("total"))
    return counts.join(totals, key).withColumn("norm", F.col("count") / F.greatest(F.col("total"), F.lit(min_counts))).drop("total")


def scale_factors(totals: DataFrame) -> DataFrame:
    """One row: host (mean of RNA and bacterial counts per cell) and host_16S (mean RNA count)."""
    return totals.agg(F.avg(F.col("n_count") + F.col("n_bac")).alias("host"), F.avg("n_count").alias("host_16S"))


def log_normalized(norm: DataFrame, factors: DataFrame) -> DataFrame:
    """norm with scaled = norm * host factor and logged = ln(1 + scaled)."""
    one = F.broadcast(factors.select(F.col("host").alias("f")).limit(1))
    return norm.join(one).withColumn("scaled", F.col("norm") * F.col("f")).withColumn("logged", F.log1p("scaled")).drop("f")


def background_normalized(counts: DataFrame, n_cells: int, n_negatives: int) -> DataFrame:
    """Bacterial counts over the mean of the negative probe matrix, zeros included; null if there is no background."""
    rate = counts.where(F.col("assay") == "negative").agg((F.coalesce(F.sum("count"), F.lit(0)) / F.lit(float(n_cells * n_negatives))).alias("rate"))
    return (
        counts.where(F.col("assay") == "bacterial")
        .join(F.broadcast(rate))
        .select("cell_id", "gene", F.when(F.col("rate") > 0, F.col("count") / F.col("rate")).alias("norm"))
    )


def variation(moments: DataFrame, cutoff: float | None) -> DataFrame:
    """(gene, cv, kept): coefficient of variation; kept where above its quantile `cutoff`, all if that is not in [0, 1]."""
    cv = moments.withColumn("cv", F.when(F.col("mean") != 0, F.col("sd") / F.col("mean")))
    if cutoff is None or not 0 <= cutoff <= 1:
        return cv.select("gene", "cv", F.lit(True).alias("kept"))
    limit = F.broadcast(cv.agg(F.percentile("cv", F.lit(float(cutoff))).alias("limit")))
    return cv.join(limit).select("gene", "cv", F.coalesce(F.col("cv") > F.col("limit"), F.lit(False)).alias("kept"))


def z_scores(counts: DataFrame, moments: DataFrame, value: str = "count", clip: float | None = None) -> DataFrame:
    """(cell_id, gene, z) of the non-zero entries; absent entries have the gene's `z_zero` = -mean / sd."""
    z = (F.col(value) - F.col("mean")) / F.when(F.col("sd") > 0, F.col("sd"))
    z = z if clip is None else F.least(z, F.lit(float(clip)))
    return counts.join(moments.select("gene", "mean", "sd"), "gene").select("cell_id", "gene", z.alias("z"), (-F.col("mean") / F.when(F.col("sd") > 0, F.col("sd"))).alias("z_zero"))


def local_fit(x: np.ndarray, y: np.ndarray, span: float = 0.3) -> np.ndarray:
    """Local quadratic regression of y on x at each x: the nearest `span` of the points, weighted by the tricube of their distance (Cleveland 1979)."""
    n = len(x)
    q = min(n, max(4, int(np.ceil(span * n))))
    fitted = np.empty(n)
    for i in range(n):
        far = np.abs(x - x[i])
        near = np.argpartition(far, q - 1)[:q]
        width = far[near].max()
        w = np.sqrt(np.maximum(1 - (far[near] / width) ** 3, 0) ** 3) if width > 0 else np.ones(q)
        d = x[near] - x[i]
        fitted[i] = np.linalg.lstsq(np.stack([w, w * d, w * d * d], axis=1), w * y[near], rcond=None)[0][0]
    return fitted


def variable_features(counts: DataFrame, moments: DataFrame, n: int, span: float = 0.3) -> DataFrame:
    """(gene, standardized, rank): the n genes whose variance most exceeds what their mean lets expect.

    log10 variance is fitted on log10 mean by a local regression; values are standardized by
    the fitted sd, clipped at the root of the number of cells, and the variance of these is ranked. The fit is made on the driver from one row per
    gene of the panel; more genes than a factor may have levels are refused.
    """
    m = moments.where((F.col("mean") > 0) & (F.col("sd") > 0)).withColumns({"lx": F.log10("mean"), "ly": F.log10(F.pow("sd", F.lit(2)))})
    rows = sorted(few(m.select("gene", "lx", "ly")), key=lambda r: r["gene"])
    fitted = local_fit(np.array([r["lx"] for r in rows]), np.array([r["ly"] for r in rows]), span) if rows else []
    expected = moments.sparkSession.createDataFrame([(r["gene"], float(10 ** (f / 2))) for r, f in zip(rows, fitted, strict=True)], "gene string, expected double")
    m = m.join(expected, "gene").select("gene", "n_cells", "mean", "expected")
    top = F.sqrt(F.col("n_cells").cast("double"))
    z = F.least((F.col("count") - F.col("mean")) / F.col("expected"), top)
    zero = F.first(-F.col("mean") / F.col("expected"))
    n_zero = F.first("n_cells") - F.count(F.lit(1))
    ranked = (
        counts.join(m, "gene")
        .groupBy("gene")
        .agg(((F.sum(z * z) + n_zero * zero * zero) / (F.first("n_cells") - 1)).alias("standardized"))
    )
    return ranked.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("standardized"), "gene"))).where(F.col("rank") <= n)
