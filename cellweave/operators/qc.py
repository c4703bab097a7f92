"""Quality control of cells, probes and targets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.tails import t_upper_col
from ..functions.values import ratio


@dataclass(frozen=True)
class Limits:
    """Cutoffs of the cell flags."""

    min_counts: int = 200
    min_features: int = 200
    max_negative: float = 0.1
    min_complexity: float = 1.0
    max_area: float = 30000.0
    min_signal: float = 4.0
    min_cells_per_fov: int = 50
    area_alpha: float = 0.01
    negative_alpha: float = 0.01
    detection_alpha: float = 0.01


def cell_totals(cells: DataFrame, counts: DataFrame) -> DataFrame:
    """cells with n_count, n_feature, n_neg and n_bac; cells without counts have 0.

    One aggregation of the count triples, partial sums before the shuffle, left-joined by cell.
    """
    of = lambda assay, what: F.coalesce(F.sum(F.when(F.col("assay") == assay, what)), F.lit(0)).cast("bigint")
    sums = counts.groupBy("cell_id").agg(
        of("RNA", F.col("count")).alias("n_count"),
        of("RNA", F.when(F.col("count") > 0, 1).otherwise(0)).alias("n_feature"),
        of("negative", F.col("count")).alias("n_neg"),
        of("bacterial", F.col("count")).alias("n_bac"),
    )
    return cells.join(sums, "cell_id", "left").fillna(0, ["n_count", "n_feature", "n_neg", "n_bac"])


def cell_metrics(totals: DataFrame, n_genes: int, n_negatives: int) -> DataFrame:
    """totals with proportion_negative, complexity and signal_strength.

    Null where 0 is divided by 0; infinite signal where a cell has RNA and no negative counts.
    """
    count, neg = F.col("n_count").cast("double"), F.col("n_neg").cast("double")
    return totals.withColumns(
        {
            "proportion_negative": ratio(neg, count + neg),
            "complexity": ratio(count, F.col("n_feature").cast("double")),
            "signal_strength": ratio(count / F.lit(float(n_genes)), neg / F.lit(float(n_negatives))),
        }
    )


def cell_flags(metrics: DataFrame, limits: Limits, area_outliers: DataFrame | None = None) -> DataFrame:
    """metrics with one nullable flag per criterion and `flagged`.

    flagged combines minimum counts, negative proportion, complexity and area outlier; it is null where one of these is
    unknown, as a sum is, so that a filter on false drops such cells. area_outliers: (area), the values that count as
    outliers; without it no area does. A missing area is no outlier.
    """
    flags = metrics.withColumns(
        {
            "flag_counts": F.col("n_count") < limits.min_counts,
            "flag_features": F.col("n_feature") < limits.min_features,
            "flag_negative": ~(F.col("proportion_negative") < limits.max_negative),
            "flag_complexity": ~(F.col("complexity") >= limits.min_complexity),
            "flag_signal": ~(F.col("signal_strength") >= limits.min_signal),
        }
    )
    if area_outliers is None:
        flags = flags.withColumn("flag_area", F.lit(False))
    else:
        known_outliers = area_outliers.select("area").where(F.col("area").isNotNull()).distinct().withColumn("flag_area", F.lit(True))
        flags = flags.join(known_outliers, "area", "left").fillna(False, ["flag_area"])
    parts = ["flag_counts", "flag_negative", "flag_complexity", "flag_area"]
    known = sum((F.col(p).cast("int") for p in parts[1:]), F.col(parts[0]).cast("int"))
    return flags.withColumn("flagged", known > 0)


def count_outliers(totals: DataFrame, by: str, total: str = "n_count") -> DataFrame:
    """(cell_id, by, total, flag): outside median - IQR to median + IQR of its tissue."""
    q = totals.groupBy(by).agg(F.percentile(total, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q"))
    iqr, median = F.col("q")[2] - F.col("q")[0], F.col("q")[1]
    return totals.join(q, by).select("cell_id", by, total, (~F.col(total).between(median - iqr, median + iqr)).alias("flag_outlier"))


def qc_summary(metrics: DataFrame, limits: Limits, fov: str = "fov") -> DataFrame:
    """(metric, value): means, flagged counts and percentages over all cells, and figures per FOV."""
    n = F.count(F.lit(1))
    low = lambda c, t: F.count_if(F.col(c) < t)
    high = lambda c, t: F.count_if(F.col(c) > t)
    finite = F.when(F.abs("signal_strength") < float("inf"), F.col("signal_strength"))
    by_metric = [
        ("total_counts", F.avg("n_count"), low("n_count", limits.min_counts)),
        ("total_features", F.avg("n_feature"), low("n_feature", limits.min_features)),
        ("proportion_negative", F.avg("proportion_negative"), high("proportion_negative", limits.max_negative)),
        ("complexity", F.avg("complexity"), low("complexity", limits.min_complexity)),
        ("area", F.avg("area"), high("area", limits.max_area)),
        ("signal_strength", F.avg(finite), low("signal_strength", limits.min_signal)),
    ]
    rows = [F.struct(F.lit("total_cells").alias("metric"), n.cast("double").alias("value"))]
    for name, mean, flagged in by_metric:
        rows += [
            F.struct(F.lit(f"average_{name}").alias("metric"), F.round(mean, 2).alias("value")),
            F.struct(F.lit(f"flagged_{name}").alias("metric"), flagged.cast("double").alias("value")),
            F.struct(F.lit(f"percent_{name}").alias("metric"), F.round(F.lit(100.0) * flagged / n, 2).alias("value")),
        ]
    cell_rows = metrics.agg(F.array(*rows).alias("r"))
    few = F.count_if(F.col("n") < limits.min_cells_per_fov)
    fov_rows = metrics.groupBy(fov).agg(n.alias("n")).where(F.col(fov).isNotNull()).agg(
        F.array(
            F.struct(F.lit("total_fovs").alias("metric"), n.cast("double").alias("value")),
            F.struct(F.lit("average_cells_per_fov").alias("metric"), F.round(F.avg("n"), 2).alias("value")),
            F.struct(F.lit("fovs_with_few_cells").alias("metric"), few.cast("double").alias("value")),
            F.struct(F.lit("percent_fovs_with_few_cells").alias("metric"), F.round(F.lit(100.0) * few / n, 2).alias("value")),
        ).alias("r")
    )
    return cell_rows.unionByName(fov_rows).select(F.inline("r"))


def flagged_table(metrics: DataFrame, limits: Limits) -> DataFrame:
    """(stat, n): cells beyond each cutoff, beyond any, beyond none, and all. A missing negative proportion counts as 0."""
    tests = {
        "min_counts": F.col("n_count") < limits.min_counts,
        "min_features": F.col("n_feature") < limits.min_features,
        "max_negative": F.coalesce("proportion_negative", F.lit(0.0)) > limits.max_negative,
        "min_complexity": F.col("complexity") < limits.min_complexity,
        "max_area": F.col("area") > limits.max_area,
        "min_signal": F.col("signal_strength") < limits.min_signal,
    }
    tests = {k: F.coalesce(t, F.lit(False)) for k, t in tests.items()}
    anyone = F.lit(False)
    for t in tests.values():
        anyone = anyone | t
    sums = {**{k: F.count_if(t) for k, t in tests.items()}, "total_flagged": F.count_if(anyone), "total_passed": F.count_if(~anyone), "all_cells": F.count(F.lit(1))}
    rows = [F.struct(F.lit(k).alias("stat"), s.alias("n")) for k, s in sums.items()]
    return metrics.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def bacterial_stats(totals: DataFrame, by: str = "slide") -> DataFrame:
    """Median and quartiles of bacterial counts per slide."""
    q = F.percentile("n_bac", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return totals.groupBy(by).agg(q.alias("q")).select(by, F.col("q")[0].alias("q25"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q75"))


def contingency(rows: DataFrame, a: str, b: str) -> DataFrame:
    """Number of rows per pair of values."""
    return rows.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))


def extremes(rows: DataFrame, value: str) -> DataFrame:
    """One row of n, lowest, highest, mean and sd with Grubbs' statistics.

    g10 = max |x - mean| / sd tests one outlier, g11 = (max - min) / sd both ends together; t10 and t11 are the
    matching Student statistics with n - 2 degrees of freedom.
    """
    v = F.col(value)
    moments = rows.where(v.isNotNull()).agg(
        F.count(v).alias("n"), F.min(v).alias("lowest"), F.max(v).alias("highest"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("sd")
    )
    n, sd = F.col("n"), F.when(F.col("sd") > 0, F.col("sd"))
    with_g = moments.withColumn(
        "g10", F.greatest(F.col("highest") - F.col("mean"), F.col("mean") - F.col("lowest")) / sd
    ).withColumn("g11", (F.col("highest") - F.col("lowest")) / sd)
    den10 = (n - 1) * (n - 1) - n * F.pow("g10", F.lit(2))
    den11 = 2 * (n - 1) - F.pow("g11", F.lit(2))
    return with_g.withColumn("t10", F.when(den10 > 0, F.sqrt(n * (n - 2) * F.pow("g10", F.lit(2)) / den10))).withColumn(
        "t11", F.when(den11 > 0, F.sqrt((n - 2) * F.pow("g11", F.lit(2)) / den11))
    )


def grubbs(found: DataFrame) -> DataFrame:
    """`extremes` with two-sided p values p10 and p11; a statistic beyond its range has p = 0."""
    n = F.col("n")
    p = lambda t, times: F.when(n > 2, F.least(F.lit(1.0), 2 * times * F.coalesce(t_upper_col(F.col(t), n - 2), F.lit(0.0))))
    return found.withColumn("p10", p("t10", n)).withColumn("p11", p("t11", n * (n - 1)))


def area_outliers(cells: DataFrame, alpha: float, value: str = "area") -> DataFrame:
    """(area): the lowest and the highest value if both together are outliers by Grubbs' test of two ends, else no row."""
    return grubbs(extremes(cells, value)).where(F.col("p11") < alpha).select(F.explode(F.array("lowest", "highest")).alias(value)).distinct()


def negative_outliers(moments: DataFrame, alpha: float) -> DataFrame:
    """(gene, mean, p, outlier): negative probes; an outlier's mean is the one farthest from the others, p that of Grubbs' test for one."""
    probes = moments.where(F.col("assay") == "negative")
    found = grubbs(extremes(probes, "mean")).select(
        F.col("p10").alias("p"), F.when(F.col("highest") - F.col("mean") >= F.col("mean") - F.col("lowest"), F.col("highest")).otherwise(F.col("lowest")).alias("far")
    )
    low = F.coalesce((F.col("p") < alpha) & (F.col("mean") == F.col("far")), F.lit(False))
    return probes.join(F.broadcast(found)).select("gene", "mean", "p", low.alias("outlier"))


def flagged_targets(tested: DataFrame, below: DataFrame, by_quantile: bool, by_detection: bool) -> DataFrame:
    """(gene): targets to be left out: below the negative quantile, undetected, or both where both are asked for."""
    genes = tested.select("gene", "flag_detection").join(below.select("gene", "flag_below"), "gene")
    flag = {(True, True): F.col("flag_detection") & F.col("flag_below"), (True, False): F.col("flag_below"), (False, True): F.col("flag_detection")}
    return genes.where(flag.get((by_quantile, by_detection), F.lit(False))).select("gene")


def filtered(
    cells: DataFrame, counts: DataFrame, cells_flagged: DataFrame | None, fovs_flagged: DataFrame | None, targets: DataFrame | None, negatives: DataFrame | None, pre_qc: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Cells and counts without what was flagged; pre_qc filters nothing, whatever is given.

    cells_flagged: (cell_id, flagged), of which only false ones stay; fovs_flagged: (fov); targets and negatives: (gene), left out of their assay only.
    Counts of cells that go are left out.
    """
    if pre_qc:
        return cells, counts
    if cells_flagged is not None:
        cells = cells.join(cells_flagged.where(~F.col("flagged")).select("cell_id"), "cell_id", "left_semi")
    if fovs_flagged is not None:
        cells = cells.join(fovs_flagged.select("fov").distinct(), "fov", "left_anti")
    for assay, genes in (("RNA", targets), ("negative", negatives)):
        if genes is not None:
            counts = counts.join(genes.select("gene", F.lit(assay).alias("assay")).distinct(), ["gene", "assay"], "left_anti")
    return cells, counts.join(cells.select("cell_id"), "cell_id", "left_semi")


def gene_moments(counts: DataFrame, genes: DataFrame, n_cells: int, value: str = "count") -> DataFrame:
    """(gene, assay, n_cells, mean, sd): over all cells, cells without an entry count as 0; genes without any too."""
    v = F.col(value).cast("double")
    sums = counts.groupBy("gene").agg(F.sum(v).alias("s1"), F.sum(v * v).alias("s2"))
    n = F.lit(float(n_cells))
    s1, s2 = F.coalesce("s1", F.lit(0.0)), F.coalesce("s2", F.lit(0.0))
    spread = F.when(F.lit(n_cells > 1), F.greatest(F.lit(0.0), (s2 - s1 * s1 / n) / (n - 1)))
    return genes.select("gene", "assay").join(sums, "gene", "left").select("gene", "assay", F.lit(n_cells).cast("bigint").alias("n_cells"), (s1 / n).alias("mean"), F.sqrt(spread).alias("sd"))


def below_negatives(moments: DataFrame, quantile: float) -> DataFrame:
    """RNA genes with their mean, the quantile of the negative probes' means, and whether they lie below it."""
    limit = moments.where(F.col("assay") == "negative").agg(F.percentile("mean", F.lit(quantile)).alias("limit"))
    return moments.where(F.col("assay") == "RNA").join(F.broadcast(limit)).select("gene", "mean", "limit", (F.col("mean") < F.col("limit")).alias("flag_below"))


def welch_against_negatives(moments: DataFrame) -> DataFrame:
    """(gene, mean, t, df): Welch's t of each RNA gene's counts against the means of the negative probes."""
    control = moments.where(F.col("assay") == "negative").agg(F.count(F.lit(1)).alias("m"), F.avg("mean").alias("c_mean"), F.var_samp("mean").alias("c_var"))
    a, b = F.col("sd") * F.col("sd") / F.col("n_cells"), F.col("c_var") / F.col("m")
    both = F.when(a + b > 0, a + b)
    return (
        moments.where(F.col("assay") == "RNA")
        .join(F.broadcast(control))
        .select("gene", "mean", ((F.col("mean") - F.col("c_mean")) / F.sqrt(both)).alias("t"), (both * both / (a * a / (F.col("n_cells") - 1) + b * b / (F.col("m") - 1))).alias("df"))
    )


def adjusted(rows: DataFrame, p: str, by: list[str] | None = None, key: str | None = None) -> DataFrame:
    """rows with p_adj: Benjamini and Hochberg within each group of `by`; null p values take no part."""
    groups = by or []
    up = Window.partitionBy(*[F.col(b) for b in groups], F.col(p).isNull()).orderBy(F.col(p).asc(), *([F.col(key)] if key else []))
    n = F.count(p).over(Window.partitionBy(*groups)) if groups else F.count(p).over(Window.partitionBy(F.lit(0)))
    stepped = rows.withColumn("bh_raw", F.when(F.col(p).isNotNull(), F.col(p) * n / F.row_number().over(up)))
    from_here = up.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    return stepped.withColumn("p_adj", F.when(F.col(p).isNotNull(), F.least(F.lit(1.0), F.min("bh_raw").over(from_here)))).drop("bh_raw")


def undetected_targets(welch: DataFrame, below: DataFrame, cutoff: float = 0.01) -> DataFrame:
    """(gene, p, p_adj, flag_detection, flag_both): one-sided test that a gene lies below background.

    Both flags: significantly below by the test, and below the quantile of the negative probes.
    """
    tested = adjusted(welch.withColumn("p", t_upper_col(-F.col("t"), F.col("df"))), "p", key="gene")
    low = F.col("p_adj") < cutoff
    return tested.join(below.select("gene", "flag_below"), "gene").select(
        "gene", "p", "p_adj", low.alias("flag_detection"), (low & F.col("flag_below")).alias("flag_both")
    )
