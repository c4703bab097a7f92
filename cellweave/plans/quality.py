"""Queries of quality control, normalization and molecule-level operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.tails_sql import t_upper
from ..functions.values import value
from ..operators import normalize, qc, transcripts
from ..sources.tables import table
from . import domain

LIMITS = qc.Limits(min_counts=5, min_features=3, max_negative=0.1, min_complexity=1.2, max_area=8000.0, min_signal=4.0, min_cells_per_fov=200)
MIN_TOTAL = 10


def _sizes(spark: SparkSession, sf_dir: str) -> tuple[int, int]:
    """Number of RNA genes and of negative probes, from the probe table."""
    n = domain.genes(spark, sf_dir).agg(F.count_if(F.col("assay") == "RNA"), F.count_if(F.col("assay") == "negative")).first()
    return n[0], n[1]


def _totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qc.cell_totals(domain.cells(spark, sf_dir), domain.counts(spark, sf_dir))


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qc.cell_metrics(_totals(spark, sf_dir), *_sizes(spark, sf_dir))


def cell_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _totals(spark, sf_dir).select("cell_id", "n_count", "n_feature", "n_neg", "n_bac")


def _flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qc.cell_flags(_metrics(spark, sf_dir), LIMITS, qc.area_outliers(domain.cells(spark, sf_dir), LIMITS.area_alpha))


def qc_cell_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ["cell_id", "flag_counts", "flag_features", "flag_negative", "flag_complexity", "flag_signal", "flag_area", "flagged"]
    return _flags(spark, sf_dir).select(*cols)


def qc_flags_by_slide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells passed, flagged and undecided per slide."""
    return _flags(spark, sf_dir).groupBy("slide").agg(
        F.count_if(F.col("flagged")).alias("n_flagged"), F.count_if(~F.col("flagged")).alias("n_passed"), F.count_if(F.col("flagged").isNull()).alias("n_unknown")
    )


def qc_passed_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flags(spark, sf_dir).where(~F.col("flagged")).select("cell_id", "slide", "fov")


def qc_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qc.qc_summary(_metrics(spark, sf_dir), LIMITS)


def qc_count_outliers_by_slide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qc.count_outliers(_totals(spark, sf_dir), "slide")


def qc_flagged_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qc.flagged_table(_metrics(spark, sf_dir), LIMITS)


def bacterial_stats_by_slide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qc.bacterial_stats(_totals(spark, sf_dir))


def bacterial_contingency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qc.contingency(_totals(spark, sf_dir), "slide", "n_bac")


def area_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qc.extremes(domain.cells(spark, sf_dir), "area").select("n", "lowest", "highest", *[F.round(c, 5).alias(c) for c in ("mean", "sd", "g10", "g11", "t10", "t11")])


def area_grubbs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qc.grubbs(qc.extremes(domain.cells(spark, sf_dir), "area")).select("n", "lowest", "highest", *[F.round(c, 6).alias(c) for c in ("t10", "t11", "p10", "p11")])


def _moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = domain.cells(spark, sf_dir).count()
    return qc.gene_moments(domain.counts(spark, sf_dir), domain.genes(spark, sf_dir).where(F.col("assay") != "system"), n)


def gene_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _moments(spark, sf_dir).select("gene", "assay", "n_cells", F.round("mean", 8).alias("mean"), F.round("sd", 6).alias("sd"))


def probe_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _moments(spark, sf_dir).where(F.col("assay") == "negative").select("gene", F.round("mean", 8).alias("mean"))


def neg_probe_extreme(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = _moments(spark, sf_dir).where(F.col("assay") == "negative")
    return qc.extremes(means, "mean").select("n", *[F.round(c, 6).alias(c) for c in ("lowest", "highest", "mean", "sd", "g10", "t10")])


def neg_probe_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = qc.negative_outliers(_moments(spark, sf_dir), LIMITS.negative_alpha)
    return found.select("gene", F.round("mean", 8).alias("mean"), F.round("p", 6).alias("p"), "outlier")


def target_below_negative_quantile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qc.below_negatives(_moments(spark, sf_dir), 0.5).select("gene", F.round("mean", 8).alias("mean"), F.round("limit", 8).alias("limit"), "flag_below")


def target_welch_t(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qc.welch_against_negatives(_moments(spark, sf_dir)).select("gene", F.round("mean", 8).alias("mean"), F.round("t", 5).alias("t"), F.round("df", 3).alias("df"))


def _tested(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _moments(spark, sf_dir)
    return qc.undetected_targets(qc.welch_against_negatives(m), qc.below_negatives(m, 0.5), LIMITS.detection_alpha)


def target_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tested(spark, sf_dir).select("gene", F.round("p", 5).alias("p"), F.round("p_adj", 4).alias("p_adj"), "flag_detection", "flag_both")


def norm_counts_cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.normalized_counts(domain.counts(spark, sf_dir).where("assay = 'RNA'"), MIN_TOTAL).select("cell_id", "gene", F.round("norm", 9).alias("norm"))


def norm_counts_gene(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.normalized_counts(domain.counts(spark, sf_dir).where("assay = 'RNA'"), MIN_TOTAL, "gene").select("cell_id", "gene", F.round("norm", 9).alias("norm"))


def scale_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.scale_factors(_totals(spark, sf_dir)).select(F.round("host", 8).alias("host"), F.round("host_16S", 8).alias("host_16S"))


def log1p_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    norm = normalize.normalized_counts(domain.counts(spark, sf_dir).where("assay = 'RNA'"), MIN_TOTAL)
    logged = normalize.log_normalized(norm, normalize.scale_factors(_totals(spark, sf_dir)))
    return logged.select("cell_id", "gene", F.round("scaled", 7).alias("scaled"), F.round("logged", 7).alias("logged"))


def bacterial_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = domain.cells(spark, sf_dir).count()
    found = normalize.background_normalized(domain.counts(spark, sf_dir), n, _sizes(spark, sf_dir)[1])
    return found.select("cell_id", "gene", F.round("norm", 5).alias("norm"))


def gene_cv_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.variation(_moments(spark, sf_dir).where("assay = 'RNA' AND mean > 0"), 0.25).select("gene", F.round("cv", 6).alias("cv"), "kept")


def gene_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    z = normalize.z_scores(domain.counts(spark, sf_dir), _moments(spark, sf_dir), clip=10)
    return z.select("cell_id", "gene", F.round("z", 5).alias("z"), F.round("z_zero", 5).alias("z_zero"))


def variable_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.variable_features(domain.counts(spark, sf_dir).where("assay = 'RNA'"), _moments(spark, sf_dir).where("assay = 'RNA'"), 200)


def _molecules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Molecules inside cells, at a measured place; NaN is no value."""
    kept = table(spark, sf_dir, "transcripts").where(F.col("cell").isNotNull() & (F.col("cell") != "c_0_0_0_0"))
    return kept.withColumns({c: value(F.col(c)) for c in ("x_local_px", "y_local_px", "z")})


TARGET_16S = "RUVK9"


def transcript_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    boxes = transcripts.cell_boxes(_molecules(spark, sf_dir))
    return boxes.select("cell", "n", *[F.round(f"{w}_{a}", 6).alias(f"{w}_{a}") for a in "xyz" for w in ("median", "low", "high")])


def _marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    molecules = _molecules(spark, sf_dir)
    return transcripts.inside_box(molecules, transcripts.cell_boxes(molecules), TARGET_16S)


def transcript_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Molecules of the 16S target by their confidence per axis."""
    return _marked(spark, sf_dir).groupBy("x_confidence", "y_confidence", "z_confidence", "confidence").agg(F.count(F.lit(1)).alias("n"))


def transcript_intracellular(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transcripts.intracellular(domain.cells(spark, sf_dir).select("cell_id", "slide"), _marked(spark, sf_dir))


def expression_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = _totals(spark, sf_dir).select("cell_id", "n_count")
    return transcripts.expression_levels(totals, "n_count")


def bacterial_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    located = transcripts.intracellular(_totals(spark, sf_dir).select("cell_id", "n_bac"), _marked(spark, sf_dir))
    return transcripts.bacterial_state(transcripts.expression_levels(located, "n_bac")).select("cell_id", "level", "location", "state")


def filter_include_exclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = transcripts.apply_filters(domain.cells(spark, sf_dir), "timepoint,exclude,week4;cell_type,Include,tumor,fibroblast;nowhere,include,1")
    return rows.select("cell_id", "timepoint", "cell_type")


def neovariable(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = transcripts.neovariable(domain.cells(spark, sf_dir), "timepoint+cell_type")
    return made.groupBy("timepoint_cell_type").agg(F.count(F.lit(1)).alias("n"))


def top_k_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transcripts.best_rows(domain.cells(spark, sf_dir).where("area IS NOT NULL"), "fov", [F.desc("area"), F.col("cell_id")], 10).select("fov", "cell_id", "area", "place")


def top_ties_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First five cells per FOV by bacterial count, ties kept."""
    rows = _totals(spark, sf_dir).where("n_bac > 0")
    return transcripts.best_rows(rows, "fov", [F.desc("n_bac")], 5, ties=True).select("fov", "cell_id", "n_bac", "place")


def bh_adjust(spark: SparkSession, sf_dir: str) -> DataFrame:
    """1 - prob_DE as p, adjusted within run and cell type."""
    rows = table(spark, sf_dir, "de_results").where(F.col("prob_DE").between(0, 1) & F.col("gene").isNotNull())
    p = rows.groupBy("run_ID", "cell_type", "gene").agg(F.round(1 - F.max("prob_DE"), 9).alias("p"))
    return qc.adjusted(p, "p", ["run_ID", "cell_type"], "gene").select("run_ID", "cell_type", "gene", "p", F.round("p_adj", 7).alias("p_adj"))


def fov_bbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transcripts.bounding_boxes(domain.points(spark, sf_dir), "fov")


def histogram_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transcripts.histogram_bins(domain.cells(spark, sf_dir), "area", 50)


def shared_columns_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = table(spark, sf_dir, "metadata"), table(spark, sf_dir, "expr_counts")
    return transcripts.shared_columns_union([a, b]).groupBy("slide_no", "fov").agg(F.count(F.lit(1)).alias("n"), F.max("cell_ID").alias("last_cell"))


def downsample_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transcripts.downsampled(domain.cells(spark, sf_dir), "cell_type", "cell_id", 30, 7).select("cell_type", "cell_id")


QUERIES = {
    f.__name__: f
    for f in (
        cell_totals, qc_cell_flags, qc_flags_by_slide, qc_passed_cells, qc_summary, qc_count_outliers_by_slide, qc_flagged_table,
        bacterial_stats_by_slide, bacterial_contingency, area_extremes, area_grubbs, gene_moments, probe_means, neg_probe_extreme, neg_probe_outliers,
        target_below_negative_quantile, target_welch_t, target_detection, norm_counts_cell, norm_counts_gene, scale_factors, log1p_norm,
        bacterial_norm, gene_cv_filter, gene_zscore, variable_features, transcript_box, transcript_confidence, transcript_intracellular,
        expression_levels, bacterial_state, filter_include_exclude, neovariable, top_k_per_group, top_ties_per_group, bh_adjust, fov_bbox,
        histogram_bins, shared_columns_union, downsample_per_group,
    )
}

_L = LIMITS
_GRUBBS = """SELECT n, lowest, highest, mean, sd, g10, g11, t10, t11, least(1.0, 2 * n * coalesce({p10}, 0.0)) AS p10, least(1.0, 2 * n * (n - 1) * coalesce({p11}, 0.0)) AS p11 FROM (
    SELECT *, sqrt(CASE WHEN (n - 1) * (n - 1) - n * g10 * g10 > 0 THEN n * (n - 2) * g10 * g10 / ((n - 1) * (n - 1) - n * g10 * g10) END) AS t10,
        sqrt(CASE WHEN 2 * (n - 1) - g11 * g11 > 0 THEN (n - 2) * g11 * g11 / (2 * (n - 1) - g11 * g11) END) AS t11
    FROM (SELECT *, greatest(highest - mean, mean - lowest) / sd AS g10, (highest - lowest) / sd AS g11 FROM (
        SELECT count({v}) AS n, min({v}) AS lowest, max({v}) AS highest, avg({v}) AS mean, stddev_samp({v}) AS sd FROM {t})))"""


def _grubbs(value: str, source: str) -> str:
    return _GRUBBS.replace("{p10}", t_upper("t10", "n - 2")).replace("{p11}", t_upper("t11", "n - 2")).replace("{v}", value).replace("{t}", source)


_TOTALS = (
    domain.SQL
    + """, totals AS (
        SELECT c.*, coalesce(s.n_count, 0)::BIGINT AS n_count, coalesce(s.n_feature, 0)::BIGINT AS n_feature,
            coalesce(s.n_neg, 0)::BIGINT AS n_neg, coalesce(s.n_bac, 0)::BIGINT AS n_bac
        FROM cells c LEFT JOIN (
            SELECT cell_id, sum(count) FILTER (assay = 'RNA') AS n_count, count(*) FILTER (assay = 'RNA') AS n_feature,
                sum(count) FILTER (assay = 'negative') AS n_neg, sum(count) FILTER (assay = 'bacterial') AS n_bac
            FROM counts GROUP BY cell_id
        ) s ON c.cell_id = s.cell_id
    ), sizes AS (SELECT count(*) FILTER (assay = 'RNA') AS ng, count(*) FILTER (assay = 'negative') AS nn FROM probes
    ), metrics AS (
        SELECT t.*,
            CASE WHEN n_count + n_neg > 0 THEN n_neg::DOUBLE / (n_count + n_neg) END AS proportion_negative,
            CASE WHEN n_feature > 0 THEN n_count::DOUBLE / n_feature END AS complexity,
            CASE WHEN n_neg > 0 THEN (n_count::DOUBLE / ng) / (n_neg::DOUBLE / nn) WHEN n_count > 0 THEN 'inf'::DOUBLE END AS signal_strength
        FROM totals t, sizes
    ), area_ends AS (SELECT lowest, highest FROM ({grubbs}) WHERE p11 < {alpha}
    ), flags AS (
        SELECT *, coalesce(area IN (SELECT lowest FROM area_ends UNION ALL SELECT highest FROM area_ends), false) AS flag_area, n_count < {mc} AS flag_counts, n_feature < {mf} AS flag_features, NOT (proportion_negative < {mn}) AS flag_negative,
            NOT (complexity >= {mx}) AS flag_complexity, NOT (signal_strength >= {ms}) AS flag_signal
        FROM metrics
    ), decided AS (
        SELECT *, CASE WHEN flag_negative IS NULL OR flag_complexity IS NULL THEN NULL
            ELSE flag_counts OR flag_negative OR flag_complexity OR flag_area END AS flagged
        FROM flags
    ), moments AS (
        SELECT g.gene, g.assay, n::BIGINT AS n_cells, coalesce(s1, 0) / n AS mean,
            sqrt(greatest(0.0, (coalesce(s2, 0) - coalesce(s1, 0)::DOUBLE * coalesce(s1, 0) / n) / (n - 1))) AS sd
        FROM (SELECT * FROM genes WHERE assay <> 'system') g CROSS JOIN (SELECT count(*) AS n FROM cells)
            LEFT JOIN (SELECT gene, sum(count)::DOUBLE AS s1, sum(count * count)::DOUBLE AS s2 FROM counts GROUP BY gene) s ON g.gene = s.gene
    )
""".format(mc=_L.min_counts, mf=_L.min_features, mn=_L.max_negative, mx=_L.min_complexity, ms=_L.min_signal, alpha=_L.area_alpha, grubbs=_grubbs("area", "cells"))
)
_TESTS = [
    ("total_counts", "n_count", f"n_count < {_L.min_counts}"),
    ("total_features", "n_feature", f"n_feature < {_L.min_features}"),
    ("proportion_negative", "proportion_negative", f"proportion_negative > {_L.max_negative}"),
    ("complexity", "complexity", f"complexity < {_L.min_complexity}"),
    ("area", "area", f"area > {_L.max_area}"),
    ("signal_strength", "CASE WHEN signal_strength < 'inf'::DOUBLE THEN signal_strength END", f"signal_strength < {_L.min_signal}"),
]
_SUMMARY = "SELECT 'total_cells' AS metric, count(*)::DOUBLE AS value FROM metrics"
for _name, _value, _test in _TESTS:
    _SUMMARY += f"""
    UNION ALL SELECT 'average_{_name}', round(avg({_value}), 2) FROM metrics
    UNION ALL SELECT 'flagged_{_name}', count(*) FILTER ({_test})::DOUBLE FROM metrics
    UNION ALL SELECT 'percent_{_name}', round(100.0 * count(*) FILTER ({_test}) / count(*), 2) FROM metrics"""
_FOVS = "(SELECT fov, count(*) AS n FROM metrics WHERE fov IS NOT NULL GROUP BY fov)"
_SUMMARY += f"""
    UNION ALL SELECT 'total_fovs', count(*)::DOUBLE FROM {_FOVS}
    UNION ALL SELECT 'average_cells_per_fov', round(avg(n), 2) FROM {_FOVS}
    UNION ALL SELECT 'fovs_with_few_cells', count(*) FILTER (n < {_L.min_cells_per_fov})::DOUBLE FROM {_FOVS}
    UNION ALL SELECT 'percent_fovs_with_few_cells', round(100.0 * count(*) FILTER (n < {_L.min_cells_per_fov}) / count(*), 2) FROM {_FOVS}"""
_APP = {
    "min_counts": f"n_count < {_L.min_counts}",
    "min_features": f"n_feature < {_L.min_features}",
    "max_negative": f"coalesce(proportion_negative, 0) > {_L.max_negative}",
    "min_complexity": f"coalesce(complexity < {_L.min_complexity}, false)",
    "max_area": f"coalesce(area > {_L.max_area}, false)",
    "min_signal": f"coalesce(signal_strength < {_L.min_signal}, false)",
}
_ANY = " OR ".join(f"({t})" for t in _APP.values())
_FLAGGED = " UNION ALL ".join(
    f"SELECT '{k}' AS stat, count(*) FILTER ({t}) AS n FROM metrics"
    for k, t in {**_APP, "total_flagged": _ANY, "total_passed": f"NOT ({_ANY})", "all_cells": "true"}.items()
)
_EXTREMES = """
    SELECT n, lowest, highest, mean, sd, g10, g11, sqrt(n * (n - 2) * g10 * g10 / ((n - 1) * (n - 1) - n * g10 * g10)) AS t10,
        sqrt((n - 2) * g11 * g11 / (2 * (n - 1) - g11 * g11)) AS t11
    FROM (SELECT *, greatest(highest - mean, mean - lowest) / sd AS g10, (highest - lowest) / sd AS g11 FROM (
        SELECT count({v}) AS n, min({v}) AS lowest, max({v}) AS highest, avg({v}) AS mean, stddev_samp({v}) AS sd FROM {t}))
"""
_NORM = "(SELECT *, count / greatest(sum(count) OVER (PARTITION BY {by}), %d)::DOUBLE AS norm FROM counts WHERE assay = 'RNA')" % MIN_TOTAL
_BOXES = """, mol AS (
        SELECT cell, target, CASE WHEN NOT isnan(x_local_px) THEN x_local_px * 0.12 END AS x, CASE WHEN NOT isnan(y_local_px) THEN y_local_px * 0.12 END AS y,
            CASE WHEN NOT isnan(z) THEN z END AS z
        FROM transcripts WHERE cell IS NOT NULL AND cell <> 'c_0_0_0_0'
    ), box AS (
        SELECT *, median_x - (median_x - min_x) * 0.8 AS low_x, median_x + (max_x - median_x) * 0.8 AS high_x,
            median_y - (median_y - min_y) * 0.8 AS low_y, median_y + (max_y - median_y) * 0.8 AS high_y,
            median_z - (median_z - min_z) * 0.8 AS low_z, median_z + (max_z - median_z) * 0.8 AS high_z
        FROM (SELECT cell, count(*) AS n, quantile_cont(x, 0.5) AS median_x, min(x) AS min_x, max(x) AS max_x, quantile_cont(y, 0.5) AS median_y,
            min(y) AS min_y, max(y) AS max_y, quantile_cont(z, 0.5) AS median_z, min(z) AS min_z, max(z) AS max_z FROM mol GROUP BY cell)
    ), marked AS (
        SELECT m.cell, CASE WHEN low_x < x AND x < high_x THEN 'High' ELSE 'Low' END AS x_confidence,
            CASE WHEN low_y < y AND y < high_y THEN 'High' ELSE 'Low' END AS y_confidence, CASE WHEN low_z < z AND z < high_z THEN 'High' ELSE 'Low' END AS z_confidence
        FROM mol m JOIN box b ON m.cell = b.cell WHERE target = '%s'
    ), sure AS (SELECT *, CASE WHEN x_confidence = 'High' AND y_confidence = 'High' AND z_confidence = 'High' THEN 'High' ELSE 'Low' END AS confidence FROM marked)
""" % TARGET_16S
_MOLECULES = domain.SQL + _BOXES
_DETECTION = f""", welch AS (SELECT gene, mean < lim AS flag_below, {t_upper("-(mean - cm) / sqrt(a + b)", "(a + b) * (a + b) / (a * a / (n_cells - 1) + b * b / (m - 1))")} AS p
        FROM (SELECT gene, mean, n_cells, sd * sd / n_cells AS a, cv / m AS b, cm, m, lim FROM moments,
            (SELECT count(*) AS m, avg(mean) AS cm, var_samp(mean) AS cv, quantile_cont(mean, 0.5) AS lim FROM moments WHERE assay = 'negative') WHERE assay = 'RNA')
    ), tested AS (SELECT *, p_adj < {LIMITS.detection_alpha} AS flag_detection FROM (SELECT gene, flag_below, p, least(1.0, min(raw) OVER (ORDER BY p, gene ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS p_adj
        FROM (SELECT *, p * count(*) OVER () / row_number() OVER (ORDER BY p, gene) AS raw FROM welch)))
"""
_LEVEL = """CASE WHEN {v} <= q[1] THEN 'Negative' WHEN {v} <= q[2] THEN 'Low' WHEN {v} <= q[3] THEN 'Medium' ELSE 'High' END"""
SQL = {
    "cell_totals": _TOTALS + "SELECT cell_id, n_count, n_feature, n_neg, n_bac FROM totals",
    "qc_cell_flags": _TOTALS + "SELECT cell_id, flag_counts, flag_features, flag_negative, flag_complexity, flag_signal, flag_area, flagged FROM decided",
    "qc_flags_by_slide": _TOTALS
    + "SELECT slide, count(*) FILTER (flagged) AS n_flagged, count(*) FILTER (NOT flagged) AS n_passed, count(*) FILTER (flagged IS NULL) AS n_unknown FROM decided GROUP BY slide",
    "qc_passed_cells": _TOTALS + "SELECT cell_id, slide, fov FROM decided WHERE NOT flagged",
    "qc_summary": _TOTALS + _SUMMARY,
    "qc_count_outliers_by_slide": _TOTALS
    + """SELECT t.cell_id, t.slide, t.n_count, NOT (n_count BETWEEN q[2] - (q[3] - q[1]) AND q[2] + (q[3] - q[1])) AS flag_outlier
        FROM totals t JOIN (SELECT slide, quantile_cont(n_count, [0.25, 0.5, 0.75]) AS q FROM totals GROUP BY slide) s ON t.slide = s.slide""",
    "qc_flagged_table": _TOTALS + _FLAGGED,
    "bacterial_stats_by_slide": _TOTALS
    + "SELECT slide, quantile_cont(n_bac, 0.25) AS q25, quantile_cont(n_bac, 0.5) AS median, quantile_cont(n_bac, 0.75) AS q75 FROM totals GROUP BY slide",
    "bacterial_contingency": _TOTALS + "SELECT slide, n_bac, count(*) AS n FROM totals GROUP BY 1, 2",
    "area_extremes": domain.SQL
    + "SELECT n, lowest, highest, round(mean, 5) AS mean, round(sd, 5) AS sd, round(g10, 5) AS g10, round(g11, 5) AS g11, round(t10, 5) AS t10, round(t11, 5) AS t11 FROM ("
    + _EXTREMES.format(v="area", t="cells")
    + ")",
    "area_grubbs": domain.SQL + "SELECT n, lowest, highest, " + ", ".join(f"round({c}, 6) AS {c}" for c in ("t10", "t11", "p10", "p11")) + f" FROM ({_grubbs('area', 'cells')})",
    "neg_probe_outliers": _TOTALS
    + f"""SELECT gene, round(m.mean, 8) AS mean, round(p10, 6) AS p, p10 < {LIMITS.negative_alpha} AND m.mean = CASE WHEN highest - g.mean >= g.mean - lowest THEN highest ELSE lowest END AS outlier
        FROM moments m, ({_grubbs('mean', "(SELECT mean FROM moments WHERE assay = 'negative')")}) g WHERE assay = 'negative'""",
    "target_detection": _TOTALS + _DETECTION + "SELECT gene, round(p, 5) AS p, round(p_adj, 4) AS p_adj, flag_detection, flag_detection AND flag_below AS flag_both FROM tested",
    "gene_moments": _TOTALS + "SELECT gene, assay, n_cells, round(mean, 8) AS mean, round(sd, 6) AS sd FROM moments",
    "probe_means": _TOTALS + "SELECT gene, round(mean, 8) AS mean FROM moments WHERE assay = 'negative'",
    "neg_probe_extreme": _TOTALS
    + "SELECT n, round(lowest, 6) AS lowest, round(highest, 6) AS highest, round(mean, 6) AS mean, round(sd, 6) AS sd, round(g10, 6) AS g10, round(t10, 6) AS t10 FROM ("
    + _EXTREMES.format(v="mean", t="(SELECT mean FROM moments WHERE assay = 'negative')")
    + ")",
    "target_below_negative_quantile": _TOTALS
    + """SELECT gene, round(mean, 8) AS mean, round(l, 8) AS "limit", mean < l AS flag_below
        FROM moments, (SELECT quantile_cont(mean, 0.5) AS l FROM moments WHERE assay = 'negative') WHERE assay = 'RNA'""",
    "target_welch_t": _TOTALS
    + """SELECT gene, round(mean, 8) AS mean, round((mean - cm) / sqrt(a + b), 5) AS t, round((a + b) * (a + b) / (a * a / (n_cells - 1) + b * b / (m - 1)), 3) AS df
        FROM (SELECT gene, mean, n_cells, sd * sd / n_cells AS a, cv / m AS b, cm, m FROM moments,
            (SELECT count(*) AS m, avg(mean) AS cm, var_samp(mean) AS cv FROM moments WHERE assay = 'negative') WHERE assay = 'RNA')""",
    "norm_counts_cell": domain.SQL + "SELECT cell_id, gene, round(norm, 9) AS norm FROM " + _NORM.format(by="cell_id"),
    "norm_counts_gene": domain.SQL + "SELECT cell_id, gene, round(norm, 9) AS norm FROM " + _NORM.format(by="gene"),
    "scale_factors": _TOTALS + "SELECT round(avg(n_count + n_bac), 8) AS host, round(avg(n_count), 8) AS host_16S FROM totals",
    "log1p_norm": _TOTALS
    + "SELECT cell_id, gene, round(norm * f, 7) AS scaled, round(ln(1 + norm * f), 7) AS logged FROM "
    + _NORM.format(by="cell_id")
    + ", (SELECT avg(n_count + n_bac) AS f FROM totals)",
    "bacterial_norm": _TOTALS
    + """SELECT cell_id, gene, round(count / rate, 5) AS norm FROM counts,
        (SELECT (SELECT sum(count) FROM counts WHERE assay = 'negative') / ((SELECT count(*) FROM cells) * nn)::DOUBLE AS rate FROM sizes) WHERE assay = 'bacterial'""",
    "gene_cv_filter": _TOTALS
    + """SELECT gene, round(cv, 6) AS cv, cv > l AS kept FROM (SELECT gene, sd / mean AS cv FROM moments WHERE assay = 'RNA' AND mean > 0),
        (SELECT quantile_cont(sd / mean, 0.25) AS l FROM moments WHERE assay = 'RNA' AND mean > 0)""",
    "gene_zscore": _TOTALS
    + "SELECT c.cell_id, c.gene, round(least((count - mean) / sd, 10.0), 5) AS z, round(-mean / sd, 5) AS z_zero FROM counts c JOIN moments m ON c.gene = m.gene",
    "transcript_box": _MOLECULES
    + "SELECT cell, n, "
    + ", ".join(f"round({w}_{a}, 6) AS {w}_{a}" for a in "xyz" for w in ("median", "low", "high"))
    + " FROM box",
    "transcript_confidence": _MOLECULES + "SELECT x_confidence, y_confidence, z_confidence, confidence, count(*) AS n FROM sure GROUP BY 1, 2, 3, 4",
    "transcript_intracellular": _MOLECULES
    + """SELECT cell_id, slide, CASE WHEN cell_id IN (SELECT cell FROM sure WHERE confidence = 'High') THEN 'Intracellular' ELSE 'Extracellular' END AS location FROM cells""",
    "expression_levels": _TOTALS
    + "SELECT cell_id, n_count, " + _LEVEL.format(v="n_count") + " AS level FROM totals, (SELECT quantile_cont(n_count, [0.96, 0.99, 0.999]) AS q FROM totals)",
    "bacterial_state": _TOTALS + _BOXES
    + """ SELECT cell_id, level, location, CASE WHEN level = 'Negative' THEN 'Negative' WHEN location = 'Intracellular' THEN 'Intracellular_16S' ELSE 'Extracellular_16S' END AS state
        FROM (SELECT cell_id, """ + _LEVEL.format(v="n_bac") + """ AS level,
            CASE WHEN cell_id IN (SELECT cell FROM sure WHERE confidence = 'High') THEN 'Intracellular' ELSE 'Extracellular' END AS location
            FROM totals, (SELECT quantile_cont(n_bac, [0.96, 0.99, 0.999]) AS q FROM totals))""",
    "filter_include_exclude": domain.SQL
    + "SELECT cell_id, timepoint, cell_type FROM cells WHERE (timepoint IS NULL OR timepoint <> 'week4') AND cell_type IN ('tumor', 'fibroblast')",
    "neovariable": domain.SQL + "SELECT coalesce(timepoint, 'NA') || '_' || coalesce(cell_type, 'NA') AS timepoint_cell_type, count(*) AS n FROM cells GROUP BY 1",
    "top_k_per_group": domain.SQL
    + "SELECT fov, cell_id, area, place FROM (SELECT *, row_number() OVER (PARTITION BY fov ORDER BY area DESC, cell_id)::INT AS place FROM cells WHERE area IS NOT NULL) WHERE place <= 10",
    "top_ties_per_group": _TOTALS
    + "SELECT fov, cell_id, n_bac, place FROM (SELECT *, rank() OVER (PARTITION BY fov ORDER BY n_bac DESC)::INT AS place FROM totals WHERE n_bac > 0) WHERE place <= 5",
    "bh_adjust": """
        WITH p AS (SELECT run_ID, cell_type, gene, round(1 - max(prob_DE), 9) AS p FROM de_results
            WHERE prob_DE BETWEEN 0 AND 1 AND NOT isnan(prob_DE) AND gene IS NOT NULL GROUP BY 1, 2, 3),
        r AS (SELECT *, p * count(*) OVER (PARTITION BY run_ID, cell_type) / row_number() OVER (PARTITION BY run_ID, cell_type ORDER BY p, gene) AS raw FROM p)
        SELECT run_ID, cell_type, gene, p, round(least(1.0, min(raw) OVER (PARTITION BY run_ID, cell_type ORDER BY p, gene
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 7) AS p_adj FROM r""",
    "fov_bbox": domain.SQL
    + "SELECT fov, min(x) AS x_min, max(x) AS x_max, min(y) AS y_min, max(y) AS y_max, max(x) - min(x) AS width, max(y) - min(y) AS height FROM pts GROUP BY fov",
    "histogram_bins": domain.SQL
    + "SELECT least(50, floor((area - lo) / (hi - lo) * 50) + 1)::INT AS bin, count(*) AS n FROM cells, (SELECT min(area) AS lo, max(area) AS hi FROM cells) WHERE area IS NOT NULL GROUP BY 1",
    "shared_columns_union": """SELECT slide_no, fov, count(*) AS n, max(cell_ID) AS last_cell
        FROM (SELECT slide_no, fov, cell_ID FROM metadata UNION ALL SELECT slide_no, fov, cell_ID FROM expr_counts) GROUP BY 1, 2""",
    "downsample_per_group": domain.SQL
    + "SELECT cell_type, cell_id FROM (SELECT *, row_number() OVER (PARTITION BY cell_type ORDER BY md5(cell_id || '7'), cell_id) AS rn FROM cells) WHERE rn <= 30",
}
