"""Queries of the rows behind plots and exports, and of the remaining pattern statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scratch import saved
from ..operators import expression, niches, patterns, qc, spatial, views
from . import biology, domain, fovs, quality, space
from .space import EDGES, RADIUS

SIGMA = 30.0
CUTOFF = 5
#: Cells to be drawn: few, so that the small tables have some that are not.
DRAWN = 1000


def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.radius_edges(domain.points(spark, sf_dir), "fov", "cell_id", RADIUS)


def cell_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells with the exported columns; those the table lacks are left out."""
    rows, _ = views.projected(domain.cells(spark, sf_dir), ["cell_id", "fov", "niche"], ["cell_type", "area", "not_there"])
    return views.renamed(rows, {"cell_id": "CellID"})


def types_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = domain.cells(spark, sf_dir).where("cell_type IS NOT NULL").groupBy("cell_type").agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("sort_key", views.type_order(F.col("cell_type"), ["T_CD4", "T_CD8", "B_cell", "NK", "macrophage"]))


def profile_heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = expression.mean_profiles(domain.counts(spark, sf_dir).where("assay = 'RNA'"), domain.cells(spark, sf_dir), "cell_type")
    return views.profile_heat(means, "gene", "cell_type", "mean", 0.05).select("gene", "cell_type", F.round("heat", 8).alias("heat"))


def niche_heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares of cell types per niche, standardized over niches."""
    n = domain.cells(spark, sf_dir).where("niche IS NOT NULL AND cell_type IS NOT NULL").groupBy("niche", "cell_type").agg(F.count(F.lit(1)).alias("n"))
    z = views.standardized(n.withColumn("n", F.col("n").cast("double")), "cell_type", "n")
    return z.select("niche", "cell_type", "n", (F.round("z", 7) + F.lit(0.0)).alias("z"))


def counts_in_space(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.log_counts(quality._totals(spark, sf_dir), CUTOFF, DRAWN)
    return rows.select("cell_id", "x", "y", F.round("log_count", 9).alias("log_count"), "below", "drawn")


def pca_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of variance explained by each component of the neighbourhood profiles."""
    wide, kinds = biology._wide(spark, sf_dir)
    _, shares = niches.principal_components(wide, "cell_id", kinds, 5)
    return spark.createDataFrame([(i + 1, v) for i, v in enumerate(shares)], "component int, share double")


def de_volcano(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = views.volcano(biology._tested(spark, sf_dir), "p_adj")
    return found.select("cell_type", "gene", "level_a", "level_b", "estimate", F.round("minus_log10_p", 4).alias("minus_log10_p"), "significant")


def auc_group_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean and sd over FOVs of the area between two types."""
    auc = patterns.curve_summary(biology._curves(spark, sf_dir), "fov", "g")
    found = views.group_summary(auc, ["type_i", "type_j"], "auc")
    return found.select("type_i", "type_j", F.round("mean", 6).alias("mean"), F.round("sd", 6).alias("sd"))


def auc_label_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = saved(patterns.framed(domain.points(spark, sf_dir), "fov", "cell_type"))
    return patterns.label_difference_test(_edges(spark, sf_dir), frame, "fov", biology.RADII, "tumor", "fibroblast", "macrophage", biology.LABELS, 4)


def kernel_intensity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = views.kernel_intensity(_edges(spark, sf_dir), domain.points(spark, sf_dir), "fov", "cell_id", SIGMA)
    return found.select("cell_id", F.round("intensity", 10).alias("intensity"))


def inhomogeneity(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = domain.points(spark, sf_dir)
    intensity = views.kernel_intensity(_edges(spark, sf_dir), points, "fov", "cell_id", SIGMA)
    found = views.inhomogeneity(spatial.quadrat_counts(points, "fov", 5, 5), intensity, "fov")
    return found.select("fov", "n", F.round("vmr", 7).alias("vmr"), F.round("cv", 7).alias("cv"))


def k_inhomogeneous(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = domain.points(spark, sf_dir)
    intensity = views.kernel_intensity(_edges(spark, sf_dir), points, "fov", "cell_id", SIGMA)
    found = patterns.inhomogeneous_k(_edges(spark, sf_dir), points, intensity, "fov", biology.RADII)
    return found.select("fov", "r", "n_i", F.round("k", 3).alias("k"), F.round("k_inhom", 3).alias("k_inhom"))


def inhomogeneity_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quadrat dispersion of each type and of all other types, per FOV; fewer than ten points give no row."""
    points = domain.points(spark, sf_dir).where("cell_type IS NOT NULL").select("fov", "x", "y", "cell_type")
    kinds = points.select("fov", F.col("cell_type").alias("focal")).distinct()
    both = points.join(kinds, "fov").withColumn("mode", F.when(F.col("cell_type") == F.col("focal"), "same").otherwise("not_same"))
    keyed = both.withColumn("pattern", F.concat_ws("|", "fov", "focal", "mode"))
    found = spatial.quadrat_test(spatial.quadrat_counts(keyed, "pattern", 3, 3), "pattern").where("n >= 10")
    part = F.split("pattern", "\\|")
    return found.select(part[0].alias("fov"), part[1].alias("focal"), part[2].alias("mode"), "n", F.round("vmr", 7).alias("vmr"))


def lr_final_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ligand-receptor scores with the receptor cell's activity of each factor, a row per factor."""
    scores = biology.pathway_activity(spark, sf_dir).withColumnRenamed("cell_id", "receptor_cell")
    return space.lr_score(spark, sf_dir).join(scores, "receptor_cell", "left").select("ligand", "receptor", "ligand_cell", "receptor_cell", "lr_score", "tf", F.col("score").alias("auc_score"))


def qc_filtered_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells that pass the cell flags, of FOVs that pass theirs."""
    return _filtered(spark, sf_dir, False)[0].select("cell_id", "fov")


def _filtered(spark: SparkSession, sf_dir: str, pre_qc: bool) -> tuple[DataFrame, DataFrame]:
    flags = quality._flags(spark, sf_dir)
    bad = fovs.fov_flags(spark, sf_dir).where("flagged")
    moments = quality._moments(spark, sf_dir)
    targets = qc.flagged_targets(quality._tested(spark, sf_dir), qc.below_negatives(moments, 0.5), True, False)
    negatives = qc.negative_outliers(moments, quality.LIMITS.negative_alpha).where("outlier")
    return qc.filtered(domain.cells(spark, sf_dir), domain.counts(spark, sf_dir), flags, bad, targets, negatives, pre_qc)


def qc_filtered_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per gene after all filters; flagged targets and outlying negative probes are gone."""
    return _filtered(spark, sf_dir, False)[1].groupBy("gene", "assay").agg(F.count(F.lit(1)).alias("n_cells"), F.sum("count").alias("n_molecules"))


def qc_pre_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells and genes that are left with the filters, and in pre-QC mode, which filters nothing."""
    made = None
    for mode in (False, True):
        cells, counts = _filtered(spark, sf_dir, mode)
        n = cells.agg(F.count(F.lit(1)).alias("n_cells")).join(counts.agg(F.countDistinct("gene").alias("n_genes")))
        part = n.select(F.lit(mode).alias("pre_qc"), "n_cells", "n_genes")
        made = part if made is None else made.unionByName(part)
    return made


QUERIES = {
    f.__name__: f
    for f in (
        cell_export, types_in_order, profile_heatmap, niche_heatmap, counts_in_space, pca_variance, de_volcano, auc_group_summary, auc_label_test,
        kernel_intensity, inhomogeneity, k_inhomogeneous, inhomogeneity_by_type, lr_final_scores,
        qc_filtered_cells, qc_filtered_genes, qc_pre_mode,
    )
}

_INTENSITY = f"""(SELECT p.fov, p.cell_id, (coalesce(s, 0) + 1) / (2 * pi() * {SIGMA * SIGMA}::DOUBLE) AS intensity FROM pts p
    LEFT JOIN (SELECT src, sum(exp(-dist * dist / {2 * SIGMA * SIGMA}::DOUBLE)) AS s FROM edges GROUP BY 1) e ON p.cell_id = e.src)"""
_TYPED = """, keyed AS (SELECT p.fov, focal, CASE WHEN cell_type = focal THEN 'same' ELSE 'not_same' END AS mode, x, y FROM pts p
        JOIN (SELECT DISTINCT fov, cell_type AS focal FROM pts WHERE cell_type IS NOT NULL) k ON p.fov = k.fov WHERE cell_type IS NOT NULL
    ), boxes AS (SELECT fov, focal, mode, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1, count(*) AS n FROM keyed GROUP BY 1, 2, 3
    ), quads AS (SELECT k.fov, k.focal, k.mode, CASE WHEN x1 > x0 THEN least(2, floor((x - x0) / (x1 - x0) * 3)) ELSE 0 END AS qx, CASE WHEN y1 > y0 THEN least(2, floor((y - y0) / (y1 - y0) * 3)) ELSE 0 END AS qy, count(*) AS c
        FROM keyed k JOIN boxes b ON k.fov = b.fov AND k.focal = b.focal AND k.mode = b.mode GROUP BY ALL)
"""
_FILTERED = (
    fovs._FLAGS
    + quality._TOTALS[len(domain.SQL) :]
    + f""", negs AS ({quality.SQL["neg_probe_outliers"][len(quality._TOTALS) :]}
    ), kept AS (SELECT d.* FROM decided d WHERE NOT flagged AND NOT EXISTS (SELECT 1 FROM fov_flags f WHERE f.flagged AND f.fov = d.fov)
    ), low_targets AS (SELECT gene FROM moments, (SELECT quantile_cont(mean, 0.5) AS l FROM moments WHERE assay = 'negative') WHERE assay = 'RNA' AND mean < l
    ), left_counts AS (SELECT * FROM counts WHERE cell_id IN (SELECT cell_id FROM kept) AND NOT (assay = 'RNA' AND gene IN (SELECT gene FROM low_targets)) AND NOT (assay = 'negative' AND gene IN (SELECT gene FROM negs WHERE outlier)))
"""
)
SQL = {
    "cell_export": domain.SQL + 'SELECT cell_id AS "CellID", fov, niche, cell_type, area FROM cells',
    "types_in_order": domain.SQL
    + """SELECT cell_type, count(*) AS n, CASE WHEN regexp_full_match(cell_type, '[a-z]') THEN 0 ELSE coalesce(list_position(['T_CD4', 'T_CD8', 'B_cell', 'NK', 'macrophage'], cell_type), 6) END::INT AS sort_key
        FROM cells WHERE cell_type IS NOT NULL GROUP BY 1""",
    "profile_heatmap": domain.SQL
    + """SELECT gene, cell_type, round(mean / greatest(top, 0.05), 8) AS heat FROM (SELECT *, max(mean) OVER (PARTITION BY gene) AS top FROM (
        SELECT s.cell_type, gene, s / n::DOUBLE AS mean FROM (SELECT cell_type, gene, sum(count) AS s FROM counts c JOIN cells k ON c.cell_id = k.cell_id WHERE assay = 'RNA' AND cell_type IS NOT NULL GROUP BY 1, 2) s
        JOIN (SELECT cell_type, count(*) AS n FROM cells GROUP BY 1) z ON s.cell_type = z.cell_type)) WHERE top > 0.05""",
    "niche_heatmap": domain.SQL
    + """SELECT niche, cell_type, n, round((n - avg(n) OVER w) / CASE WHEN stddev_samp(n) OVER w > 0 THEN stddev_samp(n) OVER w END, 7) + 0.0::DOUBLE AS z
        FROM (SELECT niche, cell_type, count(*)::DOUBLE AS n FROM cells WHERE niche IS NOT NULL AND cell_type IS NOT NULL GROUP BY 1, 2) WINDOW w AS (PARTITION BY cell_type)""",
    "counts_in_space": quality._TOTALS + f"SELECT cell_id, x, y, round(log10(n_count + 1), 9) AS log_count, n_count < {CUTOFF} AS below, ('0x' || md5(cell_id)[1:8])::BIGINT < 4294967296.0::DOUBLE * {DRAWN} / (SELECT count(*) FROM totals) AS drawn FROM totals",
    "auc_group_summary": biology._CURVES + "SELECT type_i, type_j, round(avg(auc), 6) AS mean, round(stddev_samp(auc), 6) AS sd FROM auc GROUP BY 1, 2",
    "kernel_intensity": EDGES + f"SELECT cell_id, round(intensity, 10) AS intensity FROM {_INTENSITY}",
    "inhomogeneity": EDGES
    + f"""SELECT q.fov, n, round(vmr, 7) AS vmr, round(cv, 7) AS cv FROM (SELECT fov, sum(n)::BIGINT AS n, (sum(n * n)::DOUBLE / (sum(n)::DOUBLE / count(*)) - sum(n)::DOUBLE) / (count(*) - 1) AS vmr FROM {space._QUADS} GROUP BY fov) q
        JOIN (SELECT fov, stddev_samp(intensity) / avg(intensity) AS cv FROM {_INTENSITY} GROUP BY 1) i ON q.fov = i.fov""",
    "k_inhomogeneous": EDGES
    + f""", lam AS {_INTENSITY}, frame AS (SELECT p.fov, p.cell_id, least(x - x0, x1 - x, y - y0, y1 - y) AS border, (x1 - x0) * (y1 - y0) AS area, intensity AS l FROM pts p
            JOIN (SELECT fov, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM pts GROUP BY fov) b ON p.fov = b.fov JOIN lam ON p.cell_id = lam.cell_id
        ), radii AS (SELECT unnest({biology.RADII}::DOUBLE[]) AS r
        ), inn AS (SELECT fov, r, count(*) AS n_i, sum(1 / l) AS w FROM frame, radii WHERE border >= r GROUP BY ALL
        ), near AS (SELECT a.fov, r, count(*) AS pairs, sum(1 / (a.l * b.l)) AS weighted FROM edges e JOIN frame a ON src = a.cell_id JOIN frame b ON dst = b.cell_id, radii WHERE dist <= r AND a.border >= r GROUP BY ALL)
        SELECT inn.fov, inn.r, n_i, round(coalesce(pairs, 0) * area / (n * n_i)::DOUBLE, 3) AS k, round(coalesce(weighted, 0) / w, 3) AS k_inhom
        FROM inn JOIN (SELECT fov, count(*) AS n, any_value(area) AS area FROM frame GROUP BY 1) t ON inn.fov = t.fov LEFT JOIN near ON inn.fov = near.fov AND inn.r = near.r""",
    "inhomogeneity_by_type": domain.SQL
    + _TYPED
    + """SELECT b.fov, b.focal, b.mode, n, round((sum(c * c)::DOUBLE / (n / 9.0::DOUBLE) - n) / 8, 7) AS vmr FROM boxes b JOIN quads q ON b.fov = q.fov AND b.focal = q.focal AND b.mode = q.mode
        WHERE n >= 10 GROUP BY b.fov, b.focal, b.mode, n""",
    "lr_final_scores": f"SELECT l.ligand, l.receptor, l.ligand_cell, l.receptor_cell, l.lr_score, a.tf, a.score AS auc_score FROM ({space.SQL['lr_score']}) l LEFT JOIN ({biology.SQL['pathway_activity']}) a ON l.receptor_cell = a.cell_id",
    "de_volcano": biology._TESTED_DE + "SELECT cell_type, gene, level_a, level_b, estimate, round(-log10(CASE WHEN p_adj > 0 THEN p_adj END), 4) AS minus_log10_p, p_adj < 0.05 AS significant FROM tested",
    "qc_filtered_cells": _FILTERED + "SELECT cell_id, fov FROM kept",
    "qc_filtered_genes": _FILTERED + "SELECT gene, assay, count(*) AS n_cells, sum(count)::BIGINT AS n_molecules FROM left_counts GROUP BY 1, 2",
    "qc_pre_mode": _FILTERED
    + "SELECT false AS pre_qc, (SELECT count(*) FROM kept) AS n_cells, (SELECT count(DISTINCT gene) FROM left_counts) AS n_genes UNION ALL SELECT true, (SELECT count(*) FROM cells), (SELECT count(DISTINCT gene) FROM counts)",
}
