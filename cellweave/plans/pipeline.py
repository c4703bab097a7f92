"""From the flat files of a run to checked, normalized cells: the stages in order, each lazily built on the one before."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..operators import normalize, qc, transcripts
from ..sources import flatfiles


@dataclass(frozen=True)
class Experiment:
    """Tables of a run: cells, genes and count triples."""

    cells: DataFrame
    genes: DataFrame
    counts: DataFrame


def imported(spark: SparkSession, root: str, config: Config) -> Experiment:
    """Cells and counts of all slides, aligned, filtered and with the configured pasted columns."""
    key = flatfiles.cell_key("Run_Tissue_name", "fov", "cell_ID")
    cells = flatfiles.read_cells(spark, root, str(config.get("metadata_file") or "*metadata_file*")).withColumn("cell_id", key)
    counts = flatfiles.read_counts(spark, root, str(config.get("counts_file") or "*exprMat_file*")).withColumn("cell_id", key)
    cells = cells.join(flatfiles.read_run_ids(spark, root, cells.select("Run_Tissue_name")), "Run_Tissue_name", "left")
    cells, counts = flatfiles.aligned(cells, counts)
    if config.get("filter_vars"):
        cells, _ = transcripts.apply_filters(cells, str(config["filter_vars"]))
        counts = counts.join(cells.select("cell_id"), "cell_id", "left_semi")
    for spec in config.get("neovariables") or []:
        cells = transcripts.neovariable(cells, spec)
    assay = flatfiles.assay_of(F.col("gene"), list(config.get("bacterial_probes") or []))
    counts = counts.select("cell_id", "gene", assay.alias("assay"), "count").where(F.col("assay") != "system")
    genes = counts.select("gene", "assay").distinct()
    return Experiment(cells, genes, counts)


def checked(e: Experiment, limits: qc.Limits, config: Config | None = None, fovs_flagged: DataFrame | None = None) -> Experiment:
    """The experiment without flagged cells, FOVs, targets and negative probes, as far as the configuration asks for it.

    Cells whose flag is unknown are dropped too. fovs_flagged: (fov), names as in uniqueFOV. With pre_qc_mode nothing is dropped.
    """
    asked = {k: (config or {}).get(k) for k in ("pre_qc_mode", "filter_cells", "filter_fovs", "filter_targets", "filter_neg_probes", "filter_targets_by_neg_control_quantile", "filter_targets_by_detection_p_value")}
    cells = e.cells.withColumnRenamed("Area", "area").withColumn("fov_id", F.col("fov")).withColumn("fov", F.col("uniqueFOV"))
    sizes = e.genes.agg(F.count_if(F.col("assay") == "RNA"), F.count_if(F.col("assay") == "negative")).first()
    metrics = qc.cell_metrics(qc.cell_totals(cells, e.counts), sizes[0], max(1, sizes[1]))
    flags = qc.cell_flags(metrics, limits, qc.area_outliers(cells, limits.area_alpha) if "area" in cells.columns else None)
    moments = qc.gene_moments(e.counts, e.genes, cells.count())
    targets = negatives = None
    if asked["filter_targets"]:
        below = qc.below_negatives(moments, 0.5)
        targets = qc.flagged_targets(
            qc.undetected_targets(qc.welch_against_negatives(moments), below, limits.detection_alpha), below,
            bool(asked["filter_targets_by_neg_control_quantile"]), bool(asked["filter_targets_by_detection_p_value"]),
        )
    if asked["filter_neg_probes"]:
        negatives = qc.negative_outliers(moments, limits.negative_alpha).where("outlier").select("gene")
    cells_flagged = flags if asked["filter_cells"] is None or asked["filter_cells"] else None
    kept, counts = qc.filtered(flags, e.counts, cells_flagged, fovs_flagged if asked["filter_fovs"] else None, targets, negatives, bool(asked["pre_qc_mode"]))
    return Experiment(kept.withColumn("fov", F.col("fov_id")).drop("fov_id"), e.genes, counts)


def normalized(e: Experiment, min_counts: int) -> DataFrame:
    """Normalized RNA counts of the experiment."""
    norm = normalize.normalized_counts(e.counts.where(F.col("assay") == "RNA"), min_counts)
    return normalize.log_normalized(norm, normalize.scale_factors(e.cells))
