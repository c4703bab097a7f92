"""The domain tables of a scale directory in the shape the operators take, and the same in SQL.

cells: one row per cell that stands, its latest delivery, with its latest type; x and y are null where the
place was not measured. counts: the long count matrix, non-zero entries only, with the assay of each gene.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.values import value
from ..operators.proximity import located
from ..sources.tables import table


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "metadata").where(F.col("updated_cell_id").isNotNull() & F.col("deleted_at").isNull())
    last = ("loaded_at", "Area", "CenterX_global_px", "CenterY_global_px", "nCount_RNA", "Mean_PanCK", "Mean_CD45", "timepoint")
    newest = Window.partitionBy("updated_cell_id").orderBy(*[F.col(c).desc_nulls_last() for c in last])
    place = located(F.col("CenterX_global_px"), F.col("CenterY_global_px"))
    types = table(spark, sf_dir, "cell_types").where(F.col("updated_cell_id").isNotNull())
    newest_type = Window.partitionBy("updated_cell_id").orderBy(*[F.col(c).desc_nulls_last() for c in ("loaded_at", "final_cell_type", "niche")])
    types = types.withColumn("rn", F.row_number().over(newest_type)).where("rn = 1").select(
        F.col("updated_cell_id").alias("cell_id"), F.col("final_cell_type").alias("cell_type"), F.col("niche").cast("int").alias("niche")
    )
    return (
        rows.withColumn("rn", F.row_number().over(newest))
        .where("rn = 1")
        .select(
            F.col("updated_cell_id").alias("cell_id"),
            F.col("Run_Tissue_name").alias("slide"),
            F.concat("Run_Tissue_name", F.lit(":"), F.col("fov").cast("string")).alias("fov"),
            F.when(place, F.col("CenterX_global_px")).alias("x"),
            F.when(place, F.col("CenterY_global_px")).alias("y"),
            value(F.col("Area")).alias("area"),
            value(F.col("Mean_PanCK")).alias("mean_panck"),
            value(F.col("Mean_CD45")).alias("mean_cd45"),
            "timepoint",
        )
        .join(types, "cell_id", "left")
    )


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells with a measured place."""
    return cells(spark, sf_dir).where(F.col("x").isNotNull())


def genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "probes").select("gene", "assay", "panel", "barcode")


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(cell_id, gene, assay, count): a count delivered twice is taken at its larger value; system probes are left out."""
    rows = table(spark, sf_dir, "expr_counts").where(F.col("cell_ID") > 0)
    kept = (
        rows.groupBy(F.concat_ws("_", F.lit("c"), "slide_no", "slide_ID", "fov", "cell_ID").alias("cell_id"), "gene")
        .agg(F.max("n_molecules").cast("bigint").alias("count"))
        .where(F.col("count") > 0)
    )
    assays = genes(spark, sf_dir).select("gene", "assay").where(F.col("assay") != "system")
    return kept.join(assays, "gene").join(cells(spark, sf_dir).select("cell_id"), "cell_id", "left_semi")


def gene_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(gs_name, gene): the genes of an assay by the first letter of their names."""
    return genes(spark, sf_dir).select(F.concat_ws("_", F.upper("assay"), F.lit("GROUP"), F.upper(F.substring("gene", 1, 1))).alias("gs_name"), "gene").dropDuplicates()


SQL = """
    WITH cells AS (
        SELECT m.updated_cell_id AS cell_id, m.Run_Tissue_name AS slide, m.Run_Tissue_name || ':' || m.fov AS fov,
            CASE WHEN m.located THEN CenterX_global_px END AS x, CASE WHEN m.located THEN CenterY_global_px END AS y,
            CASE WHEN NOT isnan(Area) THEN Area END AS area, CASE WHEN NOT isnan(Mean_PanCK) THEN Mean_PanCK END AS mean_panck,
            CASE WHEN NOT isnan(Mean_CD45) THEN Mean_CD45 END AS mean_cd45, timepoint, t.cell_type, t.niche
        FROM (
            SELECT *, coalesce(NOT isnan(CenterX_global_px) AND NOT isnan(CenterY_global_px)
                    AND NOT (CenterX_global_px = 0 AND CenterY_global_px = 0), false) AS located,
                row_number() OVER (PARTITION BY updated_cell_id ORDER BY loaded_at DESC NULLS LAST, Area DESC NULLS LAST,
                    CenterX_global_px DESC NULLS LAST, CenterY_global_px DESC NULLS LAST, nCount_RNA DESC NULLS LAST,
                    Mean_PanCK DESC NULLS LAST, Mean_CD45 DESC NULLS LAST, timepoint DESC NULLS LAST) AS rn
            FROM metadata WHERE updated_cell_id IS NOT NULL AND deleted_at IS NULL
        ) m LEFT JOIN (
            SELECT updated_cell_id, final_cell_type AS cell_type, niche, row_number() OVER (PARTITION BY updated_cell_id
                ORDER BY loaded_at DESC NULLS LAST, final_cell_type DESC NULLS LAST, niche DESC NULLS LAST) AS trn
            FROM cell_types WHERE updated_cell_id IS NOT NULL
        ) t ON m.updated_cell_id = t.updated_cell_id AND t.trn = 1
        WHERE m.rn = 1
    ), pts AS (SELECT * FROM cells WHERE x IS NOT NULL),
    genes AS (SELECT gene, assay, panel, barcode FROM probes),
    counts AS (
        SELECT e.cell_id, e.gene, g.assay, e.count FROM (
            SELECT concat('c_', slide_no, '_', slide_ID, '_', fov, '_', cell_ID) AS cell_id, gene, max(n_molecules)::BIGINT AS count
            FROM expr_counts WHERE cell_ID > 0 GROUP BY 1, 2
        ) e JOIN probes g ON e.gene = g.gene
        WHERE e.count > 0 AND g.assay <> 'system' AND e.cell_id IN (SELECT cell_id FROM cells)
    )
"""
