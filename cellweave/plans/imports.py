"""Queries of the readers and sinks: flat files of a run are written from the tables, read back and compared with the tables.

Slides with an odd number have other columns, in another order, than those with an even one.
"""

from __future__ import annotations

import uuid
import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.levels import few
from ..functions.scratch import checkpoint_dir
from ..operators import expression
from ..sources import flatfiles
from ..sources.tables import table
from . import domain


#: Texts keep their outer spaces and line ends; an empty text is no null, since nulls have a mark of their own.
VERBATIM = {"lineSep": "\n", "nullValue": uuid.uuid4().hex, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def _folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/run-{uuid.uuid4().hex}/{name}"


def _csv(rows: DataFrame, path: str, columns: list[str]) -> None:
    """Rows as CSV files with a header, a folder per slide with one file."""
    rows.select("Run_Tissue_name", *columns).repartition("Run_Tissue_name").write.mode("append").partitionBy("Run_Tissue_name").option("header", True).csv(path)


def _cells_folder(spark: SparkSession, sf_dir: str) -> str:
    """Metadata of each slide; odd slides have Width, even ones another order of columns."""
    path = _folder(spark, "cells")
    rows = table(spark, sf_dir, "metadata").where(F.col("Run_Tissue_name").isNotNull()).withColumn("Width", F.col("nCount_RNA"))
    _csv(rows.where("slide_no % 2 = 1"), path, ["fov", "cell_ID", "Area", "Width", "timepoint", "nCount_RNA"])
    _csv(rows.where("slide_no % 2 = 0"), path, ["nCount_RNA", "timepoint", "cell_ID", "Area", "fov"])
    return path


def _read(reader, spark: SparkSession, path: str) -> DataFrame:
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")  # columns that not every slide has are meant to be left out here
        return reader(spark, path, "*.csv")


def csv_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _read(flatfiles.read_cells, spark, _cells_folder(spark, sf_dir))
    return cells.select("Run_Tissue_name", "uniqueFOV", "fov", "cell_ID", "Area", "timepoint", F.col("nCount_RNA").cast("int").alias("nCount_RNA"))


def _counts_folder(spark: SparkSession, sf_dir: str) -> str:
    """Wide counts of each slide; odd slides have all genes, even ones those of the main panel, from the last to the first."""
    path = _folder(spark, "counts")
    slides = table(spark, sf_dir, "slides").select("slide_no", "Run_Tissue_name")
    genes = few(domain.genes(spark, sf_dir).select("gene", "panel").orderBy("gene"))
    held = table(spark, sf_dir, "expr_counts").where(F.col("cell_ID").isNotNull()).join(slides, "slide_no")
    wide = held.groupBy("slide_no", "Run_Tissue_name", "fov", "cell_ID").pivot("gene", [g["gene"] for g in genes]).agg(F.max("n_molecules")).fillna(0)
    names = [f"`{g['gene']}`" for g in genes]
    main = [f"`{g['gene']}`" for g in reversed(genes) if g["panel"] == "main"]
    _csv(wide.where("slide_no % 2 = 1"), path, ["fov", "cell_ID", *names])
    _csv(wide.where("slide_no % 2 = 0"), path, ["cell_ID", *main, "fov"])
    return path


def csv_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(flatfiles.read_counts, spark, _counts_folder(spark, sf_dir)).select("Run_Tissue_name", "fov", "cell_ID", "gene", "count")


def csv_aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells with counts, and counts of cells with metadata, per slide; metadata gets the slides' panel as an additional table."""
    key = flatfiles.cell_key("Run_Tissue_name", "fov", "cell_ID")
    cells = csv_cells(spark, sf_dir).withColumn("cell_id", key).dropDuplicates(["cell_id"])
    cells = flatfiles.with_additional(cells, table(spark, sf_dir, "slides").select("Run_Tissue_name", "panel"), "Run_Tissue_name")
    cells, counts = flatfiles.aligned(cells, csv_counts(spark, sf_dir).withColumn("cell_id", key))
    n = counts.groupBy("Run_Tissue_name").agg(F.sum("count").alias("n_molecules"))
    return cells.groupBy("Run_Tissue_name", "panel").agg(F.count(F.lit(1)).alias("n_cells")).join(n, "Run_Tissue_name", "left")


def csv_run_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run ids of all slides; only odd slides have a summary."""
    path, slides = _folder(spark, "slides"), table(spark, sf_dir, "slides")
    lines = slides.where("slide_no % 2 = 1").select("Run_Tissue_name", F.lit("RunSummary").alias("part"), F.concat(F.lit("Run Number: "), "run_ID", F.lit("\nother lines")).alias("value"))
    lines.repartition("Run_Tissue_name").write.partitionBy("Run_Tissue_name", "part").text(path)
    return flatfiles.read_run_ids(spark, path, slides, "*.txt")


def csv_molecules(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark, "molecules")
    table(spark, sf_dir, "transcripts").select("fov", "cell_ID", "cell", "x_local_px", "y_local_px", "x_global_px", "y_global_px", "z", "target", "CellComp").write.option("header", True).options(**VERBATIM).csv(path)
    return flatfiles.read_molecules(spark, path, multiLine=True, **VERBATIM).groupBy("target", "CellComp").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("cell").alias("n_cells"), F.min("x_local_px").alias("x_min"), F.max(F.nanvl("z", F.lit(None).cast("double"))).alias("z_max")
    )


def csv_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean profiles of the types written as a reference table, read and scaled to thousandths of the 99th percentile."""
    path = _folder(spark, "profiles")
    means = expression.mean_profiles(domain.counts(spark, sf_dir).where("assay = 'RNA'"), domain.cells(spark, sf_dir), "cell_type")
    kinds = sorted(r[0] for r in few(domain.cells(spark, sf_dir).where("cell_type IS NOT NULL").select("cell_type").distinct()))
    means.groupBy("gene").pivot("cell_type", kinds).agg(F.first("mean")).write.option("header", True).csv(path)
    measured = domain.genes(spark, sf_dir).where("panel = 'main'")
    return flatfiles.scaled_profiles(flatfiles.read_profiles(spark, path).where("value IS NOT NULL"), measured).select("gene", "cell_type", F.round("value", 6).alias("value"))


def csv_pathways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A headerless table of categories and subcategories, and the gene sets it asks for."""
    path, sets = _folder(spark, "wanted.tsv"), _folder(spark, "sets")
    genes = domain.genes(spark, sf_dir).select(F.col("panel").alias("category"), F.col("assay").alias("subcategory"), F.concat_ws("_", F.upper("assay"), F.substring("gene", 1, 1)).alias("gs_name"), "gene")
    genes.unionByName(genes).write.parquet(sets)
    genes.select("category", F.when(F.col("category") == "main", F.col("subcategory")).alias("subcategory")).where("category = 'addon' OR subcategory = 'RNA'").distinct().write.option("sep", "\t").csv(path)
    return flatfiles.read_gene_sets(spark, sets, flatfiles.read_pathways(spark, path))


def csv_regulons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of factors and their targets, taken from effects: the reference level regulates genes up or down."""
    path = _folder(spark, "regulons")
    regulons(spark, sf_dir).write.option("header", True).csv(path)
    return flatfiles.read_regulons(spark, path)


def regulons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tf, target, mor, confidence) from the effects: a factor per effect and direction, with the sign of the mean difference and a grade by probability."""
    rows = table(spark, sf_dir, "de_results").where(F.col("gene").isNotNull() & ~F.isnan("diff_mean") & F.col("prob_DE").between(0, 1))
    best = rows.groupBy(F.concat_ws("_", "fixed_effect", "direction").alias("tf"), F.col("gene").alias("target")).agg(F.round(F.avg("diff_mean"), 9).alias("d"), F.max("prob_DE").alias("p"))
    grade = F.when(F.col("p") >= 0.99, "A").when(F.col("p") >= 0.95, "B").when(F.col("p") >= 0.9, "C").when(F.col("p") >= 0.8, "D").otherwise("E")
    return best.where("tf IS NOT NULL AND d <> 0").select("tf", "target", F.when(F.col("d") > 0, 1).otherwise(-1).alias("mor"), grade.alias("confidence"))


def lr_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ligand-receptor pairs of neighbouring types: the receptor is the target's second and third gene, the ligand the source's first.

    Types pair with the next one by name; genes rank by their total count in a type.
    """
    known = domain.cells(spark, sf_dir).where("cell_type IS NOT NULL").select("cell_id", "cell_type")
    sums = domain.counts(spark, sf_dir).where("assay = 'RNA'").join(known, "cell_id").groupBy("cell_type", "gene").agg(F.sum("count").alias("s"))
    place = F.row_number().over(_by_type())
    top = sums.withColumn("place", place).where("place <= 3").groupBy("cell_type").pivot("place", [1, 2, 3]).agg(F.first("gene"))
    ordered = sorted(r[0] for r in few(known.select("cell_type").distinct()))
    following = spark.createDataFrame(list(zip(ordered, [*ordered[1:], *ordered[:1]], strict=True)), "ligand_cell string, receptor_cell string")
    a = top.select(F.col("cell_type").alias("ligand_cell"), F.col("1").alias("ligand"))
    b = top.select(F.col("cell_type").alias("receptor_cell"), F.concat_ws("+", "2", "3").alias("receptor"))
    pairs = following.join(a, "ligand_cell").join(b, "receptor_cell").where("ligand IS NOT NULL AND receptor <> ''")
    return pairs.select(F.lower("receptor").alias("receptor_id"), "receptor", "ligand", "receptor_cell", "ligand_cell", F.lit("cell_type").alias("cell_type_col"), F.lit(120.0).alias("r"))


def _by_type():
    from pyspark.sql import Window

    return Window.partitionBy("cell_type").orderBy(F.desc("s"), "gene")


def csv_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark, "pairs")
    lr_table(spark, sf_dir).write.csv(path)
    return flatfiles.read_pairs(spark, path)


def file_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL over a CSV file."""
    path = _folder(spark, "file")
    table(spark, sf_dir, "slides").select("Run_Tissue_name", "run_ID", "panel", "slide_no").write.option("header", True).csv(path)
    return flatfiles.query_file(spark, path, "SELECT run_ID, panel, count(*) AS n, CAST(max(slide_no) AS int) AS last FROM f GROUP BY run_ID, panel")


def stage_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells after a stage's Parquet, a result's CSV and a created table, with the stage noted last."""
    stage, result, made, mark = (_folder(spark, n) for n in ("stage", "result", "table", "mark"))
    flatfiles.write_stage(domain.cells(spark, sf_dir).where("slide IS NOT NULL"), stage, "slide")
    flatfiles.write_result(spark.read.parquet(stage).select("slide", "cell_id", "area"), result)
    name = f"cells_{uuid.uuid4().hex}"
    flatfiles.create_table(spark.read.option("header", True).csv(result).withColumn("area", F.col("area").cast("double")), name, made)
    flatfiles.mark_stage(spark, mark, "typing")
    cells = spark.table(name)
    return cells.groupBy("slide").agg(F.count(F.lit(1)).alias("n_cells"), F.round(F.avg("area"), 6).alias("mean_area"), F.lit(flatfiles.last_stage(spark, mark)).alias("stage"))


QUERIES = {f.__name__: f for f in (csv_cells, csv_counts, csv_aligned, csv_run_ids, csv_molecules, csv_profiles, csv_pathways, csv_regulons, csv_pairs, file_query, stage_tables)}

_COUNTS = """SELECT Run_Tissue_name, fov, cell_ID, e.gene, max(n_molecules)::BIGINT AS count FROM expr_counts e JOIN slides s ON e.slide_no = s.slide_no JOIN probes p ON e.gene = p.gene
    WHERE cell_ID IS NOT NULL AND p.panel = 'main' GROUP BY 1, 2, 3, 4 HAVING max(n_molecules) <> 0"""
REGULONS = """(SELECT tf, target, CASE WHEN d > 0 THEN 1 ELSE -1 END AS mor, CASE WHEN p >= 0.99 THEN 'A' WHEN p >= 0.95 THEN 'B' WHEN p >= 0.9 THEN 'C' WHEN p >= 0.8 THEN 'D' ELSE 'E' END AS confidence
    FROM (SELECT concat_ws('_', fixed_effect, direction) AS tf, gene AS target, round(avg(diff_mean), 9) AS d, max(prob_DE) AS p FROM de_results
        WHERE gene IS NOT NULL AND NOT isnan(diff_mean) AND prob_DE BETWEEN 0 AND 1 AND NOT isnan(prob_DE) GROUP BY 1, 2) WHERE d <> 0)"""
LR_TABLE = """, kinds AS (SELECT cell_type, coalesce(lead(cell_type) OVER (ORDER BY cell_type), min(cell_type) OVER ()) AS following FROM (SELECT DISTINCT cell_type FROM cells WHERE cell_type IS NOT NULL)
    ), tops AS (SELECT cell_type, max(gene) FILTER (k = 1) AS g1, max(gene) FILTER (k = 2) AS g2, max(gene) FILTER (k = 3) AS g3 FROM (
        SELECT *, row_number() OVER (PARTITION BY cell_type ORDER BY s DESC, gene) AS k FROM (SELECT cell_type, gene, sum(count) AS s FROM counts c JOIN cells k ON c.cell_id = k.cell_id
            WHERE assay = 'RNA' AND cell_type IS NOT NULL GROUP BY 1, 2)) WHERE k <= 3 GROUP BY 1
    ), lr AS (SELECT concat_ws('+', b.g2, b.g3) AS receptor, b.g2 AS unit1, b.g3 AS unit2, a.g1 AS ligand, b.cell_type AS receptor_cell, a.cell_type AS ligand_cell FROM kinds k JOIN tops a ON k.cell_type = a.cell_type JOIN tops b ON k.following = b.cell_type
        WHERE a.g1 IS NOT NULL AND concat_ws('+', b.g2, b.g3) <> '')
"""
SQL = {
    "csv_cells": """SELECT Run_Tissue_name, Run_Tissue_name || ':' || fov AS "uniqueFOV", fov, cell_ID, Area, timepoint, nCount_RNA FROM metadata WHERE Run_Tissue_name IS NOT NULL""",
    "csv_counts": _COUNTS,
    "csv_aligned": f"""WITH n AS ({_COUNTS}), c AS (SELECT DISTINCT Run_Tissue_name, fov, cell_ID FROM metadata WHERE Run_Tissue_name IS NOT NULL AND fov IS NOT NULL AND cell_ID IS NOT NULL)
        SELECT x.Run_Tissue_name, s.panel, n_cells, n_molecules FROM (SELECT Run_Tissue_name, count(*) AS n_cells FROM c WHERE (Run_Tissue_name, fov, cell_ID) IN (SELECT (Run_Tissue_name, fov, cell_ID) FROM n) GROUP BY 1) x
        JOIN slides s ON x.Run_Tissue_name = s.Run_Tissue_name LEFT JOIN (SELECT Run_Tissue_name, sum(count)::BIGINT AS n_molecules FROM n WHERE (Run_Tissue_name, fov, cell_ID) IN (SELECT (Run_Tissue_name, fov, cell_ID) FROM c) GROUP BY 1) m
        ON x.Run_Tissue_name = m.Run_Tissue_name""",
    "csv_run_ids": "SELECT Run_Tissue_name, CASE WHEN slide_no % 2 = 1 THEN run_ID ELSE substr(sha256(Run_Tissue_name || '|0'), 1, 37) END AS \"run_ID\" FROM slides",
    "csv_molecules": """SELECT target, CellComp AS "CellComp", count(*) AS n, count(DISTINCT cell) AS n_cells, min(x_local_px) AS x_min, max(CASE WHEN NOT isnan(z) THEN z END) AS z_max FROM transcripts GROUP BY 1, 2""",
    "csv_profiles": domain.SQL
    + """, prof AS (SELECT s.cell_type, gene, s / n::DOUBLE AS mean FROM (SELECT cell_type, gene, sum(count) AS s FROM counts c JOIN cells k ON c.cell_id = k.cell_id WHERE assay = 'RNA' AND cell_type IS NOT NULL GROUP BY 1, 2) s
            JOIN (SELECT cell_type, count(*) AS n FROM cells GROUP BY 1) z ON s.cell_type = z.cell_type WHERE gene IN (SELECT gene FROM probes WHERE panel = 'main'))
        SELECT gene, cell_type, round(mean / top * 1000, 6) AS value FROM prof, (SELECT quantile_cont(mean, 0.99) AS top FROM prof)""",
    "csv_pathways": "SELECT DISTINCT upper(assay) || '_' || gene[1:1] AS gs_name, gene FROM probes WHERE panel = 'addon' OR assay = 'RNA'",
    "csv_regulons": f"SELECT * FROM {REGULONS}",
    "csv_pairs": domain.SQL + LR_TABLE + "SELECT lower(receptor) AS receptor_id, receptor, ligand, receptor_cell, ligand_cell, 'cell_type' AS cell_type_col, 120.0::DOUBLE AS r FROM lr",
    "file_query": 'SELECT run_ID AS "run_ID", panel, count(*) AS n, max(slide_no) AS last FROM slides GROUP BY 1, 2',
    "stage_tables": domain.SQL + "SELECT slide, count(*) AS n_cells, round(avg(area), 6) AS mean_area, 'typing' AS stage FROM cells WHERE slide IS NOT NULL GROUP BY 1",
}
