"""Queries of the general data-quality problems: orphans, nearness, schema drift."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.levels import few
from ..functions.scratch import saved
from ..operators import drift, orphans, proximity
from ..sources.tables import table

#: Cells of different FOVs at most this far apart, in pixels, almost coincide.
NEAR_PX = 25.05


def references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All references to cells: (src_table, ref_key, ref_time)."""
    transcripts, counts, types = (table(spark, sf_dir, t) for t in ("transcripts", "expr_counts", "cell_types"))
    key = F.concat_ws("_", F.lit("c"), "slide_no", "slide_ID", "fov", "cell_ID")
    whole = F.col("slide_no").isNotNull() & F.col("slide_ID").isNotNull() & F.col("fov").isNotNull()
    return (
        transcripts.where(F.col("cell").isNotNull() & (F.coalesce("cell_ID", F.lit("")) != "0") & (F.col("cell") != "c_0_0_0_0"))
        .select(F.lit("transcripts").alias("src_table"), F.col("cell").alias("ref_key"), F.col("loaded_at").alias("ref_time"))
        .unionByName(
            counts.where((F.col("cell_ID") != 0) & whole).select(
                F.lit("expr_counts").alias("src_table"), key.alias("ref_key"), F.col("loaded_at").alias("ref_time")
            )
        )
        .unionByName(
            types.select(F.lit("cell_types").alias("src_table"), F.col("updated_cell_id").alias("ref_key"), F.col("loaded_at").alias("ref_time"))
        )
    )


def p1_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphans.orphan_references(references(spark, sf_dir), table(spark, sf_dir, "metadata"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p1_orphans(spark, sf_dir).select("src_table", "load_month", F.col("ref_key").alias("updated_cell_id"))


def p1_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphans.orphan_report(p1_orphans(spark, sf_dir))


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "metadata").select(
        "slide_no",
        "Run_Tissue_name",
        F.concat("Run_Tissue_name", F.lit(":"), F.col("fov").cast("string")).alias("owner"),
        F.col("updated_cell_id").alias("key"),
        F.col("CenterX_global_px").alias("x"),
        F.col("CenterY_global_px").alias("y"),
    )


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _cells(spark, sf_dir)
    near = proximity.near_pairs(cells.withColumn("space", F.col("Run_Tissue_name")), NEAR_PX)
    fovs = table(spark, sf_dir, "fov_positions").select(
        F.col("slide_no").alias("space"),
        F.col("uniqueFOV").alias("region"),
        *[F.col(f"{axis}_{end}_px").alias(f"{axis}_{end}") for axis in "xy" for end in ("min", "max")],
    )
    inside = proximity.in_regions(cells.withColumn("space", F.col("slide_no")), fovs, NEAR_PX)
    return near.select(F.lit("near").alias("kind"), "key_a", "key_b").unionByName(
        inside.select(F.lit("region").alias("kind"), F.col("key").alias("key_a"), F.col("region").alias("key_b"))
    )


def p4_fov_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells per pair of FOVs: own FOV and the other one whose area holds them."""
    found = p4_found(spark, sf_dir).where(F.col("kind") == "region")
    own = _cells(spark, sf_dir).select("key", "owner").distinct()
    return (
        found.join(own, found["key_a"] == own["key"])
        .groupBy(F.col("owner").alias("own_fov"), F.col("key_b").alias("other_fov"))
        .agg(F.countDistinct("key_a").alias("n_cells"))
    )


def _schemas(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All files, their schemas, and the edits between neighbours."""
    raw, names = table(spark, sf_dir, "raw_records"), drift.known_names(table(spark, sf_dir, "field_names"))
    files = saved(drift.stream_files(raw))
    schemas = saved(drift.file_schemas(drift.parsed_lines(raw, files), files, names))
    return files, schemas, drift.schema_changes(schemas, names)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.listed_changes(_schemas(spark, sf_dir)[2]).select("file_name", "field_name", "change_kind")


def p5_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole edit scripts, with renames and moves found without the field table."""
    return _schemas(spark, sf_dir)[2]


def p5_unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    files, schemas, changes = _schemas(spark, sf_dir)
    fields = sorted(r[0] for r in few(table(spark, sf_dir, "field_names").select("field_name").distinct()))
    records = drift.parsed_lines(drift.distinct_lines(table(spark, sf_dir, "raw_records")), files)
    return drift.unified_records(records, saved(drift.composed_fields(schemas, changes)), fields)


QUERIES = {
    "p1_found": p1_found,
    "p1_report": p1_report,
    "p4_found": p4_found,
    "p4_fov_overlap": p4_fov_overlap,
    "p5_found": p5_found,
    "p5_changes": p5_changes,
    "p5_unified": p5_unified,
}

_P1_CASES = """
    WITH refs AS (
        SELECT 'transcripts' AS src_table, cell AS k, loaded_at AS t FROM transcripts
        WHERE cell IS NOT NULL AND coalesce(cell_ID, '') <> '0' AND cell <> 'c_0_0_0_0'
        UNION ALL
        SELECT 'expr_counts', concat('c_', slide_no, '_', slide_ID, '_', fov, '_', cell_ID), loaded_at FROM expr_counts
        WHERE cell_ID IS NOT NULL AND cell_ID <> 0
        UNION ALL
        SELECT 'cell_types', updated_cell_id, loaded_at FROM cell_types WHERE updated_cell_id IS NOT NULL
    ), cases AS (
        SELECT * FROM refs WHERE NOT EXISTS (
            SELECT 1 FROM metadata m WHERE m.updated_cell_id = refs.k AND m.loaded_at <= refs.t
                AND (m.deleted_at IS NULL OR refs.t < m.deleted_at))
    )
"""
_P4_CELLS = """
    WITH c AS (
        SELECT DISTINCT slide_no, Run_Tissue_name AS tissue, Run_Tissue_name || ':' || fov AS own, updated_cell_id AS key,
            CenterX_global_px AS x, CenterY_global_px AS y
        FROM metadata
        WHERE CenterX_global_px IS NOT NULL AND CenterY_global_px IS NOT NULL AND NOT isnan(CenterX_global_px)
            AND NOT isnan(CenterY_global_px) AND NOT (CenterX_global_px = 0 AND CenterY_global_px = 0)
            AND updated_cell_id IS NOT NULL
    )
"""
SQL = {
    "p1_found": _P1_CASES + "SELECT DISTINCT src_table, strftime(t, '%Y-%m') AS load_month, k AS updated_cell_id FROM cases",
    "p1_report": _P1_CASES
    + "SELECT src_table, strftime(t, '%Y-%m') AS load_month, count(DISTINCT k) AS n_keys, count(*) AS n_rows FROM cases GROUP BY 1, 2",
    "p4_found": _P4_CELLS
    + f"""
    SELECT DISTINCT 'near' AS kind, least(a.key, b.key) AS key_a, greatest(a.key, b.key) AS key_b
    FROM c a JOIN c b ON a.tissue = b.tissue AND a.own < b.own AND b.x BETWEEN a.x - 26 AND a.x + 26
        AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= {NEAR_PX}::DOUBLE * {NEAR_PX}::DOUBLE
    UNION ALL
    SELECT DISTINCT 'region', c.key, f.uniqueFOV
    FROM c JOIN fov_positions f ON c.slide_no = f.slide_no AND c.own <> f.uniqueFOV
        AND c.x BETWEEN f.x_min_px AND f.x_max_px AND c.y BETWEEN f.y_min_px AND f.y_max_px
    """,
    "p4_fov_overlap": _P4_CELLS
    + """
    SELECT c.own AS own_fov, f.uniqueFOV AS other_fov, count(DISTINCT c.key) AS n_cells
    FROM c JOIN fov_positions f ON c.slide_no = f.slide_no AND c.own <> f.uniqueFOV
        AND c.x BETWEEN f.x_min_px AND f.x_max_px AND c.y BETWEEN f.y_min_px AND f.y_max_px
    GROUP BY 1, 2
    """,
}
