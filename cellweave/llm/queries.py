"""Registered queries of the training-data problems, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table
from .leakage import shared_passages
from .lookalike import consistent_texts, look_alike_classes, look_alike_pairs
from .mixture import mixture, mixture_shares, sized_documents
from .quantiles import percentiles, value_counts
from .topn import top_items

#: Vocabulary in whose tokens documents are sized.
RANKS = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
TOP_GENES = 10
QUARTILES = [0.25, 0.5, 0.75]
AXES = ("x_local_px", "y_local_px", "z")
#: Least width of the middle half, per axis, and least number of values of a listed cell.
WIDE = {"x_local_px": 150.0, "y_local_px": 150.0, "z": 4.5}
LEAST_VALUES = 8


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "de_results").where(F.col("prob_DE").between(0, 1))


def p2_top_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_items(_scored(spark, sf_dir), ["run_ID", "cell_type"], "gene", "prob_DE", TOP_GENES)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p2_top_genes(spark, sf_dir).select("run_ID", "cell_type", "gene")


def _axis_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(cell, loaded_at, axis number, v), a row per molecule and axis."""
    molecules = table(spark, sf_dir, "transcripts").where(F.col("cell").isNotNull())
    values = F.array(*[F.struct(F.lit(i).cast("tinyint").alias("axis"), F.col(a).alias("v")) for i, a in enumerate(AXES)])
    return molecules.select("cell", "loaded_at", F.explode(values).alias("a")).select("cell", "loaded_at", "a.axis", "a.v")


def _by_axis_name(q: DataFrame) -> DataFrame:
    axis = F.element_at(F.array(*[F.lit(a) for a in AXES]), F.col("axis") + F.lit(1))
    return q.select("cell", axis.alias("axis"), "n", *[F.col("q")[i].alias(c) for i, c in enumerate(("q25", "q50", "q75"))])


def p3_quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = _axis_values(spark, sf_dir)
    return _by_axis_name(percentiles(values, ["cell", "axis"], QUARTILES, spread=True))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    width = F.col("q75") - F.col("q25")
    bound = F.element_at(F.create_map(*[F.lit(x) for kv in WIDE.items() for x in kv]), F.col("axis"))
    return p3_quartiles(spark, sf_dir).where((F.col("n") >= LEAST_VALUES) & (width >= bound)).select("cell", "axis")


def p3_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quartiles of all loads, from the value counts of each month's load."""
    values = _axis_values(spark, sf_dir).where(F.col("v").isNotNull() & ~F.isnan("v"))
    loads = value_counts(values.withColumn("load_month", F.date_format("loaded_at", "yyyy-MM")), ["cell", "axis", "load_month"])
    return _by_axis_name(percentiles(loads, ["cell", "axis"], QUARTILES, weight="w"))


def p6_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p6_passages(spark, sf_dir).select("doc_id", "item_id")


def p6_leaked_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents per leaked test item."""
    items = table(spark, sf_dir, "eval_items").select("item_id", "bench_name", "lang")
    return p6_found(spark, sf_dir).groupBy("item_id").agg(F.count(F.lit(1)).alias("n_docs")).join(items, "item_id")


def _sized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sized_documents(table(spark, sf_dir, "documents"), RANKS)


def p7_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(_sized(spark, sf_dir), table(spark, sf_dir, "mix_targets"))


def p7_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture_shares(_sized(spark, sf_dir), table(spark, sf_dir, "mix_targets"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return look_alike_pairs(table(spark, sf_dir, "documents"))


def p8_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consistent_texts(table(spark, sf_dir, "documents"), "doc_id", "text")


def p8_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return look_alike_classes(table(spark, sf_dir, "documents"))


QUERIES = {
    "p2_found": p2_found,
    "p2_top_genes": p2_top_genes,
    "p3_found": p3_found,
    "p3_quartiles": p3_quartiles,
    "p3_combined": p3_combined,
    "p6_found": p6_found,
    "p6_passages": p6_passages,
    "p6_leaked_items": p6_leaked_items,
    "p7_mixture": p7_mixture,
    "p7_shares": p7_shares,
    "p8_found": p8_found,
    "p8_texts": p8_texts,
    "p8_classes": p8_classes,
}

_P2 = """
    WITH scores AS (
        SELECT run_ID, cell_type, gene, max(prob_DE) AS prob_DE FROM de_results
        WHERE gene IS NOT NULL AND prob_DE IS NOT NULL AND NOT isnan(prob_DE) AND prob_DE BETWEEN 0 AND 1
        GROUP BY 1, 2, 3
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY run_ID, cell_type ORDER BY prob_DE DESC, gene) AS rank FROM scores
    )
"""
_P3 = """
    WITH long AS (
        SELECT cell, 'x_local_px' AS axis, x_local_px AS v FROM transcripts
        UNION ALL SELECT cell, 'y_local_px', y_local_px FROM transcripts
        UNION ALL SELECT cell, 'z', z FROM transcripts
    ), q AS (
        SELECT cell, axis, count(*) AS n, quantile_cont(v, 0.25) AS q25, quantile_cont(v, 0.5) AS q50, quantile_cont(v, 0.75) AS q75
        FROM long WHERE cell IS NOT NULL AND v IS NOT NULL AND NOT isnan(v) GROUP BY 1, 2
    )
"""
SQL = {
    "p2_found": _P2 + f"SELECT run_ID, cell_type, gene FROM ranked WHERE rank <= {TOP_GENES}",
    "p2_top_genes": _P2 + f"SELECT run_ID, cell_type, gene, prob_DE, rank::INT AS rank FROM ranked WHERE rank <= {TOP_GENES}",
    "p3_found": _P3
    + f"SELECT cell, axis FROM q WHERE n >= {LEAST_VALUES} AND q75 - q25 >= CASE WHEN axis = 'z' THEN {WIDE['z']} ELSE {WIDE['x_local_px']} END",
    "p3_quartiles": _P3 + "SELECT * FROM q",
    "p3_combined": _P3 + "SELECT * FROM q",
}
