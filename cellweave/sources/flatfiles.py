"""Flat files of a run: one folder per slide with metadata, counts, molecules and a run summary.

Each reader takes the folder of all slides and reads every slide in one job; the slide's name is the
folder's. Compressed CSV cannot be split, so counts are best read once and kept as Parquet (`write_stage`).
"""

from __future__ import annotations

import json
import re
import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

#: Columns of the molecule files; z is a number.
MOLECULES = "fov string, cell_ID string, cell string, x_local_px double, y_local_px double, x_global_px double, y_global_px double, z double, target string, CellComp string"
PAIRS = "receptor_id string, receptor string, ligand string, receptor_cell string, ligand_cell string, cell_type_col string, r double"


def slide_of_path() -> Column:
    """Name of the folder a row's file lies in; of a partition folder column=value the value."""
    return F.regexp_extract("_metadata.file_path", r"([^/=]+)/[^/]+$", 1)


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    """df, or an error that names the columns it lacks."""
    lacking = [c for c in columns if c not in df.columns]
    if lacking:
        raise ValueError(f"columns are missing: {', '.join(lacking)}")
    return df


def cell_key(*parts: str) -> Column:
    """Cell id: c and the parts, joined by underscores; null if a part is."""
    return F.concat(F.lit("c_"), *[x for p in parts[:-1] for x in (F.col(p).cast("string"), F.lit("_"))], F.col(parts[-1]).cast("string"))


def header_groups(spark: SparkSession, pattern: str) -> list[tuple[list[str], list[str]]]:
    """(columns, paths) of the CSV files of a pattern, files with the same header line together; empty files are left out.

    Spark reads files of one call by position under the header of one of them, so only files of a group may be read in one call.
    A header costs a look at the first lines of its file.
    """
    files = sorted(r[0] for r in spark.read.format("binaryFile").load(pattern).select("path").collect())
    groups: dict[tuple[str, ...], list[str]] = {}
    for path in (re.sub(r"([\\{}\[\]*?])", r"\\\1", f) for f in files):
        columns = tuple(spark.read.option("header", True).csv(path).columns)
        if columns:
            groups.setdefault(columns, []).append(path)
    return [(list(columns), paths) for columns, paths in groups.items()]


def shared_columns(groups: list[tuple[list[str], list[str]]], needed: list[str]) -> list[str]:
    """Names that every header has, in the order of the first; an error if a needed one is not among them.

    The columns left out are named in a warning.
    """
    shared = [c for c in (groups[0][0] if groups else []) if all(c in columns for columns, _ in groups)]
    lacking = [c for c in needed if c not in shared]
    if lacking:
        raise ValueError(f"columns are missing: {', '.join(lacking)}")
    apart = sorted({c for columns, _ in groups for c in columns} - set(shared))
    if apart:
        warnings.warn(f"{len(apart)} columns that not every file has are left out: {', '.join(apart)}", stacklevel=3)
    return shared


def _common_type(rows: list[DataFrame], column: str):
    """The type of a column that fits all of several frames with inferred types; one without any value of it has no say."""
    kinds = {df.schema[column].dataType.simpleString(): df.schema[column].dataType for df in rows}
    if len(kinds) > 1:
        valued = [df for df in rows if df.schema[column].dataType != StringType() or not df.where(F.col(f"`{column}`").isNotNull()).isEmpty()]
        kinds = {df.schema[column].dataType.simpleString(): df.schema[column].dataType for df in valued}
    wider = [k for order in (("int", "bigint", "double"), ("date", "timestamp")) if kinds.keys() <= set(order) for k in order if k in kinds]
    return next(iter(kinds.values())) if len(kinds) == 1 else kinds[wider[-1]] if wider else StringType()


def read_cells(spark: SparkSession, root: str, pattern: str = "*metadata_file*") -> DataFrame:
    """Metadata of all slides, with Run_Tissue_name from the folder and uniqueFOV.

    Columns that not every file has are left out: files are matched by name, values read as text where they do not fit one type.
    """
    groups = header_groups(spark, f"{root}/*/{pattern}")
    shared = shared_columns(groups, ["fov", "cell_ID"])
    inferred = [spark.read.option("header", True).option("inferSchema", True).csv(paths) for _, paths in groups]
    types = {c: _common_type(inferred, c) for c in shared}
    rows = None
    for columns, paths in groups:
        schema = StructType([StructField(c, types.get(c, StringType())) for c in columns])
        part = spark.read.option("header", True).schema(schema).csv(paths).select(*[F.col(f"`{c}`") for c in shared], slide_of_path().alias("Run_Tissue_name"))
        rows = part if rows is None else rows.unionByName(part)
    return rows.withColumn("uniqueFOV", F.concat("Run_Tissue_name", F.lit(":"), F.col("fov").cast("string")))


def read_counts(spark: SparkSession, root: str, pattern: str = "*exprMat_file*") -> DataFrame:
    """(Run_Tissue_name, fov, cell_ID, gene, count): non-zero entries of the wide count files, for the genes that every file has.

    Genes are matched by name. A short line lacks its last genes; what is missing or not a number is 0. Rows of cell 0, molecules outside any cell, stay.
    """
    groups = header_groups(spark, f"{root}/*/{pattern}")
    genes = [c for c in shared_columns(groups, ["fov", "cell_ID"]) if c not in ("fov", "cell_ID")]
    long = None
    for _, paths in groups:
        wide = spark.read.option("header", True).csv(paths).select("fov", "cell_ID", *[F.col(f"`{g}`") for g in genes], slide_of_path().alias("Run_Tissue_name"))
        part = wide.unpivot(["Run_Tissue_name", "fov", "cell_ID"], [F.col(f"`{g}`") for g in genes], "gene", "count")
        long = part if long is None else long.unionByName(part)
    return long.withColumn("count", F.col("count").try_cast("bigint")).where(F.col("count") != 0).withColumns(
        {"fov": F.col("fov").try_cast("int"), "cell_ID": F.col("cell_ID").try_cast("int")}
    )


def assay_of(gene: Column, bacterial: list[str]) -> Column:
    """system, negative, bacterial or RNA; system probes come first and belong to no assay that is analysed."""
    return (
        F.when(gene.rlike("SystemControl"), "system").when(gene.rlike("Negative"), "negative").when(gene.isin(bacterial) if bacterial else F.lit(False), "bacterial").otherwise("RNA")
    )


def aligned(cells: DataFrame, counts: DataFrame, key: str = "cell_id") -> tuple[DataFrame, DataFrame]:
    """Cells that have counts, and counts of cells that have metadata."""
    return cells.join(counts.select(key).distinct(), key, "left_semi"), counts.join(cells.select(key), key, "left_semi")


def read_run_ids(spark: SparkSession, root: str, slides: DataFrame | None = None, pattern: str = "Run_*_ExptConfig.txt", seed: int = 0) -> DataFrame:
    """(Run_Tissue_name, run_ID): from the first line of each slide's run summary, at any depth below the slide's folder.

    A slide of `slides` (Run_Tissue_name) without a summary, or whose summary says nothing, gets a hash of its name. Of several summaries the
    smallest number counts.
    """
    base = root.rstrip("/").rsplit("/", 1)[-1]
    slide = F.regexp_extract("_metadata.file_path", "/" + re.sub(r"(\W)", r"\\\1", base) + r"/(?:[^/=]+=)?([^/]+)/", 1)
    schema = StructType([StructField("value", StringType())])
    texts = spark.read.schema(schema).option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", pattern).format("text").load(root)
    first = F.regexp_extract(F.split("value", "\\r?\\n")[0], r"^Run Number: (.+)$", 1)
    found = texts.select(slide.alias("Run_Tissue_name"), F.trim(first).alias("number")).groupBy("Run_Tissue_name").agg(F.min(F.when(F.col("number") != "", F.col("number"))).alias("number"))
    if slides is not None:
        found = slides.select("Run_Tissue_name").distinct().join(found, "Run_Tissue_name", "left")
    made = F.substring(F.sha2(F.concat("Run_Tissue_name", F.lit(f"|{seed}")), 256), 1, 37)
    return found.select("Run_Tissue_name", F.coalesce("number", made).alias("run_ID"))


def with_additional(cells: DataFrame, extra: DataFrame, on: str) -> DataFrame:
    """cells with further columns of a table, by a column both have; if either lacks it, the cells as they are."""
    if on not in cells.columns or on not in extra.columns:
        return cells
    fresh = [c for c in extra.columns if c == on or c not in cells.columns]
    return cells.join(extra.select(fresh).dropDuplicates([on]), on, "left")


def read_molecules(spark: SparkSession, path: str, **options) -> DataFrame:
    """Molecule files with declared types; `options` are those of Spark's CSV reader (multiLine for texts with line ends, a file is then one task)."""
    return spark.read.option("header", True).options(**options).schema(MOLECULES).csv(path)


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    """(gene, cell_type, value) of a profile table whose first, unnamed column holds the genes."""
    wide = spark.read.option("header", True).csv(path)
    gene, *types = wide.columns
    return wide.withColumnRenamed(gene, "gene").unpivot(["gene"], types, "cell_type", "value").withColumn("value", F.col("value").try_cast("double"))


def scaled_profiles(profiles: DataFrame, genes: DataFrame) -> DataFrame:
    """Profiles over the genes that are measured, as thousandths of the 99th percentile of all entries."""
    shared = profiles.join(genes.select("gene").distinct(), "gene", "left_semi")
    top = F.broadcast(shared.agg(F.percentile("value", F.lit(0.99)).alias("top")))
    return shared.join(top).select("gene", "cell_type", (F.col("value") / F.when(F.col("top") != 0, F.col("top")) * 1000).alias("value"))


def read_pathways(spark: SparkSession, path: str) -> DataFrame:
    """(category, subcategory) of a headerless csv or tsv file."""
    kind = path.rsplit(".", 1)[-1].lower()
    if kind not in ("csv", "tsv"):
        raise ValueError(f"a pathway table is a csv or tsv file, not {kind}; save spreadsheets as one of these")
    return spark.read.option("sep", "," if kind == "csv" else "\t").schema("category string, subcategory string").csv(path)


def read_gene_sets(spark: SparkSession, path: str, wanted: DataFrame | None = None) -> DataFrame:
    """Distinct (gs_name, gene) of a Parquet table with category and subcategory, for the wanted ones."""
    sets = spark.read.parquet(path)
    if wanted is not None:
        same = (sets["category"] == wanted["category"]) & (wanted["subcategory"].isNull() | (sets["subcategory"] == wanted["subcategory"]))
        sets = sets.join(wanted, same, "left_semi")
    return sets.select("gs_name", "gene").dropDuplicates()


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Ligand-receptor pairs of a headerless file."""
    return spark.read.schema(PAIRS).csv(path)


def read_regulons(spark: SparkSession, path: str) -> DataFrame:
    """(tf, target, mor, confidence) of a table of transcription factors with a header; mor is 1 or -1."""
    rows = require(spark.read.option("header", True).csv(path), ["tf", "target", "mor", "confidence"])
    return rows.select("tf", "target", F.col("mor").try_cast("int").alias("mor"), "confidence").dropDuplicates()


def query_file(spark: SparkSession, path: str, sql: str) -> DataFrame:
    """Result of a SQL query over a CSV file with a header, called f in the query."""
    spark.read.option("header", True).option("inferSchema", True).csv(path).createOrReplaceTempView("f")
    return spark.sql(sql)


def write_stage(df: DataFrame, path: str, by: str | None = None) -> None:
    """A stage's table as Parquet, partitioned by slide if `by` says so."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).parquet(path)


def write_result(df: DataFrame, path: str) -> None:
    """A result as CSV files with headers."""
    df.write.mode("overwrite").option("header", True).csv(path)


def create_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """The table `name` with the rows of df, in place of any before; its files lie in `path`, if given."""
    writer = df.write.mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def mark_stage(spark: SparkSession, path: str, stage: str) -> None:
    """Note in a small file which stage ran last."""
    spark.createDataFrame([(json.dumps({"stage": stage}),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def last_stage(spark: SparkSession, path: str) -> str:
    """The stage noted by `mark_stage`."""
    return json.loads(spark.read.text(path).first()[0])["stage"]
