"""Molecules within cells: boxes around the middle of a cell, 16S levels, and small row verbs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.values import among

UM_PER_PX = 0.12


def cell_boxes(molecules: DataFrame, share: float = 0.8) -> DataFrame:
    """(cell, n, then median, lowest, highest and box bounds of x_um, y_um and z).

    The box reaches from the median `share` of the way to the lowest and the highest value. One aggregation by cell, to be
    joined back where needed: a window over cells would put the largest cell in one task.
    """
    aggs, bounds = [], []
    for axis, source in (("x", F.col("x_local_px") * UM_PER_PX), ("y", F.col("y_local_px") * UM_PER_PX), ("z", F.col("z"))):
        v = F.when(~F.isnan(source), source)
        aggs += [F.percentile(v, F.lit(0.5)).alias(f"median_{axis}"), F.min(v).alias(f"min_{axis}"), F.max(v).alias(f"max_{axis}")]
        mid = F.col(f"median_{axis}")
        bounds += [(mid - (mid - F.col(f"min_{axis}")) * share).alias(f"low_{axis}"), (mid + (F.col(f"max_{axis}") - mid) * share).alias(f"high_{axis}")]
    boxes = molecules.where(F.col("cell").isNotNull()).groupBy("cell").agg(F.count(F.lit(1)).alias("n"), *aggs)
    return boxes.select("*", *bounds)


def inside_box(molecules: DataFrame, boxes: DataFrame, target: str) -> DataFrame:
    """Molecules of one target with a confidence per axis (strictly inside the box: High) and overall."""
    sure = lambda v, axis: F.when((F.col(f"low_{axis}") < v) & (v < F.col(f"high_{axis}")), "High").otherwise("Low")
    marked = molecules.where(F.col("target") == target).join(boxes, "cell").withColumns(
        {
            "x_confidence": sure(F.col("x_local_px") * UM_PER_PX, "x"),
            "y_confidence": sure(F.col("y_local_px") * UM_PER_PX, "y"),
            "z_confidence": sure(F.col("z"), "z"),
        }
    )
    high = (F.col("x_confidence") == "High") & (F.col("y_confidence") == "High") & (F.col("z_confidence") == "High")
    return marked.withColumn("confidence", F.when(high, "High").otherwise("Low"))


def intracellular(cells: DataFrame, marked: DataFrame) -> DataFrame:
    """cells with location: Intracellular where a molecule lies inside the box, else Extracellular."""
    inside = marked.where(F.col("confidence") == "High").select(F.col("cell").alias("cell_id"), F.lit(True).alias("inside")).distinct()
    return cells.join(inside, "cell_id", "left").withColumn("location", F.when(F.col("inside"), "Intracellular").otherwise("Extracellular")).drop("inside")


def expression_levels(values: DataFrame, value: str) -> DataFrame:
    """values with level: Negative, Low, Medium or High by the quantiles 0.960, 0.990 and 0.999 of all rows."""
    q = F.broadcast(values.agg(F.percentile(value, F.array(F.lit(0.96), F.lit(0.99), F.lit(0.999))).alias("q")))
    v = F.col(value)
    level = F.when(v <= F.col("q")[0], "Negative").when(v <= F.col("q")[1], "Low").when(v <= F.col("q")[2], "Medium").when(v > F.col("q")[2], "High")
    return values.join(q).withColumn("level", level).drop("q")


def bacterial_state(levels: DataFrame) -> DataFrame:
    """levels with state: Intracellular_16S, Extracellular_16S or Negative."""
    state = F.when(F.col("level") == "Negative", "Negative").when(F.col("location") == "Intracellular", "Intracellular_16S").otherwise("Extracellular_16S")
    return levels.withColumn("state", F.when(F.col("level").isNotNull(), state))


def apply_filters(rows: DataFrame, text: str) -> tuple[DataFrame, list[str]]:
    """rows after the filters 'column,include|exclude,value,...;...', and the columns that were unknown and skipped.

    A null is not among the values: include drops it, exclude keeps it. The verb may be in any case.
    """
    skipped = []
    for part in filter(None, (p.strip() for p in text.split(";"))):
        column, verb, *values = (p.strip() for p in part.split(","))
        if column not in rows.columns:
            skipped.append(column)
        elif verb.lower() == "include":
            rows = rows.where(among(F.col(column), values))
        elif verb.lower() == "exclude":
            rows = rows.where(~among(F.col(column), values))
        else:
            raise ValueError(f"unknown filter verb {verb!r}")
    return rows, skipped


def neovariable(rows: DataFrame, spec: str) -> DataFrame:
    """rows with the column a_b pasted from 'a+b'; nulls are pasted as NA, and the parts stay."""
    parts = [p.strip() for p in spec.split("+")]
    return rows.withColumn("_".join(parts), F.concat_ws("_", *[F.coalesce(F.col(p).cast("string"), F.lit("NA")) for p in parts]))


def shared_columns_union(frames: list[DataFrame]) -> DataFrame:
    """All rows of the frames over the columns that every one of them has."""
    shared = [c for c in frames[0].columns if all(c in f.columns for f in frames)]
    united = frames[0].select(shared)
    for f in frames[1:]:
        united = united.unionByName(f.select(shared))
    return united


def histogram_bins(rows: DataFrame, value: str, bins: int) -> DataFrame:
    """(bin, n): equal-width bins from the lowest to the highest value, both included."""
    ends = F.broadcast(rows.agg(F.min(value).alias("lo"), F.max(value).alias("hi")))
    at = F.when(F.col("hi") > F.col("lo"), F.least(F.lit(bins), F.floor((F.col(value) - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins) + 1)).otherwise(F.lit(1))
    return rows.where(F.col(value).isNotNull()).join(ends).groupBy(at.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def bounding_boxes(points: DataFrame, by: str) -> DataFrame:
    """(by, x_min, x_max, y_min, y_max, width, height)."""
    box = points.groupBy(by).agg(F.min("x").alias("x_min"), F.max("x").alias("x_max"), F.min("y").alias("y_min"), F.max("y").alias("y_max"))
    return box.withColumns({"width": F.col("x_max") - F.col("x_min"), "height": F.col("y_max") - F.col("y_min")})


def best_rows(rows: DataFrame, by: str, order: list, n: int, ties: bool = False) -> DataFrame:
    """The first n rows of each group in `order`; with ties=True all rows that share the n-th place."""
    w = Window.partitionBy(by).orderBy(*order)
    return rows.withColumn("place", (F.rank() if ties else F.row_number()).over(w)).where(F.col("place") <= n)


def downsampled(rows: DataFrame, by: str, key: str, n: int, seed: int) -> DataFrame:
    """n rows of each group, the same ones on every run: those with the smallest md5 of key and seed."""
    return best_rows(rows, by, [F.md5(F.concat(F.col(key), F.lit(str(seed)))), F.col(key)], n)
