"""Points near other points, and points inside regions, over Z-order codes.

Distances: only places where owners mix can hold a pair, so points far from any other owner are dropped by a semi join of coarse
grid cells. The rest is grouped by (space, grid cell, owner) in a grid of half the radius; the disc of cells around an occupied
cell is covered with merged code ranges, and a range join with the sorted codes of the groups finds the pairs of groups that can
hold near points. Only such points are paired and measured, so a dense cell of one owner costs nothing.

Regions: a rectangle is covered with quadtree cells of a size that fits it (at most `fineness` + 1 a
side), adjacent ones merged into ranges; the range join gives each point the rectangles whose cover
contains its code, level by level, and the exact test follows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scratch import saved
from ..functions.zcurve import axis_index, code_sorted, cover_ranges, disc_ranges, level_join, sorted_range_join, with_morton

#: Grid cells per radius, and radii per coarse cell.
REACH, COARSE = 2, 16


def located(x: Column, y: Column) -> Column:
    """Whether (x, y) was measured: both are values and not both zero."""
    known = x.isNotNull() & y.isNotNull() & ~F.isnan(x) & ~F.isnan(y)
    return known & ~((x == 0) & (y == 0))


def near_pairs(points: DataFrame, radius: float) -> DataFrame:
    """Pairs of points of one space and different owners at most `radius` apart.

    points: (space, owner, key, x, y); further columns are ignored. Result, distinct: (space, key_a, key_b) with
    key_a < key_b by code point.

    Points with a null space, owner or key, or that are not `located`, pair with nothing. Repeated points
    count once; the same key at several places pairs through any of them, never with itself. No pair is
    lost at cell borders. Infinite coordinates are near nothing.
    """
    pts = points.where(located(F.col("x"), F.col("y"))).where(F.col("space").isNotNull() & F.col("owner").isNotNull() & F.col("key").isNotNull())
    pts = _where_owners_mix(pts.select("space", "owner", "key", "x", "y"), radius * COARSE).distinct()
    side = radius / REACH * (1 + 1e-9)  # cells a whole number of radii apart hold no pair at the radius, whatever was rounded
    pts = saved(with_morton(pts, axis_index(F.col("x"), side), axis_index(F.col("y"), side), "code"))  # for the groups and both sides of the pairs
    groups = code_sorted(pts.select("space", "owner", "code").distinct())

    def discs(batch: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return disc_ranges(batch.column("code").to_numpy(), REACH)

    def other_owner(a: pa.Table, b: pa.Table) -> pa.ChunkedArray:
        same_cell = pc.equal(a.column("code"), b.column("code"))
        return pc.if_else(same_cell, pc.less(a.column("owner"), b.column("owner")), pc.not_equal(a.column("owner"), b.column("owner")))

    meeting = sorted_range_join(groups.drop("z_part"), groups, discs, other_owner)
    meeting = meeting.select(F.col("a_space").alias("space"), F.col("a_owner").alias("owner_a"), F.col("a_code").alias("code_a"), F.col("b_owner").alias("owner"), F.col("b_code").alias("code"))
    a = pts.select("space", F.col("owner").alias("owner_a"), F.col("code").alias("code_a"), F.col("key").alias("k1"), F.col("x").alias("x1"), F.col("y").alias("y1"))
    b = pts.select("space", "owner", "code", F.col("key").alias("k2"), F.col("x").alias("x2"), F.col("y").alias("y2"))
    dx, dy = F.col("x1") - F.col("x2"), F.col("y1") - F.col("y2")
    return (
        meeting.join(a, ["space", "owner_a", "code_a"])
        .join(b, ["space", "owner", "code"])
        .where((dx * dx + dy * dy <= F.lit(float(radius) ** 2)) & (F.col("k1") != F.col("k2")))
        .select("space", F.least("k1", "k2").alias("key_a"), F.greatest("k1", "k2").alias("key_b"))
        .distinct()
    )


def _where_owners_mix(points: DataFrame, side: float) -> DataFrame:
    """Points of the grid cells that have, with the eight around them, more than one owner."""
    placed = points.withColumns({"cx": axis_index(F.col("x"), side), "cy": axis_index(F.col("y"), side)})
    around = F.array(*[F.struct((F.col("cx") + i).alias("cx"), (F.col("cy") + j).alias("cy")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    mixed = (
        placed.select("space", "cx", "cy", "owner")
        .distinct()
        .select("space", "owner", F.inline(around))
        .groupBy("space", "cx", "cy")
        .agg(F.min("owner").alias("one"), F.max("owner").alias("other"))
        .where(F.col("one") != F.col("other"))
        .select("space", "cx", "cy")
    )
    return placed.join(mixed, ["space", "cx", "cy"], "left_semi").drop("cx", "cy")


def in_regions(points: DataFrame, regions: DataFrame, side: float, fineness: int = 8) -> DataFrame:
    """Points with every rectangle of their space, other than their owner's, that contains them.

    points: (space, owner, key, x, y); regions: (space, region, x_min, x_max, y_min, y_max). Edges count as inside.
    Result, distinct: (space, key, region). `side` is the width of the finest grid cell.

    Points with a null space or key, or not `located`, are in no region; a null owner owns none.
    Rectangles with a missing or NaN bound, or whose bounds are reversed, contain nothing. Both tables may be empty.
    """
    bounds = ["x_min", "x_max", "y_min", "y_max"]
    whole = F.lit(True)
    for b in bounds:
        whole = whole & F.col(b).isNotNull() & ~F.isnan(b)
    rects = regions.select("space", "region", *bounds).where(
        whole & (F.col("x_min") <= F.col("x_max")) & (F.col("y_min") <= F.col("y_max"))
    ).distinct()
    extent = F.greatest(F.col("x_max") - F.col("x_min"), F.col("y_max") - F.col("y_min"))
    level = F.greatest(F.lit(0), F.least(F.lit(26), F.ceil(F.log2(F.greatest(extent, F.lit(side)) / F.lit(side * fineness))))).cast("int")
    covers = saved(cover_ranges(
        rects,
        ["space", "region", *bounds],
        axis_index(F.col("x_min"), side),
        axis_index(F.col("x_max"), side),
        axis_index(F.col("y_min"), side),
        axis_index(F.col("y_max"), side),
        level,
    ))
    pts = (
        points.where(located(F.col("x"), F.col("y")) & F.col("space").isNotNull() & F.col("key").isNotNull())
        .select("space", "owner", "key", "x", "y")
    )
    pts = with_morton(pts, axis_index(F.col("x"), side), axis_index(F.col("y"), side), "code")
    return (
        level_join(covers, pts, ["space"])
        .where(F.col("x").between(F.col("x_min"), F.col("x_max")) & F.col("y").between(F.col("y_min"), F.col("y_max")))
        .where(F.col("owner").isNull() | (F.col("owner") != F.col("region")))
        .select("space", "key", "region")
        .distinct()
    )
