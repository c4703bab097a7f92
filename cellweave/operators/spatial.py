"""Neighbour graphs of cells and what is computed over them.

Edges are rows (src, dst, dist): directed, within a subset (an FOV), without self edges.
"""

from __future__ import annotations

import math
import warnings

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..functions.levels import for_each_level
from ..functions.scratch import saved
from ..functions.zcurve import HALF


def slide_offsets(cells: DataFrame, slide: str = "slide", buffer: float = 1.2) -> DataFrame:
    """cells with x_adj and y_adj: slides laid out on a square grid, in the order of their names.

    The spacing is the range of all coordinates times `buffer`.
    """
    names = cells.select(slide).distinct().withColumn("idx", F.row_number().over(Window.orderBy(slide)) - 1)
    size = cells.agg((F.max("x") - F.min("x")).alias("w"), (F.max("y") - F.min("y")).alias("h"), F.countDistinct(slide).alias("n"))
    columns = F.ceil(F.sqrt("n"))
    return (
        cells.join(names, slide)
        .join(F.broadcast(size))
        .withColumn("x_adj", F.col("x") + (F.col("idx") % columns) * F.col("w") * buffer)
        .withColumn("y_adj", F.col("y") + F.floor(F.col("idx") / columns) * F.col("h") * buffer)
        .drop("idx", "w", "h", "n")
    )


def _strip(coordinate: Column, side: Column) -> Column:
    limit = F.lit(float(HALF))
    return F.floor(F.greatest(-limit, F.least(limit, coordinate / side))).cast("bigint")


def radius_edges(points: DataFrame, subset: str, key: str, radius: float) -> DataFrame:
    """(subset, src, dst, dist): all pairs at most `radius` apart, both directions.

    The grid is as wide as the radius; one side is entered in the nine cells around it, so each pair meets in one
    cell and the join is an equi-join on (subset, cell). Distance is tested squared.
    """
    side = F.lit(float(radius))
    pts = points.where(F.col("x").isNotNull() & F.col("y").isNotNull()).select(
        F.col(subset).alias("sub"), F.col(key).alias("k"), "x", "y", _strip(F.col("x"), side).alias("bx"), _strip(F.col("y"), side).alias("by")
    )
    around = F.array(*[F.struct((F.col("bx") + i).alias("bx"), (F.col("by") + j).alias("by")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    a = pts.select("sub", F.col("k").alias("src"), F.col("x").alias("xa"), F.col("y").alias("ya"), F.explode(around).alias("b")).select("sub", "src", "xa", "ya", "b.bx", "b.by")
    b = pts.select("sub", F.col("k").alias("dst"), F.col("x").alias("xb"), F.col("y").alias("yb"), "bx", "by")
    dx, dy = F.col("xa") - F.col("xb"), F.col("ya") - F.col("yb")
    return (
        a.join(b, ["sub", "bx", "by"])
        .where((F.col("src") != F.col("dst")) & (dx * dx + dy * dy <= F.lit(float(radius) ** 2)))
        .select(F.col("sub").alias(subset), "src", "dst", F.sqrt(dx * dx + dy * dy).alias("dist"))
    )


def knn_edges(points: DataFrame, subset: str, key: str, k: int, max_rounds: int = 20) -> DataFrame:
    """(subset, src, dst, dist, rank): the k nearest points of the same subset, ties by key; exact.

    Each subset gets a grid in which a cell holds about k points, finer where its fullest cell holds many more. A round
    compares the open points with the nine cells around them; a point is settled when k neighbours lie within one cell
    width, for nothing outside the nine cells can be nearer, or when the cells cover the subset. The rest go on with cells eight
    times as wide. Only points in sparse places need further rounds, so no round compares all pairs of a subset. Of points at one place only
    the first k + 1 by key can be among anyone's k nearest and are compared.
    """
    pts = saved(points.where(F.col("x").isNotNull() & F.col("y").isNotNull()).select(F.col(subset).alias("sub"), F.col(key).alias("k"), "x", "y"))
    w, h = F.max("x") - F.min("x"), F.max("y") - F.min("y")
    extent = F.greatest(w, h)
    grid = pts.groupBy("sub").agg(
        F.greatest(F.sqrt(F.greatest(w * h, extent) * k / F.count(F.lit(1))), F.lit(1e-9)).alias("even"), extent.alias("extent"), F.min("x").alias("x0"), F.min("y").alias("y0")
    )
    at_place = Window.partitionBy("sub", "x", "y").orderBy("k")
    placed = pts.withColumn("candidate", F.row_number().over(at_place) <= k + 1).join(grid, "sub")
    cell = [F.floor((F.col(c) - F.col(c + "0")) / F.col("even")).cast("bigint") for c in ("x", "y")]
    fullest = (
        placed.where("candidate").groupBy("sub", *[c.alias(f"b{i}") for i, c in enumerate(cell)]).agg(F.count(F.lit(1)).alias("m")).groupBy("sub").agg(F.max("m").alias("m"))
    )
    finer = F.greatest(F.lit(1.0), F.sqrt(F.col("m") / float(8 * k)))
    located = saved(placed.join(fullest, "sub").withColumn("side", F.col("even") / finer).drop("m", "even"))
    opened, settled = located, None
    for level in range(max_rounds):
        side = F.col("side") * float(8**level)
        at = lambda c, s=side: F.floor((F.col(c) - F.col(c + "0")) / s).cast("bigint")
        around = F.array(*[F.struct((F.col("bx") + i).alias("bx"), (F.col("by") + j).alias("by")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
        a = (
            opened.select("sub", F.col("k").alias("src"), F.col("x").alias("xa"), F.col("y").alias("ya"), side.alias("s"), "extent", at("x").alias("bx"), at("y").alias("by"))
            .withColumn("b", F.explode(around))
            .select("sub", "src", "xa", "ya", "s", "extent", "b.bx", "b.by")
        )
        b = located.where("candidate").select("sub", F.col("k").alias("dst"), F.col("x").alias("xb"), F.col("y").alias("yb"), at("x").alias("bx"), at("y").alias("by"))
        dx, dy = F.col("xa") - F.col("xb"), F.col("ya") - F.col("yb")
        nearest = Window.partitionBy("sub", "src").orderBy("d2", "dst")
        ranked = (
            a.join(b, ["sub", "bx", "by"])
            .where(F.col("src") != F.col("dst"))
            .select("sub", "src", "dst", (dx * dx + dy * dy).alias("d2"), "s", (F.col("s") >= F.col("extent")).alias("whole"))
            .where((F.col("d2") <= F.col("s") * F.col("s")) | F.col("whole"))  # farther ones cannot settle a point in this round
            .withColumn("rank", F.row_number().over(nearest))
            .where(F.col("rank") <= k)
        )
        # one row per open point: its neighbours so far, and whether they are final
        listed = ranked.groupBy("sub", F.col("src").alias("k")).agg(F.collect_list(F.struct("rank", "dst", "d2")).alias("near"))
        sure = (side >= F.col("extent")) | (F.coalesce(F.size("near"), F.lit(0)) == k)
        tried = saved(opened.join(listed, ["sub", "k"], "left").withColumn("done", F.coalesce(sure, F.lit(False))))
        found = tried.where("done").select("sub", F.col("k").alias("src"), F.inline("near"))
        settled = found if settled is None else settled.unionByName(found)
        opened = tried.where("NOT done").select(*located.columns)
        if opened.isEmpty():
            break
    else:
        raise ValueError(f"points are left without neighbours after {max_rounds} rounds; allow more")
    return settled.select(F.col("sub").alias(subset), "src", "dst", F.sqrt("d2").alias("dist"), "rank")


def neighbor_values(edges: DataFrame, cells: DataFrame, key: str, value: str) -> DataFrame:
    """(src, degree, total, mean) of a value over neighbours at a distance above 0; the mean divides by at least 1."""
    total = F.coalesce(F.sum("v"), F.lit(0.0))
    sums = edges.where(F.col("dist") > 0).join(cells.select(F.col(key).alias("dst"), F.col(value).alias("v")), "dst").groupBy("src").agg(
        F.count(F.lit(1)).alias("degree"), total.alias("total")
    )
    return (
        cells.select(F.col(key).alias("src"))
        .join(sums, "src", "left")
        .fillna(0, ["degree", "total"])
        .withColumn("mean", F.col("total") / F.greatest(F.col("degree"), F.lit(1)))
    )


def neighbor_tabulate(edges: DataFrame, cells: DataFrame, key: str, kind: str) -> DataFrame:
    """(src, kind, n, share): neighbours of each kind; coincident ones do not count. Kinds without neighbours have no row."""
    n = edges.where(F.col("dist") > 0).join(cells.select(F.col(key).alias("dst"), F.col(kind)), "dst").where(F.col(kind).isNotNull()).groupBy("src", kind).agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("src")))


def neighborhood_expression(edges: DataFrame, counts: DataFrame) -> DataFrame:
    """(src, gene, mean): mean count over all neighbours, coincident ones included; genes absent from all of them have no row."""
    degree = edges.groupBy("src").agg(F.count(F.lit(1)).alias("degree"))
    sums = edges.select("src", "dst").join(counts.select(F.col("cell_id").alias("dst"), "gene", "count"), "dst").groupBy("src", "gene").agg(F.sum("count").alias("s"))
    return sums.join(degree, "src").select("src", "gene", (F.col("s") / F.col("degree")).alias("mean"))


def neighbor_profile(edges: DataFrame, cells: DataFrame, key: str, kind: str, kinds: list[str]) -> DataFrame:
    """(key, one column per kind): neighbours of each kind, 0 where there are none."""
    n = edges.join(cells.select(F.col(key).alias("dst"), F.col(kind)), "dst").groupBy(F.col("src").alias(key)).pivot(kind, kinds).agg(F.count(F.lit(1)))
    return cells.select(key).join(n, key, "left").fillna(0)


def local_profile(edges: DataFrame, cells: DataFrame, key: str, kind: str) -> DataFrame:
    """(cell, kind, n): the long form of `neighbor_profile`, non-zero entries only."""
    return edges.join(cells.select(F.col(key).alias("dst"), F.col(kind)), "dst").where(F.col(kind).isNotNull()).groupBy(F.col("src").alias(key), kind).agg(F.count(F.lit(1)).alias("n"))


def _deviations(cells: DataFrame, by: str, key: str, values: list[str]) -> DataFrame:
    means = cells.groupBy(by).agg(*[F.avg(v).alias(f"m_{v}") for v in values])
    return cells.join(means, by).select(by, key, *[(F.col(v) - F.col(f"m_{v}")).alias(f"d_{v}") for v in values])


def moran(edges: DataFrame, cells: DataFrame, by: str, key: str, x: str, y: str | None = None) -> DataFrame:
    """(by, n, moran): Moran's I of x per subset over binary weights, or of x with y; null for a constant."""
    y = y or x
    dev = _deviations(cells.where(F.col(x).isNotNull() & F.col(y).isNotNull()), by, key, list(dict.fromkeys([x, y])))
    scale = dev.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(f"d_{x}") ** 2).alias("sx"), F.sum(F.col(f"d_{y}") ** 2).alias("sy"))
    a = dev.select(F.col(key).alias("src"), F.col(f"d_{x}").alias("dx"))
    b = dev.select(F.col(key).alias("dst"), F.col(f"d_{y}").alias("dy"))
    cross = edges.join(a, "src").join(b, "dst").groupBy(by).agg(F.sum(F.col("dx") * F.col("dy")).alias("s"), F.count(F.lit(1)).alias("w"))
    norm = F.sqrt(F.col("sx")) * F.sqrt(F.col("sy"))
    return scale.join(cross, by, "left").select(by, "n", F.when(norm > 0, F.col("n") / norm * F.col("s") / F.col("w")).alias("moran"))


def lisa(edges: DataFrame, cells: DataFrame, by: str, key: str, x: str, y: str | None = None) -> DataFrame:
    """(key, lisa): deviation of x times the summed deviations of y (or x) over the neighbours."""
    y = y or x
    dev = _deviations(cells.where(F.col(x).isNotNull() & F.col(y).isNotNull()), by, key, list(dict.fromkeys([x, y])))
    lag = edges.join(dev.select(F.col(key).alias("dst"), F.col(f"d_{y}").alias("dy")), "dst").groupBy(F.col("src").alias(key)).agg(F.sum("dy").alias("lag"))
    return dev.join(lag, key, "left").select(key, (F.col(f"d_{x}") * F.coalesce("lag", F.lit(0.0))).alias("lisa"))


def type_pairs(edges: DataFrame, cells: DataFrame, subset: str, key: str, kind: str, ligand: str, receptor: str) -> DataFrame:
    """(subset, ligand_cell, receptor_cell, dist): each unordered pair of a ligand and a receptor cell once.

    Where both are of one type, the first by name is the ligand cell.
    """
    kinds = cells.select(key, kind)
    a = kinds.select(F.col(key).alias("src"), F.col(kind).alias("ta"))
    b = kinds.select(F.col(key).alias("dst"), F.col(kind).alias("tb"))
    pairs = edges.join(a, "src").join(b, "dst").where((F.col("ta") == ligand) & (F.col("tb") == receptor))
    if ligand == receptor:
        pairs = pairs.where(F.col("src") < F.col("dst"))
    return pairs.select(subset, F.col("src").alias("ligand_cell"), F.col("dst").alias("receptor_cell"), "dist")


def units_minimum(counts: DataFrame, units: list[str]) -> DataFrame:
    """(cell_id, level): least count among the units of a multimer; cells that lack one have no row (a least count of 0)."""
    return (
        counts.where(F.col("gene").isin(units))
        .groupBy("cell_id")
        .agg(F.min("count").alias("level"), F.countDistinct("gene").alias("n"))
        .where(F.col("n") == len(set(units)))
        .drop("n")
    )


def lr_scores(pairs: DataFrame, cells: DataFrame, counts: DataFrame, subset: str, ligand: str, receptor: str) -> DataFrame:
    """pairs with lr_score, the subset's mean and that over its number of cells; 'a+b' names a multimer."""
    lig = units_minimum(counts, ligand.split("+")).select(F.col("cell_id").alias("ligand_cell"), F.col("level").alias("l"))
    rec = units_minimum(counts, receptor.split("+")).select(F.col("cell_id").alias("receptor_cell"), F.col("level").alias("r"))
    scored = pairs.join(lig, "ligand_cell", "left").join(rec, "receptor_cell", "left").withColumn("lr_score", F.coalesce("l", F.lit(0)) * F.coalesce("r", F.lit(0)))
    size = cells.groupBy(subset).agg(F.count(F.lit(1)).alias("n_cells"))
    means = scored.groupBy(subset).agg(F.avg("lr_score").alias("overall")).join(size, subset)
    return scored.join(means, subset).select(subset, "ligand_cell", "receptor_cell", "lr_score", "overall", (F.col("overall") / F.col("n_cells")).alias("overall_normalized"))


def signaling_scores(edges: DataFrame, cells: DataFrame, counts: DataFrame, subset: str, key: str, kind: str, anchors: list[str], targets: list[str], ligand: str, receptor: str) -> DataFrame:
    """(key, score) of each anchor cell: e^z of the receptor times the summed e^z of the ligand over target neighbours.

    z is taken within the subset over all its cells, zeros included; 0 without target neighbours; null where a gene does not vary.
    """

    def level(gene: str, name: str) -> DataFrame:
        v = counts.where(F.col("gene") == gene).select(F.col("cell_id").alias(key), F.col("count").alias("c"))
        held = cells.select(subset, key).join(v, key, "left").fillna(0, ["c"])
        moments = held.groupBy(subset).agg(F.avg("c").alias("m"), F.stddev_samp("c").alias("s"))
        return held.join(moments, subset).select(key, F.exp((F.col("c") - F.col("m")) / F.when(F.col("s") > 0, F.col("s"))).alias(name))

    target = cells.where(F.col(kind).isin(targets)).select(key).join(level(ligand, "lz"), key).select(F.col(key).alias("dst"), "lz")
    sums = edges.join(target, "dst").groupBy(F.col("src").alias(key)).agg(F.sum("lz").alias("near"), F.count(F.lit(1)).alias("n"))
    anchor = cells.where(F.col(kind).isin(anchors)).select(key).join(level(receptor, "rz"), key)
    return anchor.join(sums, key, "left").select(key, F.when(F.col("n").isNull(), 0.0).otherwise(F.col("rz") * F.col("near")).alias("score"))


def lr_table_scores(edges: DataFrame, cells: DataFrame, counts: DataFrame, pairs: DataFrame, subset: str, key: str, kind: str) -> DataFrame:
    """(ligand, receptor, ligand_type, receptor_type, subset, ligand_cell, receptor_cell, dist, lr_score, overall, overall_normalized) for a whole pair table.

    pairs: (ligand, receptor, ligand_cell, receptor_cell, r), types under the names of their cells; 'a+b' names a multimer, of which the least count
    is taken, 0 where a unit is absent. Cells of the two types at most r apart pair; of one type, each pair once. The score is the
    product of both levels; overall is its mean over a subset's pairs of a row of the table, overall_normalized that over the subset's cells.
    """
    kinds = cells.where(F.col(kind).isNotNull()).select(key, kind)
    table = pairs.select("ligand", "receptor", F.col("ligand_cell").alias("ligand_type"), F.col("receptor_cell").alias("receptor_type"), "r").distinct()
    typed = edges.join(kinds.select(F.col(key).alias("src"), F.col(kind).alias("ligand_type")), "src").join(kinds.select(F.col(key).alias("dst"), F.col(kind).alias("receptor_type")), "dst")
    met = typed.join(table, ["ligand_type", "receptor_type"]).where((F.col("dist") <= F.col("r")) & ((F.col("ligand_type") != F.col("receptor_type")) | (F.col("src") < F.col("dst"))))

    def levels(column: str, cell: str, name: str) -> DataFrame:
        units = table.select(column, F.explode(F.array_distinct(F.split(column, "\\+"))).alias("gene"), F.size(F.array_distinct(F.split(column, "\\+"))).alias("n")).distinct()
        held = counts.join(units, "gene").groupBy(F.col("cell_id").alias(cell), column, "n").agg(F.min("count").alias(name), F.count(F.lit(1)).alias("n_held"))
        return held.where("n_held = n").drop("n_held", "n")

    scored = met.join(levels("ligand", "src", "l"), ["src", "ligand"], "left").join(levels("receptor", "dst", "m"), ["dst", "receptor"], "left").withColumn("lr_score", F.coalesce("l", F.lit(0)) * F.coalesce("m", F.lit(0)))
    row = ["ligand", "receptor", "ligand_type", "receptor_type", subset]
    size = cells.groupBy(subset).agg(F.count(F.lit(1)).alias("n_cells"))
    means = scored.groupBy(*row).agg(F.avg("lr_score").alias("overall")).join(size, subset)
    return scored.join(means, row).select(
        *row, F.col("src").alias("ligand_cell"), F.col("dst").alias("receptor_cell"), "dist", "lr_score", "overall", (F.col("overall") / F.col("n_cells")).alias("overall_normalized")
    )


def signaling_table(edges: DataFrame, cells: DataFrame, counts: DataFrame, pairs: DataFrame, subset: str, key: str, kind: str) -> DataFrame:
    """(ligand, receptor, anchor_type, target_type, key, score): `signaling_scores` for every row of a pair table, the receptor's type being the anchor.

    A receptor of several genes is looked at by its first one. z is taken within the subset over all its cells, zeros included; the score is 0 without target
    neighbours and null where a gene does not vary.
    """
    table = pairs.select("ligand", F.split("receptor", "\\+")[0].alias("receptor"), F.col("receptor_cell").alias("anchor_type"), F.col("ligand_cell").alias("target_type")).distinct()
    genes = table.select(F.col("ligand").alias("gene")).unionByName(table.select(F.col("receptor").alias("gene"))).distinct()
    held = counts.join(genes, "gene").join(cells.select(F.col(key).alias("cell_id"), subset), "cell_id")
    n = cells.groupBy(subset).agg(F.count(F.lit(1)).cast("double").alias("n"))
    sums = n.join(for_each_level(n.select(subset), genes), subset).join(held.groupBy(subset, "gene").agg(F.sum("count").cast("double").alias("s1"), F.sum(F.col("count") * F.col("count")).cast("double").alias("s2")), [subset, "gene"], "left").fillna(0.0, ["s1", "s2"])
    mean, var = F.col("s1") / F.col("n"), (F.col("s2") - F.col("s1") * F.col("s1") / F.col("n")) / (F.col("n") - 1)
    moments = sums.select(subset, "gene", mean.alias("mean"), F.when((F.col("n") > 1) & (var > 1e-12), F.sqrt(var)).alias("sd"))

    def level(rows: DataFrame, gene: str, name: str) -> DataFrame:
        v = counts.select(F.col("cell_id").alias(key), F.col("gene").alias(gene), F.col("count").alias("c"))
        found = rows.join(v, [key, gene], "left").fillna(0, ["c"]).join(moments.withColumnRenamed("gene", gene), [subset, gene])
        return found.withColumn(name, F.exp((F.col("c") - F.col("mean")) / F.col("sd"))).drop("c", "mean", "sd")

    typed = cells.where(F.col(kind).isNotNull()).select(subset, key, kind)
    targets = level(typed.withColumnRenamed(kind, "target_type").join(table.select("ligand", "target_type").distinct(), "target_type"), "ligand", "lz")
    near = edges.select("src", "dst").join(targets.select(F.col(key).alias("dst"), "ligand", "target_type", "lz"), "dst").groupBy(F.col("src").alias(key), "ligand", "target_type").agg(F.sum("lz").alias("near"), F.count(F.lit(1)).alias("m"))
    anchors = level(typed.withColumnRenamed(kind, "anchor_type").join(table, "anchor_type"), "receptor", "rz")
    score = F.when(F.col("m").isNull(), 0.0).otherwise(F.col("rz") * F.col("near"))
    return anchors.join(near, [key, "ligand", "target_type"], "left").select("ligand", "receptor", "anchor_type", "target_type", key, score.alias("score"))


def neighborhood_summary(edges: DataFrame, cells: DataFrame, key: str, columns: list[str], most: int = 200) -> DataFrame:
    """(src, variable, level, value): sums of numeric columns and counts of each level of the others, over neighbours at a distance above 0.

    What a column is follows from its type. Cells without neighbours have a sum of 0 and no levels; more than `most` levels give a warning.
    """
    numeric = [c for c in columns if isinstance(cells.schema[c].dataType, NumericType)]
    found = None
    for c in columns:
        if c in numeric:
            part = neighbor_values(edges, cells.where(F.col(c).isNotNull()), key, c).select("src", F.lit(c).alias("variable"), F.lit(None).cast("string").alias("level"), F.col("total").alias("value"))
        else:
            if cells.select(c).distinct().limit(most + 1).count() > most:
                warnings.warn(f"{c} has more than {most} levels", stacklevel=2)
            part = neighbor_tabulate(edges, cells, key, c).select("src", F.lit(c).alias("variable"), F.col(c).cast("string").alias("level"), F.col("n").cast("double").alias("value"))
        found = part if found is None else found.unionByName(part)
    return found


def quadrat_counts(points: DataFrame, by: str, nx: int, ny: int) -> DataFrame:
    """(by, qx, qy, n): points per quadrat of each window's bounding box, empty quadrats included."""
    box = points.groupBy(by).agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))
    at = lambda c, n: F.when(F.col(f"{c}1") > F.col(f"{c}0"), F.least(F.lit(n - 1), F.floor((F.col(c) - F.col(f"{c}0")) / (F.col(f"{c}1") - F.col(f"{c}0")) * n))).otherwise(0).cast("int")
    n = points.select(by, "x", "y").join(box, by).groupBy(by, at("x", nx).alias("qx"), at("y", ny).alias("qy")).agg(F.count(F.lit(1)).alias("n"))
    quads = box.select(by, F.explode(F.sequence(F.lit(0), F.lit(nx - 1))).alias("qx")).withColumn("qy", F.explode(F.sequence(F.lit(0), F.lit(ny - 1))))
    return quads.join(n, [by, "qx", "qy"], "left").fillna(0, ["n"])


def quadrat_test(counts: DataFrame, by: str) -> DataFrame:
    """(by, n, chi2, df, vmr): dispersion of quadrat counts; vmr is chi2 over df."""
    expected = F.sum("n") / F.count(F.lit(1))
    chi2 = F.sum(F.col("n") * F.col("n")) / expected - F.sum("n")
    return counts.groupBy(by).agg(F.sum("n").alias("n"), chi2.alias("chi2"), (F.count(F.lit(1)) - 1).cast("int").alias("df")).withColumn("vmr", F.col("chi2") / F.col("df"))


def quadrat_suggestions(boxes: DataFrame, by: str, low: float = 5, high: float = 10, max_nx: int = 10) -> DataFrame:
    """(by, nx, ny, quadrats, points_per_quadrat): grids that give a window `low` to `high` points per quadrat.

    boxes: (by, width, height, n). A half is rounded to the even number.
    """
    made = (
        boxes.where((F.col("width") > 0) & (F.col("height") > 0))
        .withColumn("nx", F.explode(F.sequence(F.lit(2), F.lit(max_nx))))
        .withColumn("ny", F.greatest(F.lit(1), F.bround(F.col("nx") * F.col("height") / F.col("width")).cast("int")))
        .withColumn("quadrats", F.col("nx") * F.col("ny"))
        .withColumn("per", F.col("n") / F.col("quadrats"))
    )
    return made.where(F.col("per").between(low, high)).select(by, "nx", "ny", "quadrats", F.round("per", 2).alias("points_per_quadrat"))


def to_micrometres(value: float, unit: str) -> float:
    """A length in um, mm or px as the radius unit used for neighbours: um as is, mm / 1000, px / 0.12."""
    factors = {"um": 1.0, "mm": 1 / 1000, "px": 1 / 0.12}
    if unit not in factors or not math.isfinite(value):
        raise ValueError(f"unknown length {value!r} {unit!r}")
    return value * factors[unit]
