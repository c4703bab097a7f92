"""Point-pattern statistics between cell types, per FOV: border-corrected G and K curves and tests on them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.mixing import GOLDEN, mixed
from ..functions.scratch import saved

#: Points of a window for each task that deals its labels, and bytes of one array there, unless one simulation needs more.
DEALT, HELD = 20_000, 1 << 21


def framed(points: DataFrame, by: str, kind: str) -> DataFrame:
    """points with border (distance to the edge of their window) and area of the window, its points' bounding box."""
    box = points.groupBy(by).agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))
    border = F.least(F.col("x") - F.col("x0"), F.col("x1") - F.col("x"), F.col("y") - F.col("y0"), F.col("y1") - F.col("y"))
    return (
        points.where(F.col(kind).isNotNull())
        .join(box, by)
        .select(by, "cell_id", F.col(kind).alias("kind"), border.alias("border"), ((F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))).alias("area"))
    )


def cross_curves(edges: DataFrame, frame: DataFrame, by: str, radii: list[float]) -> DataFrame:
    """(by, type_i, type_j, r, n_i, g, k): curves of nearest distances and of counts from type i to type j.

    edges must reach the largest radius. Only points of type i at least r from the border count at r. g is the share of them with a
    point of type j within r; k the mean number of these over their density. Null where no point counts, or the window has no area.
    """
    grid = F.explode(F.array(*[F.lit(float(r)) for r in radii]))
    inner = frame.withColumn("r", grid).where(F.col("border") >= F.col("r")).groupBy(by, F.col("kind").alias("type_i"), "r").agg(F.count(F.lit(1)).alias("n_i"))
    kinds = frame.groupBy(by, "kind").agg(F.count(F.lit(1)).alias("n_j"), F.first("area").alias("area"))
    levels = kinds.select(by, F.col("kind").alias("type_i")).join(kinds.select(by, F.col("kind").alias("type_j"), "n_j", "area"), by).withColumn("r", grid)
    a = frame.select(F.col("cell_id").alias("src"), F.col("kind").alias("type_i"), "border")
    b = frame.select(F.col("cell_id").alias("dst"), F.col("kind").alias("type_j"))
    near = (
        edges.select(by, "src", "dst", "dist")
        .join(a, "src")
        .join(b, "dst")
        .withColumn("r", grid)
        .where((F.col("dist") <= F.col("r")) & (F.col("border") >= F.col("r")))
        .groupBy(by, "type_i", "type_j", "r", "src")
        .agg(F.count(F.lit(1)).alias("c"))
        .groupBy(by, "type_i", "type_j", "r")
        .agg(F.count(F.lit(1)).alias("reached"), F.sum("c").alias("pairs"))
    )
    return (
        levels.join(inner, [by, "type_i", "r"], "left")
        .join(near, [by, "type_i", "type_j", "r"], "left")
        .select(
            by,
            "type_i",
            "type_j",
            "r",
            F.coalesce("n_i", F.lit(0)).alias("n_i"),
            F.when(F.col("n_i") > 0, F.coalesce("reached", F.lit(0)) / F.col("n_i")).alias("g"),
            F.when((F.col("n_i") > 0) & (F.col("area") > 0), F.coalesce("pairs", F.lit(0)) * F.col("area") / (F.col("n_j") * F.col("n_i"))).alias("k"),
        )
    )


def curve_summary(curves: DataFrame, by: str, value: str) -> DataFrame:
    """(by, type_i, type_j, auc, highest): sum of the curve times the mean step of r, and its maximum."""
    step = (F.max("r") - F.min("r")) / (F.count(F.lit(1)) - 1)
    known = curves.where(F.col(value).isNotNull())
    return known.groupBy(by, "type_i", "type_j").agg(F.count(F.lit(1)).alias("n"), (F.sum(value) * F.when(F.count(F.lit(1)) > 1, step)).alias("auc"), F.max(value).alias("highest"))


def auc_differences(summary: DataFrame, by: str, i: str, j: str, k: str) -> DataFrame:
    """(by, delta): difference of the areas of i to j and i to k."""
    of = lambda t: F.max(F.when(F.col("type_j") == t, F.col("auc")))
    return summary.where(F.col("type_i") == i).groupBy(by).agg((of(j) - of(k)).alias("delta")).where(F.col("delta").isNotNull())


def sign_flip_test(deltas: DataFrame, by: str, flips: int, seed: int) -> DataFrame:
    """(mean_delta, p_value, n): share of random sign flips whose mean is as far from 0 as the observed one.

    The sign of a row in a flip is a bit of the md5 of its key, the flip and the seed, so reruns agree.
    """
    minus = F.substring(F.md5(F.concat_ws("|", F.col(by), F.col("flip").cast("string"), F.lit(str(seed)))), 1, 1) < "8"
    mean = deltas.agg(F.avg("delta").alias("mean_delta"), F.count(F.lit(1)).alias("n"))
    means = (
        deltas.withColumn("flip", F.explode(F.sequence(F.lit(1), F.lit(flips))))
        .groupBy("flip")
        .agg(F.avg(F.when(minus, -F.col("delta")).otherwise(F.col("delta"))).alias("m"))
    )
    far = F.abs(F.round("m", 9)) >= F.abs(F.round("mean_delta", 9))
    return means.join(F.broadcast(mean)).groupBy("mean_delta", "n").agg(F.avg(far.cast("double")).alias("p_value"))


def relabelled(frame: DataFrame, by: str, simulations: int, seed: int) -> DataFrame:
    """(by, sim, cell_id, kind): the types of a window's points dealt out anew in each simulation."""
    own = Window.partitionBy(by).orderBy("cell_id")
    labels = frame.select(by, "kind", F.row_number().over(own).alias("place"))
    sims = frame.select(by, "cell_id").withColumn("sim", F.explode(F.sequence(F.lit(1), F.lit(simulations))))
    dealt = Window.partitionBy(by, "sim").orderBy(F.md5(F.concat_ws("|", "cell_id", F.col("sim").cast("string"), F.lit(str(seed)))), "cell_id")
    return sims.withColumn("place", F.row_number().over(dealt)).join(labels, [by, "place"]).select(by, "sim", "cell_id", "kind")


def envelope(edges: DataFrame, frame: DataFrame, by: str, r: float | list[float], simulations: int, seed: int) -> DataFrame:
    """(by, type_i, type_j, r, lowest, highest): range of the share g at each radius over simulated labels.

    A simulation deals the types of a window's points out anew, in the order of a hash of point and simulation. Labels are dealt within a task that
    holds a window's points and edges as numbers, and only the ranges leave it; a window of many points is dealt in several tasks, each with
    some of the simulations.
    """
    radii = sorted({float(x) for x in (r if isinstance(r, (list, tuple)) else [r])})
    text = frame.schema[by].dataType.simpleString()
    below = lambda test: sum((test(F.lit(x)).cast("int") for x in radii), F.lit(0)).cast("smallint")
    at = (F.row_number().over(Window.partitionBy(by).orderBy("cell_id")) - 1).alias("i")
    inside = below(lambda x: F.col("border") >= x).alias("inside")  # so many radii count at the point
    points = saved(frame.select(by, "cell_id", at, inside, F.xxhash64("cell_id", F.lit(seed)).alias("h"), "kind"))
    tasks = F.least(F.lit(simulations), F.ceil(F.count(F.lit(1)) / DEALT)).cast("int")
    parts = saved(points.groupBy(by).agg(tasks.alias("parts")))
    near = edges.where(F.col("dist") <= radii[-1]).select("src", "dst", below(lambda x: F.col("dist") > x).alias("q"))  # q: the first radius that reaches
    near = near.join(points.select(by, F.col("cell_id").alias("src"), "i", "inside"), "src").where(F.col("q") < F.col("inside"))
    near = near.join(points.select(F.col("cell_id").alias("dst"), F.col("i").alias("j")), "dst")
    nothing = lambda kind: F.lit(None).cast(kind)
    rows = points.select(by, "i", "inside", "h", "kind", nothing("int").alias("j"), nothing("smallint").alias("q")).unionByName(
        near.select(by, "i", "inside", nothing("bigint").alias("h"), nothing("string").alias("kind"), "j", "q")
    )
    work = rows.join(parts, by).select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))

    def ranges(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, near = [], []
        for batch in batches:
            c = {name: batch.column(name) for name in ("i", "inside", "h", "kind", "j", "q", "parts")}
            point = c["j"].is_null()
            if pc.any(point).as_py():
                held.append(pa.table({n: c[n].filter(point) for n in ("i", "inside", "h", "kind", "parts")}))
            if not pc.all(point).as_py():
                edge = pc.invert(point)
                near.append([c[n].filter(edge).to_numpy().astype(t) for n, t in (("i", np.int32), ("j", np.int32), ("q", np.uint8))])
        own = pa.concat_tables(held).sort_by("i")
        kinds = sorted(pc.unique(own["kind"]).to_pylist())
        label = pc.index_in(own["kind"], pa.array(kinds)).to_numpy().astype(np.int64)
        inside, h, n, t, m = own["inside"].to_numpy().astype(np.int64), own["h"].to_numpy().view(np.uint64), len(own), len(kinds), len(radii)
        src, dst, q = (np.concatenate(x) for x in zip(*near, strict=True)) if near else (np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.uint8))
        order = np.argsort(q, kind="stable")[::-1]  # the nearest are written last and stay
        src, dst, q = src[order].astype(np.int64), dst[order], q[order]
        lowest, highest = np.full((t, t, m), np.inf), np.full((t, t, m), -np.inf)
        mine = np.arange(1 + key[1].as_py(), simulations + 1, own["parts"][0].as_py())
        step = max(1, min(len(mine), HELD // max(1, n * t, len(q), t * t * (m + 1))))
        for sims in (mine[k : k + step] for k in range(0, len(mine), step)):
            z, s = len(sims), np.arange(len(sims))[:, None]
            dealt = np.empty((z, n), np.int64)
            np.put_along_axis(dealt, np.argsort(mixed(h[None, :] + sims.astype(np.uint64)[:, None] * GOLDEN), axis=1, kind="stable"), label[None, :], axis=1)
            first = np.full(z * n * t, m, np.uint8)
            first[((s * n + src) * t + dealt[:, dst]).ravel()] = np.broadcast_to(q, (z, len(q))).ravel()
            met = np.flatnonzero(first < m)
            place = met // t  # simulation and point
            pair = ((place // n) * t + dealt.ravel()[place]) * t + met % t
            size = z * t * t * (m + 1)
            c = np.bincount(pair * (m + 1) + first[met], minlength=size) - np.bincount(pair * (m + 1) + inside[place % n], minlength=size)
            c = np.cumsum(c.reshape(z, t, t, m + 1), axis=3)[..., :m]
            n_i = np.bincount(((s * t + dealt) * (m + 1) + inside).ravel(), minlength=z * t * (m + 1)).reshape(z, t, m + 1)
            n_i = n_i[..., ::-1].cumsum(axis=2)[..., ::-1][..., 1:][:, :, None, :]
            known = np.broadcast_to(n_i > 0, c.shape)
            g = c / np.maximum(n_i, 1)
            lowest = np.minimum(lowest, np.where(known, g, np.inf).min(axis=0))
            highest = np.maximum(highest, np.where(known, g, -np.inf).max(axis=0))
        a, b, k = np.nonzero(lowest < np.inf)
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[0].as_py()] * len(a), key[0].type), pa.array([kinds[x] for x in a], pa.string()), pa.array([kinds[x] for x in b], pa.string()),
             pa.array(np.array(radii)[k]), pa.array(lowest[a, b, k]), pa.array(highest[a, b, k])], names=[by, "type_i", "type_j", "r", "lowest", "highest"],
        )

    found = work.groupBy(by, "part").applyInArrow(ranges, f"`{by}` {text}, type_i string, type_j string, r double, lowest double, highest double")
    return found.groupBy(by, "type_i", "type_j", "r").agg(F.min("lowest").alias("lowest"), F.max("highest").alias("highest"))


def label_difference_test(edges: DataFrame, frame: DataFrame, by: str, radii: list[float], i: str, j: str, k: str, simulations: int, seed: int) -> DataFrame:
    """(by, delta, p_value): area of g from i to j minus that to k, against labels dealt out anew among the points of j and k.

    Windows where one of the two curves is missing give no row. Only edges from i to j or k are repeated per simulation.
    """
    jk = frame.where(F.col("kind").isin([j, k]))
    dealt = relabelled(jk, by, simulations, seed).unionByName(jk.select(by, F.lit(0).alias("sim"), "cell_id", "kind"))
    inner = frame.where(F.col("kind") == i).select(F.col("cell_id").alias("src"), "border")
    grid = F.explode(F.array(*[F.lit(float(r)) for r in radii]))
    n = frame.where(F.col("kind") == i).withColumn("r", grid).where(F.col("border") >= F.col("r")).groupBy(by, "r").agg(F.count(F.lit(1)).alias("n_i"))
    reached = (
        edges.select("src", "dst", "dist")
        .join(inner, "src")
        .join(dealt.withColumnRenamed("cell_id", "dst"), "dst")
        .groupBy(by, "sim", "kind", "src", "border")
        .agg(F.min("dist").alias("d"))
        .withColumn("r", grid)
        .where((F.col("d") <= F.col("r")) & (F.col("border") >= F.col("r")))
        .groupBy(by, "sim", "kind", "r")
        .agg(F.count(F.lit(1)).alias("c"))
    )
    step = (max(radii) - min(radii)) / max(1, len(radii) - 1)
    sims = dealt.select(by, "sim", "kind").distinct()
    g = sims.join(n, by).join(reached, [by, "sim", "kind", "r"], "left").withColumn("g", F.coalesce("c", F.lit(0)) / F.col("n_i"))
    area = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("g"))) * step
    deltas = g.groupBy(by, "sim").agg((area(j) - area(k)).alias("delta")).where(F.col("delta").isNotNull())
    seen = deltas.where(F.col("sim") == 0).select(by, F.col("delta").alias("seen"))
    far = F.abs(F.round("delta", 9)) >= F.abs(F.round("seen", 9))
    return deltas.where(F.col("sim") > 0).join(seen, by).groupBy(by, F.col("seen").alias("delta")).agg(F.avg(far.cast("double")).alias("p_value"))


def inhomogeneous_k(edges: DataFrame, points: DataFrame, intensity: DataFrame, by: str, radii: list[float]) -> DataFrame:
    """(by, r, n_i, k, k_inhom): K of all points of a window, plain and weighted by 1 / intensity of both points.

    Only points at least r from the border count at r. The weighted K of a pattern that follows its intensity stays near pi * r^2
    where the plain one does not. intensity: (by, cell_id, intensity).
    """
    frame = framed(points.withColumn("one", F.lit("x")), by, "one").join(intensity.select("cell_id", "intensity"), "cell_id")
    grid = F.explode(F.array(*[F.lit(float(r)) for r in radii]))
    n = frame.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.first("area").alias("area"))
    inner = frame.withColumn("r", grid).where(F.col("border") >= F.col("r")).groupBy(by, "r").agg(F.count(F.lit(1)).alias("n_i"), F.sum(1 / F.col("intensity")).alias("w_i"))
    a = frame.select(F.col("cell_id").alias("src"), "border", F.col("intensity").alias("li"))
    b = frame.select(F.col("cell_id").alias("dst"), F.col("intensity").alias("lj"))
    near = (
        edges.select(by, "src", "dst", "dist")
        .join(a, "src")
        .join(b, "dst")
        .withColumn("r", grid)
        .where((F.col("dist") <= F.col("r")) & (F.col("border") >= F.col("r")))
        .groupBy(by, "r")
        .agg(F.count(F.lit(1)).alias("pairs"), F.sum(1 / (F.col("li") * F.col("lj"))).alias("weighted"))
    )
    joined = inner.join(n, by).join(near, [by, "r"], "left")
    return joined.select(
        by,
        "r",
        "n_i",
        (F.coalesce("pairs", F.lit(0)) * F.col("area") / (F.col("n") * F.col("n_i"))).alias("k"),
        (F.coalesce("weighted", F.lit(0.0)) / F.col("w_i")).alias("k_inhom"),
    )
