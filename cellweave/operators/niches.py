"""Neighbourhood profiles, co-occurrence of cell types, niches, vector neighbours and graph clusters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import GaussianMixture, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.levels import few
from ..functions.mixing import GOLDEN, mixed
from ..functions.scratch import cut, saved
from ..functions.tails import normal_quantile_col, normal_upper_col

#: Rows of the gap statistic that a task looks at together, so that their distances stay in the cache; files for each core; tasks of a pass, whose sums the driver holds.
BLOCK, SPREAD, MOST_SUMS = 1024, 9, 128


def shares(profile: DataFrame, key: str) -> DataFrame:
    """(key, kind, n, v): a long profile with each entry's share of its cell."""
    return profile.withColumn("v", F.col("n") / F.sum("n").over(Window.partitionBy(key)))


def cooccurrence(share: DataFrame, key: str, kind: str) -> DataFrame:
    """(type_from, type_to, weight): summed products of shares over cells; pairs that never meet have no row.

    The join is by cell, where there are at most as many rows as types.
    """
    a = share.select(key, F.col(kind).alias("type_from"), F.col("v").alias("va"))
    b = share.select(key, F.col(kind).alias("type_to"), F.col("v").alias("vb"))
    return a.join(b, key).groupBy("type_from", "type_to").agg(F.sum(F.col("va") * F.col("vb")).alias("weight"))


def cooccurrence_test(share: DataFrame, weights: DataFrame, kind: str, n_cells: int) -> DataFrame:
    """weights with z and p against independent permutation of each type's column of shares.

    Mean and variance of the permuted product sum are known: Sx * Sy / n and SSx * SSy / (n - 1), SS being sums of squared
    deviations over all cells, zeros included; p is the upper normal tail of z. A type with itself is unchanged
    by permutation and has p = 1. This is the limit of the simulated test and needs no simulation.
    """
    n = F.lit(float(n_cells))
    m = share.groupBy(kind).agg(F.sum("v").alias("s"), F.sum(F.col("v") * F.col("v")).alias("s2")).select(kind, "s", (F.col("s2") - F.col("s") * F.col("s") / n).alias("ss"))
    a = m.select(F.col(kind).alias("type_from"), F.col("s").alias("sa"), F.col("ss").alias("qa"))
    b = m.select(F.col(kind).alias("type_to"), F.col("s").alias("sb"), F.col("ss").alias("qb"))
    sd = F.sqrt(F.col("qa") * F.col("qb") / (n - 1))
    z = (F.col("weight") - F.col("sa") * F.col("sb") / n) / F.when(sd > 0, sd)
    tail = normal_upper_col(F.col("z"))
    tested = weights.join(a, "type_from").join(b, "type_to").withColumn("z", z)
    return tested.select("type_from", "type_to", "weight", "z", F.when(F.col("type_from") == F.col("type_to"), 1.0).otherwise(tail).alias("p"))


def significant_edges(tested: DataFrame, alpha: float = 0.05) -> DataFrame:
    """(type_from, type_to, weight, p, degree): edges below alpha with the degree of their first type."""
    kept = tested.where(F.col("p") < alpha)
    return kept.withColumn("degree", F.count(F.lit(1)).over(Window.partitionBy("type_from")))


def abundance(profile: DataFrame, kind: str) -> DataFrame:
    """(kind, abundance): each type's percentage of all neighbours."""
    n = profile.groupBy(kind).agg(F.sum("n").alias("n"))
    total = F.broadcast(n.agg(F.sum("n").alias("t")))
    return n.join(total).select(kind, (F.col("n") * 100.0 / F.col("t")).alias("abundance"))


def _vectors(profile: DataFrame, key: str, columns: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=columns, outputCol="features").transform(profile.select(key, *[F.col(f"`{c}`").cast("double").alias(c) for c in columns])).select(key, "features")


def principal_components(profile: DataFrame, key: str, columns: list[str], k: int) -> tuple[DataFrame, list[float]]:
    """(key, pc array<double>) and the share of variance each component explains; signs are arbitrary."""
    vectors = _vectors(profile, key, columns)
    model = PCA(k=k, inputCol="features", outputCol="pc").fit(vectors)
    return model.transform(vectors).select(key, vector_to_array("pc").alias("pc")), [float(v) for v in model.explainedVariance]


def dense_vectors(entries: DataFrame, keys: DataFrame, key: str, name: str, value: str) -> DataFrame:
    """(key, v array<double>): long entries as vectors over all names that occur, sorted; what has no entry is 0.

    Names are a panel (more than a factor may have are refused). Keys without entries have a vector of zeros.
    """
    names = sorted(r[0] for r in few(entries.select(name).distinct()))
    index = entries.sparkSession.createDataFrame([(n, i) for i, n in enumerate(names)], f"`{name}` string, place int")
    rows = entries.join(index, name).groupBy(key).agg(F.collect_list("place").alias("place"), F.collect_list(F.col(value).cast("double")).alias("value"))
    held = keys.select(key).join(rows, key, "left")
    kind = keys.schema[key].dataType.simpleString()

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            at = batch.column(1).fill_null(pa.scalar([], batch.column(1).type)) if batch.column(1).null_count else batch.column(1)
            size = np.diff(at.offsets.to_numpy())
            row = np.repeat(np.arange(n), size)
            dense = np.zeros((n, len(names)))
            dense[row, at.flatten().to_numpy()] = batch.column(2).flatten().to_numpy()
            lists = pa.ListArray.from_arrays(np.arange(0, n * len(names) + 1, max(1, len(names)), dtype=np.int32)[: n + 1] if names else np.zeros(n + 1, np.int32), pa.array(dense.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=[key, "v"])

    return held.select(key, "place", "value").mapInArrow(spread, f"`{key}` {kind}, v array<double>")


def vector_components(vectors: DataFrame, key: str, k: int) -> tuple[DataFrame, list[float]]:
    """`principal_components` of vectors (key, v); at most as many components as the vectors are long."""
    rows = vectors.select(key, array_to_vector("v").alias("features"))
    first = vectors.select(F.size("v")).first()
    model = PCA(k=min(k, first[0]), inputCol="features", outputCol="pc").fit(rows)
    return model.transform(rows).select(key, vector_to_array("pc").alias("pc")), [float(v) for v in model.explainedVariance]


def vector_kmeans(vectors: DataFrame, key: str, k: int, seed: int = 1) -> DataFrame:
    """(key, cluster): k-means of vectors (key, v)."""
    rows = vectors.select(key, array_to_vector("v").alias("features"))
    return KMeans(k=k, seed=seed, predictionCol="cluster").fit(rows).transform(rows).select(key, "cluster")


def grouped_kmeans(vectors: DataFrame, by: str, key: str, k: int, steps: int = 10, seed: int = 1) -> DataFrame:
    """(by, key, cluster, v): k-means within each group, each column in units of its spread within the group.

    vectors: (by, key, v). Seeds are k distinct vectors of a group by a hash; a group with fewer has fewer clusters. A step joins the centers of its group, k short
    vectors, to each row and averages per group and cluster, so no group lies in one task. It ends when no center moves, or after `steps`, as Spark's
    own k-means does after its limit. A cluster that loses all its rows keeps its center; equal distances go to the first.
    """
    size = vectors.select(F.size("v")).first()
    d = size[0] if size else 0
    spread = vectors.groupBy(F.col(by).alias("sub")).agg(F.array(*[F.coalesce(F.stddev_samp(F.col("v")[i]), F.lit(0.0)) for i in range(d)]).cast("array<double>").alias("sd"))
    scaled = F.zip_with("v", "sd", lambda x, s: F.when(s > 0, x / s).otherwise(0.0))
    rows = saved(vectors.withColumnRenamed(by, "sub").join(spread, "sub").select("sub", F.col(key).alias("k"), "v", scaled.alias("z")))
    chosen = Window.partitionBy("sub").orderBy(F.xxhash64("z", F.lit(seed)), "z")
    seeds = rows.select("sub", "z").distinct().withColumn("c", F.row_number().over(chosen) - 1).where(F.col("c") < k)
    gathered = lambda c: c.groupBy("sub").agg(F.transform(F.array_sort(F.collect_list(F.struct("c", "z"))), lambda x: x["z"]).alias("centers"))
    centers = saved(gathered(seeds))
    far = F.transform("centers", lambda c: F.aggregate(F.zip_with("z", c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x))
    nearest = (F.array_position("far", F.array_min("far")) - 1).cast("int")
    for _ in range(steps):
        placed = rows.join(centers, "sub").withColumn("far", far).withColumn("c", nearest)
        means = placed.groupBy("sub", "c").agg(F.array(*[F.avg(F.col("z")[i]) for i in range(d)]).cast("array<double>").alias("z"))
        old = centers.select("sub", F.posexplode("centers").alias("c", "old"))
        moved = saved(old.join(means, ["sub", "c"], "left").select("sub", "c", F.coalesce("z", "old").alias("z"), (F.coalesce("z", "old") != F.col("old")).alias("moved")))
        centers = saved(gathered(moved.select("sub", "c", "z")))
        if moved.where("moved").isEmpty():
            break
    placed = rows.join(centers, "sub").withColumn("far", far)
    return placed.select(F.col("sub").alias(by), F.col("k").alias(key), nearest.alias("cluster"), "v")


def diagonal_mixture(vectors: DataFrame, key: str, k: int, steps: int = 30, seed: int = 1) -> DataFrame:
    """(key, niche, certainty): Gaussian mixture whose components share one diagonal covariance, by expectation and maximization.

    Starts from k-means. A step is one pass: every task sums weights, vectors and squares under the current parameters (k centers and one variance
    per column, sent along), and the sums of the tasks, not rows, reach the driver. It ends when the likelihood grows by less than 1e-4 a row.
    """
    rows = saved(vectors.select(key, "v"))
    n = rows.count()
    if n == 0:
        return rows.select(key, F.lit(0).alias("niche"), F.lit(0.0).alias("certainty"))
    model = KMeans(k=k, seed=seed).fit(rows.select(array_to_vector("v").alias("features")))
    means = np.array([c for c in model.clusterCenters()])
    ranges = rows.agg(F.array(*[F.var_pop(F.col("v")[i]) for i in range(means.shape[1])])).first()[0]
    var, weight = np.maximum(np.array(ranges, float), 1e-9), np.full(len(means), 1 / len(means))

    def matrix(column: pa.Array) -> np.ndarray:
        return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)

    def responsibilities(x: np.ndarray, m: np.ndarray, s: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        log = np.log(np.maximum(w, 1e-300)) - 0.5 * (((x[:, None, :] - m) ** 2 / s).sum(axis=2) + np.log(2 * np.pi * s).sum())
        top = log.max(axis=1, keepdims=True)
        whole = top[:, 0] + np.log(np.exp(log - top).sum(axis=1))
        return np.exp(log - whole[:, None]), whole

    last = -np.inf
    for _ in range(steps):

        def summed(batches: Iterator[pa.RecordBatch], m=means, s=var, w=weight) -> Iterator[pa.RecordBatch]:
            r, rx, rxx, like = np.zeros(len(m)), np.zeros_like(m), np.zeros_like(m), 0.0
            for batch in batches:
                if batch.num_rows:
                    x = matrix(batch.column(0))
                    share, whole = responsibilities(x, m, s, w)
                    r, rx, rxx, like = r + share.sum(axis=0), rx + share.T @ x, rxx + share.T @ (x * x), like + float(whole.sum())
            yield pa.RecordBatch.from_arrays([pa.array([like]), pa.array([np.concatenate([r, rx.ravel(), rxx.ravel()]).tolist()], pa.list_(pa.float64()))], names=["like", "sums"])

        parts = rows.select("v").mapInArrow(summed, "like double, sums array<double>").collect()  # a row per task
        total, like = np.sum([p["sums"] for p in parts], axis=0), sum(p["like"] for p in parts)
        g, d = means.shape
        r, rx, rxx = np.maximum(total[:g], 1e-12), total[g : g + g * d].reshape(g, d), total[g + g * d :].reshape(g, d)
        weight, means = r / r.sum(), rx / r[:, None]
        var = np.maximum((rxx - r[:, None] * means * means).sum(axis=0) / r.sum(), 1e-9)
        if like - last < 1e-4 * n:
            break
        last = like

    def settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                share, _ = responsibilities(matrix(batch.column(1)), means, var, weight)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(share.argmax(axis=1).astype(np.int32)), pa.array(share.max(axis=1))], names=[key, "niche", "certainty"])

    return rows.mapInArrow(settled, f"`{key}` {rows.schema[key].dataType.simpleString()}, niche int, certainty double")


def batch_corrected(scores: DataFrame, batches: DataFrame, key: str, batch: str, clusters: int, rounds: int = 3, sigma: float = 0.1, ridge: float = 1.0, seed: int = 1) -> DataFrame:
    """(key, v): component scores from which what sets batches apart within soft clusters is taken.

    scores: (key, v), batches: (key, batch). Each round finds clusters of the directions of the scores, gives every row a share in each by its cosine, and takes from it the
    shares' mean differences between its batch and all rows, damped by `ridge`. The means are sums per batch and cluster; clusters, not rows, are
    held by the driver. Rows without a batch stay as they are.
    """
    rows = saved(scores.select(key, "v").join(batches.select(key, F.col(batch).alias("batch")), key, "left"))
    size = rows.select(F.size("v")).first()
    if size is None:
        return rows.select(key, "v")
    d = size[0]
    for turn in range(rounds):
        norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
        unit = rows.withColumn("u", F.when(norm > 0, F.transform("v", lambda x: x / norm)).otherwise(F.col("v")))
        model = KMeans(k=clusters, seed=seed + turn).fit(unit.select(array_to_vector("u").alias("features")))
        lit = F.array(*[F.array(*[F.lit(float(x)) for x in c / max(1e-12, float(np.linalg.norm(c)))]) for c in model.clusterCenters()])
        close = F.transform(lit, lambda c: F.exp((F.aggregate(F.zip_with("u", c, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x) - 1) * 2 / sigma))
        shared = saved(unit.withColumn("r", close).withColumn("r", F.transform("r", lambda x: x / F.greatest(F.aggregate("r", F.lit(0.0), lambda a, y: a + y), F.lit(1e-300)))).drop("u"))
        long = shared.where("batch IS NOT NULL").select("batch", "v", F.posexplode("r").alias("c", "w"))
        sums = saved(long.groupBy("batch", "c").agg(F.sum("w").alias("w"), F.array(*[F.sum(F.col("w") * F.col("v")[i]) for i in range(d)]).alias("s")))
        whole = sums.groupBy("c").agg(F.sum("w").alias("wt"), F.array(*[F.sum(F.col("s")[i]) for i in range(d)]).alias("st"))
        shift = F.zip_with("s", "st", lambda a, b: (a / F.col("w") - b / F.col("wt")) * F.col("w") / (F.col("w") + ridge))
        shifts = sums.join(whole, "c").where("w > 0 AND wt > 0").groupBy("batch").agg(F.map_from_entries(F.collect_list(F.struct("c", shift.alias("shift")))).alias("m"))
        moved = F.aggregate(
            F.sequence(F.lit(0), F.lit(clusters - 1)), F.col("v"),
            lambda v, c: F.when(F.map_contains_key("m", c), F.zip_with(v, F.try_element_at("m", c), lambda x, y: x - y * F.get("r", c))).otherwise(v),
        )
        rows = saved(shared.join(shifts, "batch", "left").select(key, F.when(F.col("m").isNotNull(), moved).otherwise(F.col("v")).alias("v"), "batch"))
    return rows.select(key, "v")


def kmeans_niches(profile: DataFrame, key: str, columns: list[str], k: int, seed: int = 1) -> DataFrame:
    """(key, niche): k-means clusters of profiles."""
    vectors = _vectors(profile, key, columns)
    return KMeans(k=k, seed=seed, predictionCol="niche").fit(vectors).transform(vectors).select(key, "niche")


def _nearest_centers(points: DataFrame, centers: DataFrame, grid: DataFrame) -> DataFrame:
    """points with the cluster of the nearest center of their group (sub), the smaller cluster of equals; exact.

    A point looks at the centers of the nine cells around it; what is not settled there goes on with cells four times as wide.
    """
    opened, settled, level = points.join(grid, "sub"), None, 0
    while True:
        side = F.col("side") * float(4**level)
        at = lambda c, s=side: F.floor((F.col(c) - F.col(c + "0")) / s).cast("bigint")
        around = F.array(*[F.struct((at("cx") + i).alias("bx"), (at("cy") + j).alias("by")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
        put = centers.join(grid.select("sub", "side", F.col("x0").alias("cx0"), F.col("y0").alias("cy0")), "sub").withColumn("b", F.explode(around))
        put = put.select("sub", "cluster", "cx", "cy", "b.bx", "b.by")
        dx, dy = F.col("x") - F.col("cx"), F.col("y") - F.col("cy")
        best = (
            opened.withColumns({"bx": at("x"), "by": at("y")})
            .join(put, ["sub", "bx", "by"], "left")
            .groupBy("sub", "k", "x", "y")
            .agg(F.min(F.when(F.col("cluster").isNotNull(), F.struct((dx * dx + dy * dy).alias("d2"), "cluster"))).alias("m"))
            .join(grid, "sub")
        )
        sure = F.coalesce((F.sqrt("m.d2") <= side) | (side >= F.col("extent")), F.lit(False))
        tried = saved(best.withColumn("done", sure))
        found = tried.where("done").select("sub", "k", "x", "y", F.col("m.cluster").alias("cluster"))
        settled = found if settled is None else settled.unionByName(found)
        opened, level = tried.where("NOT done").drop("m", "done"), level + 1
        if opened.isEmpty():
            return settled


def place_clusters(points: DataFrame, by: str, key: str, share: float, steps: int = 20) -> DataFrame:
    """(by, key, cluster): k-means of places x and y within each group, with share * n clusters (rounded up) for its n points.

    Seeds are points at equal steps in an order by strips of x, then y, so they are as dense as the points. Lloyd steps are a join with
    near centers and a mean per cluster, until no center moves or `steps` are done, as many as those of the k-means of `kmeans_niches`. A cluster that loses all its points keeps its center.
    """
    pts = saved(points.where(F.col("x").isNotNull() & F.col("y").isNotNull()).select(F.col(by).alias("sub"), F.col(key).alias("k"), "x", "y"))
    box = pts.groupBy("sub").agg(
        F.count(F.lit(1)).alias("n"), F.min("x").alias("x0"), F.min("y").alias("y0"), (F.max("x") - F.min("x")).alias("w"), (F.max("y") - F.min("y")).alias("h")
    )
    box = saved(box.withColumn("wanted", F.ceil(F.col("n") * F.lit(share))))
    strip = F.when(F.col("w") > 0, F.floor((F.col("x") - F.col("x0")) / F.col("w") * F.ceil(F.sqrt("wanted")))).otherwise(0)
    place = F.row_number().over(Window.partitionBy("sub").orderBy("strip", "y", "k"))
    turn = lambda p: F.floor(p * F.col("wanted") / F.col("n"))
    seeds = pts.join(box, "sub").withColumn("strip", strip).withColumn("p", place).where(turn(F.col("p")) > turn(F.col("p") - 1))
    centers = saved(seeds.select("sub", turn(F.col("p")).alias("cluster"), F.col("x").alias("cx"), F.col("y").alias("cy")))
    even = F.greatest(F.sqrt(F.col("w") * F.col("h") / F.col("wanted")), F.greatest("w", "h") / F.col("wanted"), F.lit(1e-9))
    even_grid = box.withColumn("even", even)
    cells = [F.floor((F.col(c) - F.col(o)) / F.col("even")) for c, o in (("cx", "x0"), ("cy", "y0"))]
    fullest = centers.join(even_grid, "sub").groupBy("sub", *[c.alias(f"b{i}") for i, c in enumerate(cells)]).agg(F.count(F.lit(1)).alias("m")).groupBy("sub").agg(F.max("m").alias("m"))
    side = F.col("even") / F.greatest(F.lit(1.0), F.sqrt(F.col("m") / 2.0))
    grid = saved(even_grid.join(fullest, "sub").select("sub", "x0", "y0", side.alias("side"), F.greatest("w", "h").alias("extent")))
    for _ in range(steps):
        placed = _nearest_centers(pts, centers, grid)
        means = placed.groupBy("sub", "cluster").agg(F.avg("x").alias("mx"), F.avg("y").alias("my"))
        moved = saved(centers.join(means, ["sub", "cluster"], "left").withColumns({"nx": F.coalesce("mx", "cx"), "ny": F.coalesce("my", "cy")}))
        centers = moved.select("sub", "cluster", F.col("nx").alias("cx"), F.col("ny").alias("cy"))
        if moved.where((F.abs(F.col("nx") - F.col("cx")) > 1e-4) | (F.abs(F.col("ny") - F.col("cy")) > 1e-4)).isEmpty():
            break
    return placed.select(F.col("sub").alias(by), F.col("k").alias(key), "cluster")


def mixture_niches(profile: DataFrame, key: str, columns: list[str], k: int, seed: int = 1) -> DataFrame:
    """(key, niche, certainty): Gaussian mixture with full covariances (the tied diagonal form has no Spark counterpart)."""
    vectors = _vectors(profile, key, columns)
    made = GaussianMixture(k=k, seed=seed, predictionCol="niche", maxIter=30).fit(vectors).transform(vectors)
    return made.select(key, "niche", F.array_max(vector_to_array("probability")).alias("certainty"))


def silhouettes(profile: DataFrame, key: str, columns: list[str], ks: list[int], seed: int = 1) -> DataFrame:
    """(k, silhouette): mean silhouette of k-means for each k, to choose one."""
    vectors = _vectors(profile, key, columns)
    judge = ClusteringEvaluator(predictionCol="niche")
    rows = [(k, float(judge.evaluate(KMeans(k=k, seed=seed, predictionCol="niche").fit(vectors).transform(vectors)))) for k in ks]
    return profile.sparkSession.createDataFrame(rows, "k int, silhouette double")


def gap_statistic(vectors: DataFrame, key: str, ks: list[int], references: int, steps: int = 10, seed: int = 1) -> DataFrame:
    """(k, gap, se, chosen): log dispersion of k-means against uniform references over the same ranges.

    vectors: (key, v). A reference has as many rows as the data, drawn within each column's range by a hash of key, reference and column, in the task that
    uses them. All k of all references are fitted together: a step is one pass in which a task adds up rows per reference, k and cluster, and only these sums, whose number
    depends on the parameters alone, reach the driver, as bytes. Chosen is the smallest k whose gap is at least the first local maximum's less its standard error.
    """
    size = vectors.select(F.size("v")).first()
    if size is None:
        return vectors.sparkSession.createDataFrame([], "k int, gap double, se double, chosen boolean")
    d, most = size[0], max(ks)
    ends = vectors.agg(F.array(*[F.min(F.col("v")[i]) for i in range(d)]), F.array(*[F.max(F.col("v")[i]) for i in range(d)])).first()
    low, high = np.array(ends[0], float), np.array(ends[1], float)
    span = (high - low) / 2.0**32
    files = SPREAD * vectors.sparkSession.sparkContext.defaultParallelism  # so that even a small table keeps all cores busy
    rows = saved(vectors.select(F.xxhash64(key, F.lit(seed)).alias("h"), "v").repartition(files))
    starts = vectors.select("v").distinct().orderBy(F.xxhash64("v", F.lit(seed))).limit(most).collect()  # as many rows as clusters
    rng = np.random.default_rng(seed)
    seeds = rng.uniform(low, high, (references + 1, most, d))
    seeds[0, : len(starts)] = [r["v"] for r in starts]
    parts = np.cumsum([0, *ks])
    centers = np.concatenate([seeds[:, :k] for k in ks], axis=1)
    turns = np.arange(1, references * d + 1, dtype=np.uint64).reshape(references, d, 1) * GOLDEN

    def summed(batches: Iterator[pa.RecordBatch], now: np.ndarray) -> Iterator[pa.RecordBatch]:
        total, cost = np.zeros((*now.shape[:2], d + 1)), np.zeros((len(now), len(ks)))
        planes = np.concatenate([-2 * now, (now * now).sum(axis=2, keepdims=True)], axis=2)  # times (x, 1): the squared distance less that of x from 0
        for batch in batches:
            h, v = batch.column(0).to_numpy().view(np.uint64), batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            for at in range(0, batch.num_rows, BLOCK):
                state = h[at : at + BLOCK]
                x, own = np.ones((d + 1, len(state))), np.empty((now.shape[1], len(state)))
                nearest = np.empty((len(ks), len(state)))
                for b in range(len(now)):
                    x[:d] = v[at : at + BLOCK].T if b == 0 else (mixed(state + turns[b - 1]) >> np.uint64(32)) * span[:, None] + low[:, None]
                    far = planes[b] @ x
                    for j, (lo, hi) in enumerate(zip(parts, parts[1:], strict=False)):
                        np.minimum.reduce(far[lo:hi], axis=0, out=nearest[j])
                        np.equal(far[lo:hi], nearest[j], out=own[lo:hi])
                    found = own @ x.T
                    if found[:, d].sum() > len(ks) * len(state):  # equally near centers: the first has the row
                        for lo, hi in zip(parts, parts[1:], strict=False):
                            own[lo:hi] = np.arange(hi - lo)[:, None] == far[lo:hi].argmin(axis=0)
                        found = own @ x.T
                    total[b] += found
                    cost[b] += np.maximum(nearest + (x[:d] * x[:d]).sum(axis=0), 0).sum(axis=1)
        yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()) for a in (total, cost)], names=["total", "cost"])

    read = rows.coalesce(MOST_SUMS)
    for _ in range(steps + 1):
        tasks = read.mapInArrow(lambda batches, now=centers: summed(batches, now), "total binary, cost binary").collect()  # a row per task
        total, cost = np.zeros((*centers.shape[:2], d + 1)), np.zeros((references + 1, len(ks)))
        for t in tasks:
            total += np.frombuffer(t["total"]).reshape(total.shape)
            cost += np.frombuffer(t["cost"]).reshape(cost.shape)
        n, s = total[:, :, d], total[:, :, :d]
        fresh = np.where(n[:, :, None] > 0, s / np.maximum(n, 1)[:, :, None], centers)
        if np.allclose(fresh, centers, rtol=0, atol=1e-9):
            break
        centers = fresh
    log = np.log(np.maximum(cost, 1e-12))
    gaps, errors = log[1:].mean(axis=0) - log[0], log[1:].std(axis=0) * np.sqrt(1 + 1 / max(1, references))
    peak = next((i for i in range(len(ks) - 1) if gaps[i] >= gaps[i + 1]), len(ks) - 1)
    best = next(i for i in range(peak + 1) if gaps[i] >= gaps[peak] - errors[peak])
    found = [(k, float(gaps[i]), float(errors[i]), i == best) for i, k in enumerate(ks)]
    return vectors.sparkSession.createDataFrame(found, "k int, gap double, se double, chosen boolean")


def niche_means(profile: DataFrame, niches: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(niche, mean of each column)."""
    return profile.join(niches.select(key, "niche"), key).groupBy("niche").agg(*[F.avg(f"`{c}`").alias(c) for c in columns])


def vector_neighbors(queries: DataFrame, vectors: DataFrame, key: str, vector: str, k: int, block: int = 2048) -> DataFrame:
    """(query, neighbor, dist, rank): k nearest vectors of a stated query set against all rows, exact.

    Both sides are cut into blocks; a pair of blocks is one row of work and gives at most k rows a query, which are merged.
    Ties by key. A vector is not its own neighbour.
    """

    def blocks(rows: DataFrame, n: str, v: str) -> DataFrame:
        b = F.pmod(F.xxhash64(key), F.lit(max(1, -(-rows.count() // block))))
        return rows.where(F.col(vector).isNotNull()).groupBy(b.alias(f"b{n}")).agg(F.collect_list(key).alias(f"k{n}"), F.collect_list(vector).alias(v))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                x, y = np.array([list(v) for v in r.x], float), np.array([list(v) for v in r.y], float)
                kx, ky = np.array(r.k1), np.array(r.k2)
                for i in range(len(x)):
                    d = np.round(((x[i] - y) ** 2).sum(axis=1), 9)
                    order = [j for j in np.lexsort((ky, d))[: k + 1] if ky[j] != kx[i]][:k]
                    yield pd.DataFrame({"query": kx[i], "neighbor": ky[order], "d2": d[order]})

    kind = vectors.schema[key].dataType.simpleString()
    all_blocks = blocks(vectors, "2", "y").withColumn("one", F.lit(1))
    pairs = blocks(queries, "1", "x").withColumn("one", F.lit(1)).join(all_blocks, "one").repartition("b1", "b2").select("k1", "x", "k2", "y")
    best = Window.partitionBy("query").orderBy("d2", "neighbor")
    return (
        pairs.mapInPandas(compare, f"query {kind}, neighbor {kind}, d2 double")
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query", "neighbor", F.sqrt("d2").alias("dist"), "rank")
    )


def shared_neighbors(edges: DataFrame, k: int, cutoff: float) -> DataFrame:
    """(a, b, jaccard), a < b: neighbours two points share, of a k-nearest graph (src, dst): overlap / (2k - overlap).

    A point is listed by as many others as there are room for near it, so the join by neighbour stays local.
    """
    l, r = edges.select("dst", F.col("src").alias("a")), edges.select("dst", F.col("src").alias("b"))
    n = l.join(r, "dst").where(F.col("a") < F.col("b")).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    jaccard = F.col("n") / (2 * k - F.col("n"))
    return n.select("a", "b", jaccard.alias("jaccard")).where(F.col("jaccard") > cutoff)


def propagated_labels(graph: DataFrame, a: str, b: str, weight: str, rounds: int = 10, most: int = 1000) -> DataFrame:
    """(node, label): communities of a weighted undirected graph by label propagation.

    Each round a node takes the label with the largest weight among its neighbours and itself (its own counts as its
    heaviest edge), the smaller label of equals, until nothing changes; lineage is cut each round. After `rounds` rounds no two neighbours
    change at once: of those that would, one goes before its neighbours by a hash of node and round. Each change then adds at least
    the node's heaviest edge to the weight within communities, so labels cannot swing. An error if `most` rounds do not settle.
    """
    both = cut(graph.select(F.col(a).alias("node"), F.col(b).alias("other"), F.col(weight).alias("w")).unionByName(graph.select(F.col(b).alias("node"), F.col(a).alias("other"), F.col(weight).alias("w"))))
    heaviest = both.groupBy("node").agg(F.max("w").alias("w"))
    labels = cut(heaviest.select("node", F.col("node").alias("label")))
    for turn in range(most):
        votes = both.join(labels.withColumnRenamed("node", "other"), "other").select("node", "label", "w").unionByName(heaviest.join(labels, "node").select("node", "label", "w"))
        sums = votes.groupBy("node", "label").agg(F.sum("w").alias("w"))
        new = cut(sums.groupBy("node").agg(F.min(F.struct((-F.round("w", 9)).alias("w"), "label")).alias("m")).select("node", F.col("m.label").alias("label")))
        changes = new.join(labels, ["node", "label"], "left_anti")
        if changes.isEmpty():
            return new
        if turn >= rounds:
            ahead = changes.select("node", F.struct(F.xxhash64("node", F.lit(turn)).alias("h"), "node").alias("p"))
            rivals = both.join(ahead, "node").join(ahead.select(F.col("node").alias("other"), F.col("p").alias("q")), "other").where("other <> node AND q < p")
            going = changes.join(rivals.select("node"), "node", "left_anti")
            new = cut(labels.join(going.withColumnRenamed("label", "to"), "node", "left").select("node", F.coalesce("to", "label").alias("label")))
        labels = new
    raise ValueError(f"labels have not settled after {most} rounds; allow more")


def rank_normal(rows: DataFrame, by: str, value: str) -> DataFrame:
    """rows with rank_norm: normal quantile of (rank - 3/8) / (n + 1/4) within a group, equal values sharing a mean rank.

    Ranks come from counts per distinct value.
    """
    v = rows.where(F.col(value).isNotNull()).groupBy(by, value).agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy(by).orderBy(value)
    upto, total = F.sum("c").over(w.rowsBetween(Window.unboundedPreceding, 0)), F.sum("c").over(Window.partitionBy(by))
    placed = v.withColumn("p", (upto - (F.col("c") - 1) / 2 - 0.375) / (total + 0.25)).select(by, value, "p")
    return rows.join(placed, [by, value]).withColumn("rank_norm", normal_quantile_col(F.col("p"))).drop("p")
