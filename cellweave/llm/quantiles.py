"""Exact percentiles per group by one distributed sort.

All values are sorted by (group, value) over range partitions. A pass over each sorted partition gives, for
every group met there, how many values it has, its smallest and largest value and the percentiles it
would have if it were whole. A group in one partition is finished by that. Only groups that cross a partition border,
fewer than there are partitions, need more: the counts of their parts are offsets, they tell which
part holds each wanted position, and the values of that part alone are ranked to read the neighbouring
order statistics. So no group, however large, is held by one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scratch import saved
from ..functions.sizes import sort_partitions


def value_counts(values: DataFrame, keys: list[str], value: str = "v", weight: str | None = None) -> DataFrame:
    """(keys, v, w): how often each value occurs in a group, as bigint `w`.

    The summary of one partition, day or load. Summaries add up: their union, given to `percentiles` with
    weight='w', gives the percentiles of all their rows together, exactly.
    """
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return values.groupBy(*keys, F.col(value).alias("v")).agg(n.cast("bigint").alias("w"))


def _starts(batch: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    """Row numbers at which a group starts in a batch sorted by group."""
    new = np.zeros(batch.num_rows, dtype=bool)
    new[0] = True
    for k in keys:
        here, there = batch.column(k).slice(1), batch.column(k).slice(0, batch.num_rows - 1)
        new[1:] |= pc.fill_null(pc.not_equal(here, there), False).to_numpy(zero_copy_only=False)
        if batch.column(k).null_count:
            new[1:] |= pc.xor(pc.is_null(here), pc.is_null(there)).to_numpy(zero_copy_only=False)
    return np.flatnonzero(new)


def _partition_pass(keys: list[str], percents: list[float], schema: pa.Schema):
    """mapInArrow function: one row per group of a partition sorted by (keys, v)."""
    ps = np.asarray(percents)

    def finished(heads: pa.RecordBatch, starts: np.ndarray, v: np.ndarray, w: np.ndarray | None, pid: int) -> pa.RecordBatch:
        """Rows of the groups that start at `starts`; heads: their keys, v and w: the values of all and their weights."""
        ends = np.append(starts[1:], len(v))
        cum = np.arange(1, len(v) + 1, dtype=np.int64) if w is None else np.cumsum(w)
        before = np.where(starts > 0, cum[starts - 1], 0)
        n = cum[ends - 1] - before
        at = (n[:, None] - 1) * ps
        low = np.floor(at).astype(np.int64)
        high = np.minimum(low + 1, n[:, None] - 1)
        pick = lambda t: v[np.searchsorted(cum, t + before[:, None], side="right")]
        a, b = pick(low), pick(high)
        part = at - low
        q = np.where(part == 0, a, a * (1 - part) + b * part)
        lists = pa.ListArray.from_arrays(np.arange(0, q.size + 1, len(ps), dtype=np.int32), pa.array(q.ravel()))
        columns = [heads.column(k) for k in keys]
        columns += [pa.array(np.full(len(starts), pid, dtype=np.int32)), pa.array(n), pa.array(v[starts]), pa.array(v[ends - 1]), lists]
        return pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pid = TaskContext.get().partitionId()
        head: pa.RecordBatch | None = None  # the group that is not over yet: its first row, and its values and weights so far
        held: list[tuple[np.ndarray, np.ndarray | None]] = []

        def close() -> pa.RecordBatch:
            weights = None if held[0][1] is None else np.concatenate([w for _, w in held])
            return finished(head, np.zeros(1, np.int64), np.concatenate([v for v, _ in held]), weights, pid)

        def same(batch: pa.RecordBatch) -> bool:
            return all(head.column(k)[0].as_py() == batch.column(k)[0].as_py() for k in keys)

        for batch in batches:
            if not batch.num_rows:
                continue
            starts = _starts(batch, keys)
            v, w = batch.column("v").to_numpy(), batch.column("w").to_numpy() if "w" in batch.schema.names else None
            part = lambda a, b, v=v, w=w: (v[a:b], None if w is None else w[a:b])
            begin = 0
            if head is not None and same(batch):
                begin = int(starts[1]) if len(starts) > 1 else len(v)
                held.append(part(0, begin))
            if begin < len(v):
                if head is not None:
                    yield close()
                last = int(starts[-1])
                if last > begin:
                    inner = starts[(starts >= begin) & (starts < last)]
                    yield finished(batch.take(pa.array(inner)), inner - begin, *part(begin, last), pid)
                head, held = batch.slice(last, 1), [part(last, len(v))]
        if head is not None:
            yield close()

    return run


def percentiles(
    values: DataFrame,
    keys: list[str],
    percents: list[float],
    value: str = "v",
    weight: str | None = None,
    spread: bool = False,
) -> DataFrame:
    """(keys, n bigint, q array<double>): linear-interpolation percentiles of `value` per group, exact.

    percents are fractions from 0 to 1. Rows whose value is null or NaN do not count, nor do weights that
    are null or below 1; a group without values gives no row. Null keys form groups like others. Repeated rows
    count as often as they occur, a row with weight w as w rows. Infinities are values like others. An
    empty table gives an empty result. Columns of the same names as the working columns may be present.

    spread: rows of equal value are parted among partitions by their running number, for values that are mostly distinct; else rows are first summed
    per (group, value), which costs a shuffle and leaves no ties. Either way a value that very many rows repeat fills no task.
    The number of partitions grows with the input; a task holds the values, not the keys, of one group of its partition.
    """
    spark = values.sparkSession
    v = F.col(value).cast("double")
    src = values.where(v.isNotNull() & ~F.isnan(v))
    if weight is not None:
        src = src.where(F.col(weight) >= 1)
    names = [f"k{i}" for i in range(len(keys))]
    src = src.select(
        *[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)],
        (v + F.lit(0.0)).alias("v"),
        *([F.col(weight).cast("bigint").alias("w")] if weight is not None else []),
        *([(F.shiftright(F.monotonically_increasing_id(), 5) % F.lit(1024)).cast("smallint").alias("s")] if spread else []),
    )
    if not spread:
        src = value_counts(src, names, "v", "w" if weight is not None else None)
    weighted = "w" in src.columns
    parts = sort_partitions(src)
    order = [F.col(c) for c in [*names, "v"]]
    in_order = src.repartitionByRange(parts, *order, *([F.col("s")] if spread else [])).sortWithinPartitions(*order)
    fields = [f"{n} {src.schema[n].dataType.simpleString()}" for n in names]
    shape = spark.createDataFrame([], ", ".join([*fields, "pid int, n bigint, first double, last double, q array<double>"]))
    from pyspark.sql.pandas.types import to_arrow_schema

    runs = in_order.select(*names, "v", *(["w"] if weighted else [])).mapInArrow(
        _partition_pass(names, percents, to_arrow_schema(shape.schema)), shape.schema
    )
    groups = saved(
        runs.groupBy(*names).agg(
            F.sum("n").alias("n"),
            F.count(F.lit(1)).alias("parts"),
            F.first("q").alias("q"),
            F.sort_array(F.collect_list(F.struct("pid", "n", "first", "last"))).alias("run"),
        )
    )
    whole = groups.where(F.col("parts") == 1).select(*names, "n", "q")
    border = groups.where(F.col("parts") > 1)
    result = whole.unionByName(_border_groups(border, src, names, percents, weighted))
    return result.select(*[F.col(n).alias(k) for k, n in zip(keys, names, strict=True)], "n", "q")


def _border_groups(border: DataFrame, src: DataFrame, names: list[str], percents: list[float], weighted: bool) -> DataFrame:
    """The groups that lie in several partitions: fewer than partitions, so their rows here are few."""
    # wanted positions of each percent: the lower and the upper neighbour
    places = []
    for i, p in enumerate(percents):
        at = (F.col("n") - 1) * F.lit(float(p))
        low = F.floor(at)
        places += [F.struct(F.lit(i).alias("i"), F.lit(0).alias("up"), low.alias("t")), F.struct(F.lit(i).alias("i"), F.lit(1).alias("up"), F.least(low + 1, F.col("n") - 1).alias("t"))]
    part = F.col("r")
    offsets = F.transform(
        "run",
        lambda r, j: F.struct(
            F.aggregate(F.slice("run", 1, j), F.lit(0).cast("bigint"), lambda a, x: a + x["n"]).alias("start"), r["n"].alias("n"), r["first"].alias("first"), r["last"].alias("last")
        ),
    )
    wanted = (
        border.select(*names, "n", F.explode(F.array(*places)).alias("p"), offsets.alias("run"))
        .withColumn("r", F.filter("run", lambda r: (r["start"] <= F.col("p.t")) & (F.col("p.t") < r["start"] + r["n"]))[0])
        .select(*names, "n", "p.i", "p.up", "p.t", part["first"].alias("lo"), part["last"].alias("hi"))
    )
    ranges = wanted.select(*names, "lo", "hi").distinct()
    same = lambda a, b: [F.col(f"{a}.{n}").eqNullSafe(F.col(f"{b}.{n}")) for n in names]
    both = lambda conds: reduce(and_, conds)
    n_here = F.col("s.w") if weighted else F.lit(1).cast("bigint")
    near = (
        src.alias("s")
        .join(F.broadcast(ranges).alias("g"), both([*same("s", "g"), F.col("s.v") <= F.col("g.hi")]))
        .groupBy(*[F.col(f"g.{n}").alias(n) for n in names], F.col("g.lo").alias("lo"), F.col("g.hi").alias("hi"), F.when(F.col("s.v") >= F.col("g.lo"), F.col("s.v")).alias("v"))
        .agg(F.sum(n_here).alias("c"))
    )
    upto = Window.partitionBy(*names, "lo", "hi").orderBy(F.col("v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    ranked = near.withColumn("upto", F.sum("c").over(upto)).where(F.col("v").isNotNull())
    picked = ranked.alias("s").join(
        F.broadcast(wanted).alias("g"),
        both([*same("s", "g"), F.col("s.lo") == F.col("g.lo"), F.col("s.hi") == F.col("g.hi"), F.col("g.t") < F.col("s.upto"), F.col("g.t") >= F.col("s.upto") - F.col("s.c")]),
    )
    pair = (
        picked.groupBy(*[F.col(f"g.{n}").alias(n) for n in names], F.col("g.n").alias("n"), F.col("g.i").alias("i"))
        .agg(F.max(F.when(F.col("g.up") == 0, F.col("s.v"))).alias("a"), F.max(F.when(F.col("g.up") == 1, F.col("s.v"))).alias("b"))
    )
    fraction = F.element_at(F.array(*[F.lit(float(p)) for p in percents]), F.col("i") + 1) * (F.col("n") - 1)
    fraction = fraction - F.floor(fraction)
    q = F.when(fraction == 0, F.col("a")).otherwise(F.col("a") * (1 - fraction) + F.col("b") * fraction)
    listed = pair.groupBy(*names, "n").agg(F.sort_array(F.collect_list(F.struct("i", q.alias("q")))).alias("l"))
    return listed.select(*names, "n", F.transform("l", lambda x: x["q"]).alias("q"))
