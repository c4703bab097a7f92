"""Z-order (Morton) codes of points, covers of rectangles by code ranges, and a join of ranges with sorted codes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import saved

HALF = 1 << 30
_STEPS = ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555))
#: Candidate pairs that a task holds at once.
AT_ONCE = 1 << 20


def axis_index(coordinate: Column, side: float) -> Column:
    """Number of the grid line strip that holds `coordinate`, from 0 to 2**31 - 1.

    Coordinates beyond the grid go to its border strips, which keeps order and neighbourhood.
    """
    strip = F.floor(F.greatest(F.lit(-float(HALF - 1)), F.least(F.lit(float(HALF - 1)), coordinate / F.lit(float(side)))))
    return (strip + F.lit(HALF)).cast("bigint")


def with_morton(df: DataFrame, ix: Column, iy: Column, name: str) -> DataFrame:
    """df with the interleaved bits of two 31-bit numbers.

    Each step of the spreading is a projection of its own: it uses the step before twice, and as one expression
    the steps would double it each time.
    """
    made = df.withColumns({"z_sx": ix, "z_sy": iy})
    for shift, mask in _STEPS:
        made = made.withColumns({c: F.col(c).bitwiseOR(F.shiftleft(c, shift)).bitwiseAND(F.lit(mask)) for c in ("z_sx", "z_sy")})
    return made.withColumn(name, F.col("z_sx").bitwiseOR(F.shiftleft("z_sy", 1))).drop("z_sx", "z_sy")


def _spread(v: np.ndarray) -> np.ndarray:
    for shift, mask in _STEPS:
        v = (v | (v << shift)) & mask
    return v


def _gathered(z: np.ndarray) -> np.ndarray:
    z = z & 0x5555555555555555
    for (shift, _), (_, mask) in zip(_STEPS[::-1], [*_STEPS[-2::-1], (0, 0x7FFFFFFF)], strict=True):
        z = (z | (z >> shift)) & mask
    return z


def disc_ranges(code: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, lo, hi): merged code ranges around each grid cell, of the cells with a larger code that are nearer than `reach` sides.

    A cell counts if the gap between it and the middle one is below `reach` sides. Cells with a smaller code are
    left out, since they find this one; the middle cell itself is in. Cells beyond the grid do not exist.
    """
    steps = np.arange(-reach, reach + 1)
    dx, dy = (d.ravel() for d in np.meshgrid(steps, steps))
    gap = np.maximum(np.abs(dx) - 1, 0) ** 2 + np.maximum(np.abs(dy) - 1, 0) ** 2
    dx, dy = dx[gap < reach * reach], dy[gap < reach * reach]
    x, y = _gathered(code)[:, None] + dx, _gathered(code >> 1)[:, None] + dy
    there = (x >= 0) & (y >= 0) & (x < 2 * HALF) & (y < 2 * HALF)
    z = _spread(np.where(there, x, 0)) | (_spread(np.where(there, y, 0)) << 1)
    z = np.sort(np.where(there & (z >= code[:, None]), z, -5), axis=1)
    first = (z >= 0) & (np.diff(z, axis=1, prepend=-9) != 1)
    last = (z >= 0) & np.append(first[:, 1:], np.ones((len(z), 1), bool), axis=1)
    return np.nonzero(first)[0], z[first], z[last]


def cover_ranges(rects: DataFrame, id_cols: list[str], ix0: Column, ix1: Column, iy0: Column, iy1: Column, level: Column) -> DataFrame:
    """Code ranges that cover grid rectangles: (id_cols, z_level, lo, hi), runs of adjacent codes merged.

    ix0..iy1 are inclusive strip numbers and `level` the quadtree level of the covering cells (each
    2**level strips wide), chosen by the caller so that a rectangle needs a bounded number of them.
    """
    shift = lambda c: F.call_function("shiftright", c, F.col("z_level"))
    cells = with_morton(
        rects.withColumn("z_level", level.cast("int"))
        .withColumns({"z_x0": ix0, "z_x1": ix1, "z_y0": iy0, "z_y1": iy1})
        .withColumn("z_x", F.explode(F.sequence(shift(F.col("z_x0")), shift(F.col("z_x1")))))
        .withColumn("z_y", F.explode(F.sequence(shift(F.col("z_y0")), shift(F.col("z_y1"))))),
        F.col("z_x"),
        F.col("z_y"),
        "z_code",
    ).select(*id_cols, "z_level", "z_code")
    width = F.call_function("shiftleft", F.lit(1).cast("bigint"), 2 * F.col("z_level"))
    codes = cells.groupBy(*id_cols, "z_level").agg(F.sort_array(F.collect_list("z_code")).alias("z"))
    starts = F.filter("z", lambda c, i: (i == 0) | (F.get("z", i - 1) != c - 1))
    ends = F.filter("z", lambda c, i: (i == F.size("z") - 1) | (F.get("z", i + 1) != c + 1))
    ranges = F.zip_with(starts, ends, lambda a, b: F.struct((a * width).alias("lo"), ((b + 1) * width - 1).alias("hi")))
    return codes.select(*id_cols, "z_level", F.inline(ranges))


def level_join(ranges: DataFrame, coded: DataFrame, on: list[str]) -> DataFrame:
    """Rows of `coded` (column code) with the rows of `ranges` (columns z_level, lo, hi) that contain their code.

    Ranges of each level meet codes in buckets of 16 cells of that level: a range is entered in the buckets it touches, of which
    a rectangle needs a bounded number whatever its size, and a code in one bucket per level that occurs (at most 27 levels). So a
    wide rectangle adds nothing to the buckets of narrow ones, and no pair is found twice through the same range.
    """
    levels = [r[0] for r in ranges.select("z_level").distinct().collect()]
    shift = lambda c: F.call_function("shiftright", c, 2 * (F.col("z_level") + 2))
    entered = ranges.withColumn("z_bucket", F.explode(F.sequence(shift(F.col("lo")), shift(F.col("hi")))))
    at_levels = F.explode(F.array(*[F.lit(n) for n in levels]).cast("array<int>"))
    placed = coded.withColumn("z_level", at_levels).withColumn("z_bucket", shift(F.col("code")))
    return placed.join(entered, [*on, "z_level", "z_bucket"]).where(F.col("code").between(F.col("lo"), F.col("hi"))).drop("z_level", "z_bucket", "lo", "hi")


def code_sorted(coded: DataFrame, space: str = "space", code: str = "code") -> DataFrame:
    """`coded` range-partitioned and sorted by (space, code), kept as a table with z_part, the number of the partition.

    Rows of one code may lie in several partitions: a hash of the row ends the order by which they are parted.
    """
    order = [F.col(space), F.col(code), F.pmod(F.xxhash64(*coded.columns), F.lit(1024))]
    return saved(coded.repartitionByRange(*order).withColumn("z_part", F.spark_partition_id()).sortWithinPartitions("z_part", space, code))


class Borders:
    """First and last code of each partition of a sorted table, per space: a row per partition and space at its ends."""

    def __init__(self, table: DataFrame, space: str = "space", code: str = "code"):
        rows = table.groupBy("z_part").agg(F.min(F.struct(space, code)).alias("a"), F.max(F.struct(space, code)).alias("b")).collect()
        self.parts = sorted(((r["a"][0], r["a"][1]), (r["b"][0], r["b"][1]), r["z_part"]) for r in rows)  # a row per partition
        self._of: dict[object, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def of(self, space: object) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first, last, number) of the partitions that hold codes of a space, in order."""
        if space not in self._of:
            held = [
                (a[1] if a[0] == space else 0, b[1] if b[0] == space else (1 << 62), p)
                for a, b, p in self.parts
                if a[0] <= space <= b[0]
            ]
            self._of = {space: tuple(np.array(c, np.int64) for c in zip(*held, strict=True)) if held else (np.empty(0, np.int64),) * 3}
        return self._of[space]


def sorted_range_join(ranged: DataFrame, sorted_codes: DataFrame, make_ranges, keep, space: str = "space") -> DataFrame:
    """Rows of a code-sorted table with the rows of `ranged` one of whose ranges holds their code.

    make_ranges(table of `ranged` rows) gives (row, lo, hi) arrays. A row goes to each partition of codes that its ranges reach, most
    to one, those near a border to two; there the ends of the ranges are looked up in the sorted codes. keep(left, right) gets
    the candidates, Arrow tables of `AT_ONCE` rows at most with the columns of both sides, and gives a mask. The result has
    the columns of `ranged` with the prefix a_ and those of `sorted_codes` with the prefix b_. A partition of codes is what a
    task holds; a code with very many rows is spread over several.
    """
    borders = Borders(sorted_codes)
    left, right = ranged.columns, [c for c in sorted_codes.columns if c != "z_part"]
    shape = ranged.select(*[F.col(c).alias(f"a_{c}") for c in left]).schema.fields + sorted_codes.select(*[F.col(c).alias(f"b_{c}") for c in right]).schema.fields
    from pyspark.sql.types import IntegerType, StructField, StructType

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            row, lo, hi = make_ranges(batch)
            spaces = batch.column(space).dictionary_encode()
            names, which = spaces.dictionary.to_pylist(), spaces.indices.to_numpy(zero_copy_only=False)[row]
            hits = []
            for i, name in enumerate(names):
                mine = which == i
                first, last, number = borders.of(name)
                if not len(number) or not mine.any():
                    continue
                begin = np.searchsorted(last, lo[mine], side="left")
                end = np.searchsorted(first, hi[mine], side="right")
                n = np.maximum(end - begin, 0)
                at = np.repeat(begin, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                hits.append(np.unique(np.stack([np.repeat(row[mine], n), number[at]]), axis=1))
            if hits:
                rows, parts = np.concatenate(hits, axis=1)
                made = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([*made.columns, pa.array(parts.astype(np.int32))], names=[*left, "z_part"])

    def matched(key, a: pa.Table, b: pa.Table) -> pa.Table:
        empty = pa.table({f"a_{c}": a.column(c).slice(0, 0) for c in left} | {f"b_{c}": b.column(c).slice(0, 0) for c in right})
        if not a.num_rows or not b.num_rows:
            return empty
        a, b = a.combine_chunks(), b.combine_chunks().sort_by([(space, "ascending"), ("code", "ascending")])
        row, lo, hi = make_ranges(a)
        names = pc.unique(b.column(space)).to_pylist()
        of_b = b.column(space).combine_chunks().dictionary_encode()
        of_b = np.array([names.index(v) for v in of_b.dictionary.to_pylist()])[of_b.indices.to_numpy(zero_copy_only=False)]
        index = {v: i for i, v in enumerate(names)}
        of_a = a.column(space).combine_chunks().dictionary_encode()
        of_a = np.array([index.get(v, -1) for v in of_a.dictionary.to_pylist()])[of_a.indices.to_numpy(zero_copy_only=False)][row]
        codes, out = b.column("code").to_numpy(), [empty]
        for i in range(len(names)):
            at = np.flatnonzero(of_b == i)
            mine = of_a == i
            base = at[0]
            here = codes[at]
            begin, end = np.searchsorted(here, lo[mine], side="left"), np.searchsorted(here, hi[mine], side="right")
            n, rows = end - begin, row[mine]
            cut = 0
            total = np.cumsum(n)
            while cut < len(n):  # slices of ranges whose candidates fit; a range with more goes alone, in pieces
                stop = max(cut + 1, int(np.searchsorted(total, (total[cut - 1] if cut else 0) + AT_ONCE, side="right")))
                m = n[cut:stop]
                for piece in range(0, max(1, int(m.sum())), AT_ONCE):
                    place = np.arange(piece, min(piece + AT_ONCE, int(m.sum())))
                    owner = np.searchsorted(np.cumsum(m), place, side="right")
                    inside = place - (np.cumsum(m) - m)[owner]
                    l, r = rows[cut:stop][owner], base + begin[cut:stop][owner] + inside
                    x, y = a.take(pa.array(l)), b.take(pa.array(r))
                    mask = keep(x, y)
                    mask = mask if isinstance(mask, pa.ChunkedArray) else pa.array(mask, pa.bool_())
                    x, y = x.filter(mask), y.filter(mask)
                    if x.num_rows:
                        out.append(pa.table([x.column(c) for c in left] + [y.column(c) for c in right], names=empty.schema.names))
                cut = stop
        return pa.concat_tables(out)

    spread = ranged.mapInArrow(placed, StructType([*ranged.schema.fields, StructField("z_part", IntegerType())]))
    return spread.groupBy("z_part").cogroup(sorted_codes.groupBy("z_part")).applyInArrow(matched, StructType(shape))
