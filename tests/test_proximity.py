import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellweave.functions import zcurve
from cellweave.functions.zcurve import HALF, axis_index, cover_ranges, with_morton
from cellweave.operators import proximity
from tests.helpers import rows

POINT = "space string, owner string, key string, x double, y double, code int, lo string"
REGION = "space string, region string, x_min double, x_max double, y_min double, y_max double, owner int"


def points(spark, data):
    return spark.createDataFrame([(*p, 1, "z") for p in data], POINT)


def usable(p):
    s, o, k, x, y = p
    return None not in (x, y) and x == x and y == y and not (x == 0 and y == 0)


def brute_near(data, r):
    found = set()
    good = [p for p in data if usable(p) and None not in p[:3]]
    for i, a in enumerate(good):
        for b in good[i + 1 :]:
            if a[0] == b[0] and a[1] != b[1] and a[2] != b[2] and (a[3] - b[3]) ** 2 + (a[4] - b[4]) ** 2 <= r * r:
                found.add((a[0], min(a[2], b[2]), max(a[2], b[2])))
    return found


@pytest.mark.parametrize("radius", [0.7, 5.0, 60.0])
def test_near_against_brute_force(spark, radius):
    rnd = random.Random(5)
    data = [(rnd.choice("ST"), f"o{rnd.randint(0, 3)}", f"k{i}", round(rnd.uniform(-50, 50), 1), round(rnd.uniform(-50, 50), 1)) for i in range(250)]
    data += [("S", "o1", f"d{i}", 7.0, 7.0) for i in range(200)]  # a dense place of one owner
    data += data[:30]  # repeated rows
    data += [("S", "o9", "n1", None, 1.0), ("S", "o9", "n2", math.nan, 1.0), ("S", "o9", "n3", 0.0, 0.0), (None, "o9", "n4", 7.0, 7.0), ("S", None, "n5", 7.0, 7.0), ("S", "o9", None, 7.0, 7.0)]
    assert rows(proximity.near_pairs(points(spark, data), radius)) == brute_near(data, radius)


def test_far_coordinates(spark):
    data = [("S", "a", "k1", 1e300, 5.0), ("S", "b", "k2", 1e300, 5.5), ("S", "c", "k3", math.inf, 5.0), ("S", "d", "k4", math.inf, 5.0)]
    assert rows(proximity.near_pairs(points(spark, data), 1.0)) == {("S", "k1", "k2")}


def test_empty(spark):
    assert proximity.near_pairs(points(spark, []), 1.0).count() == 0
    empty = spark.createDataFrame([], REGION)
    assert proximity.in_regions(points(spark, [("S", "a", "k", 1.0, 1.0)]), empty, 1.0).count() == 0


def test_regions_against_brute_force(spark):
    rnd = random.Random(6)
    data = [("S" if i % 3 else "T", f"r{rnd.randint(0, 12)}", f"k{i}", round(rnd.uniform(-300, 300), 1), round(rnd.uniform(-300, 300), 1)) for i in range(400)]
    data += [("S", None, "n1", 5.0, 5.0), ("S", "r1", "n2", None, 5.0), (None, "r1", "n3", 5.0, 5.0)]
    rects = []
    for i in range(12):
        x, y, w, h = rnd.uniform(-300, 200), rnd.uniform(-300, 200), rnd.choice([0.5, 40, 400]), rnd.choice([1, 60, 300])
        rects.append((rnd.choice("ST"), f"r{i}", x, x + w, y, y + h, 1))
    rects += [("S", "r20", None, 1.0, 0.0, 1.0, 1), ("S", "r21", 9.0, -9.0, 0.0, 1.0, 1), ("S", "r22", math.nan, 1.0, 0.0, 1.0, 1), rects[0]]
    good = [r for r in rects if None not in r and r[2] <= r[3] and r[4] <= r[5]]
    wanted = {
        (s, k, r[1]) for s, o, k, x, y in data if s is not None and usable((s, o, k, x, y)) for r in good if r[0] == s and r[1] != o and r[2] <= x <= r[3] and r[4] <= y <= r[5]
    }
    assert rows(proximity.in_regions(points(spark, data), spark.createDataFrame(rects, REGION), 10.0)) == wanted
    assert wanted


def test_codes_and_ranges(spark):
    codes = with_morton(spark.createDataFrame([(3, 5), (2**31 - 1, 2**31 - 1), (0, 0)], "x long, y long"), F.col("x"), F.col("y"), "c")
    assert [r.c for r in codes.collect()] == [39, 2**62 - 1, 0]
    strips = spark.createDataFrame([(-0.1,), (0.0,), (25.0,), (1e300,), (-math.inf,)], "v double").select(axis_index(F.col("v"), 10.0).alias("i"))
    assert [r.i - HALF for r in strips.collect()] == [-1, 0, 2, HALF - 1, -(HALF - 1)]
    one = spark.createDataFrame([(1,)], "id int")
    ranges = cover_ranges(one, ["id"], F.lit(4), F.lit(7), F.lit(4), F.lit(7), F.lit(0))
    assert rows(ranges, "lo", "hi") == {(48, 63)}  # a whole quadtree cell is one range


def test_ranges_of_discs():
    rnd = np.random.default_rng(3)
    x, y = rnd.integers(0, 60, 200), rnd.integers(0, 60, 200)
    assert (zcurve._gathered(zcurve._spread(x) | (zcurve._spread(y) << 1)) == x).all()
    assert zcurve._gathered(np.array([2**62 - 1]))[0] == 2**31 - 1
    code = zcurve._spread(x) | (zcurve._spread(y) << 1)
    for reach in (1, 2, 3):
        row, lo, hi = zcurve.disc_ranges(code, reach)
        for i in range(len(code)):
            near = (np.maximum(abs(x - x[i]) - 1, 0) ** 2 + np.maximum(abs(y - y[i]) - 1, 0) ** 2 < reach**2) & (code >= code[i])
            held = ((code[:, None] >= lo[row == i]) & (code[:, None] <= hi[row == i])).sum(axis=1)
            assert (held == near).all()
    assert len(zcurve.disc_ranges(np.array([0, 2**62 - 1]), 2)[0]) >= 2


def test_sorted_range_join_over_borders(spark, monkeypatch):
    monkeypatch.setattr(zcurve, "AT_ONCE", 7)
    rnd = random.Random(8)
    coded = [(rnd.choice("ABC"), rnd.randint(0, 90), i) for i in range(300)] + [("B", 40, i) for i in range(300, 700)]  # one code in several partitions
    ranged = [(rnd.choice("ABCD"), lo, lo + rnd.choice([0, 3, 200]), i) for i, lo in enumerate(rnd.randint(-5, 95) for _ in range(60))]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    table = zcurve.code_sorted(spark.createDataFrame(coded, "space string, code long, id long"))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert table.select("z_part").distinct().count() > 1

    def ends(batch):
        return np.arange(batch.num_rows), batch.column("lo").to_numpy(), batch.column("hi").to_numpy()

    found = zcurve.sorted_range_join(spark.createDataFrame(ranged, "space string, lo long, hi long, r long"), table, ends, lambda a, b: [True] * a.num_rows)
    wanted = sorted((r, i) for s, lo, hi, r in ranged for t, c, i in coded if s == t and lo <= c <= hi)
    assert sorted((x.a_r, x.b_id) for x in found.collect()) == wanted


def test_a_wide_rectangle_leaves_the_buckets_small(spark):
    rnd = random.Random(9)
    pts = spark.createDataFrame([("S", "o", f"k{i}", rnd.uniform(0, 5000), rnd.uniform(0, 5000), 1, "z") for i in range(2000)], POINT)
    rects = [("S", f"r{i}", x + 0.0, x + 400.0, x + 0.0, x + 400.0, 1) for i, x in enumerate(range(0, 5000, 500))]
    wide = [("S", "wide", -4e8, 4e8, -4e8, 4e8, 1)]
    met = []
    for regions in (rects, rects + wide):
        frame = spark.createDataFrame(regions, REGION)
        met.append(proximity.in_regions(pts, frame, 10.0).where("region <> 'wide'").count())
    assert met[0] == met[1] > 0
    level = F.when(F.col("x_max") - F.col("x_min") > 1e6, 23).otherwise(3)
    index = lambda c: axis_index(F.col(c), 10.0)
    covers = cover_ranges(spark.createDataFrame(rects + wide, REGION), ["space", "region"], index("x_min"), index("x_max"), index("y_min"), index("y_max"), level)
    coded = with_morton(pts.select("space", "key", "x", "y"), index("x"), index("y"), "code")
    candidates = zcurve.level_join(covers, coded, ["space"])
    narrow = sum(1 for r in candidates.select("region").collect() if r.region != "wide")
    assert narrow < 2000  # a narrow rectangle is met only from the few cells it covers, not from everywhere under the wide one
    assert candidates.where("region = 'wide'").count() == 2000
