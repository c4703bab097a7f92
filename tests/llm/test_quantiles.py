import math
import random

import numpy as np
import pytest

from cellweave.llm import quantiles

PS = [0.0, 0.25, 0.5, 0.75, 1.0]
ROW = "g string, a int, x double, w long, v string, k0 int"


def frame(spark, data):
    return spark.createDataFrame([(*d, "junk", 1) for d in data], ROW).repartition(6)


def brute(data, weighted=False):
    groups = {}
    for g, a, x, w in data:
        if x is not None and x == x and (not weighted or (w is not None and w >= 1)):
            groups.setdefault((g, a), []).extend([x] * (w if weighted else 1))
    return {k: (len(v), np.percentile(v, [100 * p for p in PS])) for k, v in groups.items()}


def check(found, wanted):
    got = {(r.g, r.a): (r.n, np.array(r.q)) for r in found.collect()}
    assert got.keys() == wanted.keys()
    for k, (n, q) in wanted.items():
        assert got[k][0] == n
        np.testing.assert_allclose(got[k][1], q, rtol=1e-12, atol=1e-12)


def data(seed, hot):
    rnd = random.Random(seed)
    made = [(f"g{rnd.randint(0, 40)}", rnd.choice([1, 2, None]), rnd.choice([rnd.gauss(0, 50), 3.5, -0.0]), rnd.randint(0, 4)) for _ in range(800)]
    made += [("hot", 1, rnd.choice([7.25, rnd.random()]) if hot == "mixed" else 7.25, 2) for _ in range(900)]  # lies in several partitions
    return made + [(None, 1, 1.0, 1), ("g1", 1, None, 1), ("g1", 1, math.nan, 1), ("one", 1, 4.0, None), ("none", 1, None, 1), ("", 1, 2.0, 3)]


@pytest.mark.parametrize("hot", ["mixed", "equal"])
@pytest.mark.parametrize("spread", [True, False])
def test_against_numpy(spark, hot, spread):
    made = data(8, hot)
    check(quantiles.percentiles(frame(spark, made), ["g", "a"], PS, "x", spread=spread), brute(made))


def test_one_group_over_all_partitions(spark):
    rnd = random.Random(1)
    made = [("all", 1, rnd.gauss(0, 1), 1) for _ in range(3000)]
    check(quantiles.percentiles(frame(spark, made), ["g", "a"], PS, "x", spread=True), brute(made))


def test_weights_and_combined_loads(spark):
    made = data(9, "mixed")
    check(quantiles.percentiles(frame(spark, made), ["g", "a"], PS, "x", weight="w"), brute(made, True))
    loads = [quantiles.value_counts(frame(spark, part), ["g", "a"], "x") for part in (made[:500], made[500:])]
    check(quantiles.percentiles(loads[0].unionByName(loads[1]), ["g", "a"], PS, weight="w"), brute(made))


def test_infinities_and_empty(spark):
    made = [("g", 1, math.inf, 1), ("g", 1, -math.inf, 1), ("g", 1, 2.0, 1)]
    found = quantiles.percentiles(frame(spark, made), ["g", "a"], [0.5], "x").first()
    assert (found.n, found.q) == (3, [2.0])
    assert quantiles.percentiles(frame(spark, []), ["g", "a"], PS, "x").count() == 0


def test_a_repeated_row_is_parted(spark):
    made = [("rep", 1, 2.5, 1)] * 4000 + [("g", 1, float(i), 1) for i in range(50)]
    check(quantiles.percentiles(frame(spark, made), ["g", "a"], PS, "x", spread=True), brute(made))
    same = frame(spark, made).selectExpr("g", "x", "CAST(monotonically_increasing_id() % 1024 AS smallint) AS s").repartitionByRange(4, "g", "x", "s")
    sizes = [r[0] for r in same.groupBy("g", "x").agg({"*": "count"}).where("g = 'rep'").select("count(1)").collect()]
    parts = same.where("g = 'rep'").selectExpr("spark_partition_id() AS p").groupBy("p").count().collect()
    assert sizes == [4000] and max(r["count"] for r in parts) < 2000


def test_small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    made = data(12, "mixed")
    check(quantiles.percentiles(frame(spark, made), ["g", "a"], PS, "x", spread=True), brute(made))
    check(quantiles.percentiles(frame(spark, made), ["g", "a"], PS, "x", weight="w"), brute(made, True))
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
