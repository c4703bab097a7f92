import datetime as dt
import random

import pytest

from cellweave.operators import orphans
from tests.helpers import rows

REF = "src_table string, ref_key string, ref_time timestamp_ntz, n int, p_key string, bf_word int"
PARENT = "updated_cell_id string, loaded_at timestamp_ntz, deleted_at timestamp_ntz, ref_key string, at int"


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def brute(refs, parents):
    found = {}
    for t, k, at, *_ in refs:
        if k is None or at is None:
            continue
        if not any(p == k and s is not None and s <= at and (e is None or at < e) for p, s, e, *_ in parents):
            key = (t, at.strftime("%Y-%m"), k)
            found[key] = found.get(key, 0) + 1
    return {(*k, n) for k, n in found.items()}


def run(spark, refs, parents, **options):
    r = spark.createDataFrame([(*x, 1, "x", 0) for x in refs], REF)
    p = spark.createDataFrame([(*x, "y", 5) for x in parents], PARENT)
    return rows(orphans.orphan_references(r, p, **options))


@pytest.mark.parametrize("max_words", [1, 64, 1 << 20])
def test_against_brute_force(spark, max_words):
    rnd = random.Random(3)
    keys = [f"c_{i}" for i in range(60)]
    parents = []
    for k in keys[:40]:
        for _ in range(rnd.randint(0, 3)):
            start = rnd.randint(0, 80)
            parents.append((k, day(start), rnd.choice([None, day(start + rnd.randint(0, 30))])))
    refs = [(rnd.choice("ab"), rnd.choice(keys), day(rnd.randint(0, 120))) for _ in range(500)]
    refs += [("a", "c_59", day(10))] * 400  # a hot key
    assert run(spark, refs, parents, max_words=max_words) == brute(refs, parents)


def test_bounds_and_nulls(spark):
    parents = [("k", day(2), day(4)), ("k", None, None), (None, day(0), None)]
    refs = [("t", "k", day(d)) for d in (1, 2, 3, 4)] + [("t", None, day(1)), ("t", "k", None), ("t", "K", day(3))]
    assert run(spark, refs, parents) == {("t", "2024-01", "k", 2), ("t", "2024-01", "K", 1)}


def test_empty_tables(spark):
    assert run(spark, [], [("k", day(0), None)]) == set()
    assert run(spark, [("t", "k", day(40)), ("t", "", day(40))], []) == {("t", "2024-02", "k", 1), ("t", "2024-02", "", 1)}


def test_filter_has_no_false_negatives(spark):
    keys = spark.range(2000).selectExpr("concat('k', id) AS k")
    words = orphans.filter_words(2000, 1 << 20)
    bloom = orphans.bloom_filter(keys, "k", words)
    assert bloom.count() <= words
    parents = keys.selectExpr("k AS updated_cell_id", "timestamp_ntz'2020-01-01' AS loaded_at", "CAST(NULL AS timestamp_ntz) AS deleted_at")
    refs = keys.selectExpr("'t' AS src_table", "k AS ref_key", "timestamp_ntz'2021-01-01' AS ref_time")
    assert orphans.orphan_references(refs, parents).count() == 0


def test_report(spark):
    found = spark.createDataFrame([("t", "2024-01", "a", 2), ("t", "2024-01", "b", 1), ("t", "2024-02", "a", 1)], "src_table string, load_month string, ref_key string, n_rows long")
    assert rows(orphans.orphan_report(found)) == {("t", "2024-01", 2, 3), ("t", "2024-02", 1, 1)}


def test_a_parent_delivered_very_often_stands_as_few_rows(spark):
    rnd = random.Random(5)
    minutes = [(m, rnd.choice([None, m + rnd.randint(-5, 40)])) for m in (rnd.randint(0, 90_000) for _ in range(600))]
    at = lambda m: None if m is None else day(0) + dt.timedelta(minutes=m)
    parents = [("hot", at(a), at(b)) for a, b in minutes] + [("gone", at(a), at(a + 30)) for a in range(0, 3000, 20)] + [("never", at(7), at(7))]
    refs = [("t", rnd.choice(["hot", "gone", "never"]), at(rnd.randint(0, 90_000))) for _ in range(400)]
    assert run(spark, refs, parents) == brute(refs, parents)
    keys = spark.createDataFrame([(*x, "y", 5) for x in parents], PARENT).toDF("p_key", "p_start", "p_end", "ref_key", "at")
    standing = rows(orphans.standing_intervals(keys))
    assert {x for x in standing if x[0] == "gone"} == {("gone", at(0), at(1450)), ("gone", at(1440), at(2890)), ("gone", at(2880), at(3010))}
    assert not any(k == "never" for k, *_ in standing)
    merged = sorted((s, e) for k, s, e in standing if k == "hot")
    assert all(e < t for (s, e), (t, _) in zip(merged, merged[1:]) if s.date() == t.date())


def test_only_what_the_filter_lets_through_is_joined(spark):
    parents = spark.range(500).selectExpr("concat('k', id) AS updated_cell_id", "timestamp_ntz'2020-01-01' AS loaded_at", "CAST(NULL AS timestamp_ntz) AS deleted_at")
    refs = spark.range(1000).selectExpr("'t' AS src_table", "concat('k', id) AS ref_key", "timestamp_ntz'2021-01-01' AS ref_time")
    found = orphans.orphan_references(refs, parents)
    assert found.count() == 500
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    exact, proven = plan.split("Join LeftAnti")[1], plan.split("Union")[1]
    assert "maybe" in exact and "NOT maybe" in proven and plan.count("Join LeftAnti") == 1


def test_a_thin_filter_still_proves_many(spark):
    keys = spark.range(3000).selectExpr("concat('k', id) AS k")
    for words, least in ((1024, 0.98), (256, 0.75), (64, 0.2)):
        probes = orphans.filter_probes(3000, words)
        bloom = orphans.bloom_filter(keys, "k", words, probes)
        probed = orphans.with_maybe(spark.range(6000).selectExpr("concat('k', id) AS k", "id"), "k", bloom, words, probes)
        assert probed.where("id < 3000 AND NOT maybe").count() == 0
        assert probed.where("id >= 3000 AND NOT maybe").count() >= least * 3000
