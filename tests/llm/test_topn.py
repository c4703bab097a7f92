import math
import random

import pytest

from cellweave.llm import topn
from tests.helpers import rows

ROW = "g int, h string, item string, score double, k0 string, place int"


def frame(spark, data):
    return spark.createDataFrame([(*d, "x", 9) for d in data], ROW).repartition(5)


def brute(data, n):
    best = {}
    for g, h, item, score in data:
        if item is not None and score is not None and score == score:
            group = best.setdefault((g, h), {})
            group[item] = max(group.get(item, -math.inf), score)
    found = set()
    for key, items in best.items():
        for place, (item, score) in enumerate(sorted(items.items(), key=lambda x: (-x[1], x[0]))[: max(0, n)]):
            found.add((*key, item, score, place + 1))
    return found


@pytest.mark.parametrize("buffer", [5, 200_000])
@pytest.mark.parametrize("n", [0, 1, 10])
def test_against_brute_force(spark, monkeypatch, n, buffer):
    monkeypatch.setattr(topn, "BUFFER", buffer)
    rnd = random.Random(4)
    data = [(rnd.choice([1, 2, None]), rnd.choice("ab"), f"i{rnd.randint(0, 30)}", rnd.choice([0.1, 0.5, 0.9, rnd.random()])) for _ in range(600)]
    data += [(7, "hot", f"i{rnd.randint(0, 400)}", 0.5) for _ in range(600)]  # ties in a hot group
    data += [(1, "a", None, 0.99), (1, "a", "i1", None), (1, "a", "i2", math.nan), (1, None, "é", 1.0), (1, None, "z", 1.0), (1, None, "\U0001f600", 1.0), (1, None, "ﬀ", 1.0), (5, "", "", math.inf)]
    assert rows(topn.top_items(frame(spark, data), ["g", "h"], "item", "score", n)) == brute(data, n)


def test_empty_and_long(spark):
    assert topn.top_items(frame(spark, []), ["g"], "item", "score", 3).count() == 0
    long = "x" * 500_000
    assert rows(topn.top_items(frame(spark, [(1, "a", long, 1.0)]), ["g"], "item", "score", 3)) == {(1, long, 1.0, 1)}


def test_items_keep_their_type_and_order(spark):
    data = [(g, i % 40, float(i % 3)) for g in (1, 2) for i in range(100)]
    found = topn.top_items(spark.createDataFrame(data, "g int, item int, score double"), ["g"], "item", "score", 5)
    assert found.schema["item"].dataType.simpleString() == "int"
    wanted = {(g, i, 2.0, n + 1) for g in (1, 2) for n, i in enumerate(sorted({i % 40 for i in range(100) if i % 3 == 2})[:5])}
    assert rows(found) == wanted
    dates = spark.sql("SELECT 1 AS g, date'2024-01-01' + CAST(id AS int) AS item, 1.0 AS score FROM range(9)")
    assert topn.top_items(dates, ["g"], "item", "score", 2).schema["item"].dataType.simpleString() == "date"
