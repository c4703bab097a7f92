"""The N best items of every group, whatever the size of the groups.

One pass over each partition, before anything is shuffled, keeps the N best distinct items of each group
met there. The N-th of them is a lower bound for the group: N items are at least as good, so nothing
worse can be among its best N. The largest bound of a group over all partitions is joined to what the
partitions kept, rows below it are dropped, and only the survivors are ranked. At most N rows a group
leave a partition, so a group with a third of all rows costs its task no more than any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ..functions.scratch import saved

#: Rows gathered in a task before they are reduced again.
BUFFER = 200_000


def top_items(rows: DataFrame, group: list[str], item: str, score: str, n: int) -> DataFrame:
    """(group columns, item, score, rank): the `n` items with the highest score, ties by item ascending.

    An item's score is its largest in the group. Rows with a null item, or a null or NaN score, do not count; null
    group columns form groups like others. Whole numbers compare as numbers, other items by the code points of their text; items keep
    their type. Groups with fewer items give all of
    them, an empty table gives none. Repeated rows change nothing. Further columns are ignored; `item`, `score`
    and `group` may have any names. With n below 1 the result is empty.
    """
    keys = [f"k{i}" for i in range(len(group))]
    whole = isinstance(rows.schema[item].dataType, IntegralType)
    clean = rows.where(F.col(item).isNotNull() & F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double"))).select(
        *[F.col(c).cast("string").alias(k) for c, k in zip(group, keys, strict=True)],
        F.col(item).cast("bigint" if whole else "string").alias("item"),
        F.col(score).cast("double").alias("score"),
    )

    def reduced(pdf: pd.DataFrame) -> pd.DataFrame:
        best = pdf.groupby([*keys, "item"], dropna=False, sort=False, as_index=False)["score"].max()
        best = best.assign(points=best["item"] if whole else best["item"].str.encode("utf-8"))  # bytes of UTF-8 are in code point order
        best = best.sort_values(["score", "points"], ascending=[False, True], kind="stable").drop(columns="points")
        place = best.groupby(keys, dropna=False, sort=False).cumcount()
        return best.assign(place=place + 1)[place < n]

    def local_best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: list[pd.DataFrame] = []
        size, limit = 0, BUFFER
        for batch in batches:
            kept.append(batch)
            size += len(batch)
            if size >= limit:
                kept = [reduced(pd.concat(kept)).drop(columns="place")]
                size = len(kept[0])
                limit = max(BUFFER, 2 * size)
        if size:
            yield reduced(pd.concat(kept))

    shape = ", ".join([*[f"{k} string" for k in keys], f"item {'bigint' if whole else 'string'}, score double, place bigint"])
    local = saved(clean.mapInPandas(local_best, shape))
    bounds = local.where(F.col("place") == n).groupBy(*keys).agg(F.max(F.col("score")).alias("bound"))
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    survivors = (
        local.alias("l")
        .join(bounds.alias("b"), same, "left")
        .where(F.col("b.bound").isNull() | (F.col("l.score") >= F.col("b.bound")))
        .groupBy(*[F.col(f"l.{k}").alias(k) for k in keys], F.col("l.item").alias("item"))
        .agg(F.max("l.score").alias("score"))
    )
    best = Window.partitionBy(*keys).orderBy(F.desc("score"), "item")
    return (
        survivors.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= n)
        .select(
            *[F.col(k).cast(rows.schema[c].dataType).alias(c) for c, k in zip(group, keys, strict=True)],
            F.col("item").cast(rows.schema[item].dataType).alias(item),
            F.col("score").alias(score),
            "rank",
        )
    )
