"""Levels of a factor, few by nature (cell types, timepoints), kept with every row of another frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

MOST = 10_000


def few(levels: DataFrame) -> list[Row]:
    """All rows of `levels`; more than `MOST` of them are refused."""
    found = levels.limit(MOST + 1).collect()
    if len(found) > MOST:
        raise ValueError(f"more than {MOST} levels")
    return found


def for_each_level(rows: DataFrame, levels: DataFrame) -> DataFrame:
    """Every row of `rows` with each row of `levels`, so that levels without data are kept.

    The levels are read once and travel in the plan as literals; more than `MOST` of them are refused.
    """
    found = few(levels)
    if not found:
        return rows.limit(0).select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in levels.schema])
    records = F.array(*[F.struct(*[F.lit(r[f.name]).cast(f.dataType).alias(f.name) for f in levels.schema]) for r in found])
    return rows.select("*", F.inline(records))
