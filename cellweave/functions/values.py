"""Null and number rules shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def value(col: Column) -> Column:
    """The number in `col`, with NaN turned into null."""
    return F.when(~F.isnan(col), col)


def ratio(num: Column, den: Column) -> Column:
    """num / den with division by zero giving infinity, and 0/0 giving null."""
    return (
        F.when(den != 0, num / den)
        .when((den == 0) & (num == 0), F.lit(None).cast("double"))
        .when(den == 0, F.lit(float("inf")) * F.signum(num))
    )


def among(col: Column, values: list) -> Column:
    """Membership that is false, not null, for a null."""
    return F.coalesce(col.isin(values), F.lit(False))
