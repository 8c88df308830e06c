"""Shared sales aggregates.

Reports aggregate in two levels: first by a fine key (product, customer,
region x product), then, after joining the small dimension, by the report
key.  Money and fixed-scale columns are summed in DECIMAL, so the two-level
total is exactly the one-level total, whatever the partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from priceloom.functions.numerics import exact_sum


def dsum(c: str, scale: int = 2) -> Column:
    return exact_sum(c, scale)


def dbl(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


# name -> (first-level aggregate, second-level re-aggregate)
def _measures() -> dict[str, tuple[Column, Column]]:
    return {
        "n": (F.count("transaction_id"), F.sum("n")),
        "units": (F.sum("quantity").cast("bigint"), F.sum("units").cast("bigint")),
        "rev": (dsum("revenue"), F.sum("rev")),
        "prof": (dsum("profit"), F.sum("prof")),
        "cost_s": (dsum("cost"), F.sum("cost_s")),
        "eff_s": (dsum("effective_price"), F.sum("eff_s")),
        "eff_n": (F.count("effective_price"), F.sum("eff_n")),
        "disc_s": (dsum("discount", 4), F.sum("disc_s")),
        "disc_n": (F.count("discount"), F.sum("disc_n")),
        "unit_s": (dsum("unit_price"), F.sum("unit_s")),
        "unit_n": (F.count("unit_price"), F.sum("unit_n")),
    }


ALL = ("n", "units", "rev", "prof", "cost_s", "eff_s", "eff_n", "disc_s", "disc_n", "unit_s", "unit_n")


def facts(sales: DataFrame, keys: list[str], measures=ALL) -> DataFrame:
    """First-level aggregate of sales by ``keys``; of a ledger (a ``facts``
    frame by these or finer keys) the same totals, from its sums."""
    if "transaction_id" not in sales.columns and set(measures) <= set(sales.columns):
        return refacts(sales, keys, measures)
    m = _measures()
    return sales.groupBy(*keys).agg(*[m[x][0].alias(x) for x in measures])


def refacts(df: DataFrame, keys: list[str], measures=ALL) -> DataFrame:
    """Second-level aggregate of a ``facts`` frame by ``keys``."""
    m = _measures()
    return df.groupBy(*keys).agg(*[m[x][1].alias(x) for x in measures if x in df.columns])


def span_months(sales: DataFrame) -> DataFrame:
    """Calendar months from the first to the last sale, both included (one
    row): the horizon that annual and monthly volumes are scaled by."""
    first, last = F.min("date"), F.max("date")
    n = (F.year(last) - F.year(first)) * 12 + F.month(last) - F.month(first) + 1
    return sales.agg(n.cast("double").alias("months"))


def horizon(months: int | Column) -> Column:
    """A number of months, given or measured (``span_months(...).scalar()``)."""
    return months if isinstance(months, Column) else F.lit(float(months))


def avg_of(sum_col: str, n_col: str) -> Column:
    """Exact-sum average as DOUBLE; NULL for an empty group."""
    return F.try_divide(dbl(sum_col), dbl(n_col))


def margin(prof: str = "prof", rev: str = "rev") -> Column:
    """``(SUM(profit) / SUM(revenue)) * 100`` unrounded; NULL on zero revenue."""
    return F.try_divide(dbl(prof), dbl(rev)) * F.lit(100.0)
