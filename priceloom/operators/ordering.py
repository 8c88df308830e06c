"""Distributed ordered numbering and running sums.

``ROW_NUMBER() OVER (PARTITION BY k ORDER BY ...)`` and
``SUM(x) OVER (ORDER BY x DESC)`` are single-task operations when the
partition is huge (one category holding a third of the catalogue) or absent
(a running total over all products).  Both are computed here over a
range-partitioned sort instead:

1. ``repartitionByRange`` on the full ordering (sampled boundaries split
   even long runs of equal leading values, because the trailing columns
   differ), tagged with the block id; the tagged frame is written to the
   shared checkpoint folder and read back, so every later branch (and any
   recomputation after a lost executor) sees the same blocks.  Without an
   explicit block count AQE sizes the blocks: it coalesces adjacent ranges
   up to the advisory partition size, so the block count follows the data
   size (not ``spark.sql.shuffle.partitions``, which at cluster scale would
   cut a product table into hundreds of thousands of tiny files), and the
   coalesced ids stay in range order;
2. per block (and group) counts / sums: one row per block, a bounded table;
3. prefix offsets over that small table;
4. numbering / running sums inside each block, plus the block's offset.

Every step is a DataFrame operation; no rows pass through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from priceloom.session import materialize

BLOCK = "_blk"


def _blocked(df: DataFrame, order: list[Column], n_blocks: int | None) -> DataFrame:
    ranged = df.repartitionByRange(n_blocks, *order) if n_blocks else df.repartitionByRange(*order)
    return materialize(ranged.withColumn(BLOCK, F.spark_partition_id()), "blocks")


def row_number_within(df: DataFrame, group_cols: list[str], order: list[Column], out: str,
                      n_blocks: int | None = None) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY group_cols ORDER BY order)`` as BIGINT.

    ``order`` must make rows unique within a group (add the key as the last
    column) for the numbering to be deterministic.
    """
    g = [F.col(c) for c in group_cols]
    b = _blocked(df, [*[c.asc() for c in g], *order], n_blocks)
    counts = b.groupBy(BLOCK, *group_cols).agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.partitionBy(*group_cols).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(BLOCK, *group_cols,
                            F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"))
    local = F.row_number().over(Window.partitionBy(BLOCK, *group_cols).orderBy(*order))
    numbered = b.withColumn("_rn", local)
    # null-safe: rows whose group is NULL are numbered as a group of their own
    offsets = offsets.select(F.col(BLOCK).alias("_oblk"), "_off", *[F.col(c).alias(f"_o_{c}") for c in group_cols])
    on = F.col(BLOCK) == F.col("_oblk")
    for c in group_cols:
        on = on & F.col(c).eqNullSafe(F.col(f"_o_{c}"))
    return (numbered.join(offsets, on).drop("_oblk", *[f"_o_{c}" for c in group_cols])
            .withColumn(out, (F.col("_off") + F.col("_rn")).cast("bigint"))
            .drop(BLOCK, "_rn", "_off"))


def cumulative_sum_desc(df: DataFrame, value_col: str, out: str, n_blocks: int | None = None) -> DataFrame:
    """``SUM(v) OVER (ORDER BY v DESC)`` with the default RANGE frame: each
    row gets the sum of every row whose value is >= its own (ties share).

    Rows are first collapsed to one per distinct value (partial aggregation,
    so a value shared by a third of all rows costs one row per task), the
    prefix runs over distinct values, and the result joins back on the value.
    """
    v = F.col(value_col)
    by_value = df.groupBy(value_col).agg(F.coalesce(F.sum(v), F.lit(0).cast("decimal(38,2)")).alias("_s"))
    b = _blocked(by_value, [v.desc()], n_blocks)
    totals = b.groupBy(BLOCK).agg(F.sum("_s").alias("_bs"))
    before = Window.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)  # one row per block
    offsets = totals.select(BLOCK, F.coalesce(F.sum("_bs").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy(BLOCK).orderBy(v.desc()).rowsBetween(Window.unboundedPreceding, 0)
    cum = (b.withColumn("_run", F.sum("_s").over(inside))
            .join(offsets, BLOCK)  # one row per block
            .select(v.alias("_cv"), (F.col("_off") + F.col("_run")).alias(out)))
    # null-safe: rows without a value stay; they come last and add nothing
    return df.join(cum, v.eqNullSafe(F.col("_cv"))).drop("_cv")
