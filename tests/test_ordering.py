"""Distributed numbering / running sums against plain windows (brute force)."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from priceloom.operators import ordering


def _data(spark, n=600, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        cat = "hot" if i % 3 == 0 else rnd.choice(["a", "b", "c"])
        val = 0 if i % 3 == 0 else rnd.randint(0, 40)   # a third of rows share one value
        rows.append((i, cat, val))
    return spark.createDataFrame(rows, "id long, cat string, v long") \
        .withColumn("v", F.col("v").cast("decimal(20,2)"))


def test_row_number_within_matches_window(spark):
    df = _data(spark)
    order = [F.col("v").desc(), F.col("id").asc()]
    got = ordering.row_number_within(df, ["cat"], order, "rn", n_blocks=5)
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("cat").orderBy(*order)).cast("bigint"))
    assert sorted(got.select("id", "rn").collect()) == sorted(want.select("id", "rn").collect())


def test_cumulative_sum_desc_matches_range_window(spark):
    df = _data(spark)
    got = ordering.cumulative_sum_desc(df, "v", "cum", n_blocks=4)
    want = df.withColumn("cum", F.sum("v").over(Window.orderBy(F.col("v").desc())))
    assert sorted(got.select("id", "cum").collect()) == sorted(want.select("id", "cum").collect())


def test_adaptive_blocks_match_windows(spark):
    """No block count: AQE coalesces the range partitions by size; the
    coalesced block ids must stay in range order."""
    keys = {"spark.sql.shuffle.partitions": "40",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
            "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1"}
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        df = _data(spark, n=3000, seed=11)
        blocks = ordering._blocked(df, [F.col("v").desc(), F.col("id").asc()], None)
        n = blocks.select(ordering.BLOCK).distinct().count()
        assert 1 < n < 40  # coalesced, but still several blocks
        order = [F.col("v").desc(), F.col("id").asc()]
        got = ordering.row_number_within(df, ["cat"], order, "rn")
        want = df.withColumn("rn", F.row_number().over(Window.partitionBy("cat").orderBy(*order)).cast("bigint"))
        assert sorted(got.select("id", "rn").collect()) == sorted(want.select("id", "rn").collect())
        got = ordering.cumulative_sum_desc(df, "v", "cum")
        want = df.withColumn("cum", F.sum("v").over(Window.orderBy(F.col("v").desc())))
        assert sorted(got.select("id", "cum").collect()) == sorted(want.select("id", "cum").collect())
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
