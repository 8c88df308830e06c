import math
import random

import numpy as np
from pyspark.sql import functions as F

from priceloom.functions import numerics as N


def test_rounding_matches_pandas_rule(spark):
    rnd = random.Random(7)
    vals = [round(rnd.uniform(1, 500), 2) * (1 - rnd.choice([0, .05, .1, .15, .2, .07])) for _ in range(2000)]
    vals += [0.125, 0.375, 2.675, 1.005, -0.125, 1234.565]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [row[0] for row in df.select(N.r("x", 2)).collect()]
    want = [float(np.round(v, 2)) for v in vals]
    assert got == want


def test_title_case_matches_python(spark):
    words = ["men's shoes", "a-b c", "hello_world", "x2y z", "ÉCOLE normale", "", "ALL CAPS", "o'neil-smith"]
    df = spark.createDataFrame([(w,) for w in words] + [(None,)], "s string")
    got = [row[0] for row in df.select(N.title_case("s")).collect()]
    assert got == [w.title() for w in words] + [None]


def test_clip_keeps_missing(spark):
    df = spark.createDataFrame([(None,), (-1.0,), (0.3,), (0.9,)], "x double")
    got = [row[0] for row in df.select(N.clip("x", 0.0, 0.5)).collect()]
    assert got == [None, 0.0, 0.3, 0.5]
    # The trap the helper avoids: greatest() invents a value for NULL.
    assert df.select(F.greatest("x", F.lit(0.0))).first()[0] == 0.0


def test_erfc_polynomial_accuracy(spark):
    zs = [i / 100 for i in range(0, 600)]
    assert max(abs(N.erfc_py(z) - math.erfc(z)) for z in zs) < 2e-7
    df = spark.createDataFrame([(z,) for z in zs], "z double")
    got = [row[0] for row in df.select(N.erfc_nonneg("z")).collect()]
    assert max(abs(a - N.erfc_py(z)) for a, z in zip(got, zs)) < 1e-12


def test_money_sum_is_exact(spark):
    df = spark.createDataFrame([(0.1,)] * 10 + [(0.2,)] * 5, "x double").repartition(7)
    assert df.agg(N.money_sum("x")).first()[0] == 2.0


def test_safe_div_returns_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (3.0, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(N.safe_div("a", "b")).collect()] == [None, None, 1.5]


def test_scale_configuration(spark):
    from priceloom.session import configure_for_scale
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        conf = configure_for_scale(spark, 10 * 1024 ** 4)  # 10 TiB of facts
        assert int(conf["spark.sql.shuffle.partitions"]) == 40960
        assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", before)
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(128 * 1024 ** 2))


def test_private_checkpoint_folder_only_for_local_masters():
    from priceloom.session import local_master
    assert local_master("local") and local_master("local[8]") and local_master("local[*]")
    assert local_master("local[4,2]")
    assert not local_master("yarn") and not local_master("spark://host:7077")
    assert not local_master("k8s://https://host:443") and not local_master("local-cluster[2,1,1024]")


def test_exact_sum_equals_decimal_cast_sum(spark):
    """Long-unit sums give the type and value of SUM(CAST(x AS DECIMAL(18, s)))."""
    import random
    rnd = random.Random(7)
    rows = [(i % 5, rnd.randint(-10 ** 9, 10 ** 9) / 100.0, rnd.randint(-10 ** 8, 10 ** 8) / 10000.0)
            for i in range(3000)] + [(9, None, None)]
    df = spark.createDataFrame(rows, "g int, a double, b double")
    want = df.groupBy("g").agg(F.sum(F.col("a").cast("decimal(18,2)")).alias("a"),
                               F.sum(F.col("b").cast("decimal(18,4)")).alias("b"))
    got = df.groupBy("g").agg(N.exact_sum("a").alias("a"), N.exact_sum("b", 4).alias("b"))
    assert got.schema == want.schema
    assert sorted(got.collect()) == sorted(want.collect())


def test_exact_sum_weighted_equals_decimal_product_sum(spark):
    rows = [(1, 12.34, 3), (1, 0.01, 1000000), (1, None, 5), (2, -7.5, 2), (2, 99999.99, 1)]
    df = spark.createDataFrame(rows, "g int, v double, w long")
    want = df.groupBy("g").agg(
        F.sum(F.col("v").cast("decimal(18,2)") * F.col("w").cast("decimal(20,0)")).cast("double").alias("s"))
    got = df.groupBy("g").agg(N.exact_sum("v", weight="w").cast("double").alias("s"))
    assert sorted(got.collect()) == sorted(want.collect())
