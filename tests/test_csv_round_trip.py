"""The raw sales exported as CSV in ingest order, read back and cleaned: what is shuffled, written and left behind."""

import os
import re
import time

from pyspark.sql import functions as F

from conftest import SF_SMALL
from priceloom.operators import cleaning as C
from priceloom.plans import pipeline, registry
from priceloom.plans.round_trips import _in_ingest_order
from priceloom.session import freed_shuffles
from priceloom.sources import files, testdata


def test_rows_dealt_by_range_are_those_of_the_join(spark):
    line = {c: F.lit(1).alias(c) for c in testdata.LINEITEM_ORDER}
    lines = spark.range(60).select(*[v for c, v in line.items() if c not in ("l_orderkey", "l_linenumber")], F.col("id").alias("l_linenumber"),
                                   F.when(F.col("id") % 13 > 0, F.col("id") % 12).alias("l_orderkey"),
                                   F.when(F.col("id") % 3 > 0, F.col("id")).alias("p_partkey"))
    # no order 5, two of 7, one without lines, one without a number, one with nothing but its number
    orders = spark.createDataFrame([(k, k * 10, "EUROPE") for k in range(12) if k != 5] + [(7, 71, None), (40, 400, "ASIA"), (None, 1, "ASIA"), (9, None, None)],
                                   "o_orderkey bigint, o_custkey int, r_name string")
    want, got = testdata.rows_by_order(lines, orders), testdata.rows_by_order_range(lines, orders)
    assert sorted(got.columns) == sorted(want.columns)
    rows = sorted(map(str, want.select(sorted(want.columns)).collect()))
    assert len(rows) > 55 and rows == sorted(map(str, got.select(sorted(want.columns)).collect()))


def test_sort_by_ingest_order_shuffles_a_line_with_its_order_once(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        raw = testdata.raw_from_testdata(spark, SF_SMALL)
        plan = _in_ingest_order(raw)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    dealt = re.findall(r"(?<!Broadcast)Exchange (\w+)\((\w+)", plan)
    assert dealt.count(("rangepartitioning", "l_orderkey")) == 1 and ("hashpartitioning", "l_orderkey") not in dealt
    assert sorted(key for kind, key in dealt) == ["c_custkey", "l_orderkey", "l_partkey", "o_custkey", "p_partkey"]
    above, below = plan.split("Exchange rangepartitioning")
    assert "AS profit#" in above and "AS profit#" not in below and "AS transaction_id#" not in below


def test_export_is_compressed_and_in_ingest_order(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    t = pipeline.testdata_job(spark, SF_SMALL)
    try:
        rows = registry.run_named_query(t, "sales_from_csv").count()
        folder = os.path.join(t.folder, "raw-sales-csv")
        assert rows > 0 and len([f for f in os.listdir(folder) if f.endswith(".csv.gz")]) > 1
        assert not [f for f in os.listdir(folder) if f.endswith(".csv")]
        back = files.read_raw_csv(spark, folder, "sales").orderBy(C.INGEST_ORDER)
        want = t.raw.sales.orderBy(C.INGEST_ORDER).drop(*C.SOURCE_COLUMNS)
        as_text = [F.col(c).cast("string") for c in want.columns]
        assert list(map(tuple, back.select(*want.columns).collect())) == list(map(tuple, want.select(*as_text).collect()))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        t.close()


def _shuffle_files(spark) -> set[str]:
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f.getName() for f in (found.apply(i) for i in range(found.size())) if f.getName().startswith("shuffle_")}


def test_shuffle_files_go_when_a_table_is_written(spark):
    before = _shuffle_files(spark)
    t = pipeline.testdata_job(spark, SF_SMALL)
    try:
        assert registry.run_named_query(t, "sales_from_csv").count() > 0
        written, end = _shuffle_files(spark) - before, time.time() + 30
        while len(written) > 4 and time.time() < end:  # deleted in the background; the count's own may stay
            time.sleep(0.5)
            written = _shuffle_files(spark) - before
        assert len(written) <= 4
    finally:
        t.close()


def test_a_setting_is_put_back(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    with freed_shuffles(spark):
        assert spark.conf.get(key) == "true"
    assert spark.conf.get(key, None) == before


ODD = ["1", "-1", "0", "-0.0", "nan", "NaN", "Infinity", "abc", "", None, " 3 ", "1e400", "9.3e18", "9007199254740993", "2.999", "0.125", "1e300", "4952.775"]


def test_imputed_before_the_dedup_as_after_it(spark):
    n = len(ODD)
    pick = lambda k, i: ODD[(k * (2 * i + 1) + i * k // n) % n]
    dates = ["2024-01-05", "01/07/2024", "2024-02-30", "N/A", None, " 2024-03-01 ", "2024-03-01 10:00:00"]
    rows = [(f"T{k % 700}" if k % 701 else None, dates[k % 7], f"P{k % 5}", None if k % 9 == 0 else f"C{k % 30}", "North", pick(k, 0), pick(k, 1), pick(k, 2),
             pick(k, 3), "1", "1", pick(k, 4), pick(k, 5), (k * 7919) % 2003) for k in range(2003)]
    schema = ", ".join(f"{f.name} string" for f in files.RAW_SCHEMAS["sales"])
    raw = spark.createDataFrame(rows, f"{schema}, _ingest_order int").repartition(5)
    products = spark.createDataFrame([(f"P{k}", 1.5 * k if k else None) for k in range(4)], "product_id string, base_cost double")
    want, got = C.clean_sales(raw, products), C.clean_sales(raw, products, distinct_order=True)
    assert got.schema == want.schema
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() > 100
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "gettimestamp" in plan[plan.index("Window "):]  # dates are parsed below the dedup
