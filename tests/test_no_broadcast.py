"""The reports with joins when nothing can be broadcast: sort-merge joins,
split partitions, the same rows."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from check_oracle import compare, duck
from conftest import SF_SMALL
from priceloom.operators import dashboard as D
from priceloom.operators import reports as RP
from priceloom.plans import pipeline, registry

JOINED = ["clean_sales", "revenue_and_margin_by_category", "top_10_most_profitable_products", "customer_segment_revenue_and_aov",
          "customer_lifetime_value_by_channel", "product_revenue_rank_within_category", "pareto_product_revenue_distribution",
          "regional_pricing_and_discount_disparities", "category_elasticity", "price_curve", "simulate_scenarios",
          "category_summary_filtered", "customer_segment_analysis", "customer_segment_analysis_filtered", "filter_sales",
          "opportunity_matrix", "seasonality_pivot"]
SETTINGS = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k"}


@pytest.fixture(scope="module")
def unbroadcast(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.fixture(scope="module")
def bundle(unbroadcast):
    """Cleaned without broadcasts, too (but for the 25 nations and 5 regions of the test data)."""
    t = pipeline.testdata_tables(unbroadcast, SF_SMALL)
    yield t
    t.close()


@pytest.mark.parametrize("name", JOINED)
def test_rows_without_broadcasts(bundle, con, name):
    df = registry.run_named_query(bundle, name)
    assert "BroadcastHashJoin" not in df._jdf.queryExecution().executedPlan().toString()
    assert compare(df.toPandas(), con.sql(E.oracle_sql()[name]).df()) == "OK"


def _tables(spark, n=20_000):
    sales = spark.range(n).repartition(6).select(
        F.concat(F.lit("T"), "id").alias("transaction_id"), (F.col("id") % 50).alias("product_id"),
        F.when(F.col("id") % 5 < 2, "CUST-GUEST").otherwise(F.concat(F.lit("C"), F.col("id") % 7000)).alias("customer_id"),
        F.lit("North").alias("region"), F.lit("2000-01-01").cast("date").alias("date"), F.lit(1).cast("bigint").alias("quantity"),
        F.lit(10.0).alias("revenue"), F.lit(4.0).alias("profit"), F.lit(0.1).alias("discount"))
    products = spark.range(50).select(F.col("id").alias("product_id"), F.lit("Cat").alias("category"))
    customers = spark.range(7000).select(F.concat(F.lit("C"), "id").alias("customer_id"), F.lit("Seg").alias("customer_segment"))
    return sales, products, customers


def test_no_task_gets_the_guests(unbroadcast):
    sales, products, customers = _tables(unbroadcast)
    out = D.filter_sales(sales, products, customers, categories=None, segments=None)
    spread = out.filter(F.col("customer_segment") == RP.GUEST_SEGMENT).groupBy(F.spark_partition_id().alias("p")).count().collect()
    guests = sum(r["count"] for r in spread)
    assert guests == 8000 and len(spread) > 3 and max(r["count"] for r in spread) < guests / 2
    report = {r.customer_segment: (r.total_orders, r.unique_customers) for r in RP.customer_segment_analysis(out, customers).collect()}
    assert report == {RP.GUEST_SEGMENT: (8000, 1), "Seg": (12000, 4200)}
