"""A key holding a third of all rows must not change any result."""

from pyspark.sql import functions as F

from priceloom.operators import cleaning as C
from priceloom.operators import dashboard as D
from priceloom.operators import reports as RP
from priceloom.operators import reports_sql as Q


def test_keep_first_with_a_hot_key(spark):
    n = 3000
    rows = [("HOT" if i % 3 == 0 else f"K{i}", (n - i), f"v{i}") for i in range(n)]
    df = spark.createDataFrame(rows, "k string, _ingest_order int, v string").repartition(8)
    got = {r.k: (r.v, r._copies) for r in C.keep_first(df, ["k"], with_copies=True).collect()}
    assert got["HOT"] == (f"v{max(i for i in range(n) if i % 3 == 0)}", n // 3)
    assert len(got) == 1 + 2 * n // 3


def test_guest_heavy_segment_report(spark):
    # A third of the sales belong to the guest key, which has no customer row.
    sales = spark.createDataFrame(
        [(f"T{i}", "CUST-GUEST" if i % 3 == 0 else f"C{i % 7}", 1, 10.0, 4.0) for i in range(900)],
        "transaction_id string, customer_id string, quantity int, revenue double, profit double").repartition(6)
    customers = spark.createDataFrame([(f"C{j}", "Seg" + str(j % 2)) for j in range(7)],
                                      "customer_id string, customer_segment string")
    got = {r.customer_segment: r for r in Q.customer_segment_revenue_and_aov(sales, customers).collect()}
    assert sum(r.total_transactions for r in got.values()) == 600
    assert got["Seg0"].active_customers == 4 and got["Seg1"].active_customers == 3
    assert sum(r.total_revenue for r in got.values()) == 6000.0


def test_pareto_with_a_hot_revenue_value(spark):
    # A third of the products share one revenue value: RANGE ties share a total.
    sales = spark.createDataFrame([(i, f"T{i}", 1, 5.0 if i % 3 == 0 else float(i), 1.0) for i in range(300)],
                                  "product_id long, transaction_id string, quantity int, revenue double, "
                                  "profit double")
    products = spark.createDataFrame([(i, f"p{i}", "c") for i in range(300)],
                                     "product_id long, product_name string, category string")
    out = {r.product_id: r for r in Q.pareto_product_revenue_distribution(sales, products).collect()}
    total = sum(5.0 if i % 3 == 0 else float(i) for i in range(300))
    tie = [r.cumulative_revenue for pid, r in out.items() if pid % 3 == 0]
    assert len(set(tie)) == 1
    assert tie[0] == sum(5.0 if i % 3 == 0 else float(i) for i in range(300) if (5.0 if i % 3 == 0 else i) >= 5.0)
    assert max(r.cumulative_revenue for r in out.values()) == total


def test_filtered_segment_report_with_many_guests(spark):
    # 40% guests: with the default filters they go below the join, not after it.
    n = 5000
    sales = spark.range(n).select(
        F.concat(F.lit("T"), "id").alias("transaction_id"), (F.col("id") % 50).alias("product_id"),
        F.when(F.col("id") % 5 < 2, "CUST-GUEST").otherwise(F.concat(F.lit("C"), F.col("id") % 70)).alias("customer_id"),
        F.lit("North").alias("region"), F.lit("2000-01-01").cast("date").alias("date"), F.lit(1).alias("quantity"),
        F.lit(10.0).alias("revenue"), F.lit(4.0).alias("profit"), F.lit(0.1).alias("discount"))
    products = spark.range(50).select(F.col("id").alias("product_id"), F.lit("Cat").alias("category"))
    customers = spark.range(70).select(F.concat(F.lit("C"), "id").alias("customer_id"), F.lit("Seg").alias("customer_segment"))
    kept = RP.customer_segment_analysis(D.filter_sales(sales, products, customers, segments=None), customers)
    assert {r.customer_segment: r.total_orders for r in kept.collect()} == {"Guest Shoppers": n * 2 // 5, "Seg": n * 3 // 5}
    filtered = D.filter_sales(sales, products, customers)
    known = RP.customer_segment_analysis(filtered, customers)
    assert {r.customer_segment: r.total_orders for r in known.collect()} == {"Seg": n * 3 // 5}
    plan = filtered._jdf.queryExecution().optimizedPlan().toString().splitlines()
    joined = next(i for i, line in enumerate(plan) if "Join Inner" in line and "customer_id" in line)
    assert any("CUST-GUEST" in line for line in plan[joined + 1:])
