"""Raw retail tables derived from the driver's TPC-H-like test data.

The four raw tables of the pricing application (customers, products, sales,
pricing history) do not exist in the test data; they are derived here by
fixed formulas (FIXTURES.md section 4) that the DuckDB oracle repeats in SQL.
The raw sales view also carries the application's dirt patterns (missing
customer ids and discounts, glitch rows, US-style and broken dates), each
keyed on ``l_orderkey`` so the oracle can reproduce them exactly.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from priceloom.functions.numerics import money_sum, exact_avg, r

# Label lists used to derive the customer attributes the
# test data lacks (same label texts as the application's generator).
AGE_GROUPS = ["18-25", "26-35", "36-50", "51-65", "65+"]
ACQUISITION_CHANNELS = ["Organic Search", "Paid Social", "Email Marketing", "Referral", "Direct"]

TPCH_TABLES = ("region", "nation", "customer", "part", "orders", "lineitem")


def read_tables(spark: SparkSession, sf_dir: str, names=TPCH_TABLES) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir.rstrip('/')}/{n}.parquet") for n in names}


def _label(labels: list[str], idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in labels]), (idx + F.lit(1)).cast("int"))


def _product_columns() -> dict[str, Column]:
    """What the raw sales show of a product, from its number and price."""
    k, price = F.col("p_partkey"), F.col("p_retailprice")
    return {
        "base_cost": r(price * (F.lit(0.40) + (k % 10).cast("double") * F.lit(0.15))),
        "competitor_price": r(price * (F.lit(0.90) + (k % 21).cast("double") / F.lit(100.0))),
        "inventory_level": (F.lit(5) + (k * 37) % 150).cast("int"),
    }


def raw_products(part: DataFrame) -> DataFrame:
    """Catalogue from ``part``; a few categories carry case / space dirt."""
    k, shown = F.col("p_partkey"), _product_columns()
    return part.select(
        k.alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.when(k % 400 == 11, F.concat(F.lit(" "), F.lower("p_type"), F.lit(" ")))
         .otherwise(F.col("p_type")).alias("category"),
        F.col("p_brand").alias("subcategory"),
        shown["base_cost"].alias("base_cost"),
        F.col("p_retailprice").alias("current_price"),
        shown["competitor_price"].alias("competitor_price"),
        shown["inventory_level"].alias("inventory_level"),
    )


def customer_regions(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """``c_custkey -> r_name``; nation and region are 25 and 5 rows."""
    geo = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey) \
                .select("n_nationkey", "r_name")
    return customer.join(F.broadcast(geo), customer.c_nationkey == geo.n_nationkey) \
                   .select("c_custkey", "c_mktsegment", "c_acctbal", "r_name")


def raw_customers(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Customers with segment padding and missing / ``nan`` regions."""
    c = customer_regions(customer, nation, region)
    k = F.col("c_custkey")
    return c.select(
        k.cast("string").alias("customer_id"),
        F.when(k % 50 == 3, F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit(" ")))
         .otherwise(F.col("c_mktsegment")).alias("customer_segment"),
        _label(AGE_GROUPS, F.floor((k % 25) / F.lit(5.0))).alias("age_group"),
        F.when(k % 125 == 7, F.lit(None).cast("string"))
         .when(k % 250 == 11, F.lit("nan"))
         .otherwise(F.col("r_name")).alias("region"),
        _label(ACQUISITION_CHANNELS, k % 5).alias("acquisition_channel"),
        F.col("c_acctbal").alias("customer_lifetime_value"),
        F.struct(k.alias("c_custkey")).alias("_ingest_order"),
    )


LINEITEM_ORDER = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                  "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                  "l_shipdate")


def sales_lines(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Line items, with the number and price of their product."""
    return lineitem.select(*LINEITEM_ORDER).join(part.select("p_partkey", "p_retailprice"), F.col("l_partkey") == F.col("p_partkey"), "left")


def sales_orders(orders: DataFrame, customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Orders, with the region of their customer."""
    cust = customer_regions(customer, nation, region).select("c_custkey", "r_name")
    return orders.select("o_orderkey", "o_custkey", "o_orderdate") \
                 .join(cust, orders.o_custkey == cust.c_custkey).drop("c_custkey")


def rows_by_order(lines: DataFrame, ords: DataFrame) -> DataFrame:
    """Each line with its order: what ``sales_view`` shows.  Orders last:
    their join deals the rows by order, as the dedup groups them."""
    return lines.join(ords, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")


def rows_by_order_range(lines: DataFrame, ords: DataFrame) -> DataFrame:
    """The rows of ``rows_by_order``, dealt by ranges of the order's number
    in place of its hash, so that a sort by ingest order (which begins with
    that number) needs no other shuffle.  Ranges of two tables differ, so
    both are dealt as one, and a window hands each line the orders of its
    number: none, one or (were they repeated) several, as the join does."""
    line, order = (F.struct(*[c for c in df.columns if c != key]) for df, key in ((lines, "l_orderkey"), (ords, "o_orderkey")))
    both = lines.select("l_orderkey", line.alias("_line")).unionByName(
        ords.select(F.col("o_orderkey").alias("l_orderkey"), order.alias("_order")), allowMissingColumns=True)
    found = F.collect_list("_order").over(Window.partitionBy("l_orderkey"))
    return both.filter("l_orderkey IS NOT NULL").repartitionByRange("l_orderkey") \
               .select("l_orderkey", "_line", found.alias("_orders")).filter("_line IS NOT NULL") \
               .select("l_orderkey", "_line.*", F.inline("_orders"))


def sales_view(rows: DataFrame) -> DataFrame:
    """Dirty sales transactions, one per line item, each from its row alone:
    rows that are shuffled (for a join or a sort) carry no column that
    follows from others.

    ``(l_orderkey, l_linenumber)`` repeats in the test data, so the
    transaction id is not unique; ``_ingest_order`` (all line-item columns)
    decides which copy counts as first.  All copies of one are of the same
    order, which ``_ingest_group`` names.
    """
    rows = rows.withColumns(_product_columns())
    k = F.col("l_orderkey")
    unit_price = r(F.col("l_extendedprice") / F.col("l_quantity"))
    revenue = F.when(k % 983 == 4, F.lit(-50.0)).otherwise(
        r(F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))))
    cost = r(F.col("l_quantity") * F.col("base_cost"))
    return rows.select(
        F.concat(k.cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("transaction_id"),
        F.when(k % 33 == 0, F.date_format("o_orderdate", "MM/dd/yyyy"))
         .when(k % 1999 == 17, F.lit("N/A"))
         .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date"),
        F.col("l_partkey").alias("product_id"),
        F.when(k % 100 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("o_custkey").cast("string")).alias("customer_id"),
        F.col("r_name").alias("region"),
        F.when(k % 997 == 2, F.lit(-1)).otherwise(F.col("l_quantity").cast("int")).alias("quantity"),
        F.when(k % 991 == 3, F.lit(-5.0)).otherwise(unit_price).alias("unit_price"),
        F.when(k % 83 == 1, F.lit(None).cast("double")).otherwise(F.col("l_discount")).alias("discount"),
        revenue.alias("revenue"),
        cost.alias("cost"),
        r(revenue - cost).alias("profit"),
        F.col("competitor_price"),
        F.col("inventory_level"),
        F.struct(*[F.col(c) for c in LINEITEM_ORDER]).alias("_ingest_order"),
        k.alias("_ingest_group"),
    )


def raw_pricing_history(clean_sales: DataFrame, clean_products: DataFrame) -> DataFrame:
    """Daily price / volume panel per product, from cleaned sales.

    The competitor price varies with the day of the year; a constant one
    would make the log-log regression singular.
    """
    daily = clean_sales.groupBy("date", "product_id").agg(
        r(exact_avg("unit_price")).alias("price"),
        F.sum("quantity").cast("int").alias("quantity_sold"),
        money_sum("revenue").alias("revenue"),
    )
    cur = clean_products.select("product_id", "current_price")
    # Dealt by product, as a shuffled join deals the rows in any case: the
    # dedup and the written clean history take them from there.
    d = daily.repartition("product_id").join(cur, "product_id", "left")
    shift = ((F.dayofyear("date") * 7 + F.col("product_id")) % 21).cast("double") / F.lit(100.0)
    return d.select(
        F.col("date").cast("string").alias("date"),
        "product_id",
        "price",
        "quantity_sold",
        r(F.col("current_price") * (F.lit(0.90) + shift)).alias("competitor_price"),
        "revenue",
        F.struct(F.col("date").alias("d"), F.col("product_id").alias("p")).alias("_ingest_order"),
    )


@dataclass
class RawTables:
    customers: DataFrame
    products: DataFrame
    sales: DataFrame
    #: Where the sales are the ``sales_view`` of rows: these, dealt by range.
    sales_rows: DataFrame | None = None


def raw_from_testdata(spark: SparkSession, sf_dir: str) -> RawTables:
    t = read_tables(spark, sf_dir)
    lines = sales_lines(t["lineitem"], t["part"])
    ords = sales_orders(t["orders"], t["customer"], t["nation"], t["region"])
    return RawTables(
        customers=raw_customers(t["customer"], t["nation"], t["region"]),
        products=raw_products(t["part"]),
        sales=sales_view(rows_by_order(lines, ords)),
        sales_rows=rows_by_order_range(lines, ords),
    )
