import pytest
from pyspark.sql import functions as F

from priceloom.operators import dashboard as DB
from priceloom.operators import reports as RP


def test_missing_columns_raise_keyerror(spark):
    bad_sales = spark.createDataFrame([(1,), (2,)], "some_random_col int")
    bad_prod = spark.createDataFrame([(1,)], "some_other_col int")
    with pytest.raises(KeyError) as e:
        RP.category_summary(bad_sales, bad_prod)
    assert "required in df_sales" in str(e.value)
    with pytest.raises(KeyError) as e:
        RP.regional_breakdown(bad_sales)
    assert "Available columns" in str(e.value)


def test_guards_hold_with_the_joined_column_present(spark):
    sales = spark.createDataFrame([("T1", "P1", "C1", 1, 2.0, 1.0, "Cat", "Seg", "North")],
                                  "transaction_id string, product_id string, customer_id string, quantity int, revenue double, "
                                  "profit double, category string, customer_segment string, region string")
    with pytest.raises(KeyError, match="cost"):
        RP.category_summary(sales, None)
    with pytest.raises(KeyError, match="discount"):
        RP.customer_segment_analysis(sales, None)
    with pytest.raises(KeyError, match="customer_id"):
        RP.customer_segment_analysis(sales.drop("customer_id"), None)
    with pytest.raises(KeyError, match="customer_segment.*df_customers"):
        RP.customer_segment_analysis(sales.drop("customer_segment").selectExpr("*", "0.1 AS discount"), sales.select("customer_id"))
    with pytest.raises(KeyError, match="revenue"):
        RP.regional_breakdown(sales.drop("revenue"))


def test_existing_category_column_no_suffixes(small_tables):
    t = small_tables
    pre = t.sales.join(t.products.select("product_id", "category"), "product_id", "left")
    cat = RP.category_summary(pre, t.products)
    assert "category" in cat.columns and not any(c.endswith(("_x", "_y")) for c in cat.columns)
    assert cat.count() == t.products.select("category").distinct().count()


def test_regional_group_count(small_tables):
    reg = RP.regional_breakdown(small_tables.sales)
    assert reg.count() == small_tables.sales.select("region").distinct().count()


def test_empty_input_gives_typed_empty_result(small_tables):
    empty = small_tables.sales.limit(0)
    out = RP.category_summary(empty, small_tables.products)
    assert out.count() == 0 and "revenue_share_pct" in out.columns


def test_discount_tier_edges(spark):
    df = spark.createDataFrame([(0.0,), (-0.1,), (0.05,), (0.1,), (0.15,), (0.2,), (None,)], "d double")
    got = [r[0] for r in df.select(RP.discount_tier(F.col("d"))).collect()]
    assert got == ["0% Full Price", "1% - 5%", "1% - 5%", "6% - 10%", "11% - 15%", "16% - 20%", "16% - 20%"]


def test_guest_shoppers_kept_in_segments(small_tables):
    seg = {r.customer_segment for r in RP.customer_segment_analysis(small_tables.sales,
                                                                    small_tables.customers).collect()}
    assert "Guest Shoppers" in seg


def test_dashboard_default_filter_drops_guests(small_tables):
    t = small_tables
    sl = DB.filter_sales(t.sales, t.products, t.customers)
    assert sl.filter(F.col("customer_segment") == "Guest Shoppers").count() == 0
    assert sl.filter(F.col("customer_id") == "CUST-GUEST").count() == 0
    assert DB.filter_sales(t.sales, t.products, t.customers, categories=None, regions=None,
                           segments=None).count() == t.sales.count()


def test_weekday_order(small_tables):
    days = [r.day_of_week for r in DB.weekday_ordered(small_tables.sales).collect()]
    assert days == list(DB.WEEKDAYS)
