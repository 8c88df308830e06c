import pytest

from priceloom.operators import recommend as RC

OPT = ("product_id string, product_name string, category string, current_price double, "
       "competitor_price double, base_cost double, current_margin_pct double, elasticity double, "
       "classification string, current_annual_units double, profit_max_price_change_pct double")
FITS = ("product_id string, product_name string, category string, elasticity double, classification string, "
        "current_price double, base_cost double, competitor_price double, cross_price_elasticity double")

CASES = [
    # id, P, Pc, eps, class, annual units, opt %, inventory -> action, change, price, priority
    ("r1", 90.0, 100.0, -0.6, "Inelastic", 1200.0, 0.0, 10, "Increase Price", 8.0, 97.2, "High"),
    ("r2", 110.0, 100.0, -0.6, "Inelastic", 1200.0, 0.0, 10, "Increase Price", 5.0, 115.5, "Medium"),
    ("r3", 110.0, 100.0, -2.5, "Highly Sensitive", 1200.0, 0.0, 10, "Decrease Price", -11.0, 97.9, "High"),
    ("r4", 101.0, 100.0, -2.5, "Highly Sensitive", 12.0, 0.0, 100, "Discount / Clearance", -10.0, 90.9, "Medium"),
    ("r5", 101.0, 100.0, -2.5, "Highly Sensitive", 1200.0, 0.0, 10, "Maintain Price", 0.0, 101.0, "Low"),
    ("r6", 100.0, 100.0, -1.5, "Elastic", 1200.0, 2.0, 10, "Maintain Price", 0.0, 100.0, "Low"),
    ("r7", 100.0, 100.0, -1.5, "Elastic", 1200.0, -15.0, 10, "Decrease Price", -10.0, 90.0, "Medium"),
    ("r8", 100.0, 100.0, -1.5, "Elastic", 1200.0, 6.0, 10, "Increase Price", 6.0, 106.0, "Medium"),
]


def _inputs(spark):
    opt = spark.createDataFrame(
        [(c[0], c[0], "cat", c[1], c[2], 40.0, 55.0 if i % 2 else 30.0, c[3], c[4], c[5], c[6])
         for i, c in enumerate(CASES)], OPT)
    fits = spark.createDataFrame([(c[0], c[0], "cat", c[3], c[4], c[1], 40.0, c[2], 0.3) for c in CASES], FITS)
    products = spark.createDataFrame([(c[0], c[7]) for c in CASES], "product_id string, inventory_level int")
    sales = spark.createDataFrame([(c[0], 100) for c in CASES], "product_id string, quantity int")
    return opt, fits, products, sales


def test_all_rules(spark):
    opt, fits, products, sales = _inputs(spark)
    got = {r.product_id: r for r in RC.recommendations(opt, products, fits, sales).collect()}
    for c in CASES:
        r = got[c[0]]
        assert (r.recommendation, r.recommended_change_pct, r.recommended_price, r.priority) == c[8:], c[0]
        assert r.rationale and "e = " in r.rationale or "price" in r.rationale


def test_quadrants(spark):
    df = spark.createDataFrame([(-1.0, 60.0), (-1.5, 60.0), (-1.0, 40.0), (-1.5, 40.0)], "e double, m double")
    from pyspark.sql import functions as F
    got = [r[0] for r in df.select(RC.quadrant(F.col("e"), F.col("m"))).collect()]
    assert got == list(RC.QUADRANTS)


def test_action_counts(spark):
    opt, fits, products, sales = _inputs(spark)
    counts = {r.recommendation: r.products
              for r in RC.action_counts(RC.recommendations(opt, products, fits, sales)).collect()}
    assert counts == {"Increase Price": 3, "Decrease Price": 2, "Maintain Price": 2, "Discount / Clearance": 1}
