"""Missing values in keys, text `nan`, and dates in every readable layout."""

import datetime

from pyspark.sql import functions as F

from priceloom.functions.dates import parse_iso_date, parse_mixed_date
from priceloom.functions.numerics import clip, portfolio_sum, strip
from priceloom.operators.cleaning import coerce_numeric
from priceloom.operators.optimizer import optimization_summary
from priceloom.operators.ordering import cumulative_sum_desc, row_number_within
from priceloom.operators.recommend import impact_totals
from priceloom.session import configure_for_scale


def test_null_group_is_numbered(spark):
    df = spark.createDataFrame([(1, None, 5.0), (2, "a", 4.0), (3, None, 3.0)], "id int, g string, v double")
    got = {r.id: r.rn for r in row_number_within(df, ["g"], [F.desc("v"), F.col("id")], "rn").collect()}
    assert got == {1: 1, 2: 1, 3: 2}


def test_null_value_stays_in_running_sum(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, 3.0)], "id int, v double").withColumn("v", F.col("v").cast("decimal(18,2)"))
    got = {r.id: float(r.c) for r in cumulative_sum_desc(df, "v", "c").collect()}
    assert got == {1: 5.0, 2: 8.0, 3: 8.0}


def test_nan_is_missing(spark):
    df = spark.createDataFrame([("nan",), ("NaN",), ("0.7",), ("x",), (None,)], "d string")
    rows = df.select(coerce_numeric("d").alias("n"), clip(F.col("d").try_cast("double"), 0.0, 0.5).alias("c")).collect()
    assert [tuple(r) for r in rows] == [(None, None), (None, None), (0.7, 0.5), (None, None), (None, None)]


def test_dates_and_blanks(spark):
    day = datetime.date(2024, 1, 5)
    texts = ["1/5/2024", "01/05/2024", "2024-1-5", "2024-01-05", "2024-01-05 10:00:00", "2024-01-05T00:00:00"]
    df = spark.createDataFrame([(t,) for t in [*texts, "2024", "soon", None]], "d string")
    assert [r[0] for r in df.select(parse_mixed_date("d")).collect()] == [day] * 6 + [None] * 3
    assert [r[0] for r in df.select(parse_iso_date("d")).collect()] == [None, None] + [day] * 4 + [None] * 3
    one = spark.createDataFrame([("\tPremium \n",)], "s string").select(strip("s")).first()
    assert one[0] == "Premium"


def test_partitions_have_no_ceiling(spark):
    conf = configure_for_scale(spark.newSession(), 100 * 1024 ** 4)
    assert int(conf["spark.sql.shuffle.partitions"]) == 100 * 4096


def test_one_extreme_fit_does_not_stop_the_portfolio_reports(spark):
    total = lambda *v: spark.createDataFrame([(x,) for x in v], "v double").agg(portfolio_sum(F.col("v"))).first()[0]
    assert total(0.1, 0.2, None) == 0.3 and total(8.7e42, 1.0) == 8.7e42 and total(8.7e42) == 8.7e42 and total(None) is None
    cols = ["current_annual_revenue", "rev_max_expected_revenue", "rev_max_revenue_upside", "current_annual_profit",
            "profit_max_expected_profit", "profit_max_profit_upside"]
    opt = spark.createDataFrame([(1, *[100.0] * 6), (2, 100.0, 8.7e42, 8.7e42, 100.0, 8.7e42, 8.7e42)],
                                "product_id int, " + ", ".join(f"{c} double" for c in cols))
    got = optimization_summary(opt).first()
    assert got.baseline_annual_revenue == 200.0 and got.optimal_annual_revenue == 8.7e42 and got.products_optimized == 2
    recs = spark.createDataFrame([(1.25, 8.7e42), (2.5, 1.0)], "expected_profit_impact double, expected_revenue_impact double")
    assert tuple(impact_totals(recs).first()) == (2, 3.75, 8.7e42)
