import numpy as np
import pytest

from priceloom.operators import optimizer as OP

FIT_SCHEMA = ("product_id string, product_name string, category string, elasticity double, "
              "classification string, current_price double, base_cost double, competitor_price double, "
              "avg_daily_demand double, cross_price_elasticity double")


def _fits(spark, rows):
    return spark.createDataFrame(rows, FIT_SCHEMA)


def _sales(spark, rows):
    return spark.createDataFrame(rows, "product_id string, quantity int")


def test_grid_is_numpy_arange():
    assert OP.grid_multipliers() == [float(x) for x in np.arange(0.75, 1.255, 0.01)]
    assert len(OP.grid_multipliers()) == 51


def test_curve_demand_falls_and_skips_below_cost(spark):
    fits = _fits(spark, [("A", "a", "c", -1.5, "Elastic", 100.0, 40.0, 105.0, 2.0, 0.3),
                         ("B", "b", "c", -0.8, "Inelastic", 100.0, 90.0, 100.0, 2.0, None)])
    sales = _sales(spark, [("A", 100), ("A", 140), ("B", 10)])
    curve = {}
    for r in OP.price_curve(fits, sales).collect():
        curve.setdefault(r.product_id, []).append(r)
    a = sorted(curve["A"], key=lambda r: r.candidate_price)
    assert len(a) == 51 and a[0].expected_units > a[-1].expected_units
    # (100+140)/2 at m = 1, times the competitor factor (105/100)^0.3
    assert a[0].candidate_price == 75.0 and a[25].expected_units == 121.8
    b = sorted(curve["B"], key=lambda r: r.candidate_price)
    assert min(r.candidate_price for r in b) > 90.0 and len(b) == 35


def test_optimum_and_upside(spark):
    fits = _fits(spark, [("A", "a", "c", -1.5, "Elastic", 100.0, 40.0, 105.0, 2.0, 0.3),
                         ("Z", "z", "c", -0.5, "Inelastic", 100.0, 40.0, 105.0, 3.0, 0.3)])
    opt = {r.product_id: r for r in OP.optimal_prices(fits, _sales(spark, [("A", 240)])).collect()}
    a = opt["A"]
    assert a.profit_max_price > a.base_cost and a.profit_max_profit_upside >= 0 and a.rev_max_revenue_upside >= 0
    assert a.current_annual_units == 121.8
    # No sales: the volume falls back to avg daily demand x 365.
    assert opt["Z"].current_annual_units == pytest.approx(1095.0 * (105 / 100) ** 0.3, abs=0.05)


def test_price_at_or_below_cost_uses_nearest_surviving_row(spark):
    fits = _fits(spark, [("A", "a", "c", -1.2, "Elastic", 100.0, 120.0, 100.0, 1.0, 0.3)])
    o = OP.optimal_prices(fits, _sales(spark, [("A", 10)])).first()
    assert o.current_margin_pct == pytest.approx((121 - 120) / 121 * 100, abs=0.01)


def test_constant_demand_ties_resolve_to_lowest_price(spark):
    # e = 0, g = 0: units constant; revenue peaks at the top price, and an
    # all-equal metric would pick the lowest price.
    fits = _fits(spark, [("A", "a", "c", 0.0, "Inelastic", 100.0, 200.0, 100.0, 1.0, 0.0)])
    rows = OP.price_curve(fits, _sales(spark, [("A", 20)])).collect()
    assert rows == []  # every candidate is below cost: no curve, no optimum


def test_scenarios(spark):
    fits = _fits(spark, [("A", "a", "c", -1.5, "Elastic", 150.0, 80.0, 145.0, 2.0, 0.3),
                         ("Q", "q", "c", -1.5, "Elastic", 150.0, 80.0, 145.0, 2.0, 0.3)])
    sc = spark.createDataFrame([("s1", "A", 160.0, 150.0, 5.0), ("s2", "Q", 0.0, None, 0.0),
                                ("s3", "missing", 10.0, None, 0.0)],
                               "scenario_id string, product_id string, new_price double, competitor_price double, "
                               "discount_pct double")
    out = {r.scenario_id: r for r in OP.simulate_scenarios(sc, fits, _sales(spark, [("A", 100)])).collect()}
    assert set(out) == {"s1", "s2"}
    s1 = out["s1"]
    assert s1.effective_new_price == 152.0 and s1.proposed_units > 0 and s1.proposed_revenue > 0
    assert s1.current_units == 50.0 and s1.competitor_price == 150.0
    s2 = out["s2"]  # zero price, zero sales: NULL ratios and guarded percentages, no error
    assert s2.current_units == 0.0 and s2.delta_units_pct == 0.0 and s2.proposed_margin_pct == 0.0
