"""Price-grid optimiser and what-if scenarios.

Demand at a candidate price p:  Q(p) = V * (p / P)^e * (Pc / p)^g, where V is
the annual base volume, P the current price, Pc the competitor price, e the
own-price elasticity and g the cross elasticity (both the rounded values the
elasticity report publishes).

The grid is an array in each product's row, so the optima are picked by array
functions without a shuffle; the curve as a table (51 rows per product) is
that array exploded.  No per-product loop, no driver collection.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from priceloom.functions.numerics import portfolio_sum, r, safe_div
from priceloom.operators.metrics import dbl, facts, horizon

DEFAULT_CROSS = 0.3
DAYS_PER_YEAR = 365.0


def grid_multipliers(price_range_pct: float = 0.25, step_pct: float = 0.01) -> list[float]:
    """``numpy.arange(1 - r, 1 + r + step / 2, step)``: the same doubles."""
    return [float(x) for x in np.arange(1.0 - price_range_pct, 1.0 + price_range_pct + step_pct / 2.0, step_pct)]


def annual_volumes(sales: DataFrame, months: int | Column = 24) -> DataFrame:
    """Units sold per product scaled to one year (sum * 12 / months)."""
    u = facts(sales, ["product_id"], ("units",))
    return u.select("product_id", (dbl("units") * F.lit(12.0) / horizon(months)).alias("annual_units"))


def _inputs(fits: DataFrame, sales: DataFrame, months: int | Column) -> DataFrame:
    vol = annual_volumes(sales, months)
    base = fits.select("product_id", "product_name", "category", "elasticity", "classification",
                       "current_price", "base_cost", "competitor_price", "avg_daily_demand",
                       F.coalesce(F.col("cross_price_elasticity"), F.lit(DEFAULT_CROSS)).alias("cross"))
    j = base.join(vol, "product_id", "left")
    v = F.coalesce(F.col("annual_units"), F.lit(0.0))
    return j.withColumn("volume", F.when(v <= 0, F.col("avg_daily_demand") * F.lit(DAYS_PER_YEAR)).otherwise(v))


def _with_candidates(fits: DataFrame, sales: DataFrame, price_range_pct: float, step_pct: float,
                     months: int | Column) -> DataFrame:
    """Each product's row with the array ``grid`` of its candidate prices
    above cost, ascending, as structs: a product never leaves its row."""
    mults = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(m).alias("m")) for i, m in enumerate(grid_multipliers(price_range_pct, step_pct))])
    P, c, Pc = F.col("current_price"), F.col("base_cost"), F.col("competitor_price")

    def outcome(x: Column) -> Column:
        demand = F.pow(safe_div(x["p"], P), F.col("elasticity")) * F.pow(safe_div(Pc, x["p"]), F.col("cross"))
        return F.struct(x["i"].alias("grid_idx"), x["p"].alias("candidate_price"), x["m"].alias("mult"),
                        r(F.col("volume") * demand, 1).alias("expected_units"))

    def money(x: Column) -> Column:
        p, units = x["candidate_price"], x["expected_units"]
        return F.struct(x["grid_idx"].alias("grid_idx"), p.alias("candidate_price"),
                        r((x["mult"] - F.lit(1.0)) * F.lit(100.0), 1).alias("price_change_pct"), units.alias("expected_units"),
                        r(units * p).alias("expected_revenue"), r(units * c).alias("expected_cost"),
                        r(r(units * p) - r(units * c)).alias("expected_profit"),
                        r(safe_div(p - c, p) * F.lit(100.0)).alias("margin_pct"), r(p - c).alias("unit_profit"))
    priced = F.transform(mults, lambda x: F.struct(x["i"].alias("i"), x["m"].alias("m"), r(P * x["m"]).alias("p")))
    above = F.filter(priced, lambda x: x["p"] > c)
    return _inputs(fits, sales, months).withColumn("grid", F.transform(F.transform(above, outcome), money))


def price_curve(fits: DataFrame, sales: DataFrame, price_range_pct: float = 0.25,
                step_pct: float = 0.01, months: int | Column = 24) -> DataFrame:
    """Candidate prices r2(P * m) above cost with expected units, revenue,
    cost, profit, margin and unit profit (P2), for every fitted product."""
    return _with_candidates(fits, sales, price_range_pct, step_pct, months).select("product_id", "product_name", F.inline("grid"))


def _best(order) -> Column:
    """The candidate with the largest key (ties: the lower price)."""
    return F.array_max(F.transform("grid", lambda x: F.struct(order(x).alias("key"), (-x["grid_idx"]).alias("tie"), x.alias("row"))))["row"]


def optimal_prices(fits: DataFrame, sales: DataFrame, months: int | Column = 24) -> DataFrame:
    """Per product: the curve row nearest the current price (baseline), the
    revenue-maximising and the profit-maximising rows (lowest price on ties)
    and the upside of each (P3 / P4).  The three are picked inside the
    product's row, without exploding, joining or grouping the curve."""
    j = _with_candidates(fits, sales, 0.25, 0.01, months).filter(F.size("grid") > 0).select(
        "*", _best(lambda x: -F.abs(x["candidate_price"] - F.col("current_price"))).alias("cur"),
        _best(lambda x: x["expected_revenue"]).alias("rmax"), _best(lambda x: x["expected_profit"]).alias("pmax"))
    # Upsides are published rounded; their percentages use the raw difference.
    rev_diff = F.col("rmax.expected_revenue") - F.col("cur.expected_revenue")
    prof_diff = F.col("pmax.expected_profit") - F.col("cur.expected_profit")
    rev_delta, prof_delta = r(rev_diff), r(prof_diff)
    cur_rev, cur_prof = F.col("cur.expected_revenue"), F.col("cur.expected_profit")
    return j.select(
        "product_id", "product_name", "category", "elasticity", "classification", "base_cost",
        "current_price", "competitor_price",
        F.col("cur.expected_units").alias("current_annual_units"),
        cur_rev.alias("current_annual_revenue"),
        cur_prof.alias("current_annual_profit"),
        F.col("cur.margin_pct").alias("current_margin_pct"),
        F.col("rmax.candidate_price").alias("rev_max_price"),
        F.col("rmax.price_change_pct").alias("rev_max_price_change_pct"),
        F.col("rmax.expected_units").alias("rev_max_expected_units"),
        F.col("rmax.expected_revenue").alias("rev_max_expected_revenue"),
        rev_delta.alias("rev_max_revenue_upside"),
        F.when(cur_rev > 0, r(safe_div(rev_diff, cur_rev) * F.lit(100.0))).otherwise(F.lit(0.0))
         .alias("rev_max_revenue_upside_pct"),
        F.col("pmax.candidate_price").alias("profit_max_price"),
        F.col("pmax.price_change_pct").alias("profit_max_price_change_pct"),
        F.col("pmax.expected_units").alias("profit_max_expected_units"),
        F.col("pmax.expected_revenue").alias("profit_max_expected_revenue"),
        F.col("pmax.expected_profit").alias("profit_max_expected_profit"),
        F.col("pmax.margin_pct").alias("profit_max_margin_pct"),
        prof_delta.alias("profit_max_profit_upside"),
        F.when(cur_prof > 0, r(safe_div(prof_diff, cur_prof) * F.lit(100.0))).otherwise(F.lit(0.0))
         .alias("profit_max_profit_upside_pct"),
    )


def simulate_scenarios(scenarios: DataFrame, fits: DataFrame, sales: DataFrame,
                       months: int | Column = 24) -> DataFrame:
    """What-if P&L for a table of scenarios (P5).

    ``scenarios``: scenario_id, product_id, new_price, and optionally
    competitor_price (NULL -> catalogue), discount_pct (0),
    season_multiplier (1), regional_multiplier (1).  Unknown products drop
    out (inner join).  A zero effective price yields NULL ratios instead of
    an error.
    """
    cols = set(scenarios.columns)
    sc = scenarios.select(
        "scenario_id", "product_id", F.col("new_price").cast("double").alias("new_price"),
        (F.col("competitor_price") if "competitor_price" in cols else F.lit(None)).cast("double").alias("comp_in"),
        (F.col("discount_pct") if "discount_pct" in cols else F.lit(0.0)).cast("double").alias("discount_pct"),
        (F.col("season_multiplier") if "season_multiplier" in cols else F.lit(1.0)).cast("double").alias("season"),
        (F.col("regional_multiplier") if "regional_multiplier" in cols else F.lit(1.0)).cast("double").alias("regional"),
    )
    vol = annual_volumes(sales, months)
    meta = fits.select("product_id", "product_name", "category", "elasticity", "classification", "base_cost",
                       "current_price", "competitor_price",
                       F.coalesce(F.col("cross_price_elasticity"), F.lit(DEFAULT_CROSS)).alias("cross"))
    j = sc.join(meta, "product_id").join(vol, "product_id", "left")
    P, c = F.col("current_price"), F.col("base_cost")
    j = j.withColumns({
        "competitor_price": F.coalesce(F.col("comp_in"), F.col("competitor_price")),
        "base_units": F.coalesce(F.col("annual_units"), F.lit(0.0)),
        "effective_new_price": r(F.col("new_price") * (F.lit(1.0) - F.col("discount_pct") / F.lit(100.0))),
    })
    eff, base_u = F.col("effective_new_price"), F.col("base_units")
    j = j.withColumns({
        "current_revenue": r(base_u * P),
        "current_cost": r(base_u * c),
        "current_margin_pct": r(safe_div(P - c, P) * F.lit(100.0)),
    })
    j = j.withColumn("current_profit", r(F.col("current_revenue") - F.col("current_cost")))
    mult = (F.pow(safe_div(eff, P), F.col("elasticity")) * F.pow(safe_div(F.col("competitor_price"), eff), F.col("cross"))
            * F.col("season") * F.col("regional"))
    j = j.withColumn("proposed_units", r(base_u * mult, 1))
    j = j.withColumns({
        "proposed_revenue": r(F.col("proposed_units") * eff),
        "proposed_cost": r(F.col("proposed_units") * c),
        "proposed_margin_pct": F.when(eff > 0, r(safe_div(eff - c, eff) * F.lit(100.0))).otherwise(F.lit(0.0)),
    })
    j = j.withColumn("proposed_profit", r(F.col("proposed_revenue") - F.col("proposed_cost")))
    j = j.withColumns({
        "delta_units": r(F.col("proposed_units") - base_u, 1),
        "delta_revenue": r(F.col("proposed_revenue") - F.col("current_revenue")),
        "delta_profit": r(F.col("proposed_profit") - F.col("current_profit")),
    })

    def gpct(delta: str, base: Column) -> Column:
        return F.when(base > 0, r(safe_div(F.col(delta), base) * F.lit(100.0))).otherwise(F.lit(0.0))

    return j.select(
        "scenario_id", "product_id", "product_name", "category", "elasticity", "classification", "base_cost",
        "current_price", "new_price", "effective_new_price", "competitor_price", "discount_pct",
        base_u.alias("current_units"), "current_revenue", "current_profit", "current_margin_pct",
        "proposed_units", "proposed_revenue", "proposed_profit", "proposed_margin_pct",
        "delta_units", gpct("delta_units", base_u).alias("delta_units_pct"),
        "delta_revenue", gpct("delta_revenue", F.col("current_revenue")).alias("delta_revenue_pct"),
        "delta_profit", gpct("delta_profit", F.col("current_profit")).alias("delta_profit_pct"),
    )


def optimization_summary(opt: DataFrame) -> DataFrame:
    """Portfolio totals of current and optimal revenue / profit."""
    def s(c: str) -> Column:
        return portfolio_sum(F.col(c))
    g = opt.agg(
        F.count("product_id").alias("products_optimized"),
        s("current_annual_revenue").alias("cr"), s("rev_max_expected_revenue").alias("orv"),
        s("rev_max_revenue_upside").alias("ru"), s("current_annual_profit").alias("cp"),
        s("profit_max_expected_profit").alias("opf"), s("profit_max_profit_upside").alias("pu"))
    return g.select(
        "products_optimized",
        dbl("cr").alias("baseline_annual_revenue"),
        dbl("orv").alias("optimal_annual_revenue"),
        dbl("ru").alias("revenue_upside"),
        r(safe_div(dbl("ru"), dbl("cr")) * F.lit(100.0)).alias("revenue_upside_pct"),
        dbl("cp").alias("baseline_annual_profit"),
        dbl("opf").alias("optimal_annual_profit"),
        dbl("pu").alias("profit_upside"),
        r(safe_div(dbl("pu"), dbl("cp")) * F.lit(100.0)).alias("profit_upside_pct"),
    )


def top_profit_opportunities(opt: DataFrame, k: int = 5) -> DataFrame:
    """The k largest profit upsides (P7); ties by product id."""
    return opt.orderBy(F.col("profit_max_profit_upside").desc(), "product_id").limit(k).select(
        "product_id", "product_name", "current_price", "profit_max_price",
        "profit_max_price_change_pct", "profit_max_profit_upside")


def uplift_scenarios(fits: DataFrame, raise_pct: float = 10.0, discount_pct: float = 5.0) -> DataFrame:
    """A scenario per fitted product: list price up ``raise_pct`` with a
    ``discount_pct`` promotion, catalogue competitor price."""
    return fits.select(
        F.concat(F.lit("uplift-"), F.col("product_id").cast("string")).alias("scenario_id"),
        "product_id",
        r(F.col("current_price") * F.lit(1.0 + raise_pct / 100.0)).alias("new_price"),
        F.lit(None).cast("double").alias("competitor_price"),
        F.lit(float(discount_pct)).alias("discount_pct"),
        F.lit(1.0).alias("season_multiplier"),
        F.lit(1.0).alias("regional_multiplier"),
    )
