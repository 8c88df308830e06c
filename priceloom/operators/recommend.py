"""Rule-based pricing recommendations (one ``when`` chain, no row loop)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from priceloom.functions.numerics import portfolio_sum, r, safe_div
from priceloom.operators.optimizer import simulate_scenarios

# Action, priority and quadrant labels.
ACTIONS = ("Increase Price", "Decrease Price", "Discount / Clearance", "Maintain Price")
PRIORITIES = ("High", "Medium", "Low")
QUADRANTS = ("Q1: Premium Margin & Pricing Power", "Q2: High Margin Volume Driver",
             "Q3: Margin Repair Candidate", "Q4: Price Sensitive / Operational Focus")
QUADRANT_ELASTICITY = 1.3
QUADRANT_MARGIN = 50.0
SLOW_TURN = 0.35


def competitor_gap_pct(price: Column, comp: Column) -> Column:
    """(P - Pc) / Pc * 100, unrounded."""
    return safe_div(price - comp, comp) * F.lit(100.0)


def monthly_turn(annual_units: Column, inventory: Column) -> Column:
    return (annual_units / F.lit(12.0)) / F.greatest(F.lit(1), inventory).cast("double")


def _num(x: Column, nd: int) -> Column:
    return F.format_string(f"%.{nd}f", r(x, nd))


def _decide(P: Column, Pc: Column, eps: Column, cls: Column, gap: Column, opt: Column, turn: Column,
            unit_margin: Column) -> Column:
    """First matching rule -> struct(action, change, price, priority, rationale)."""
    def rule(action, change, price, prio, text):
        return F.struct(F.lit(action).alias("action"), change.cast("double").alias("change"),
                        price.cast("double").alias("price"), F.lit(prio).alias("priority"),
                        text.alias("rationale"))

    def moved(change):
        return r(P * (F.lit(1.0) + change / F.lit(100.0)))

    e2 = _num(eps, 2)
    c_inel = F.least(F.lit(12.0), F.greatest(F.lit(5.0), r(F.abs(gap) * F.lit(0.8), 1)))
    c_hs = -F.least(F.lit(15.0), F.greatest(F.lit(5.0), r(gap * F.lit(1.1), 1)))
    c_dec = F.greatest(F.lit(-10.0), r(opt, 1))
    c_inc = F.least(F.lit(8.0), r(opt, 1))
    A, PR = ACTIONS, PRIORITIES
    return (
        F.when((cls == "Inelastic") & (P < Pc), rule(
            A[0], c_inel, moved(c_inel), PR[0],
            F.concat(F.lit("Demand is inelastic (e = "), e2, F.lit(") and the price sits "),
                     _num(F.abs(gap), 1), F.lit("% under the competitor ($"), _num(Pc, 2),
                     F.lit("); a "), _num(c_inel, 1), F.lit("% rise adds margin at little volume cost."))))
        .when(cls == "Inelastic", rule(
            A[0], F.lit(5.0), r(P * F.lit(1.05)), PR[1],
            F.concat(F.lit("Demand is inelastic (e = "), e2,
                     F.lit("), so a measured 5.0% rise widens margin while volume holds."))))
        .when((cls == "Highly Sensitive") & (gap > 2.0), rule(
            A[1], c_hs, moved(c_hs), PR[0],
            F.concat(F.lit("Buyers are highly price sensitive (e = "), e2, F.lit(") and the price is "),
                     _num(gap, 1), F.lit("% above the competitor ($"), _num(Pc, 2),
                     F.lit("); moving toward parity wins back volume and profit."))))
        .when((cls == "Highly Sensitive") & (turn < SLOW_TURN), rule(
            A[2], F.lit(-10.0), r(P * F.lit(0.90)), PR[1],
            F.concat(F.lit("Highly price sensitive (e = "), e2, F.lit(") with slow stock turn ("),
                     _num(turn, 2), F.lit("x per month); a 10% promotion clears inventory."))))
        .when(cls == "Highly Sensitive", rule(
            A[3], F.lit(0.0), P, PR[2],
            F.concat(F.lit("Price is near competitor parity ($"), _num(Pc, 2),
                     F.lit(") and sensitivity is high (e = "), e2,
                     F.lit("); hold the price to protect share."))))
        .when(F.abs(opt) < 3.0, rule(
            A[3], F.lit(0.0), P, PR[2],
            F.concat(F.lit("The current price ($"), _num(P, 2),
                     F.lit(") is within 3% of the profit-maximising price; keep it stable."))))
        .when(opt < 0, rule(
            A[1], c_dec, moved(c_dec), PR[1],
            F.concat(F.lit("Elastic demand (e = "), e2, F.lit("); a "), _num(F.abs(c_dec), 1),
                     F.lit("% cut brings enough extra units to raise gross profit."))))
        .otherwise(rule(
            A[0], c_inc, moved(c_inc), PR[1],
            F.concat(F.lit("Unit margin of $"), _num(unit_margin, 2), F.lit(" and a competitor price of $"),
                     _num(Pc, 2), F.lit(" leave room for a "), _num(c_inc, 1), F.lit("% rise."))))
    )


def quadrant(eps: Column, margin_pct: Column) -> Column:
    ae = F.abs(eps)
    hi_m = margin_pct >= QUADRANT_MARGIN
    return (F.when((ae < QUADRANT_ELASTICITY) & hi_m, QUADRANTS[0])
            .when((ae >= QUADRANT_ELASTICITY) & hi_m, QUADRANTS[1])
            .when((ae < QUADRANT_ELASTICITY) & (margin_pct < QUADRANT_MARGIN), QUADRANTS[2])
            .otherwise(QUADRANTS[3]))


def recommendations(opt: DataFrame, products: DataFrame, fits: DataFrame, sales: DataFrame,
                    months: int | Column = 24) -> DataFrame:
    """One recommendation per optimised product (R1), re-evaluated with the
    scenario simulator at the recommended price."""
    inv = products.select("product_id", "inventory_level")
    j = opt.join(inv, "product_id", "left")
    P, Pc = F.col("current_price"), F.col("competitor_price")
    gap = competitor_gap_pct(P, Pc)
    turn = monthly_turn(F.col("current_annual_units"), F.coalesce(F.col("inventory_level"), F.lit(0)))
    d = _decide(P, Pc, F.col("elasticity"), F.col("classification"), gap,
                F.col("profit_max_price_change_pct"), turn, P - F.col("base_cost"))
    j = j.withColumn("_d", d)
    scen = j.select(F.col("product_id").cast("string").alias("scenario_id"), "product_id",
                    F.col("_d.price").alias("new_price"), F.col("competitor_price"),
                    F.lit(0.0).alias("discount_pct"))
    sim = simulate_scenarios(scen, fits, sales, months).select(
        "product_id",
        F.col("delta_units_pct").alias("expected_volume_change_pct"),
        F.col("delta_revenue").alias("expected_revenue_impact"),
        F.col("delta_revenue_pct").alias("expected_revenue_impact_pct"),
        F.col("delta_profit").alias("expected_profit_impact"),
        F.col("delta_profit_pct").alias("expected_profit_impact_pct"))
    out = j.join(sim, "product_id", "left")
    z = F.lit(0.0)
    return out.select(
        "product_id", "product_name", "category", "current_price", "competitor_price", "base_cost",
        "current_margin_pct", "elasticity", "classification",
        F.col("_d.action").alias("recommendation"),
        F.col("_d.price").alias("recommended_price"),
        F.col("_d.change").alias("recommended_change_pct"),
        F.col("_d.priority").alias("priority"),
        F.coalesce("expected_volume_change_pct", z).alias("expected_volume_change_pct"),
        F.coalesce("expected_revenue_impact", z).alias("expected_revenue_impact"),
        F.coalesce("expected_revenue_impact_pct", z).alias("expected_revenue_impact_pct"),
        F.coalesce("expected_profit_impact", z).alias("expected_profit_impact"),
        F.coalesce("expected_profit_impact_pct", z).alias("expected_profit_impact_pct"),
        quadrant(F.col("elasticity"), F.col("current_margin_pct")).alias("opportunity_quadrant"),
        F.col("_d.rationale").alias("rationale"),
    )


def action_counts(recs: DataFrame) -> DataFrame:
    """Products per recommended action, most common first."""
    return recs.groupBy("recommendation").agg(F.count(F.lit(1)).alias("products")) \
               .orderBy(F.col("products").desc(), "recommendation")


def impact_totals(recs: DataFrame) -> DataFrame:
    """Net expected profit and revenue impact."""
    g = recs.agg(portfolio_sum(F.col("expected_profit_impact")).alias("p"),
                 portfolio_sum(F.col("expected_revenue_impact")).alias("v"),
                 F.count(F.lit(1)).alias("products"))
    return g.select("products", F.col("p").alias("total_profit_impact"), F.col("v").alias("total_revenue_impact"))
