"""Named-query catalogue: report name -> plan over the clean tables.

This replaces the application's "split a .sql file on ``-- NAME:``" loader:
each name maps to a function of the clean tables, and free SQL runs through
``spark.sql`` over the views ``RetailTables.register`` creates.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from priceloom.functions.numerics import r
from priceloom.operators import dashboard as db
from priceloom.operators import elasticity as el
from priceloom.operators import quality as ql
from priceloom.operators import reports as rp
from priceloom.operators import optimizer as op
from priceloom.operators import recommend as rc
from priceloom.operators import reports_sql as q
from priceloom.plans import round_trips as rt
from priceloom.plans.tables import RetailTables
from priceloom.sources import files

Query = Callable[[RetailTables], DataFrame]

SQL_REPORTS: dict[str, Query] = {
    "monthly_revenue_and_growth": lambda t: q.monthly_revenue_and_growth(t.sales),
    "monthly_profit_and_margin": lambda t: q.monthly_profit_and_margin(t.sales),
    "revenue_and_margin_by_category": lambda t: q.revenue_and_margin_by_category(t.by_product(), t.products),
    "regional_performance_ranking": lambda t: q.regional_performance_ranking(t.sales),
    "top_10_most_profitable_products": lambda t: q.top_10_most_profitable_products(t.by_product(), t.products),
    "bottom_10_underperforming_products": lambda t: q.bottom_10_underperforming_products(t.by_product(), t.products),
    "average_selling_price_vs_base_cost": lambda t: q.average_selling_price_vs_base_cost(t.by_product(), t.products),
    "discount_depth_impact_analysis": lambda t: q.discount_depth_impact_analysis(t.sales),
    "competitor_price_index_comparison": lambda t: q.competitor_price_index_comparison(t.products),
    "product_margin_bands_distribution": lambda t: q.product_margin_bands_distribution(t.by_product(), t.products),
    "customer_segment_revenue_and_aov": lambda t: q.customer_segment_revenue_and_aov(t.by_customer(), t.customers),
    "repeat_vs_one_time_customers": lambda t: q.repeat_vs_one_time_customers(t.by_customer()),
    "monthly_category_demand_seasonality": lambda t: q.monthly_category_demand_seasonality(t.sales, t.products),
    "price_change_demand_response": lambda t: q.price_change_demand_response(t.pricing_history),
    "quarterly_revenue_and_running_totals": lambda t: q.quarterly_revenue_and_running_totals(t.sales),
    "product_revenue_rank_within_category": lambda t: t.stage(
        "rank_within_category", lambda: q.product_revenue_rank_within_category(t.by_product(), t.products, ordered=False)
    ).orderBy("category", "rank_in_category"),
    "customer_lifetime_value_by_channel": lambda t: q.customer_lifetime_value_by_channel(t.customers, t.by_customer()),
    "clv_by_channel_dedup": lambda t: q.clv_by_channel_dedup(t.customers, t.by_customer()),
    "inventory_turnover_velocity_proxy": lambda t: q.inventory_turnover_velocity_proxy(t.by_product(), t.products, t.months()),
    "regional_pricing_and_discount_disparities":
        lambda t: q.regional_pricing_and_discount_disparities(t.sales, t.products),
    "immediate_pricing_opportunity_candidates":
        lambda t: q.immediate_pricing_opportunity_candidates(t.by_product(), t.products),
    "day_of_week_order_velocity": lambda t: q.day_of_week_order_velocity(t.sales),
    "pareto_product_revenue_distribution": lambda t: t.stage(
        "pareto", lambda: q.pareto_product_revenue_distribution(t.by_product(), t.products, ordered=False)
    ).orderBy(F.col("total_product_revenue").desc(), "product_id"),
}

# The model chain is fitted once per table bundle and materialised; every
# report downstream reads the written fits / optima / recommendations.
def _fits(t: RetailTables) -> DataFrame:
    return t.stage("product_fits", lambda: el.product_elasticity(t.pricing_history, t.products))


def _opt(t: RetailTables) -> DataFrame:
    return t.stage("optimal_prices", lambda: op.optimal_prices(_fits(t), t.by_product(), t.months()))


def _recs(t: RetailTables) -> DataFrame:
    return t.stage("recommendations", lambda: rc.recommendations(_opt(t), t.products, _fits(t), t.by_product(), t.months()))


def _features(t: RetailTables) -> DataFrame:
    # JVM and C logarithms may differ in the last bit; the published feature
    # view carries 9 decimals (the regression uses the unrounded values).
    f = el.elasticity_features(t.pricing_history, t.products)
    return f.select("date", "product_id", "product_name", "category", "base_cost", "current_price", "price", "quantity_sold", "competitor_price", "month",
                    "year_month", r("x1", 9).alias("ln_price"), r("x2", 9).alias("ln_comp_price"),
                    r("y", 9).alias("ln_quantity"))


MODEL: dict[str, Query] = {
    "elasticity_features": _features,
    "singular_fits": lambda t: rt.singular_fits(t),
    "annual_volumes": lambda t: op.annual_volumes(t.by_product(), t.months()),
    "product_elasticity": lambda t: _fits(t).orderBy("elasticity", "product_id"),
    "category_elasticity": lambda t: el.category_elasticity(t.pricing_history, t.products),
    "elasticity_fit_summary": lambda t: el.fit_summary(_fits(t)),
    "elasticity_ci_widths": lambda t: el.ci_widths(_fits(t)),
    "price_curve": lambda t: op.price_curve(_fits(t), t.by_product(), months=t.months()),
    "optimal_prices": lambda t: _opt(t).orderBy("product_id"),
    "optimization_summary": lambda t: op.optimization_summary(_opt(t)),
    "top_profit_opportunities": lambda t: op.top_profit_opportunities(_opt(t)),
    "simulate_scenarios": lambda t: _uplift(t),
    "recommendations": lambda t: _recs(t).orderBy(F.col("expected_profit_impact").desc(), "product_id"),
    "action_counts": lambda t: rc.action_counts(_recs(t)),
    "impact_totals": lambda t: rc.impact_totals(_recs(t)),
}

# The test data spans 1995-2001; the two latest complete years stand in for
# the application's 2024 / 2025 comparison.
KPI_YEARS = (1999, 2000)
SLICE = {"start": "1996-01-01", "end": "2000-12-31"}
LOOKUP_NAME = "blue bolt"


def _slice(t: RetailTables) -> DataFrame:
    return db.filter_sales(t.sales, t.products, t.customers, **SLICE)


def _uplift(t: RetailTables) -> DataFrame:
    fits = _fits(t)
    return op.simulate_scenarios(op.uplift_scenarios(fits), fits, t.by_product(), t.months())


DATAFRAME_REPORTS: dict[str, Query] = {
    "executive_kpis": lambda t: rp.executive_kpis(t.sales, *KPI_YEARS),
    "monthly_trends": lambda t: rp.monthly_trends(t.sales),
    "category_summary": lambda t: rp.category_summary(t.sales, t.products),
    "category_summary_filtered": lambda t: rp.category_summary(_slice(t), t.products),
    "regional_breakdown": lambda t: rp.regional_breakdown(t.sales),
    "customer_segment_analysis": lambda t: rp.customer_segment_analysis(t.sales, t.customers),
    "customer_segment_analysis_filtered": lambda t: rp.customer_segment_analysis(_slice(t), t.customers),
    "product_performance": lambda t: rp.product_performance(t.by_product(), t.products),
    "discount_impact": lambda t: rp.discount_impact(t.sales),
}

DASHBOARD: dict[str, Query] = {
    "filter_sales": _slice,
    "filter_bounds": lambda t: db.filter_bounds(t.sales, t.products, t.customers),
    "seasonality_pivot": lambda t: db.seasonality_pivot(t.sales, t.products),
    "weekday_ordered": lambda t: db.weekday_ordered(t.sales),
    "inventory_turn_all_products": lambda t: db.inventory_turn_all_products(t.by_product(), t.products, t.months()),
    "opportunity_matrix": lambda t: db.opportunity_matrix(t.by_product(), t.products, _recs(t)),
    "top_n_products": lambda t: db.top_n_products(rp.product_performance(t.by_product(), t.products)),
    "spread_sorted": lambda t: db.spread_sorted(rp.product_performance(t.by_product(), t.products)),
    "gap_sorted": lambda t: db.gap_sorted(db.opportunity_matrix(t.by_product(), t.products, _recs(t))),
    "filter_recommendations": lambda t: db.filter_recommendations(_recs(t), ["Increase Price"], ["High"]),
    "product_lookup": lambda t: db.product_lookup(t.products, LOOKUP_NAME),
    "scenario_bounds": lambda t: db.scenario_bounds(t.products),
    "scenario_comparison": lambda t: db.scenario_comparison(_uplift(t)),
}

QUALITY: dict[str, Query] = {
    # the cleaning job's own counts where it has run, else counted anew
    "cleaning_audit": lambda t: t.audit if t.audit is not None else ql.cleaning_audit(
        t.raw.customers, t.raw.products, t.raw.sales, t.raw_history, t),
    "raw_audit": lambda t: ql.raw_audit(t.raw.sales),
    "validate_clean": lambda t: ql.validate_clean(t.sales, t.products),
    "table_nonempty": lambda t: ql.table_nonempty(t),
}

FILES: dict[str, Query] = {
    "sales_from_csv": rt.sales_from_csv,
    "saved_tables_sql": rt.saved_tables,
    "recommendations_export": lambda t: rt.exported(t, "recommendations_export", _recs(t)),
    "preview_products": lambda t: files.preview(t.products),
    "duplicate_counts": rt.duplicate_counts,
    "free_sql_weekday_regions": lambda t: run_sql(t.spark, t, FREE_SQL),
}

#: What a user of the SQL page may type.
FREE_SQL = """
SELECT day_of_week, region, COUNT(*) AS orders, MAX(quantity) AS largest_quantity
FROM sales GROUP BY day_of_week, region ORDER BY day_of_week, region;
"""

CLEAN_TABLES: dict[str, Query] = {
    "clean_customers": lambda t: t.customers,
    "clean_products": lambda t: t.products,
    "clean_sales": lambda t: t.sales,
    "clean_pricing_history": lambda t: t.pricing_history,
}


def catalogue() -> dict[str, Query]:
    out: dict[str, Query] = {}
    out.update(CLEAN_TABLES)
    out.update(SQL_REPORTS)
    out.update(MODEL)
    out.update(DATAFRAME_REPORTS)
    out.update(DASHBOARD)
    out.update(QUALITY)
    out.update(FILES)
    return out


def run_named_query(tables: RetailTables, name: str) -> DataFrame:
    """Look a report up by name (KeyError lists the known names)."""
    cat = catalogue()
    if name not in cat:
        raise KeyError(f"unknown query {name!r}; known: {sorted(cat)}")
    return cat[name](tables)


def run_sql(spark: SparkSession, tables: RetailTables, text: str) -> DataFrame:
    """Free SQL over the clean tables (trailing ``;`` tolerated)."""
    tables.register()
    return spark.sql(text.strip().rstrip(";"))
