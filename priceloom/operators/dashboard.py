"""Data operators behind the dashboard pages (the widgets are not built)."""

from __future__ import annotations

import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from priceloom.functions.numerics import r, safe_div
from priceloom.operators.cleaning import GUEST_CUSTOMER
from priceloom.operators.metrics import dbl, facts, horizon, refacts
from priceloom.operators.reports import GUEST_SEGMENT, product_performance

# Weekday order of the day-of-week chart.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
KNOWN = "known"


def filter_sales(sales: DataFrame, products: DataFrame, customers: DataFrame,
                 start=None, end=None, categories: Sequence[str] | str | None = KNOWN,
                 regions: Sequence[str] | str | None = KNOWN,
                 segments: Sequence[str] | str | None = KNOWN) -> DataFrame:
    """Sales with category and customer segment attached, filtered by an
    inclusive date range and IN-lists.

    ``"known"`` is the dashboard default for each list: every category of
    the catalogue, every region seen in sales, every segment of the
    customer table.  So sales of unknown products, without a region, or of
    guests (segment ``Guest Shoppers``) drop out.  Known lists are semi-joins
    on distinct values -- nothing is collected.  ``None`` disables a filter.
    """
    for bound, within in ((start, operator.ge), (end, operator.le)):
        if bound is not None:
            sales = sales.filter(within(F.col("date"), F.lit(bound).cast("date")))
            if "year_month" in sales.columns:  # the partition column of the written sales: other months aren't read
                sales = sales.filter(within(F.col("year_month"), F.lit(str(bound)[:7])))
    s = sales.join(products.select("product_id", "category"), "product_id", "left")
    people = customers.select("customer_id", "customer_segment")
    if segments == KNOWN:
        # guests have no customer row: they go before the shuffle, where their key would be a hot one
        s = s.filter(F.col("customer_id") != GUEST_CUSTOMER).join(
            people.filter(F.col("customer_segment").isNotNull()), "customer_id")
    else:
        # guests never meet the join: their segment is known, and their key may be a third of all sales
        guests = F.coalesce(F.col("customer_id"), F.lit(GUEST_CUSTOMER)) == GUEST_CUSTOMER
        named = s.filter(~guests).join(people, "customer_id", "left").withColumn(
            "customer_segment", F.coalesce(F.col("customer_segment"), F.lit(GUEST_SEGMENT)))
        s = named.unionByName(s.filter(guests).withColumn("customer_segment", F.lit(GUEST_SEGMENT)))
    if categories == KNOWN:
        s = s.join(products.select("category").distinct(), "category", "left_semi")
    elif categories is not None:
        s = s.filter(F.col("category").isin(list(categories)))
    if regions == KNOWN:
        s = s.filter(F.col("region").isNotNull())
    elif regions is not None:
        s = s.filter(F.col("region").isin(list(regions)))
    if segments not in (KNOWN, None):
        s = s.filter(F.col("customer_segment").isin(list(segments)))
    return s


def filter_bounds(sales: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """The sidebar's bounds as (bound, value) rows, sorted: ``min_date``,
    ``max_date``, and a row for each ``category``, ``region`` and ``segment``.

    Sales are read once, grouped by region; the dates come from the groups.
    No list is gathered into a row, however many values there are."""
    per_region = sales.groupBy("region").agg(F.min("date").alias("first"), F.max("date").alias("last"))
    dates = per_region.agg(F.min("first").alias("min_date"), F.max("last").alias("max_date")).select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("bound"), F.col(c).cast("string").alias("value")) for c in ("min_date", "max_date")])))

    def options(df: DataFrame, c: str, bound: str) -> DataFrame:
        return df.select(F.lit(bound).alias("bound"), F.col(c).alias("value")).filter(F.col("value").isNotNull())
    lists = options(products, "category", "category").distinct().unionByName(
        options(customers, "customer_segment", "segment").distinct()).unionByName(options(per_region, "region", "region"))
    return dates.unionByName(lists).orderBy("bound", "value")


def seasonality_pivot(sales: DataFrame, products: DataFrame) -> DataFrame:
    """D3: category x calendar-month revenue index (each category's months
    divided by its mean over the months present, x100), one row per
    category, columns month_01..month_12 (NULL where a month is absent)."""
    if "category" in sales.columns:
        cm = facts(sales, ["category", "month"], ("rev",))
    else:
        per_prod = facts(sales, ["product_id", "month"], ("rev",))
        cm = refacts(per_prod.join(products.select("product_id", "category"), "product_id", "left"),
                     ["category", "month"], ("rev",))
    cm = cm.filter(F.col("category").isNotNull())
    per_cat = cm.groupBy("category").agg(F.sum("rev").alias("tot"), F.count(F.lit(1)).alias("k"))
    idx = cm.join(per_cat, "category").select(
        "category", "month",
        (safe_div(dbl("rev"), safe_div(dbl("tot"), dbl("k"))) * F.lit(100.0)).alias("idx"))
    wide = idx.groupBy("category").pivot("month", list(range(1, 13))).agg(F.first("idx"))
    return wide.select("category", *[F.col(str(m)).alias(f"month_{m:02d}") for m in range(1, 13)])


def weekday_ordered(sales: DataFrame) -> DataFrame:
    """Revenue and orders per weekday, Monday first; missing days NULL."""
    g = facts(sales, ["day_of_week"], ("n", "rev"))
    days = sales.sparkSession.range(len(WEEKDAYS)).select(
        (F.col("id") + 1).cast("int").alias("day_index"),
        F.element_at(F.array(*[F.lit(d) for d in WEEKDAYS]), (F.col("id") + 1).cast("int")).alias("day_of_week"))
    return days.join(g, "day_of_week", "left").select(
        "day_index", "day_of_week", dbl("rev").alias("revenue"), F.col("n").alias("orders")
    ).orderBy("day_index")


def inventory_turn_all_products(sales: DataFrame, products: DataFrame, months: int | Column = 24) -> DataFrame:
    """Every catalogue product with units sold (0 if none) and the
    monthly turn units / months / inventory (NULL on zero stock)."""
    u = facts(sales, ["product_id"], ("units",))
    j = products.select("product_id", "product_name", "category", "inventory_level") \
                .join(u, "product_id", "left")
    units = F.coalesce(F.col("units"), F.lit(0).cast("bigint"))
    return j.select(
        "product_id", "product_name", "category", "inventory_level",
        units.alias("total_units"),
        safe_div(units.cast("double") / horizon(months), F.col("inventory_level")).alias("monthly_turn"))


def opportunity_matrix(sales: DataFrame, products: DataFrame, recs: DataFrame) -> DataFrame:
    """Product performance with elasticity, action, quadrant, priority."""
    pp = product_performance(sales, products)
    rc = recs.select("product_id", "elasticity", "recommendation", "opportunity_quadrant", "priority")
    return pp.join(rc, "product_id", "left").withColumn("abs_elasticity", F.abs("elasticity"))


def top_n_products(perf: DataFrame, n: int = 10) -> DataFrame:
    """The n highest-revenue products (ties by product id)."""
    return perf.orderBy(F.col("total_revenue").desc(), "product_id").limit(n)


def spread_sorted(perf: DataFrame) -> DataFrame:
    """Unit dollar margin, widest first."""
    return perf.select("product_id", "product_name", "base_cost", "unit_dollar_margin") \
               .orderBy(F.col("unit_dollar_margin").desc(), "product_id")


def gap_sorted(matrix: DataFrame) -> DataFrame:
    """Premium versus competitor, lowest first."""
    return matrix.select("product_id", "product_name", "competitor_price_diff_pct") \
                 .orderBy(F.col("competitor_price_diff_pct").asc(), "product_id")


def filter_recommendations(recs: DataFrame, actions: Sequence[str] | None = None,
                           priorities: Sequence[str] | None = None) -> DataFrame:
    """Recommendations whose action and priority are both selected."""
    out = recs
    if actions is not None:
        out = out.filter(F.col("recommendation").isin(list(actions)))
    if priorities is not None:
        out = out.filter(F.col("priority").isin(list(priorities)))
    return out


def product_lookup(products: DataFrame, product_name: str) -> DataFrame:
    """The catalogue row of the first product (lowest id) with this name."""
    return products.filter(F.col("product_name") == product_name).orderBy("product_id").limit(1)


def scenario_bounds(products: DataFrame) -> DataFrame:
    """Simulator slider limits per product."""
    return products.select(
        "product_id", "product_name", "current_price", "base_cost", "competitor_price",
        r(F.col("base_cost") * F.lit(1.05)).alias("price_min"),
        r(F.col("current_price") * F.lit(1.5)).alias("price_max"),
        r(F.col("competitor_price") * F.lit(0.7)).alias("competitor_min"),
        r(F.col("competitor_price") * F.lit(1.3)).alias("competitor_max"))


def scenario_comparison(sim: DataFrame) -> DataFrame:
    """Baseline and proposed P&L of each scenario as two long rows."""
    rows = F.array(
        F.struct(F.lit("Current Baseline").alias("strategy"), F.col("current_revenue").alias("revenue"),
                 F.col("current_profit").alias("profit")),
        F.struct(F.lit("Proposed Dynamic Price").alias("strategy"), F.col("proposed_revenue").alias("revenue"),
                 F.col("proposed_profit").alias("profit")))
    return sim.select("scenario_id", "product_id", F.inline(rows))
