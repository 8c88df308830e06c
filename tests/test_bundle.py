"""The bundle of clean tables: the cleaning job behind it, stages, horizon, files."""

import datetime
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from priceloom.operators import elasticity as EL
from priceloom.operators import metrics, optimizer
from priceloom.plans import pipeline, registry
from priceloom.session import fingerprint, scratch_path
from priceloom.sources import files


@pytest.fixture(scope="module")
def bundle(spark):
    t = pipeline.testdata_tables(spark, SF_SMALL)
    yield t
    t.close()


def test_reports_read_stages_written_once(spark, bundle):
    names = ["product_revenue_rank_within_category", "pareto_product_revenue_distribution", "recommendations", "sales_from_csv", "saved_tables_sql"]
    first = {n: sorted(map(tuple, registry.run_named_query(bundle, n).collect())) for n in names}
    outside = set(os.listdir(scratch_path(spark, "")))
    inside = set(os.listdir(bundle.folder))
    assert first == {n: sorted(map(tuple, registry.run_named_query(bundle, n).collect())) for n in names}
    assert set(os.listdir(bundle.folder)) == inside and set(os.listdir(scratch_path(spark, ""))) == outside


def test_close_deletes_the_bundles_folder(spark):
    t = pipeline.testdata_tables(spark, SF_SMALL)
    folder = t.folder
    t.by_product().count()
    assert os.path.isdir(folder) and any(f.startswith("sales_by_product") for f in os.listdir(folder))
    t.close()
    assert not os.path.exists(folder)


def test_lazy_bundle_has_a_folder_of_its_own(spark, small_tables):
    small_tables.by_customer().count()
    folder = small_tables.folder
    assert os.path.dirname(folder) == scratch_path(spark, "").rstrip("/") and os.listdir(folder)


def test_ledger_totals_are_those_of_the_sales(small_tables):
    t = small_tables
    keys = ["product_id"]
    want = {r.product_id: r for r in metrics.facts(t.sales, keys).collect()}
    got = {r.product_id: r for r in metrics.facts(t.by_product(), keys).collect()}
    assert len(want) == len(got) and all(tuple(want[k]) == tuple(got[k]) for k in want)


def test_audit_is_the_jobs_own(bundle, small_tables):
    as_rows = lambda t: sorted(map(str, registry.run_named_query(t, "cleaning_audit").collect()))
    assert bundle.audit is not None and small_tables.audit is None
    assert as_rows(bundle) == as_rows(small_tables)


@pytest.mark.parametrize("dates, months", [(["2024-01-31"], 1), (["2023-12-31", "2024-01-01"], 2), (["2024-03-01", "2025-02-28", None], 12),
                                           (["1995-01-07", "2001-08-01"], 80)])
def test_horizon_counts_calendar_months(spark, dates, months):
    sales = spark.createDataFrame([(datetime.date.fromisoformat(d) if d else None, 1, f"T{k}", 6) for k, d in enumerate(dates)],
                                  "date date, product_id int, transaction_id string, quantity bigint")
    span = metrics.span_months(sales)
    assert span.collect()[0].months == months
    units = 6 * len(dates)
    assert optimizer.annual_volumes(sales, span.scalar()).collect()[0].annual_units == units * 12.0 / months
    assert optimizer.annual_volumes(sales).collect()[0].annual_units == units / 2.0


def test_empty_sales_have_no_horizon(spark):
    empty = spark.createDataFrame([], "date date, product_id int, transaction_id string, quantity bigint")
    assert metrics.span_months(empty).collect()[0].months is None


def test_changed_data_has_another_fingerprint(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.range(5).write.parquet(path)
    before = fingerprint(spark, [path])
    assert before == fingerprint(spark, [path])
    spark.range(7).write.mode("append").parquet(path)
    assert before != fingerprint(spark, [path])


def test_preview_is_ordered_by_all_columns(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("b", 0), ("a", 2)], "k string, v int").repartition(3)
    assert [tuple(r) for r in files.preview(df, 3).collect()] == [("a", 1), ("a", 2), ("a", 3)]


def _singular_panels(n_groups, rng):
    """Groups whose regressors do not determine a fit, in four ways."""
    rows = []
    for g in range(n_groups):
        n = int(rng.integers(6, 12))
        x1, x2, x3 = rng.normal(3, 1, n), rng.normal(2, 1, n), rng.integers(1, 13, n).astype(float)
        kind = g % 4
        if kind == 0:
            x2[:] = x2[0]
        elif kind == 1:
            x1[:] = x1[0]
        elif kind == 2:
            x3[:] = 5.0
        else:
            x1[:], x3[:] = x1[0], 2.0
        y = 1 - 1.5 * x1 + 0.4 * x2 + 0.01 * x3 + rng.normal(0, 0.1, n)
        rows.append((x1, x2, x3, y))
    return rows


def test_ten_thousand_singular_groups_in_one_batch():
    rng = np.random.default_rng(4)
    panels = _singular_panels(10_000, rng)
    xs = ("x1", "x2", "x3")
    cols = {"n": [len(p[0]) for p in panels]}
    for i, a in enumerate((*xs, "y")):
        cols[f"m_{a}"] = [p[i].mean() for p in panels]
    at = {"x1": 0, "x2": 1, "x3": 2, "y": 3}
    for a, b in EL.PAIRS:
        cols[f"s_{a}_{b}"] = [np.mean((p[at[a]] - p[at[a]].mean()) * (p[at[b]] - p[at[b]].mean())) for p in panels]
    got = EL._min_norm({k: np.array(v, float) for k, v in cols.items()})
    for g in range(0, 10_000, 97):
        x1, x2, x3, y = panels[g]
        design = np.column_stack([np.ones_like(x1), x1, x2, x3])
        beta = np.linalg.pinv(design) @ y
        left = float(((y - design @ beta) ** 2).sum())
        se = np.sqrt(np.diag(np.linalg.pinv(design.T @ design, rcond=1e-12)) * left / max(1, len(y) - 4))
        assert np.allclose([got[f"b{k}"][g] for k in range(4)], beta, atol=1e-7)
        assert np.allclose([got["se1"][g], got["se2"][g]], se[1:3], atol=1e-6)
        assert abs(got["r2"][g] - (1 - left / float(((y - y.mean()) ** 2).sum()))) < 1e-7


def test_singular_groups_next_to_regular_ones(spark):
    rng = np.random.default_rng(6)
    rows = []
    for g in range(12):
        for _ in range(40):
            price, comp, month = float(rng.uniform(5, 20)), 9.0 if g % 3 == 0 else float(rng.uniform(5, 20)), int(rng.integers(1, 13))
            rows.append((g, datetime.date(2024, month, 3), price, comp, int(50_000 * price ** -1.4 * comp ** 0.3)))
    rows += [(99, datetime.date(2024, 1, 3), None, None, 5)] * 40
    history = spark.createDataFrame(rows, "product_id int, date date, price double, competitor_price double, quantity_sold bigint")
    fits = {r.product_id: r for r in EL.ols_by_group(EL.log_features(history), ["product_id"], 30).collect()}
    assert {g for g, r in fits.items() if r.fit_status == "min_norm"} >= {0, 3, 6, 9}
    assert all(abs(fits[g].b1 + 1.4) < 0.01 for g in range(12))
    assert fits[99].b1 is None


def test_optimum_is_the_curves_best_row(small_tables):
    """Picked inside the product's row, as from the exploded curve."""
    t = small_tables
    fits = t.stage("product_fits", lambda: EL.product_elasticity(t.pricing_history, t.products))
    curve = {}
    for r in optimizer.price_curve(fits, t.by_product(), months=t.months()).collect():
        curve.setdefault(r.product_id, []).append(r)
    got = optimizer.optimal_prices(fits, t.by_product(), t.months()).collect()
    assert len(got) == len(curve) > 0
    for o in got:
        rows = sorted(curve[o.product_id], key=lambda r: r.grid_idx)
        best = max(rows, key=lambda r: (r.expected_profit, -r.grid_idx))
        top = max(rows, key=lambda r: (r.expected_revenue, -r.grid_idx))
        now = min(rows, key=lambda r: (abs(r.candidate_price - o.current_price), r.grid_idx))
        assert (o.profit_max_price, o.profit_max_expected_profit) == (best.candidate_price, best.expected_profit)
        assert (o.rev_max_price, o.current_annual_profit) == (top.candidate_price, now.expected_profit)


def test_optimal_prices_need_no_shuffle_of_the_curve(small_tables):
    t = small_tables
    fits = t.stage("product_fits", lambda: EL.product_elasticity(t.pricing_history, t.products))
    plan = optimizer.optimal_prices(fits, t.by_product(), t.months())._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and plan.count("Join") == 1


def test_product_fits_read_the_history_without_the_catalogue(bundle):
    moments = EL.group_moments(EL.log_features(bundle.pricing_history), ["product_id"])
    plan = moments._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("Relation") == 1


def test_validation_shuffles_keys_only(bundle):
    from priceloom.operators import quality
    plan = quality.validate_clean(bundle.sales, bundle.products)._jdf.queryExecution().optimizedPlan().toString()
    grouped = [line for line in plan.splitlines() if "Aggregate [transaction_id" in line]
    assert grouped and all("revenue" not in line and "customer_id" not in line for line in grouped)


def test_counts_beyond_int_are_kept(spark):
    from priceloom.operators import cleaning as C
    products = spark.createDataFrame([("P1", "a", "b", "1", "2", "3", "3000000000"), ("P2", "a", "b", "1", "2", "3", "nan"),
                                      ("P3", "a", "b", "1", "2", "3", "1e30"), ("P4", "a", "b", "1", "2", "3", None)],
                                     "product_id string, product_name string, category string, base_cost string, current_price string, "
                                     "competitor_price string, inventory_level string")
    got = {r.product_id: r.inventory_level for r in C.clean_products(products).collect()}
    assert got == {"P1": 3_000_000_000, "P2": 0, "P3": 0, "P4": 0}
    history = spark.createDataFrame([("2024-01-05", "P1", "1", "4e9", "1", "1"), ("2024-01-06", "P1", "1", "NaN", "1", "1")],
                                    "date string, product_id string, price string, quantity_sold string, competitor_price string, revenue string")
    assert sorted(r.quantity_sold for r in C.clean_pricing_history(history).collect()) == [0, 4_000_000_000]


def test_filter_bounds_rows(spark, small_tables):
    from priceloom.operators import dashboard as D
    t = small_tables
    got = [tuple(r) for r in D.filter_bounds(t.sales, t.products, t.customers).collect()]
    assert got == sorted(got) and {b for b, _ in got} == {"min_date", "max_date", "category", "region", "segment"}
    empty = D.filter_bounds(t.sales.limit(0), t.products.limit(0), t.customers.limit(0)).collect()
    assert [tuple(r) for r in empty] == [("max_date", None), ("min_date", None)]


def test_guests_do_not_meet_the_customer_join(spark):
    from priceloom.operators import dashboard as D
    sales = spark.range(1000).select(
        F.concat(F.lit("T"), "id").alias("transaction_id"), (F.col("id") % 5).alias("product_id"),
        F.when(F.col("id") % 5 < 2, "CUST-GUEST").when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("C"), F.col("id") % 70)).alias("customer_id"),
        F.lit("North").alias("region"), F.lit("2000-01-01").cast("date").alias("date"))
    products = spark.range(5).select(F.col("id").alias("product_id"), F.lit("Cat").alias("category"))
    customers = spark.range(60).select(F.concat(F.lit("C"), "id").alias("customer_id"), F.lit("Seg").alias("customer_segment"))
    out = D.filter_sales(sales, products, customers, segments=None)
    want = {}
    for r in sales.collect():
        key = "Seg" if r.customer_id and r.customer_id != "CUST-GUEST" and int(r.customer_id[1:]) < 60 else "Guest Shoppers"
        want[key] = want.get(key, 0) + 1
    assert {r.customer_segment: r["count"] for r in out.groupBy("customer_segment").count().collect()} == want
    lines = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
    joined = next(i for i, line in enumerate(lines) if "Join LeftOuter" in line and "customer_id" in line)
    assert any("CUST-GUEST" in line and "Filter" in line and "NOT" in line for line in lines[joined + 1:])


def test_date_range_reads_its_months_only(bundle):
    import re
    from priceloom.operators import dashboard as D
    t = bundle
    for bounds in ({"start": "1996-03-05", "end": "1996-05-20"}, {"start": datetime.date(1999, 12, 31)}, {"end": "1995-02-01"}, {}):
        out = D.filter_sales(t.sales, t.products, t.customers, **bounds, categories=None, regions=None, segments=None)
        want = t.sales
        if "start" in bounds:
            want = want.filter(F.col("date") >= F.lit(str(bounds["start"])).cast("date"))
        if "end" in bounds:
            want = want.filter(F.col("date") <= F.lit(str(bounds["end"])).cast("date"))
        assert sorted(r.transaction_id for r in out.collect()) == sorted(r.transaction_id for r in want.collect())
        filters = re.findall(r"PartitionFilters: \[(.*?)\]", out._jdf.queryExecution().executedPlan().toString())
        assert any("year_month" in f for f in filters) == bool(bounds)


def test_days_of_a_product_are_written_together(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        t = pipeline.testdata_tables(spark, SF_SMALL)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    where = t.pricing_history.select("product_id", F.input_file_name().alias("file")).distinct()
    assert where.select("file").distinct().count() > 1
    assert where.groupBy("product_id").count().agg(F.max("count")).collect()[0][0] == 1
    t.close()


def test_a_query_waits_for_the_steps_it_reads(spark):
    """The CSV round trip reads the raw sales and the catalogue, not the clean sales, and the gaps no audit."""
    t = pipeline.testdata_job(spark, SF_SMALL)
    try:
        got = sorted(map(tuple, registry.run_named_query(t, "sales_from_csv").collect()))
        assert {f for f in os.listdir(t.folder) if f in ("customers", "products", "sales", "pricing_history", "_audit")} == {"products"}
        assert registry.run_named_query(t, "gap_sorted").count() > 0
        assert not {"customers", "_audit", "_raw_pricing_history"} & set(os.listdir(t.folder))
        assert {"sales", "pricing_history"} <= set(os.listdir(t.folder))
        assert got == sorted(map(tuple, t.sales.collect()))
        assert t.audit.count() > 0 and {"_audit", "_raw_pricing_history"} <= set(os.listdir(t.folder))
        counts = {r.metric: r.value for r in t.audit.filter("table = 'pricing_history'").collect()}
        assert counts == {"initial_rows": t.raw_history.count(), "final_rows": t.pricing_history.count()}
    finally:
        t.close()
    assert not os.path.exists(t.job.base)
