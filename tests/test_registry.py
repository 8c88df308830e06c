import pytest

from priceloom.plans import registry


def test_named_query_lookup(small_tables):
    df = registry.run_named_query(small_tables, "day_of_week_order_velocity")
    assert df.count() == 7 and df.columns[0] == "day_of_week"
    with pytest.raises(KeyError) as e:
        registry.run_named_query(small_tables, "no_such_report")
    assert "known:" in str(e.value)


def test_free_sql_over_clean_views(spark, small_tables):
    df = registry.run_sql(spark, small_tables,
                          "SELECT region, COUNT(*) AS n FROM sales GROUP BY region ORDER BY region;")
    assert df.count() == small_tables.sales.select("region").distinct().count()


def test_catalogue_covers_the_sql_suite():
    cat = registry.catalogue()
    assert len(registry.SQL_REPORTS) == 23  # 22 reports + the dedup variant of Q17
    assert all(name in cat for name in registry.SQL_REPORTS)
