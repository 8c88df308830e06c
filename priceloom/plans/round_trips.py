"""Sources and sinks as queries: what is written is read back and used.

Each is a stage of the bundle, so its files lie in the bundle's folder and a
repeated call reads the result written first.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from priceloom.functions.numerics import r
from priceloom.operators import cleaning
from priceloom.operators import elasticity as el
from priceloom.plans.tables import RetailTables
from priceloom.session import materialize, scratch_path, setting
from priceloom.sources import files, testdata

SAVED_SQL = """
SELECT s.region, p.category, COUNT(*) AS orders, CAST(SUM(s.quantity) AS BIGINT) AS units,
       CAST(SUM(CAST(s.revenue AS DECIMAL(18, 2))) AS DOUBLE) AS revenue
FROM {prefix}sales s JOIN {prefix}products p ON s.product_id = p.product_id
GROUP BY s.region, p.category
"""


# A task's share of the compressed files, by which they are packed: its rows are
# sorted for the dedup, about ten times as large in memory.
CSV_TASK_BYTES = "32m"


def _in_ingest_order(raw: testdata.RawTables) -> DataFrame:
    """The raw sales sorted by ingest order; where they are a view of rows,
    these are sorted, by the columns that the order consists of."""
    if raw.sales_rows is None:
        return raw.sales.orderBy(cleaning.INGEST_ORDER)
    return testdata.sales_view(raw.sales_rows.orderBy(*testdata.LINEITEM_ORDER))


def sales_from_csv(t: RetailTables) -> DataFrame:
    """The raw sales exported as CSV in ingest order, read with
    the raw schema (all text) and cleaned."""
    def build() -> DataFrame:
        spark = t.spark
        folder = scratch_path(spark, "raw-sales-csv")
        files.export_csv(_in_ingest_order(t.raw).drop(*cleaning.SOURCE_COLUMNS), folder, compression="gzip")
        products = t.products.withColumn("product_id", F.col("product_id").cast("string"))
        clean = cleaning.clean_sales(files.read_raw_csv(spark, folder, "sales"), products, distinct_order=True)
        return clean.withColumn("product_id", F.col("product_id").cast(t.raw.sales.schema["product_id"].dataType))
    with setting(t.spark, "spark.sql.files.maxPartitionBytes", CSV_TASK_BYTES):
        return t.stage("sales_from_csv", build)


def saved_tables(t: RetailTables) -> DataFrame:
    """The clean tables saved to the catalogue, and free SQL over them.
    The entries go again; the files go with the bundle's folder."""
    def build() -> DataFrame:
        spark = t.spark
        prefix = f"retail_{uuid.uuid4().hex[:8]}_"
        files.write_tables(t, prefix=prefix, location=scratch_path(spark, "saved"))
        try:
            return materialize(spark.sql(SAVED_SQL.format(prefix=prefix)), "saved-sql")
        finally:
            for name in files.CLEAN_NAMES:
                spark.sql(f"DROP TABLE {prefix}{name}")
    return t.stage("saved_tables_sql", build)


def exported(t: RetailTables, key: str, report: DataFrame) -> DataFrame:
    """A report exported as CSV with a header, and read back by its types."""
    def build() -> DataFrame:
        spark = t.spark
        folder = scratch_path(spark, f"{key}-csv")
        files.export_csv(report, folder)
        return spark.read.schema(report.schema).option("header", True).csv(folder)
    return t.stage(key, build)


def duplicate_counts(t: RetailTables) -> DataFrame:
    """Rows beyond the first of each key, per raw table."""
    keyed = [("customers", t.raw.customers, ["customer_id"]), ("sales", t.raw.sales, ["transaction_id"]),
             ("pricing_history", t.raw_history, ["date", "product_id"])]
    out = None
    for name, raw, key in keyed:
        n = cleaning.duplicate_count(raw, key).select(F.lit(name).alias("table"), "duplicates")
        out = n if out is None else out.unionByName(n)
    return out


def singular_fits(t: RetailTables, min_obs: int = 30) -> DataFrame:
    """E2 where no group has a unique answer: the competitor's price of the
    catalogue in place of its history is constant for a product, so every fit
    is the one of least norm.  The intercept and the cross coefficient share
    what one of them would explain."""
    catalogue = t.products.select("product_id", F.col("competitor_price").alias("listed"))
    history = t.pricing_history.join(catalogue, "product_id").drop("competitor_price").withColumnRenamed("listed", "competitor_price")
    fits = el.ols_by_group(el.log_features(history), ["product_id"], min_obs)
    return fits.select("product_id", F.col("n").alias("observations"), r("b1", 4).alias("elasticity"), r("b2", 4).alias("cross"),
                       r("b3", 4).alias("trend"), r("b0", 4).alias("intercept"), r("se1", 4).alias("std_error"),
                       r("r2", 4).alias("r_squared"), "fit_status")
