"""File sources and sinks.

Raw CSVs are read with explicit schemas -- never inferred -- and every
column that may hold malformed numbers is read as text, so the cleaning step
decides (``try_cast``) instead of the reader failing or guessing.  Each raw
row carries its ingest order (file, block, position) for keep-first dedup.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from priceloom.operators.cleaning import INGEST_ORDER
from priceloom.session import freed_shuffles

_S, _D = T.StringType(), T.DoubleType()

RAW_SCHEMAS: dict[str, T.StructType] = {
    "customers": T.StructType([
        T.StructField("customer_id", _S), T.StructField("customer_segment", _S),
        T.StructField("age_group", _S), T.StructField("region", _S),
        T.StructField("acquisition_channel", _S), T.StructField("customer_lifetime_value", _S)]),
    "products": T.StructType([
        T.StructField("product_id", _S), T.StructField("product_name", _S), T.StructField("category", _S),
        T.StructField("subcategory", _S), T.StructField("base_cost", _S), T.StructField("current_price", _S),
        T.StructField("competitor_price", _S), T.StructField("inventory_level", _S),
        T.StructField("seasonality_factor", _S), T.StructField("true_elasticity", _S),
        T.StructField("cross_elasticity", _S)]),
    "sales": T.StructType([
        T.StructField("transaction_id", _S), T.StructField("date", _S), T.StructField("product_id", _S),
        T.StructField("customer_id", _S), T.StructField("region", _S), T.StructField("quantity", _S),
        T.StructField("unit_price", _S), T.StructField("discount", _S), T.StructField("revenue", _S),
        T.StructField("cost", _S), T.StructField("profit", _S), T.StructField("competitor_price", _S),
        T.StructField("inventory_level", _S)]),
    "pricing_history": T.StructType([
        T.StructField("date", _S), T.StructField("product_id", _S), T.StructField("price", _S),
        T.StructField("quantity_sold", _S), T.StructField("competitor_price", _S), T.StructField("revenue", _S)]),
}

RAW_FILES = {"customers": "customers.csv", "products": "products.csv", "sales": "sales.csv",
             "pricing_history": "pricing_history.csv"}
CLEAN_NAMES = ("customers", "products", "sales", "pricing_history")


def read_raw_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """One raw CSV with header, explicit schema, plus ``_ingest_order``."""
    df = spark.read.schema(RAW_SCHEMAS[table]).option("header", True).option("mode", "PERMISSIVE") \
        .option("nullValue", "").csv(path)
    order = F.struct(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"),
                     F.monotonically_increasing_id().alias("i"))
    return df.withColumn(INGEST_ORDER, order)


def read_raw_dir(spark: SparkSession, raw_dir: str) -> dict[str, DataFrame]:
    """The four raw CSVs of a folder."""
    base = raw_dir.rstrip("/")
    return {t: read_raw_csv(spark, f"{base}/{f}", t) for t, f in RAW_FILES.items()}


def write_clean(tables, out_dir: str, partition_sales: bool = True, fmt: str = "parquet") -> None:
    """S3: overwrite the four clean tables; sales partitioned by year_month
    so month-range reports prune partitions."""
    base = out_dir.rstrip("/")
    for name in CLEAN_NAMES:
        df = getattr(tables, name)
        if name == "sales" and partition_sales:
            df = df.hint("rebalance", "year_month")
        w = df.write.mode("overwrite").format(fmt)
        if name == "sales" and partition_sales:
            w = w.partitionBy("year_month")
        w.save(f"{base}/{name}")


def write_tables(tables, database: str | None = None, prefix: str = "", location: str | None = None) -> None:
    """Replace the four tables in the session catalogue; their files go
    to the warehouse, or to ``location``."""
    for name in CLEAN_NAMES:
        full = f"{database}.{prefix}{name}" if database else f"{prefix}{name}"
        out = getattr(tables, name).write.mode("overwrite")
        if location is not None:
            out = out.option("path", f"{location.rstrip('/')}/{prefix}{name}")
        out.saveAsTable(full)


def write_audit(audit: DataFrame, path: str) -> None:
    """The audit rows (a few dozen) as JSON lines in one file."""
    audit.coalesce(1).write.mode("overwrite").json(path)


def export_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    """A report as CSV with a header row; of a compressed one each file
    is read by one task."""
    with freed_shuffles(df.sparkSession):
        df.write.mode("overwrite").option("header", True).option("compression", compression) \
            .option("zlib.compress.level", "BEST_SPEED").csv(path)


def preview(df: DataFrame, n: int = 200, order_by: list[str] | None = None) -> DataFrame:
    """The first ``n`` rows, ordered by a key, or else by all columns, for
    a stable answer."""
    return df.orderBy(*(order_by or df.columns)).limit(n)
