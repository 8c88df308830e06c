"""End-to-end cleaning job (C24): raw -> clean tables -> audit.

Each cleaned table is written and read back before the next stage uses it,
so later stages read compact Parquet instead of re-running the raw joins and
dedup, and a lost executor recomputes from the written files, not from the
raw inputs.  The sales audit counts are gathered by a ``DataFrame.observe``
attached to the sales write: no extra pass over the raw sales.

``CleaningJob`` holds the steps, each run once; ``run_pipeline`` runs them all,
``testdata_job`` each when a query first reads its table.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, Observation, SparkSession

from priceloom.operators import cleaning, quality
from priceloom.plans.tables import HistorySource, RetailTables, read_clean
from priceloom.session import freed_shuffles, scratch_path
from priceloom.sources import files, testdata


class CleaningJob:
    """The steps of the job, each run (with the steps it reads) when first
    asked for: a written table, read back.  ``raw_history`` is a raw
    pricing-history frame, or a function of (clean sales, clean products)
    that derives one."""

    def __init__(self, spark: SparkSession, raw: testdata.RawTables, raw_history: HistorySource, out_dir: str,
                 partition_sales: bool = True):
        self.spark, self.raw, self.history_source = spark, raw, raw_history
        self.base = out_dir.rstrip("/")
        self.partition_sales = partition_sales

    def _write(self, df: DataFrame, name: str, partition: str | None = None) -> DataFrame:
        w = df.write.mode("overwrite")
        if partition:
            w = w.partitionBy(partition)
        with freed_shuffles(self.spark):
            w.parquet(f"{self.base}/{name}")
        return self.spark.read.parquet(f"{self.base}/{name}")

    @cached_property
    def customers(self) -> DataFrame:
        return self._write(cleaning.clean_customers(self.raw.customers), "customers")

    @cached_property
    def products(self) -> DataFrame:
        return self._write(cleaning.clean_products(self.raw.products), "products")

    @cached_property
    def sales(self) -> DataFrame:
        # The rows go to their month before the columns that follow from others
        # are computed, so these aren't shuffled.  REBALANCE: hash by month, with
        # AQE splitting big months and merging small ones, so each task writes one
        # month folder (bounded file count) and no sampling pass re-runs the plan.
        imputed = cleaning.imputed_sales(self.raw.sales, self.products)
        if self.partition_sales:
            imputed = imputed.hint("rebalance", "year_month")
        # Audit counts are observed after the last shuffle, in the write's final
        # stage: Spark applies a result task's accumulator update once, so a
        # re-executed upstream stage (lost executor) cannot double-count.
        self._sales_stage = Observation("sales_stage")
        counts = [v.alias(k) for k, v in cleaning.sales_stage_metrics().items()]
        flagged = cleaning.recompute_sales(imputed).observe(self._sales_stage, *counts)
        sales = self._write(cleaning.finalize_sales(flagged), "sales", "year_month" if self.partition_sales else None)
        # Column order as cleaned (a partition column is appended on read).
        return sales.select(*cleaning.SALES_COLUMNS)

    def _raw_history(self) -> DataFrame:
        source = self.history_source
        return source(self.sales, self.products) if callable(source) else source

    @cached_property
    def raw_history(self) -> DataFrame:
        return self._write(self._raw_history(), "_raw_pricing_history")

    @cached_property
    def pricing_history(self) -> DataFrame:
        # Dealt by product, days of a product (its rows are few) lie together in
        # the written table: the dedup by day and product needs no other shuffle,
        # and a fit's moments are complete, or nearly, in the task that reads it.
        # A derived raw history is dealt so already, and isn't written in between.
        raw = self._raw_history()
        if not callable(self.history_source):
            raw = raw.repartition("product_id")
        return self._write(cleaning.clean_pricing_history(raw), "pricing_history")

    @cached_property
    def audit(self) -> DataFrame:
        """(table, metric, value, detail), read back from JSON."""
        sales, history = self.sales, self.pricing_history
        stage = self._sales_stage.get  # filled by the sales write
        sales_stage = self.spark.createDataFrame(
            [("sales", m, float(stage[m]), None) for m in cleaning.sales_stage_metrics()], quality.AUDIT_SCHEMA)
        audit = (quality.customers_audit(self.raw.customers)
                 .unionByName(quality.products_audit(self.raw.products, self.products))
                 .unionByName(sales_stage)
                 .unionByName(quality.sales_totals(sales))
                 .unionByName(quality.history_audit(self.raw_history, history)))
        files.write_audit(audit, f"{self.base}/_audit")
        return self.spark.read.schema(quality.AUDIT_SCHEMA).json(f"{self.base}/_audit")

    def run(self) -> DataFrame:
        """All steps, in order; the audit."""
        for table in (self.customers, self.products, self.sales, self.pricing_history, self.raw_history):
            assert table is not None
        return self.audit


def run_pipeline(spark: SparkSession, raw_customers: DataFrame, raw_products: DataFrame,
                 raw_sales: DataFrame, raw_history: HistorySource, out_dir: str,
                 partition_sales: bool = True) -> DataFrame:
    """Clean, write and audit: every step of the job.  Returns the audit
    (table, metric, value, detail) read back from JSON."""
    raw = testdata.RawTables(raw_customers, raw_products, raw_sales)
    return CleaningJob(spark, raw, raw_history, out_dir, partition_sales).run()


def read_tables(spark: SparkSession, out_dir: str, raw=None) -> RetailTables:
    """The clean tables a ``run_pipeline`` call wrote (S2), with its audit;
    ``raw`` (the raw inputs) is attached for the raw audit, with the written
    raw history.  Stages of the bundle are written beside the tables."""
    t = read_clean(spark, out_dir)
    t.raw = raw
    t.folder = out_dir.rstrip("/")
    t.raw_history = spark.read.parquet(f"{t.folder}/_raw_pricing_history")
    t.audit = spark.read.schema(quality.AUDIT_SCHEMA).json(f"{t.folder}/_audit")
    return t


def testdata_tables(spark: SparkSession, sf_dir: str) -> RetailTables:
    """The whole job over the test data: raw views, cleaning, written tables."""
    raw = testdata.raw_from_testdata(spark, sf_dir)
    out = scratch_path(spark, f"retail-{uuid.uuid4().hex[:12]}")
    run_pipeline(spark, raw.customers, raw.products, raw.sales, testdata.raw_pricing_history, out)
    return read_tables(spark, out, raw)


class JobTables(RetailTables):
    """The clean tables of a job, each written when a query first reads it: a
    query waits for the steps it reads, not for the others."""

    def __init__(self, job: CleaningJob):
        self.job, self.raw, self.folder = job, job.raw, job.base
        self._stages = {}

    spark = property(lambda self: self.job.spark)
    customers = property(lambda self: self.job.customers)
    products = property(lambda self: self.job.products)
    sales = property(lambda self: self.job.sales)
    pricing_history = property(lambda self: self.job.pricing_history)
    raw_history = property(lambda self: self.job.raw_history)
    audit = property(lambda self: self.job.audit)


def testdata_job(spark: SparkSession, sf_dir: str) -> JobTables:
    """The job over the test data, its steps run as queries read their tables."""
    raw = testdata.raw_from_testdata(spark, sf_dir)
    out = scratch_path(spark, f"retail-{uuid.uuid4().hex[:12]}")
    return JobTables(CleaningJob(spark, raw, testdata.raw_pricing_history, out))
