"""The four clean retail tables as one bundle."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession

from priceloom.operators import cleaning, metrics
from priceloom.session import delete_folder, materialize, scratch_path, stages_in
from priceloom.sources import testdata

NAMES = ("customers", "products", "sales", "pricing_history")

#: A raw pricing history, or a function of (clean sales, clean products) that derives one.
HistorySource = DataFrame | Callable[[DataFrame, DataFrame], DataFrame]


@dataclass
class RetailTables:
    customers: DataFrame
    products: DataFrame
    sales: DataFrame
    pricing_history: DataFrame
    raw: testdata.RawTables | None = field(default=None, repr=False)
    raw_history: DataFrame | None = field(default=None, repr=False)
    audit: DataFrame | None = field(default=None, repr=False)
    folder: str | None = None
    _stages: dict = field(default_factory=dict, repr=False)

    @property
    def spark(self) -> SparkSession:
        return self.sales.sparkSession

    def stage(self, key: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A derived table computed once per bundle and materialised (ledgers,
        model fits, optimal prices, rankings): every report that needs it
        reads the written result instead of re-deriving it.  The table, and
        whatever its building writes, lies in the bundle's folder."""
        if key not in self._stages:
            if self.folder is None:
                self.folder = scratch_path(self.spark, f"retail-{uuid.uuid4().hex[:12]}")
            with stages_in(self.folder):
                self._stages[key] = materialize(build(), key)
        return self._stages[key]

    def by_product(self) -> DataFrame:
        """The sales measures of each product, summed once for all reports."""
        return self.stage("sales_by_product", lambda: metrics.facts(self.sales, ["product_id"]))

    def by_customer(self) -> DataFrame:
        """The sales measures of each customer, guests as one."""
        return self.stage("sales_by_customer", lambda: metrics.facts(self.sales, ["customer_id"]))

    def months(self) -> Column:
        """The span of the sales in months (a scalar)."""
        return self.stage("span", lambda: metrics.span_months(self.sales)).scalar()

    def close(self) -> None:
        """Deletes the bundle's folder: its stages, and its clean tables where
        the pipeline wrote them there.  The bundle is of no use afterwards."""
        self._stages.clear()
        if self.folder is not None:
            delete_folder(self.spark, self.folder)
            self.folder = None

    def register(self, prefix: str = "") -> "RetailTables":
        """Expose the tables as temp views for free SQL (``spark.sql``)."""
        for name in NAMES:
            getattr(self, name).createOrReplaceTempView(prefix + name)
        return self


def clean_all(raw: testdata.RawTables, raw_history: HistorySource) -> RetailTables:
    """The cleaning as lazy plans, for ad hoc use; ``plans.pipeline`` is the
    job that writes each clean table before the next one reads it."""
    customers = cleaning.clean_customers(raw.customers)
    products = cleaning.clean_products(raw.products)
    sales = cleaning.clean_sales(raw.sales, products)
    history = raw_history(sales, products) if callable(raw_history) else raw_history
    return RetailTables(customers, products, sales, cleaning.clean_pricing_history(history), raw, history)


def from_testdata(spark: SparkSession, sf_dir: str) -> RetailTables:
    """TPC-H-like parquet -> dirty raw views -> cleaned tables."""
    return clean_all(testdata.raw_from_testdata(spark, sf_dir), testdata.raw_pricing_history)


def read_clean(spark: SparkSession, path: str) -> RetailTables:
    """Cleaned tables previously written by ``plans.pipeline.run_pipeline``
    or ``sources.files.write_clean`` (sales columns back in cleaned order
    after a month-partitioned write)."""
    p = path.rstrip("/")
    customers, products, sales, history = (spark.read.parquet(f"{p}/{n}") for n in NAMES)
    return RetailTables(customers, products, sales.select(*cleaning.SALES_COLUMNS), history)
