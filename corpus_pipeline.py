"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
writes each stage's result to the shared checkpoint folder and reads it
again as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from priceloom.llm.common import materialize, small_batches
from priceloom.llm.exact_dedup import drop_exact_copies, normalised
from priceloom.llm.language import keep_identified
from priceloom.llm.minhash_dedup import drop_near_copies
from priceloom.llm.packing import pack_documents, words
from priceloom.llm.secret_scan import redact
from priceloom.session import configure


def _ready(spark: SparkSession) -> None:
    configure(spark)
    small_batches(spark)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an identified language go."""
    _ready(spark)
    return keep_identified(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one document stays."""
    _ready(spark)
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one document stays."""
    _ready(spark)
    return drop_near_copies(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; secrets in their texts are replaced by a mark."""
    _ready(spark)
    out = redact(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's place in the training sequences."""
    _ready(spark)
    return pack_documents(docs, words(F.col("text")), F.col("source"), F.xxhash64(normalised(F.col("text"))))


STAGES = [("language_id", language_id), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
          ("secret_scan", secret_scan), ("best_fit_packing", best_fit_packing)]

#: SQL can't express the trained and the probabilistic stages; tests/llm
#: compares them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ready(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
