"""The registered queries of this package: each applies one operator to its
whole table and shapes the result as its contract says."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from priceloom.llm.common import small_batches
from priceloom.session import configure


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from priceloom.llm.minhash_dedup import near_dedup
    return near_dedup(_table(spark, sf_dir, "documents"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from priceloom.llm.sentencepiece_codec import round_trip
    return round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from priceloom.llm.nearest import nearest
    return nearest(_table(spark, sf_dir, "embeddings"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from priceloom.llm.exact_dedup import normalised
    from priceloom.llm.packing import pack_documents, words
    docs = _table(spark, sf_dir, "documents")
    return pack_documents(docs, words(F.col("text")), F.col("source"), F.xxhash64(normalised(F.col("text"))))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from priceloom.llm.language import identify
    return identify(_table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from priceloom.llm.secret_scan import find_secrets
    return find_secrets(_table(spark, sf_dir, "documents"))


def op7_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from priceloom.llm.chunk_dedup import repeated_passages
    return repeated_passages(_table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from priceloom.llm.exact_dedup import exact_dedup
    return exact_dedup(_table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from priceloom.llm.toxicity import score, train
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return score(docs, train(docs, labels))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from priceloom.llm.token_files import token_round_trip
    return token_round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from priceloom.llm.token_counts import count_tokens
    return count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from priceloom.llm.periodic_runs import run_digests
    return run_digests(_table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from priceloom.llm.collocations import collocations
    return collocations(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_near_dedup, op2_sentencepiece, op3_nearest, op4_packing, op5_language, op6_secret_scan,
                                 op7_chunk_dedup, op8_exact_dedup, op9_toxicity, op10_token_files, op11_token_counts,
                                 op12_periodic_runs, op13_collocations)}
