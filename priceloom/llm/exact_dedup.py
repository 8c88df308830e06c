"""Exact deduplication through an extendible-hash index on shared files.

All of it is DataFrame work:

1. every text's normalised bytes are grouped under their 64-bit key; the
   grouping compares the bytes themselves, and map-side aggregation leaves
   one entry per distinct text and task before anything is shuffled, so a
   text that a third of all rows share costs one row per task;
2. one bounded histogram of key prefixes drives the directory: it doubles
   until every bucket holds at most ``bucket_entries`` entries (a bucket's
   local depth is the number of prefix bits it uses);
3. owner tasks, each holding a range of buckets, sort their entries by key
   and chain those whose keys collide; the index is written to the shared
   checkpoint folder;
4. rows find their entry by key, then by digest along the chain.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from priceloom.llm.common import documents, materialize

BLANKS = " \t\n\x0b\x0c\r"  # the characters of [\x20\x09-\x0D]
_ID_MAX = (1 << 63) - 1
_STEP = Decimal(1 << 64)  # over every _ID_MAX - id, ids below 0 included


def normalised(text: Column) -> Column:
    """The text without blanks; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), BLANKS, "")


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    d = documents(docs, id_col, text_col).withColumn("_norm", normalised(F.col("_text")))
    return d.select("_id", "_norm", F.xxhash64("_norm").alias("_key"), F.sha2("_norm", 256).alias("_sha"),
                    F.coalesce(F.length("_text"), F.lit(0)).alias("_chars"))


def _entries(rows: DataFrame) -> DataFrame:
    """One row per distinct text: its size and the id that stays.  Longest
    original first, then smallest id, as one fixed-width number: such a
    buffer keeps the aggregation hashed, where a struct would sort texts."""
    wide = "decimal(38,0)"
    rank = F.col("_chars").cast(wide) * F.lit(_STEP) + (F.lit(_ID_MAX).cast(wide) - F.col("_id").cast(wide))
    best = F.max(rank.cast(wide)).alias("_best")
    grouped = rows.groupBy("_key", "_sha", "_norm").agg(F.count(F.lit(1)).alias("group_size"), best)
    low = F.col("_best") % F.lit(_STEP)
    return grouped.select("_key", "_sha", "group_size", (F.lit(_ID_MAX).cast(wide) - low).cast("bigint").alias("keep_id"))


def _prefix(bits: int) -> Column:
    return F.shiftrightunsigned(F.col("_key"), 64 - bits) if bits else F.lit(0).cast("bigint")


def directory(entries: DataFrame, bucket_entries: int) -> tuple[int, list[tuple[int, int]]]:
    """Global depth, and each bucket's first prefix and local depth, in order.

    The histogram has at most about 16 cells per full bucket, whatever the
    number of documents."""
    n = entries.count()
    bits = max(1, (max(1, n // bucket_entries)).bit_length() + 3)
    counts = {r["_p"]: r["n"] for r in entries.groupBy(_prefix(bits).alias("_p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    buckets, work = [], [(0, 0)]
    while work:
        prefix, depth = work.pop()
        cells = range(prefix << (bits - depth), (prefix + 1) << (bits - depth))
        if depth == bits or sum(counts.get(c, 0) for c in cells) <= bucket_entries:
            buckets.append((cells.start, depth))
        else:  # an overfull bucket splits; the deepest one sets the directory's size
            work += [(2 * prefix + 1, depth + 1), (2 * prefix, depth + 1)]
    return bits, buckets


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                bucket_entries: int = 200_000) -> DataFrame:
    """The written index: bucket, local depth, key, chain place, digest, keep_id, group_size."""
    spark = docs.sparkSession
    entries = materialize(_entries(_rows(docs, id_col, text_col)), "dedup-entries")
    bits, buckets = directory(entries, bucket_entries)
    cells = [(c, b, depth) for b, (start, depth) in enumerate(buckets) for c in range(start, start + (1 << (bits - depth)))]
    table = spark.createDataFrame(cells, "_p bigint, bucket int, local_depth int")
    placed = entries.withColumn("_p", _prefix(bits)).join(table, "_p").drop("_p")
    owned = placed.repartitionByRange(F.col("bucket"), F.col("_key"))
    chain = F.row_number().over(Window.partitionBy("bucket", "_key").orderBy("_sha"))
    return materialize(owned.withColumn("chain", chain), "dedup-index")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                bucket_entries: int = 200_000) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every input row.

    Texts are equal when identical without blanks; the longest original (in
    code points), then the smallest id stays.  Null and empty texts are equal
    to each other.  A null id is counted and listed but never stays; a
    repeated row is listed as often as it occurs.  An empty table gives an
    empty result; other columns are not touched."""
    index = build_index(docs, id_col, text_col, bucket_entries)
    rows = _rows(docs, id_col, text_col).select("_id", "_key", "_sha")
    found = rows.join(index, ["_key", "_sha"])
    return found.select(F.col("_id").alias("doc_id"), "keep_id", "group_size",
                        F.coalesce(F.col("_id") == F.col("keep_id"), F.lit(False)).alias("kept"),
                        F.col("_sha").alias("text_sha256"))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.  Of several
    rows that repeat the id and text of one that stays, one stays; rows
    without an id go unless their text has no row with an id."""
    index = build_index(docs, id_col, text_col)
    stays = index.select(F.col("_sha").alias("_stay_sha"), F.col("keep_id").alias("_stay_id"))
    norm = normalised(F.col(text_col).cast("string"))
    rows = docs.withColumn("_stay_sha0", F.sha2(norm, 256))
    on = (F.col("_stay_sha0") == F.col("_stay_sha")) & F.col(id_col).cast("bigint").eqNullSafe(F.col("_stay_id"))
    kept = rows.join(stays, on, "left_semi")
    # the same document listed twice: looked for without the texts, as a rule there is none
    twice = kept.groupBy(id_col, "_stay_sha0").count().where("count > 1")
    if not twice.isEmpty():
        kept = kept.dropDuplicates([id_col, "_stay_sha0"])
    return kept.drop("_stay_sha0")
