"""Best-fit packing of documents into sequences under conflicts.

Documents are dealt evenly into shards by a hash of their id (a source or a
cluster that holds a third of all rows spreads over all shards), and each
shard is packed on its own: longest first, into the fullest sequence that
has room and holds neither a document of the same source nor one of the
same duplicate cluster.  Bins stand in the order of their residual space and
carry a bitmap of sources and one of clusters; the search starts at the
first bin with room enough and goes on to its successors until it finds a
compatible one, which is then the tightest.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CAPACITY = 2048  # words in a sequence
SHARD = 3000  # documents packed together

_PACKED = "_id bigint, piece int, n_pieces int, start bigint, n_tokens bigint, bin_id bigint, bin_offset bigint"


def pack(items: list[tuple[int, int, int]], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of each (length, source bit, cluster bit); a bit of 0
    conflicts with nothing.  Lengths are 1 to ``capacity``."""
    order = sorted(range(len(items)), key=lambda i: (-items[i][0], i))
    bins: list[tuple[int, int]] = []  # (residual, bin), ascending
    sources: list[int] = []
    clusters: list[int] = []
    out: list[tuple[int, int]] = [(0, 0)] * len(items)
    for i in order:
        length, source, cluster = items[i]
        at = bisect_left(bins, (length, -1))
        while at < len(bins) and (sources[bins[at][1]] & source or clusters[bins[at][1]] & cluster):
            at += 1
        if at < len(bins):
            residual, b = bins.pop(at)
        else:
            residual, b = capacity, len(sources)
            sources.append(0)
            clusters.append(0)
        out[i] = (b, capacity - residual)
        sources[b] |= source
        clusters[b] |= cluster
        if residual > length:
            insort(bins, (residual - length, b))
    return out


def _bits(values: list) -> list[int]:
    place: dict = {}
    return [0 if v is None else 1 << place.setdefault(v, len(place)) for v in values]


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def pack_documents(docs: DataFrame, length: Column, source: Column, cluster: Column, id_col: str = "doc_id",
                   capacity: int = CAPACITY, shard: int = SHARD) -> DataFrame:
    """doc_id, piece, n_pieces, start, n_tokens, bin_id, bin_offset.

    A document longer than a sequence is cut into full sequences and a rest;
    each piece is a row, and together they cover the document.  A document
    of length 0 has one row with no bin.  Null sources and clusters conflict
    with nothing.  Null ids are packed as they are, repeated rows as often
    as they occur.  An empty table gives an empty result."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("_id"), length.cast("bigint").alias("_n"),
                       source.cast("string").alias("_s"), cluster.alias("_c"))
    shards = max(1, -(-rows.count() // shard))
    # what a null id hashes to would be one shard: deal such rows by their cluster and length
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("_id", F.when(F.col("_id").isNull(), F.xxhash64("_c", "_n"))), F.lit(shards)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        now = None
        for batch in batches:
            for r in zip(*(batch[x].to_pylist() for x in ("shard", "_id", "_n", "_s", "_c"))):
                if now is not None and r[0] != now:
                    yield done(now, held.pop(now))
                now = r[0]
                held.setdefault(now, []).append(r[1:])
        if now is not None:
            yield done(now, held[now])

    def done(number: int, docs_: list) -> pa.RecordBatch:
        sources, clusters = _bits([d[2] for d in docs_]), _bits([d[3] for d in docs_])
        pieces = [(k, p) for k, d in enumerate(docs_) for p in range(max(1, -(-(d[1] or 0) // capacity)))]
        size = [min(capacity, (docs_[k][1] or 0) - p * capacity) for k, p in pieces]
        some = [i for i, n in enumerate(size) if n > 0]
        placed = dict(zip(some, pack([(size[i], sources[pieces[i][0]], clusters[pieces[i][0]]) for i in some], capacity)))
        first = number << 32
        return pa.RecordBatch.from_arrays([
            pa.array([docs_[k][0] for k, _ in pieces], pa.int64()), pa.array([p for _, p in pieces], pa.int32()),
            pa.array([max(1, -(-(docs_[k][1] or 0) // capacity)) for k, _ in pieces], pa.int32()),
            pa.array([p * capacity for _, p in pieces], pa.int64()), pa.array([max(0, n) for n in size], pa.int64()),
            pa.array([first + placed[i][0] if i in placed else None for i in range(len(pieces))], pa.int64()),
            pa.array([placed[i][1] if i in placed else None for i in range(len(pieces))], pa.int64())],
            ["_id", "piece", "n_pieces", "start", "n_tokens", "bin_id", "bin_offset"])

    # rows in a fixed order within a shard, so that a task run again packs the same
    dealt = rows.repartition(F.col("shard")).sortWithinPartitions("shard", "_id", "_n", "_s", "_c")
    return dealt.mapInArrow(run, _PACKED).withColumnRenamed("_id", "doc_id")
