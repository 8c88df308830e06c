"""Helpers shared by the operators: input columns, written stages, Arrow
batches of bounded size, and word hashing on raw UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from priceloom.session import materialize, scratch_path

__all__ = ["documents", "materialize", "scratch_path", "text_slices", "batch_words", "mix", "small_batches"]

#: Bytes of text handled by one numpy step; bounds a task's memory.
SLICE_BYTES = 2 << 20


def documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id (BIGINT) and the text, under internal names, so that other
    columns of the input can't clash with those an operator adds."""
    return docs.select(F.col(id_col).cast("bigint").alias("_id"), F.col(text_col).cast("string").alias("_text"))


def small_batches(spark: SparkSession) -> None:
    """Arrow batches are bounded by bytes as well as rows: a batch of very
    long documents must not fill an executor."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "_text",
                limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in slices of about ``limit`` text bytes (a
    single longer text is a slice of its own); null texts become empty."""
    for batch in batches:
        k = batch.schema.get_field_index(column)
        text = batch.column(k).cast(pa.large_string()).fill_null("")
        batch = batch.set_column(k, column, text)
        ends = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
        at = 0
        while at < len(text):
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + limit, side="right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def text_bytes(text: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row, and each text's bounds in them."""
    ends = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
    raw = text.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[ends[0]:ends[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, ends - ends[0]


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (two xor-shift-multiply rounds)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SEP = np.zeros(256, bool)
_SEP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_CODE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_CODE[65:91] = _CODE[97:123]  # A-Z count as a-z
_BASE = 0xD1342543DE82EF95
_UNBASE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    p = _POWERS.get(base)
    if p is None or len(p) < n:
        step = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
        step[0] = 1
        p = np.multiply.accumulate(step)
        if len(p) <= 4 * SLICE_BYTES:  # longer ones serve one very long text
            _POWERS[base] = p
    return p[:n]


def _piece_words(data: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each word; ``first`` marks bytes that begin a text."""
    n = len(data)
    inside = ~_SEP[data]
    new = inside.copy()
    new[1:] &= ~inside[:-1] | first[1:n]
    starts = np.flatnonzero(new)
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:n]
    ends = np.flatnonzero(last) + 1
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_CODE[data] * _powers(_BASE, n), out=total[1:])
    h = (total[ends] - total[starts]) * _powers(_UNBASE, n)[starts]
    return mix(h + (ends - starts).astype(np.uint64)), starts


def batch_words(text: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` of all texts (A-Z
    lower-cased), in order, and the bounds of each text's words.

    A very long text is hashed piece by piece, cut at separators."""
    data, bounds = text_bytes(text)
    n, at, hashes, starts = len(data), 0, [], []
    first = np.zeros(n + 1, bool)
    first[bounds] = True
    while at < n:
        to = min(n, at + SLICE_BYTES)
        while to < n and not _SEP[data[to]] and not first[to]:
            to += 1
        h, s = _piece_words(data[at:to], first[at:to + 1])
        hashes.append(h)
        starts.append(s + at)
        at = to
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), bounds)
