"""Passages that repeat across documents, by content-defined seeds.

A gear hash rolls over the words: the hash of ``SEED_WORDS`` words in a row
depends on them and on the gaps between them alone.  Of the seeds inside each
window of ``PASSAGE_WORDS`` words the one with the smallest hash is chosen (the
last of equal ones), so a window always has one, however uniform its text, and
equal windows choose the same.  A text's chosen seeds, about one in 17 words,
are compared across all different texts.

The windows whose seed is shared are digested, every one, and compared across
documents.  Equal texts are read once, as the one of the smallest id; they
repeat as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from priceloom.llm.common import _piece_words, documents, materialize, mix, text_bytes, text_slices

PASSAGE_WORDS = 51  # "over 50 words"
SEED_WORDS = 6
_PLACES = mix(np.arange(1, PASSAGE_WORDS + 1, dtype=np.uint64)) | np.uint64(1)
_LAST = np.uint64(0xFFFFFFFF)


def _words(text: pa.LargeStringArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per text: its words' hashes, and from each word's start to the next's."""
    data, bounds = text_bytes(text)
    for i in range(len(text)):
        d = data[bounds[i]:bounds[i + 1]]
        if not len(d):
            yield np.zeros(0, np.uint64), np.zeros(0, np.uint64)
            continue
        first = np.zeros(len(d) + 1, bool)
        first[0] = True
        hashes, starts = _piece_words(d, first)
        yield hashes, np.diff(starts).astype(np.uint64)


def _chosen(hashes: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The digest of the seed at each word, and the word of each window's seed."""
    if len(hashes) < PASSAGE_WORDS:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    n = len(hashes) - SEED_WORDS + 1
    inner = hashes[:-1] + steps
    seeds = mix(sum(inner[k:k + n] * _PLACES[k] for k in range(SEED_WORDS - 1)) + hashes[SEED_WORDS - 1:] * _PLACES[SEED_WORDS - 1])
    # the smallest of each span, by doubling; its place from the end is in the lower half
    least = (seeds & ~_LAST) | (_LAST - np.arange(n, dtype=np.uint64))
    span, whole = 1, PASSAGE_WORDS - SEED_WORDS + 1
    while span < whole:
        more = min(span, whole - span)
        least, span = np.minimum(least[:-more], least[more:]), span + more
    return seeds, (_LAST - (least & _LAST)).astype(np.int64)


def _seed_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in text_slices(batches):
        found = []
        for h, steps in _words(part["_text"]):
            seeds, at = _chosen(h, steps)
            found.append(seeds[np.unique(at)].view(np.int64))
        owner = pa.array(np.repeat(np.arange(len(found)), [len(x) for x in found]))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found)), part["_id"].take(owner), part["_same"].take(owner)],
                                         ["digest", "_id", "_same"])


_FOUND = "_id bigint, _same bigint, several boolean, n_words int, place int, windows array<bigint>"


def _window_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per run of windows whose seed is shared; a row without windows for each text."""
    for part in text_slices(batches):
        owner, n_words, places, windows = [], [], [], []
        for i, (h, steps) in enumerate(_words(part["_text"])):
            seeds, at = _chosen(h, steps)
            marks = np.sort(part["marks"][i].values.to_numpy(zero_copy_only=False).view(np.uint64))
            mine = seeds[at]
            place = np.searchsorted(marks, mine)
            shared = np.flatnonzero(marks[np.minimum(place, len(marks) - 1)] == mine) if len(marks) else np.zeros(0, np.int64)
            sums = mix(sum(h[shared + k] * _PLACES[k] for k in range(PASSAGE_WORDS))).view(np.int64) if len(shared) else shared
            runs = np.concatenate([[0], np.flatnonzero(np.diff(shared) > 1) + 1, [len(shared)]]) if len(shared) else [0]
            for x, v in [(0, sums[:0]), *[(int(shared[a]), sums[a:b]) for a, b in zip(runs[:-1], runs[1:])]]:
                owner.append(i)
                n_words.append(len(h))
                places.append(x)
                windows.append(v)
        owner = pa.array(owner, pa.int64())
        yield pa.RecordBatch.from_arrays([*[part[x].take(owner) for x in ("_id", "_same", "several")], pa.array(n_words, pa.int32()),
                                          pa.array(places, pa.int32()), pa.array(windows, pa.list_(pa.int64()))],
                                         ["_id", "_same", "several", "n_words", "place", "windows"])


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, start_word, n_words, first_doc_id: the passages of over 50
    words that occur in several documents, in each document that has them;
    ``first_doc_id`` is the smallest id of a document that shares the
    passage's beginning.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; ``start_word``
    counts from 0.  A window is compared if the gaps inside its seed are as
    long in the other document, of whatever blanks; elsewhere gaps don't
    count.  Null, empty and short texts have no passages.  Rows with a null
    id are left out; repeated rows of one id are one document.  An empty
    table gives an empty result."""
    texts = documents(docs, id_col, text_col).where("_id is not null and _text is not null").withColumn("_same", F.xxhash64("_text"))
    members = materialize(texts.select("_same", "_id").distinct(), "texts")
    same = members.groupBy("_same").agg(F.min("_id").alias("_id"), (F.min("_id") < F.max("_id")).alias("several"))
    # what is shared is joined from written tables, so that a hot seed or window can be split
    seeds = materialize(texts.mapInArrow(_seed_batches, "digest bigint, _id bigint, _same bigint"), "seeds")
    shared = seeds.groupBy("digest").agg(F.min("_same").alias("lo"), F.max("_same").alias("hi")).where("lo < hi").select("digest")
    marks = seeds.join(materialize(shared, "shared-seeds"), "digest").groupBy("_same", "_id").agg(F.collect_set("digest").alias("marks"))
    wanted = same.join(marks, ["_same", "_id"], "left").where("several or marks is not null")
    wanted = wanted.withColumn("marks", F.coalesce("marks", F.expr("cast(array() as array<bigint>)")))
    found = materialize(texts.join(wanted, ["_same", "_id"]).mapInArrow(_window_batches, _FOUND), "passages")
    rows = found.select("_id", "several", "place", F.posexplode("windows").alias("k", "digest"))
    rows = rows.select("_id", "several", (F.col("place") + F.col("k")).alias("w0"), "digest")
    both = rows.groupBy("digest").agg(F.min("_id").alias("lo"), F.max("_id").alias("hi")).where("lo < hi").select("digest", "lo")
    every = materialize(rows.join(materialize(both, "shared-windows"), "digest").select("_id", "several", "w0", "lo"), "hits")
    hits = every.where("not several")
    # windows that overlap or touch make one passage
    order = Window.partitionBy("_id").orderBy("w0")
    hits = hits.withColumn("new", (F.col("w0") - F.coalesce(F.lag("w0").over(order), F.lit(-PASSAGE_WORDS - 1)) > PASSAGE_WORDS).cast("int"))
    hits = hits.withColumn("run", F.sum("new").over(order))
    passages = hits.groupBy("_id", "run").agg(F.min("w0").alias("w0"), F.max("w0").alias("w1"), F.min_by("lo", "w0").alias("first"))
    passages = passages.select(F.col("_id").alias("doc_id"), F.col("w0").alias("start_word"),
                               (F.col("w1") - F.col("w0") + PASSAGE_WORDS).cast("int").alias("n_words"), F.col("first").alias("first_doc_id"))
    # texts of several documents are one passage each
    whole = found.where(f"several and n_words >= {PASSAGE_WORDS}").select("_same", "_id", "n_words").distinct()
    begins = every.where("several and w0 = 0").groupBy("_id").agg(F.min("lo").alias("lo"))
    whole = materialize(whole.join(begins, "_id", "left").select("_same", F.least("_id", "lo").alias("first_doc_id"), "n_words"), "whole-texts")
    copies = members.join(whole, "_same").select(F.col("_id").alias("doc_id"), F.lit(0).alias("start_word"), "n_words", "first_doc_id")
    return passages.unionByName(copies)
