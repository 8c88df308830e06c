"""Toxicity by a subsequence string-kernel SVM with Nystroem landmarks.

The kernel compares two words by the subsequences of four letters they
share; one with gaps counts less by ``DECAY`` per position it spans, so an insult with inserted or dropped characters stays close to the
plain one.  Words are taken without characters that are neither letters nor
digits, and letters standing alone in a row ("i d i o t") also make a word.

Training sees a bounded sample of labelled documents, cut into sentences.
A toxic document marks only some of its sentences, so those that hold a
word bound to the label significantly are the positive ones; sentences of
clean documents are negative.  A sentence is its most toxic word (a
multiple-instance margin).  Landmarks are such words and frequent clean
ones; a linear SVM on the Nystroem features is the kernel SVM on their span.
A logistic curve on the documents' margins gives the probability.

A margin is linear in a word's subsequences, so scoring folds landmarks and
weights into one table over subsequences and looks each distinct
word up once per slice of text.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from priceloom.llm.chunk_table import distinct
from priceloom.llm.common import documents, materialize, text_slices

DECAY = 0.4
SPAN = 6  # positions from a subsequence's first to its last letter, at most
LANDMARKS = 480
#: The training sample: toxic and clean documents.
SAMPLE_TOXIC, SAMPLE_CLEAN = 4000, 12000
POSITIVE_WORDS, NEGATIVE_WORDS = 1500, 4000
COST = 20.0  # of a margin's violation, against the weights' norm
COMMON = 30  # documents beyond which a clean word weighs no more
HARD_ROUNDS, HARD_WORDS = 3, 3000
SIGNIFICANCE = 1e-5  # of a word's tie to the label
THRESHOLD = 0.7

_CLASSES = 64
_GAPS = [(a, b, c) for c in range(3, SPAN) for b in range(2, c) for a in range(1, b)]
_SPACED = re.compile(r"(?<!\w)\w(?:[\W_]+\w(?!\w)){2,}")
_SENTENCE_END = r"[.!?\n]+"


def _letter_classes() -> np.ndarray:
    table = np.zeros(0x3000, np.int64)
    for c in range(len(table)):
        if chr(c).isalnum():
            table[c] = c - 96 if 97 <= c <= 122 else 27 + c - 48 if 48 <= c <= 57 else 37 + c % 26
    return table


_CLASS = _letter_classes()


def _subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, code, weight) of all words' subsequences of four letters."""
    lens = np.fromiter(map(len, words), np.int64, len(words))
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    cls = np.where(codes < len(_CLASS), _CLASS[np.minimum(codes, len(_CLASS) - 1)], 37 + codes % 26)
    owner = np.repeat(np.arange(len(words)), lens)
    cls, owner = cls[cls > 0], owner[cls > 0]
    n = len(cls)
    out = []
    for a, b, c in _GAPS:
        m = n - c
        if m <= 0:
            continue
        inside = np.flatnonzero(owner[:m] == owner[c:])
        code = ((cls[inside] * _CLASSES + cls[inside + a]) * _CLASSES + cls[inside + b]) * _CLASSES + cls[inside + c]
        out.append((owner[inside], code, np.full(len(code), DECAY ** (c + 1))))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(x) for x in zip(*out))


def _norms(owner: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    return np.sqrt(np.maximum(np.bincount(owner, weight * weight, minlength=n), 1e-12))


class KernelSvm:
    """``table``: a margin's weight by subsequence (few aren't 0); ``bias``; the logistic curve."""

    def __init__(self, table: np.ndarray, bias: float, slope: float = 4.0, at: float = 0.0):
        self.codes = np.flatnonzero(table)
        self.weights = table[self.codes].astype(np.float32)
        self.bias, self.slope, self.at = bias, slope, at
        self._table = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_table": None}  # tasks are sent what isn't 0

    def margins(self, words: list[str]) -> np.ndarray:
        if self._table is None:
            self._table = np.zeros(_CLASSES ** 4, np.float32)
            self._table[self.codes] = self.weights
        owner, code, weight = _subsequences(words)
        total = np.bincount(owner, weight * self._table[code], minlength=len(words))
        return total / _norms(owner, weight, len(words)) + self.bias

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * (margin - self.at), -30, 30)))


def _features(words: list[str], codes: np.ndarray) -> np.ndarray:
    """Normalised vectors over the given subsequences."""
    owner, code, weight = _subsequences(words)
    norm = _norms(owner, weight, len(words))
    place = np.searchsorted(codes, code)
    place[place == len(codes)] = 0
    hit = codes[place] == code
    out = np.zeros((len(words), len(codes)), np.float32)
    np.add.at(out, (owner[hit], place[hit]), weight[hit])
    return out / norm[:, None].astype(np.float32)


def fit(positive: dict[str, int], negative: dict[str, int], landmarks: list[str]) -> KernelSvm:
    """Words with the number of documents that hold them, which they weigh."""
    codes = np.unique(_subsequences(landmarks)[1])
    marks = _features(landmarks, codes)
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    root = vectors / np.sqrt(np.maximum(values, 1e-6)) @ vectors.T  # the pseudo square root of the landmarks' kernel
    words = [*positive, *negative]
    z = np.concatenate([_features(words[at:at + 500], codes) @ marks.T for at in range(0, len(words), 500)]) @ root
    y = np.where(np.arange(len(words)) < len(positive), 1.0, -1.0)
    share = lambda seen: np.array(list(seen.values()), float) / sum(seen.values())
    cost = np.concatenate([share(positive), share(negative)]) * len(words) * COST
    w, b = np.zeros(z.shape[1]), 0.0
    # squared hinge loss by Newton steps: a small dense system each
    for _ in range(30):
        m = 1 - y * (z @ w + b)
        k = m > 0
        zk = np.concatenate([z[k], np.ones((int(k.sum()), 1))], axis=1)
        ck = cost[k][:, None]
        reg = np.diag([1.0] * z.shape[1] + [1e-9])
        solved = np.linalg.solve(reg + 2.0 * (zk * ck).T @ zk, 2.0 * (zk * ck).T @ y[k])
        step = np.abs(solved[:-1] - w).max()
        w, b = solved[:-1], float(solved[-1])
        if step < 1e-6:
            break
    table = np.zeros(_CLASSES ** 4)
    table[codes] = (root @ w) @ marks
    return KernelSvm(table, b)


def _calibrated(svm: KernelSvm, margin: np.ndarray, toxic: np.ndarray) -> KernelSvm:
    """The logistic curve of document margins, by Newton steps."""
    x, y = margin.astype(np.float64), toxic.astype(np.float64)
    a, c = 1.0, 0.0
    w = np.where(y > 0, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum())) * len(y)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + c, -30, 30)))
        g = np.array([(w * (p - y) * x).sum() + 1e-2 * a, (w * (p - y)).sum()])
        h = w * np.maximum(p * (1 - p), 1e-6)
        hess = np.array([[(h * x * x).sum() + 1e-2, (h * x).sum()], [(h * x).sum(), h.sum() + 1e-9]])
        da, dc = np.linalg.solve(hess, g)
        a, c = a - da, c - dc
        if abs(da) + abs(dc) < 1e-7:
            break
    a = max(a, 1e-3)
    svm.slope, svm.at = a, -c / a
    return svm


def document_margins(text: pa.LargeStringArray, svm: KernelSvm) -> np.ndarray:
    """Each text's largest word margin; -inf without words."""
    low = pc.utf8_lower(text)
    spaced = pc.match_substring_regex(low, r"(^|[^\pL\pN])[\pL\pN]([^\pL\pN]+[\pL\pN]){2,}([^\pL\pN]|$)").to_numpy(zero_copy_only=False)
    if spaced.any():
        more = low.to_pylist()
        for i in np.flatnonzero(spaced):
            more[i] += "".join(" " + re.sub(r"[\W_]+", "", m) for m in _SPACED.findall(more[i]))
        low = pa.array(more, pa.large_string())
    for blank in "\n\t\r":
        low = pc.replace_substring(low, blank, " ")
    parts = pc.split_pattern(low, " ")
    bounds = parts.offsets.to_numpy().astype(np.int64)
    words, place = distinct(parts.values.slice(bounds[0], bounds[-1] - bounds[0]))
    margin = svm.margins(words) if words else np.zeros(0)
    return np.maximum.reduceat(margin[place], bounds[:-1] - bounds[0]) if len(place) else np.full(len(text), -np.inf)


def _third(column: str = "_id"):
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(3))


def _sampled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """The labelled training documents: at most SAMPLE_TOXIC and SAMPLE_CLEAN,
    the first in the order of a hash of their ids."""
    known = (labels.select(F.col(id_col).cast("bigint").alias("_id"), F.col(label_col).cast("int").alias("_toxic"))
             .where(F.col("_id").isNotNull() & F.col("_toxic").isin(0, 1) & (_third() != 1)).groupBy("_id").agg(F.max("_toxic").alias("_toxic")))
    order = [F.xxhash64("_id"), F.col("_id")]
    chosen = (known.where("_toxic = 1").orderBy(*order).limit(SAMPLE_TOXIC)
              .unionByName(known.where("_toxic = 0").orderBy(*order).limit(SAMPLE_CLEAN)))
    texts = documents(docs, id_col, text_col).where("_text is not null").join(F.broadcast(chosen), "_id")  # bounded by the sample
    return materialize(texts, "toxic-sample")


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> KernelSvm | None:
    """None unless some word is significantly tied to the label."""
    sample = _sampled(docs, labels, id_col, text_col, label_col)
    size = {r["_toxic"]: r["n"] for r in sample.groupBy("_toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not size.get(1) or not size.get(0):
        return None
    sentences = sample.select("_id", "_toxic", F.explode(F.split(F.lower("_text"), _SENTENCE_END)).alias("sentence"))
    words = sentences.select("_id", "_toxic", F.explode(F.split(F.regexp_replace("sentence", r"[^\p{L}\p{N}\s]", ""), r"\s+")).alias("word"))
    counts = words.where(F.length("word") > 2).distinct().groupBy("word").agg(
        F.count_if(F.col("_toxic") == 1).alias("t"), F.count_if(F.col("_toxic") == 0).alias("c"))
    counts = materialize(counts, "toxic-words")
    share = size[1] / (size[0] + size[1])
    # a word of n documents is all toxic by chance share^n of the time; one in 50 may be clean
    least = max(3, math.ceil(math.log(SIGNIFICANCE) / math.log(share)))
    tied = counts.where((F.col("t") >= least) & (F.col("c") * 50 <= F.col("t"))).orderBy(F.desc("t"), "word").limit(POSITIVE_WORDS).collect()
    clean = counts.where("c > 0 and t <= c")
    common = clean.orderBy(F.desc("c"), "word").limit(NEGATIVE_WORDS).collect()
    if not tied or not common:
        return None
    positive, negative = {r["word"]: r["t"] for r in tied}, {r["word"]: min(r["c"], COMMON) for r in common}
    landmarks = list(dict.fromkeys([*positive][:LANDMARKS // 2] + [*negative][:LANDMARKS // 2]))
    svm = fit(positive, negative, landmarks)
    for _ in range(HARD_ROUNDS):  # the clean words that come nearest to toxic ones join the negatives
        near = clean.mapInArrow(_word_margins(svm), "word string, c bigint, margin double")
        hard = near.where("margin > -1").orderBy(F.desc("margin"), "word").limit(HARD_WORDS).collect()
        negative |= {r["word"]: COMMON for r in hard}
        landmarks = list(dict.fromkeys(landmarks + [r["word"] for r in hard[:LANDMARKS // 4]]))
        svm = fit(positive, negative, landmarks)
    margins = sample.mapInArrow(_margins(svm), "_id bigint, margin double").join(sample.select("_id", "_toxic").distinct(), "_id")
    rows = margins.orderBy("_id", "margin").collect()  # one number per sampled document
    return _calibrated(svm, np.array([max(r["margin"], -9.0) for r in rows]), np.array([r["_toxic"] for r in rows]))


def _word_margins(svm: KernelSvm):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["word"], batch["c"], pa.array(svm.margins(batch["word"].to_pylist()), pa.float64())],
                                             ["word", "c", "margin"])
    return lambda batches: run(b.select(["word", "c"]) for b in batches)


def _margins(svm: KernelSvm):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            yield pa.RecordBatch.from_arrays([part["_id"], pa.array(document_margins(part["_text"], svm))], ["_id", "margin"])
    return run


def score(docs: DataFrame, svm: KernelSvm | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for every input row.

    Null and empty texts score as texts without words, near 0; all score 0
    if nothing was learnt.  Null ids and repeated rows are listed as they
    are; an empty table gives an empty result."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            p = np.zeros(part.num_rows) if svm is None else svm.probability(np.maximum(document_margins(part["_text"], svm), -9.0))
            yield pa.RecordBatch.from_arrays([part["_id"], pa.array(p)], ["_id", "score"])

    out = documents(docs, id_col, text_col).mapInArrow(run, "_id bigint, score double")
    return out.select(F.col("_id").alias("doc_id"), (_third() == 1).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
