"""Language identification by a byte convolutional network.

Filters of several widths slide over fixed-length windows of a text's UTF-8
bytes; each filter's largest response in a window feeds a softmax.  The
network is trained in numpy on a bounded sample of labelled windows and
applied to every window of every text; a document's probabilities are the
mean over its windows, weighted by their bytes.

For scoring, byte embeddings and filters are folded into tables over byte
pairs, so a response is two look-ups and a sum.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from priceloom.llm.common import documents, text_bytes, text_slices

WINDOW = 256  # bytes
WIDTHS, FILTERS, EMBED = (2, 3, 4), 16, 8
#: The training sample: documents, and windows of each.
SAMPLE_DOCS, SAMPLE_WINDOWS = 4000, 4
EPOCHS, BATCH, RATE = 8, 64, 0.005
UNKNOWN = "und"


class ByteNet:
    def __init__(self, labels: list[str], seed: int = 5):
        rng = np.random.default_rng(seed)
        self.labels = labels
        self.p = {"e": rng.normal(0, 0.5, (256, EMBED)).astype(np.float32),
                  "out": rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(labels))).astype(np.float32),
                  "ob": np.zeros(len(labels), np.float32)}
        for w in WIDTHS:
            self.p[f"w{w}"] = rng.normal(0, 1 / math.sqrt(w * EMBED), (w, EMBED, FILTERS)).astype(np.float32)
            self.p[f"b{w}"] = np.zeros(FILTERS, np.float32)

    def fit(self, x: np.ndarray, y: np.ndarray) -> ByteNet:
        """Adam on the class-weighted cross entropy of windows x (n, WINDOW)."""
        rng = np.random.default_rng(6)
        weight = (len(y) / (len(self.labels) * np.maximum(np.bincount(y, minlength=len(self.labels)), 1)))[y].astype(np.float32)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        t, steps = 0, EPOCHS * -(-len(y) // BATCH)
        for _ in range(EPOCHS):
            order = rng.permutation(len(y))
            for at in range(0, len(y), BATCH):
                k = order[at:at + BATCH]
                t += 1
                for name, g in self._gradients(x[k], y[k], weight[k]).items():
                    m[name] = 0.9 * m[name] + 0.1 * g
                    s[name] = 0.99 * s[name] + 0.01 * g * g
                    self.p[name] -= RATE * (1 - t / (steps + 1)) * (m[name] / (1 - 0.9 ** t)) / (np.sqrt(s[name] / (1 - 0.99 ** t)) + 1e-7)
        return self

    def _gradients(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        p, n = self.p, len(x)
        span = WINDOW - max(WIDTHS) + 1
        emb = p["e"][x]
        pooled, where = [], []
        for w in WIDTHS:
            r = sum(emb[:, k:k + span] @ p[f"w{w}"][k] for k in range(w))
            best = r.argmax(axis=1)
            where.append(best)
            pooled.append(np.take_along_axis(r, best[:, None], axis=1)[:, 0] + p[f"b{w}"])
        raw = np.concatenate(pooled, axis=1)
        h = np.maximum(raw, 0)
        d = _softmax(h @ p["out"] + p["ob"])
        d[np.arange(n), y] -= 1
        d *= weight[:, None] / n
        g = {"out": h.T @ d, "ob": d.sum(axis=0), "e": np.zeros_like(p["e"])}
        back = (d @ p["out"].T) * (raw > 0)
        for i, w in enumerate(WIDTHS):
            b = back[:, i * FILTERS:(i + 1) * FILTERS]
            g[f"b{w}"] = b.sum(axis=0)
            gw = np.zeros_like(p[f"w{w}"])
            for k in range(w):
                byte = np.take_along_axis(x, where[i] + k, axis=1)
                gw[k] = np.einsum("nfe,nf->ef", p["e"][byte], b)
                np.add.at(g["e"], byte, b[:, :, None] * p[f"w{w}"][k].T[None])
            g[f"w{w}"] = gw
        return g

    def tables(self) -> tuple[np.ndarray, ...]:
        """Responses by byte pair (all widths), by a third byte, by a second pair."""
        e = self.p["e"]
        on = {w: [e @ self.p[f"w{w}"][k] for k in range(w)] for w in WIDTHS}
        pair = lambda a, b: (a[:, None] + b[None, :]).reshape(65536, FILTERS)
        first = np.concatenate([pair(on[w][0], on[w][1]) for w in WIDTHS], axis=1)
        bias = np.concatenate([self.p[f"b{w}"] for w in WIDTHS])
        return first, on[3][2], pair(on[4][2], on[4][3]), bias, self.p["out"], self.p["ob"]


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def window_probabilities(tables: tuple[np.ndarray, ...], x: np.ndarray) -> np.ndarray:
    """Class probabilities of windows x (n, WINDOW) of bytes."""
    first, third, second, bias, out, ob = tables
    span = WINDOW - max(WIDTHS) + 1
    best = np.empty((len(x), FILTERS * len(WIDTHS)), np.float32)
    for at in range(0, len(x), 32):
        b = x[at:at + 32].astype(np.int32)
        pairs = b[:, :-1] * 256 + b[:, 1:]
        r = first[pairs[:, :span]]
        r[:, :, FILTERS:2 * FILTERS] += third[b[:, 2:2 + span]]
        r[:, :, 2 * FILTERS:] += second[pairs[:, 2:2 + span]]
        best[at:at + 32] = r.max(axis=1)
    return _softmax(np.maximum(best + bias, 0) @ out + ob)


def windows(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All texts' windows (the last of a text padded with zeros) and each
    text's bounds among them."""
    n = np.diff(bounds)
    many = -(-n // WINDOW)
    ends = np.concatenate([[0], np.cumsum(many)])
    x = np.zeros(int(ends[-1]) * WINDOW, np.uint8)
    x[np.arange(len(data)) + np.repeat(ends[:-1] * WINDOW - bounds[:-1], n)] = data
    return x.reshape(-1, WINDOW), ends


def _sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Up to SAMPLE_WINDOWS windows from all over each text."""
    for part in text_slices(batches):
        data, bounds = text_bytes(part["_text"])
        x, ends = windows(data, bounds)
        pick, owner = [], []
        for i, d in enumerate(part["_id"].to_pylist()):
            n = ends[i + 1] - ends[i]
            k = np.random.default_rng(zlib.crc32(str(d).encode())).permutation(n)[:SAMPLE_WINDOWS] if n else np.zeros(0, np.int64)
            pick.append(ends[i] + k)
            owner += [i] * len(k)
        pick = np.concatenate(pick) if pick else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([part["_label"].take(pa.array(owner, pa.int64())), pa.array([x[k].tobytes() for k in pick], pa.binary())],
                                         ["label", "bytes"])


def _remainder(by: int):
    return F.pmod(F.crc32(F.coalesce(F.col("_id").cast("string"), F.lit("")).cast("binary")), F.lit(by))


def train(docs: DataFrame, label: str = "lang", id_col: str = "doc_id", text_col: str = "text",
          sample_docs: int = SAMPLE_DOCS) -> ByteNet | None:
    """Fits the network on a sample of at most ``sample_docs`` labelled
    documents that aren't held out; None if there are fewer than two labels."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("_id"), F.col(text_col).cast("string").alias("_text"),
                       F.col(label).cast("string").alias("_label"))
    rows = rows.where(F.col("_label").isNotNull() & F.col("_id").isNotNull() & (F.length("_text") > 0) & (_remainder(5) != 0))
    rows = rows.orderBy(F.xxhash64("_id"), "_id").limit(sample_docs)
    found = rows.mapInArrow(_sample, "label string, bytes binary").collect()
    found.sort(key=lambda r: (r["label"], bytes(r["bytes"])))
    labels = sorted({r["label"] for r in found})
    if not labels:
        return None
    x = np.frombuffer(b"".join(bytes(r["bytes"]) for r in found), np.uint8).reshape(-1, WINDOW)
    return ByteNet(labels).fit(x, np.array([labels.index(r["label"]) for r in found]))


_TABLES: dict[int, tuple] = {}


def _tables(net: ByteNet) -> tuple[np.ndarray, ...]:
    """The worker's tables of a network, made once."""
    key = zlib.crc32(b"".join(v.tobytes() for v in net.p.values()))
    if key not in _TABLES:
        _TABLES.clear()
        _TABLES[key] = net.tables()
    return _TABLES[key]


def classify(text: pa.LargeStringArray, net: ByteNet | None) -> tuple[pa.Array, pa.Array]:
    """Predicted label and its mean probability over each whole text."""
    lettered = pc.match_substring_regex(text, r"\p{L}").to_numpy(zero_copy_only=False)
    pred, score = np.full(len(text), UNKNOWN, object), np.zeros(len(text))
    if net is not None and lettered.any():
        x, ends = windows(*text_bytes(text))
        share = (x != 0).sum(axis=1, keepdims=True)
        total = np.concatenate([np.zeros((1, len(net.labels))), np.cumsum(window_probabilities(_tables(net), x) * share, axis=0)])
        mass = total[ends[1:]] - total[ends[:-1]]
        for i in np.flatnonzero(lettered):
            c = int(mass[i].argmax())
            pred[i], score[i] = net.labels[c], min(1.0, max(0.0, mass[i, c] / max(mass[i].sum(), 1e-12)))
    return pa.array(pred, pa.string()), pa.array(score)


def predict(docs: DataFrame, net: ByteNet | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score for every input row.

    A null text, or one without a letter, is ``und`` with score 0; so is all
    if nothing was learnt.  Null ids and repeated rows are listed as they
    are; an empty table gives an empty result."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, limit=1 << 20):
            yield pa.RecordBatch.from_arrays([part["_id"], *classify(part["_text"], net)], ["_id", "lang_pred", "score"])

    out = documents(docs, id_col, text_col).mapInArrow(run, "_id bigint, lang_pred string, score double")
    return out.select(F.col("_id").alias("doc_id"), (_remainder(5) == 0).alias("held_out"), "lang_pred", "score")


def identify(docs: DataFrame, label: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return predict(docs, train(docs, label, id_col, text_col), id_col, text_col)


def keep_identified(docs: DataFrame, label: str = "lang", least: float = 0.4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows whose language is identified with a score of ``least`` or
    more, with all their columns; others, ``und`` included, go."""
    net = train(docs, label, id_col, text_col)
    schema = StructType([*docs.schema.fields, StructField("_lang_text", StringType()), StructField("_lang_pred", StringType()),
                         StructField("_lang_score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "_lang_text", limit=1 << 20):
            pred, score = classify(part["_lang_text"], net)
            keep = pc.and_(pc.not_equal(pred, UNKNOWN), pc.greater_equal(score, least))
            empty = pa.nulls(part.num_rows, pa.string())
            k = part.schema.get_field_index("_lang_text")
            yield pa.RecordBatch.from_arrays([*part.columns[:k], empty, pred, score], schema=pa.schema(
                [*list(part.schema)[:k], ("_lang_text", pa.string()), ("_lang_pred", pa.string()), ("_lang_score", pa.float64())])).filter(keep)

    return docs.withColumn("_lang_text", F.col(text_col).cast("string")).mapInArrow(run, schema).drop("_lang_text", "_lang_pred", "_lang_score")
