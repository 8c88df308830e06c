"""SentencePiece encoding and decoding through a distinct-chunk table.

No piece of the vocabulary has a whitespace marker after another character,
so merges never cross the start of a marked word: a text's segmentation is
that of its marked words side by side.  Each distinct marked word is
segmented once by the library and its ids are joined back by position;
decoding works the same way on distinct runs of ids.  A model for which this
does not hold is refused.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from priceloom.llm.chunk_table import ChunkTable, distinct, text_sums
from priceloom.llm.common import documents, text_slices

MARK = "▁"
_MARKED = re.compile(" +[^ ]*")


class Codec:
    """Exact ``encode`` and ``decode`` of one model, by distinct chunks."""

    def __init__(self, model: str):
        import sentencepiece
        self.sp = sentencepiece.SentencePieceProcessor(model_file=model)
        pieces = [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size())]
        probe = "AÄ Ａ\n　 b"
        if any(MARK in p.lstrip(MARK) for p in pieces) or self.sp.normalize(probe) != MARK + probe.replace(" ", MARK):
            raise ValueError("pieces of this model can cross whitespace markers, or its texts are normalised")
        self.begins = np.array([p.startswith(MARK) for p in pieces])
        self._anchor = self.sp.encode("a")
        self._words = ChunkTable(self._encode_words, np.uint16 if len(pieces) <= 1 << 16 else np.uint32)
        self._runs: dict[bytes, str] = {}

    def _encode_words(self, words: list[str]) -> list[list[int]]:
        """Words without their first marker; blank ones have markers only."""
        ids = self.sp.encode(words, num_threads=1)
        for i, w in enumerate(words):
            if not w.strip(" "):
                ids[i] = self.sp.encode("a " + w)[len(self._anchor):]
        return ids

    def encode(self, text: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a line, and each text's bounds."""
        odd = pc.any(pc.match_substring_regex(text, "  |^ | $|" + MARK)).as_py()
        if odd:
            lists = [[w[1:] for w in _MARKED.findall(" " + t.replace(MARK, " "))] if t else [] for t in text.to_pylist()]
            words = pa.array(lists, pa.large_list(pa.large_string()))
        else:
            words = pc.split_pattern(text, " ")
        bounds = words.offsets.to_numpy().astype(np.int64)
        values, place = distinct(words.values.slice(bounds[0], bounds[-1] - bounds[0]))
        ids, lens = self._words.gather(self._words.rows(values)[place])
        ends = text_sums(lens, bounds - bounds[0])
        if not odd:  # the empty text has no marked word, a split gives it one
            empty = np.flatnonzero(pc.equal(pc.binary_length(text), 0).to_numpy(zero_copy_only=False))
            if len(empty):
                keep = np.ones(len(ids), bool)
                for i in empty:
                    keep[ends[i]:ends[i + 1]] = False
                ids, ends = ids[keep], np.concatenate([[0], np.cumsum(keep)])[ends]
        return ids, ends

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> pa.StringArray:
        """The texts of the given runs of ids."""
        start = self.begins[ids]
        first = np.zeros(len(ids) + 1, bool)
        first[bounds] = True
        cuts = np.flatnonzero(start | first[:-1]) if len(ids) else np.zeros(0, np.int64)
        width = ids.dtype.itemsize
        offsets = np.concatenate([cuts, [len(ids)]]).astype(np.int64) * width
        runs = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(ids))])
        values, place = distinct(runs)
        if len(self._runs) > 400_000:
            self._runs.clear()
        new = [v for v in values if v not in self._runs]
        if new:
            lead = len(self.sp.decode(self._anchor))
            texts = self.sp.decode([self._anchor + np.frombuffer(v, ids.dtype).tolist() for v in new], num_threads=1)
            self._runs.update(zip(new, (t[lead:] for t in texts)))
        parts = pa.array([self._runs[v] for v in values], pa.string()).take(pa.array(place))
        at = np.searchsorted(cuts, bounds).astype(np.int32)
        text = pc.binary_join(pa.ListArray.from_arrays(pa.array(at), parts), "")
        marked = np.zeros(len(bounds) - 1, bool)
        some = np.flatnonzero(np.diff(bounds))
        marked[some] = start[bounds[:-1][some]]
        return pc.if_else(pa.array(marked), pc.utf8_slice_codeunits(text, 1), text)


_CODECS: dict[str, Codec] = {}


def codec(model: str) -> Codec:
    """The worker's codec of a model; its tables serve all tasks there."""
    if model not in _CODECS:
        _CODECS[model] = Codec(model)
    return _CODECS[model]


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array<int>) of every row; null and empty texts have no ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            ids, ends = codec(model).encode(part["_text"])
            yield pa.RecordBatch.from_arrays([part["_id"], pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32)))],
                                             ["doc_id", "ids"])
    return documents(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id, text of rows (doc_id, ids); null ids count as none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                rows = [x or [] for x in part["ids"].to_pylist()]
                bounds = np.concatenate([[0], np.cumsum([len(x) for x in rows])]).astype(np.int64)
                ids = np.array([i for x in rows for i in x], np.uint32)
                yield pa.RecordBatch.from_arrays([part["doc_id"], codec(model).decode(ids, bounds)], ["doc_id", "text"])
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")


def _sha(values: pa.Array) -> pa.Array:
    return pa.array([hashlib.sha256(v).hexdigest() for v in values.cast(pa.large_binary()).to_pylist()], pa.string())


def round_trip(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row: encoded,
    then decoded from those ids, without keeping either.

    Null and empty texts have no ids and decode to the empty text; a null id
    and repeated rows are listed as they are; an empty table gives an empty
    result."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for part in text_slices(batches):
            ids, ends = own.encode(part["_text"])
            listed = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids).cast(pa.string()))
            yield pa.RecordBatch.from_arrays([part["_id"], pa.array(np.diff(ends)), _sha(pc.binary_join(listed, ",")), _sha(own.decode(ids, ends))],
                                             ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return documents(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
