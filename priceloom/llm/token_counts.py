"""Token counts by heap-and-linked-list byte-pair merging.

A pre-token's bytes are a linked list of symbols; a heap holds the ranks of
its adjacent pairs.  The lowest-ranked pair that still stands is popped and
merged until none is left, so a pre-token has as many tokens as it had
symbols less the merges made.  No token ids are produced.

Pre-tokens of the tokenizers handled here never hold white space, so a
text's count is the sum of those of its chunks between ASCII white space;
a worker merges each distinct chunk once while its table, of bounded size,
holds it.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from priceloom.llm.chunk_table import TABLE_CHUNKS, distinct
from priceloom.llm.common import documents, text_slices

#: Longer chunks are merged anew each time rather than kept in the table.
KEPT_CHARS = 100
_PLACE = (1 << 40) - 1
# letters that every Unicode version has and that composition leaves alone
_PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,]?)")


class PairMerger:
    """Number of tokens of a pre-token under a byte-pair model."""

    def __init__(self, model: dict):
        if model["type"] != "BPE" or model.get("dropout") or model.get("ignore_merges") or model.get("byte_fallback") \
                or model.get("continuing_subword_prefix"):
            raise ValueError("only plain byte-pair models can be counted by merging")
        vocab, self._end = model["vocab"], model.get("end_of_word_suffix") or ""
        pairs = (tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"])
        #: (left, right) -> (rank, merged symbol); no two pairs share a rank
        self._pairs = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)}
        # how a byte-level vocabulary writes bytes: printable ones as themselves, the others from 256 on
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        written = {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}
        if not all(c in vocab and c + self._end in vocab for c in written.values()):
            raise ValueError("the vocabulary lacks single bytes")
        self._inner = [vocab[written[b]] for b in range(256)]
        self._last = [vocab[written[b] + self._end] for b in range(256)]
        self._byte = {c: b for b, c in written.items()}

    def raw(self, piece: str) -> bytes:
        """The bytes of a pre-token in the vocabulary's writing."""
        return bytes(map(self._byte.__getitem__, piece))

    def count(self, data: bytes) -> int:
        n = len(data)
        if n < 2:
            return n
        symbol = [self._inner[b] for b in data]
        symbol[-1] = self._last[data[-1]]
        pairs = self._pairs.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        # an entry is a pair's rank and, among equal ones, its place, as one number
        for at in range(n - 1):
            if found := pairs((symbol[at], symbol[at + 1])):
                heap.append(found[0] << 40 | at)
        heapify(heap)
        merges = 0
        while heap:
            entry = heappop(heap)
            at = entry & _PLACE
            follows = after[at]
            found = pairs((symbol[at], symbol[follows])) if follows < n else None
            if found is None or found[0] != entry >> 40:
                continue  # one of the two has been merged since
            merged = symbol[at] = found[1]
            symbol[follows] = -1
            merges += 1
            follows = after[at] = after[follows]
            if follows < n:
                before[follows] = at
                if found := pairs((merged, symbol[follows])):
                    heappush(heap, found[0] << 40 | at)
            ahead = before[at]
            if ahead >= 0 and (found := pairs((symbol[ahead], merged))):
                heappush(heap, found[0] << 40 | ahead)
        return n - merges


class Counter:
    """Exact token counts of whole texts for one tokenizers file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        self._merger = PairMerger(config["model"])
        self._normalizer, self._pre = tok.normalizer, tok.pre_tokenizer
        special = [t["content"] for t in config["added_tokens"]]
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] or re.search(r"\s", t["content"]) for t in config["added_tokens"]):
            raise ValueError("added tokens of this kind can't be found chunk by chunk")
        self._special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        probe = " \t\n\v\f\rb.  Ü "
        if self._pieces(probe) != [b"b", b".", "ü".encode()]:
            raise ValueError("pre-tokens of this tokenizer hold white space or upper-case letters")
        self._pieces_seen: dict[bytes, int] = {}
        self._chunks: dict[str, int] = {}

    def _pieces(self, text: str) -> list[bytes]:
        """Pre-tokens as the library cuts them, each as its bytes."""
        if self._normalizer is not None:
            text = self._normalizer.normalize_str(text)
        return [self._merger.raw(p) for p, _ in self._pre.pre_tokenize_str(text)]

    def _piece(self, data: bytes) -> int:
        n = self._pieces_seen.get(data)
        if n is None:
            n = self._merger.count(data)
            if len(data) <= KEPT_CHARS:
                if len(self._pieces_seen) > TABLE_CHUNKS:
                    self._pieces_seen.clear()
                self._pieces_seen[data] = n
        return n

    def _chunk(self, chunk: str) -> int:
        plain = _PLAIN.fullmatch(chunk)
        if plain:
            return self._piece(plain[1].lower().encode()) + (1 if plain[2] else 0)
        if self._special is None:
            return sum(map(self._piece, self._pieces(chunk)))
        # a special string is one token; what lies between is normalised on its own
        return len(self._special.findall(chunk)) + sum(self._piece(p) for part in self._special.split(chunk) if part for p in self._pieces(part))

    def counts(self, text: pa.LargeStringArray) -> np.ndarray:
        """Tokens of each text."""
        chunks = pc.ascii_split_whitespace(text)
        bounds = chunks.offsets.to_numpy().astype(np.int64)
        values, place = distinct(chunks.values.slice(bounds[0], bounds[-1] - bounds[0]))
        if len(self._chunks) > TABLE_CHUNKS:
            self._chunks.clear()
        n = np.fromiter(map(self._chunks.get, values, repeat(-1)), np.int64, len(values))
        for k in np.flatnonzero(n < 0).tolist():
            n[k] = self._chunk(values[k])
            if len(values[k]) <= KEPT_CHARS:
                self._chunks[values[k]] = int(n[k])
        return np.diff(np.concatenate([[0], np.cumsum(n[place])])[bounds - bounds[0]])


_COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """The worker's counter of a tokenizer; its tables serve all tasks there."""
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row, without a shuffle.

    Null and empty texts have no bytes and no tokens; a null id and repeated
    rows are listed as they are; an empty table gives an empty result; other
    columns of the input are not looked at."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(tokenizer)
        for part in text_slices(batches):
            text = part["_text"]
            n = own.counts(text)
            yield pa.RecordBatch.from_arrays([part["_id"], pc.binary_length(text).cast(pa.int64()), pa.array(n), pa.array(n > limit)],
                                             ["doc_id", "n_bytes", "n_tokens", "over_limit"])
    return documents(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")
