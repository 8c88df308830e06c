"""Token ids in Arrow files of equal-length sequences.

Documents are range-partitioned and sorted by id; each task tokenises its
range and writes two Arrow IPC files: the token stream cut into sequences of
``length`` ids (a fixed-size list each, with a mask that is false on the
padding of the file's last sequence), and an index with every document's id
and number of tokens.  A batch's buffers are the ids themselves, so a reader
that maps the file gets any sequence without copying or decoding.

A task attempt writes files of its own name; only those that the manifest
of the finished job names are read, so lost or repeated attempts leave
nothing behind that counts.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from priceloom.llm.chunk_table import ChunkTable, distinct, text_sums
from priceloom.llm.common import documents, materialize, scratch_path, text_slices

SEQUENCE = 2048  # ids in a sequence
BATCH = 256  # sequences in a record batch
LINE = 500  # chunks encoded side by side
_SAFE = re.compile(r" (?=\S)")
# a space before another white-space character or the end is no place to cut
_UNSAFE = r" ([\s\p{Z}\x{85}\x{1c}-\x{1f}]|$)"


class Encoder:
    """Exact ids of a byte-level BPE tokenizer, by distinct chunks.

    Its pre-tokenizer never joins what precedes a space with a word that
    follows it, so texts are cut before every space that a non-blank
    character follows, and each distinct chunk is encoded once."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        if type(self.tok.pre_tokenizer).__name__ != "ByteLevel" or self.tok.normalizer is not None:
            raise ValueError("only byte-level BPE without a normalizer can be cut at spaces")
        self.dtype = np.uint16 if self.tok.get_vocab_size() <= 1 << 16 else np.uint32
        self._rest = ChunkTable(self._encode_rest, self.dtype)
        self._opens = np.array([(self.tok.id_to_token(i) or "").startswith("Ġ") for i in range(self.tok.get_vocab_size())])
        self._first = ChunkTable(self._encode, self.dtype)

    def _encode(self, chunks: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(chunks, add_special_tokens=False)]

    def _encode_rest(self, chunks: list[str]) -> list[list[int]] | tuple[np.ndarray, np.ndarray]:
        """Chunks after a space.  Without a space inside, they are encoded
        side by side: no token reaches over the space before the next one,
        and of a chunk's tokens the first alone begins with a space."""
        if any(" " in c for c in chunks):
            return self._encode([" " + c for c in chunks])
        lines = [" " + " ".join(chunks[k:k + LINE]) for k in range(0, len(chunks), LINE)]
        ids = np.concatenate([np.array(x, self.dtype) for x in self._encode(lines)])
        starts = np.flatnonzero(self._opens[ids])
        if len(starts) != len(chunks):
            return self._encode([" " + c for c in chunks])
        return ids, np.diff(np.append(starts, len(ids)))

    def encode(self, text: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a line, and each text's bounds."""
        if pc.any(pc.match_substring_regex(text, _UNSAFE)).as_py():
            chunks = pa.array([_SAFE.split(t) for t in text.to_pylist()], pa.large_list(pa.large_string()))
        else:
            chunks = pc.split_pattern(text, " ")
        bounds = chunks.offsets.to_numpy().astype(np.int64)
        flat = chunks.values.slice(bounds[0], bounds[-1] - bounds[0])
        bounds = bounds - bounds[0]
        # a text's first chunk has no space before it
        head = np.zeros(len(flat), bool)
        head[bounds[:-1]] = True
        values, place = distinct(flat.filter(pa.array(~head)))
        rest, rest_len = self._rest.gather(self._rest.rows(values)[place])
        values, place = distinct(flat.filter(pa.array(head)))
        first, first_len = self._first.gather(self._first.rows(values)[place])
        lens = np.zeros(len(flat), np.int64)
        lens[head], lens[~head] = first_len, rest_len
        ids = np.empty(int(lens.sum()), self.dtype)
        owner = np.repeat(head, lens)
        ids[owner], ids[~owner] = first, rest
        return ids, text_sums(lens, bounds)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _schema(dtype, length: int) -> pa.Schema:
    return pa.schema([("ids", pa.list_(pa.from_numpy_dtype(dtype), length)), ("mask", pa.list_(pa.bool_(), length))])


def _sequences(schema: pa.Schema, ids: np.ndarray, length: int) -> pa.RecordBatch:
    rows = -(-len(ids) // length)
    padded = np.zeros(rows * length, ids.dtype)
    padded[:len(ids)] = ids
    mask = np.arange(rows * length) < len(ids)
    return pa.RecordBatch.from_arrays([pa.FixedSizeListArray.from_arrays(pa.array(padded), length),
                                       pa.FixedSizeListArray.from_arrays(pa.array(mask), length)], schema=schema)


_MANIFEST = "part int, tokens_path string, index_path string, n_docs bigint, n_tokens bigint"


def write_tokens(docs: DataFrame, tokenizer: str, folder: str, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = 0, length: int = SEQUENCE) -> DataFrame:
    """Writes all documents to ``folder`` in ascending id order (null ids
    first) and returns the manifest, a row per file in that order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, store, base = encoder(tokenizer), *fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        part = TaskContext.get().partitionId()
        stem = f"part-{part:06d}-{uuid.uuid4().hex[:12]}"
        paths = [f"{stem}-tokens.arrow", f"{stem}-index.arrow"]
        schema, index = _schema(own.dtype, length), pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64())])
        n_docs = n_tokens = 0
        held: list[np.ndarray] = []
        waiting, full = 0, BATCH * length
        with store.open_output_stream(f"{base}/{paths[0]}") as out, store.open_output_stream(f"{base}/{paths[1]}") as out2, \
                pa.ipc.new_file(out, schema) as tokens, pa.ipc.new_file(out2, index) as places:
            for piece in text_slices(batches):
                ids, ends = own.encode(piece["_text"])
                n = np.diff(ends) + 1
                line = np.insert(ids, ends[1:], end_id)
                places.write_batch(pa.RecordBatch.from_arrays([piece["_id"], pa.array(n)], schema=index))
                n_docs, n_tokens = n_docs + len(n), n_tokens + len(line)
                held.append(line)
                waiting += len(line)
                if waiting >= full:
                    line = np.concatenate(held)
                    whole = len(line) // full * full
                    for at in range(0, whole, full):
                        tokens.write_batch(_sequences(schema, line[at:at + full], length))
                    held, waiting = [line[whole:]], len(line) - whole
            if waiting:
                tokens.write_batch(_sequences(schema, np.concatenate(held), length))
        if n_docs:
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), *[pa.array([f"{folder}/{p}"]) for p in paths],
                                              pa.array([n_docs]), pa.array([n_tokens])],
                                             ["part", "tokens_path", "index_path", "n_docs", "n_tokens"])

    rows = documents(docs, id_col, text_col).repartitionByRange(F.col("_id")).sortWithinPartitions("_id")
    return materialize(rows.mapInArrow(run, _MANIFEST), "token-manifest")


def _opened(path: str):
    store, name = fs.FileSystem.from_uri(path)
    if isinstance(store, fs.LocalFileSystem):
        return pa.memory_map(name)  # batches are views of the file
    return store.open_input_file(name)


def token_chunks(tokens_path: str) -> Iterator[np.ndarray]:
    """The ids of a file, batch by batch, without the padding."""
    with _opened(tokens_path) as f:
        reader = pa.ipc.open_file(f)
        for k in range(reader.num_record_batches):
            batch = reader.get_batch(k)
            ids = batch["ids"].flatten().to_numpy()
            if k == reader.num_record_batches - 1:
                ids = ids[batch["mask"].flatten().to_numpy(zero_copy_only=False)]
            yield ids


def sequence(tokens_path: str, k: int, batch: int = BATCH) -> tuple[np.ndarray, np.ndarray]:
    """Ids and mask of a file's k-th sequence, by its place alone."""
    with _opened(tokens_path) as f:
        rows = pa.ipc.open_file(f).get_batch(k // batch)
        return rows["ids"][k % batch].values.to_numpy().copy(), rows["mask"][k % batch].values.to_numpy(zero_copy_only=False)


def read_tokens(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with _opened(row["index_path"]) as f:
                    index = pa.ipc.open_file(f).read_all()
                n = index["n_tokens"].to_numpy()
                ends = np.cumsum(n)
                sums, doc, at = np.zeros(len(n), np.int64), 0, 0
                for ids in token_chunks(row["tokens_path"]):
                    ids, to = ids.astype("<u4"), at + len(ids)
                    while doc < len(n) and at < to:
                        upto = min(to, int(ends[doc]))
                        sums[doc] = zlib.crc32(ids[len(ids) - (to - at):len(ids) - (to - upto)], int(sums[doc]))
                        at = upto
                        doc += at == ends[doc]
                if at != (ends[-1] if len(ends) else 0) or len(n) != row["n_docs"]:
                    raise ValueError(f"{row['tokens_path']} does not hold what its index says")
                out = pa.table({"doc_id": index["doc_id"], "start": row["offset"] + ends - n, "n_tokens": n, "ids_crc32": sums})
                yield from out.to_batches(max_chunksize=10_000)

    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    placed = manifest.withColumn("offset", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    # a given number of partitions isn't coalesced, small as the rows are
    return placed.repartition(max(1, manifest.count()), "part").mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_round_trip(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                     folder: str | None = None) -> DataFrame:
    """Writes all documents and returns what the files hold of each.

    Null and empty texts have the end id only; null ids come first; repeated
    rows are written as often as they occur, rows of one id in any order; an
    empty table writes no file and gives an empty result."""
    folder = folder or scratch_path(docs.sparkSession, f"tokens-{uuid.uuid4().hex[:12]}")
    return read_tokens(write_tokens(docs, tokenizer, folder, id_col, text_col))
