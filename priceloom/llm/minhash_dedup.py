"""Near-duplicate documents by SetSketch registers.

1. Each text's set of five-word shingles is hashed and sketched in one pass:
   a register is the minimum of exponential values over the set, on a scale
   of powers of ``SCALE`` truncated to 16 bits.  Registers of a union are
   the element-wise maximum, and two sets agree in a register with about
   the chance of their Jaccard similarity.
2. Documents with equal sets form one class; from here on a class is one
   node.  The class table is one row per class, aggregated map-side.
3. Nodes that agree on some band (``BAND`` chosen registers) are candidates.
   A few bands give every node the leaders of its buckets; these pairs, a
   bounded number per node, are verified and contract large groups first.
4. All bands then: only buckets that still hold more than one component are
   looked at.  A bucket is cut into blocks; each pair of blocks is one unit
   of work, so no bucket is ever gathered in a task.  Of the pairs of
   different components, those go whose parity bits differ in more places
   than a pair at the threshold has elements in one set only (no link is
   lost by that).  The others are estimated jointly from both sketches by
   likelihood, and those that may reach the threshold are verified on the
   full sets.

A pair at the very threshold shares no band with a chance of about 1e-6,
and falls to the likelihood test with less.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from priceloom.llm.common import batch_words, documents, materialize, mix, text_slices
from priceloom.llm.components import components

SHINGLE = 5
PERCENT = 75  # least similarity, in hundredths
REGISTERS = 192
SCALE = 1.001
RATE = 20.0
BAND, BANDS, FIRST_BANDS = 6, 96, 16
BLOCK = 1024  # members of a bucket compared at once
FEW = 90  # agreeing registers: with fewer the likelihood test drops a pair in any case
TRIES = (1, 4, FIRST_BANDS)  # leaders a node is compared with, by the end of each contraction round
PARITY_BITS = 2048
DOUBT = 20.0  # log-likelihood by which "below the threshold" must win to drop a pair

_RNG = np.random.default_rng(20)
_FACTORS = (_RNG.integers(1, 1 << 63, REGISTERS, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_CHOSEN = np.stack([_RNG.permutation(REGISTERS)[:BAND] for _ in range(BANDS)])
_SALT = mix(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_BAND_BITS = np.uint64(127)  # the lowest bits of a bucket's key say which band it is of
_PLACE = mix(np.arange(1, 64, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingle_hashes(text: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all texts' shingles (with repeats) and each text's bounds.
    A text of fewer words has its whole sequence as its only shingle."""
    words, bounds = batch_words(text)
    n = np.diff(bounds)
    count = np.where(n >= SHINGLE, n - SHINGLE + 1, (n > 0).astype(np.int64))
    out = np.zeros(int(count.sum()), np.uint64)
    ends = np.concatenate([[0], np.cumsum(count)])
    # k-th shingle of a text starts at its k-th word
    start = np.repeat(bounds[:-1] - ends[:-1], count) + np.arange(len(out))
    length = np.repeat(np.minimum(n, SHINGLE), count)
    for k in range(SHINGLE):
        inside = length > k
        out[inside] += words[start[inside] + k] * _PLACE[k]
    return mix(out + _PLACE[10 + length]) if len(out) else out, ends


def _distinct(h: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sets = [np.unique(h[a:b]) for a, b in zip(ends[:-1], ends[1:])]
    sizes = np.array([len(s) for s in sets], np.int64)
    return (np.concatenate(sets) if sets else h), np.concatenate([[0], np.cumsum(sizes)])


def sketch(h: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Registers (sets x REGISTERS, uint16) of non-empty sets."""
    least = np.empty((len(ends) - 1, REGISTERS), np.uint64)
    buf = np.empty(len(h), np.uint64)
    for r in range(REGISTERS):
        np.multiply(h, _FACTORS[r], out=buf)
        least[:, r] = np.minimum.reduceat(buf, ends[:-1])
    u = (least >> np.uint64(11)).astype(np.float64) * 2.0 ** -53
    x = -np.log1p(-u) / RATE
    k = np.floor(1.0 - np.log(np.maximum(x, 1e-300)) / math.log(SCALE))
    return np.clip(k, 0, 65535).astype(np.uint16)


def parities(h: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Packed bits (sets x PARITY_BITS / 8): each element flips one bit.  Two
    sets' bits differ in at most as many places as there are elements that
    only one of them has."""
    n = len(ends) - 1
    bit = (mix(h ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(PARITY_BITS)).astype(np.int64)
    owner = np.repeat(np.arange(n, dtype=np.int64), np.diff(ends))
    flips = np.bincount(owner * PARITY_BITS + bit, minlength=n * PARITY_BITS)
    return np.packbits((flips & 1).astype(np.uint8).reshape(n, PARITY_BITS), axis=1)


def within_bound(p1: np.ndarray, p2: np.ndarray, n1: np.ndarray, n2: np.ndarray) -> np.ndarray:
    """False only for pairs that have too many elements of one set only."""
    apart = np.bitwise_count(p1 ^ p2).sum(axis=1, dtype=np.int64)
    return (100 + PERCENT) * apart <= (100 - PERCENT) * (n1 + n2)


def _digests(h: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    a = np.add.reduceat(mix(h), ends[:-1])
    b = np.add.reduceat(mix(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)) * (h | np.uint64(1)), ends[:-1])
    return mix(a).view(np.int64), mix(b).view(np.int64)


_SKETCHES = "_id bigint, n bigint, d1 bigint, d2 bigint, regs binary, odd binary"


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in text_slices(batches):
        h, ends = _distinct(*shingle_hashes(part["_text"]))
        n = np.diff(ends)
        full = np.flatnonzero(n)
        d1, d2 = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
        regs: list = [None] * len(n)
        odd: list = [None] * len(n)
        if len(full):
            at = np.concatenate([ends[:-1][full], ends[-1:]])
            d1[full], d2[full] = _digests(h, at)
            for i, row, bits in zip(full, sketch(h, at), parities(h, at)):
                regs[i], odd[i] = row.tobytes(), bits.tobytes()
        yield pa.RecordBatch.from_arrays([part["_id"], pa.array(n), pa.array(d1), pa.array(d2), pa.array(regs, pa.binary()),
                                          pa.array(odd, pa.binary())], ["_id", "n", "d1", "d2", "regs", "odd"])


def _registers(column: pa.Array) -> np.ndarray:
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, np.uint16).reshape(len(column), REGISTERS)


def _bands(first: int) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                regs = _registers(part["regs"]).astype(np.uint64)
                keys = np.empty((len(regs), first), np.uint64)
                for t in range(first):
                    key = mix((regs[:, _CHOSEN[t]] * _PLACE[:BAND]).sum(axis=1, dtype=np.uint64) + _SALT[t])
                    keys[:, t] = (key & ~_BAND_BITS) | np.uint64(t)
                names = [x for x in part.schema.names if x != "regs"]
                cols = [pa.array(np.repeat(part[x].to_numpy(zero_copy_only=False), first)) for x in names]
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), *cols], ["key", *names])
    return run


def log_likelihood(agree: np.ndarray, above: np.ndarray, below: np.ndarray, n1: np.ndarray, n2: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Of similarity j, given how many registers agree, are larger in the
    first and larger in the second set, and the sets' sizes."""
    u, v = n1 / (n1 + n2), n2 / (n1 + n2)
    p = lambda x: -np.log1p(-np.clip(x, 0, 1) * (SCALE - 1) / SCALE) / math.log(SCALE)
    up, down = p(u - v * j), p(v - u * j)
    safe = lambda q: np.log(np.maximum(q, 1e-12))
    return agree * safe(1 - up - down) + above * safe(up) + below * safe(down)


def may_reach(r1: np.ndarray, r2: np.ndarray, n1: np.ndarray, n2: np.ndarray) -> np.ndarray:
    """False only where sizes rule the threshold out, or a lower similarity
    is more likely by far."""
    n1, n2 = n1.astype(np.float64), n2.astype(np.float64)
    agree = (r1 == r2).sum(axis=1)
    out = (np.minimum(n1, n2) * 100 >= PERCENT * np.maximum(n1, n2)) & (agree >= FEW)
    k = np.flatnonzero(out)
    out[k] = _likely(r1[k], r2[k], n1[k], n2[k], agree[k])
    return out


def _likely(r1: np.ndarray, r2: np.ndarray, n1: np.ndarray, n2: np.ndarray, agree: np.ndarray) -> np.ndarray:
    above = (r1 > r2).sum(axis=1)
    below = REGISTERS - agree - above
    at = log_likelihood(agree, above, below, n1, n2, np.full(len(n1), PERCENT / 100))
    best = at
    for j in np.arange(0.0, PERCENT / 100, 0.03):
        best = np.maximum(best, log_likelihood(agree, above, below, n1, n2, np.full(len(n1), j)))
    return best - at <= DOUBT


_PAIRS = "a bigint, b bigint"


def _block_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, i, j): pairs of different components that may
    reach the threshold.  A unit holds at most two blocks."""
    held: pa.Table | None = None

    def pairs(t: pa.Table) -> Iterator[pa.RecordBatch]:
        key = np.stack([t[x].to_numpy() for x in ("key", "i", "j")], axis=1)
        cuts = np.concatenate([[0], np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1, [len(key)]])
        node, comp, n, blk = (t[x].to_numpy() for x in ("node", "comp", "n", "blk"))
        regs = np.frombuffer(b"".join(t["regs"].to_pylist()), np.uint16).reshape(-1, REGISTERS)
        odd = np.frombuffer(b"".join(t["odd"].to_pylist()), np.uint64).reshape(-1, PARITY_BITS // 64)
        left, right = [], []
        for a, b in zip(cuts[:-1], cuts[1:]):
            x, y = np.triu_indices(b - a, 1)
            x, y = x + a, y + a
            cross = comp[x] != comp[y]
            if key[a, 1] != key[a, 2]:  # two blocks: pairs within one belong to its own unit
                cross &= blk[x] != blk[y]
            left.append(x[cross])
            right.append(y[cross])
        x, y = np.concatenate(left), np.concatenate(right)
        for at in range(0, len(x), 20000):
            p, q = x[at:at + 20000], y[at:at + 20000]
            near = within_bound(odd[p], odd[q], n[p], n[q])
            p, q = p[near], q[near]
            ok = np.flatnonzero(may_reach(regs[p], regs[q], n[p], n[q]))
            # a pair meets in every bucket it shares: only the first band's passes it on
            same = regs[p[ok]] == regs[q[ok]]
            shared = np.stack([same[:, chosen].all(axis=1) for chosen in _CHOSEN], axis=1)
            ok = ok[shared.any(axis=1) & (shared.argmax(axis=1) == (key[p[ok], 0] & 127))]
            if len(ok):
                u, v = node[p[ok]], node[q[ok]]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], ["a", "b"])

    for batch in batches:
        t = pa.Table.from_batches([batch])
        held = t if held is None else pa.concat_tables([held, t])
        if held.num_rows < 4 * BLOCK:
            continue
        k = [held[x].to_numpy() for x in ("key", "i", "j")]
        differs = np.flatnonzero((k[0] != k[0][-1]) | (k[1] != k[1][-1]) | (k[2] != k[2][-1]))
        done = int(differs[-1]) + 1 if len(differs) else 0
        if done:
            yield from pairs(held.slice(0, done).combine_chunks())
            held = held.slice(done)
    if held is not None and held.num_rows:
        yield from pairs(held.combine_chunks())


def _set_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in text_slices(batches):
        h, ends = _distinct(*shingle_hashes(part["_text"]))
        keep = np.flatnonzero(np.diff(ends))
        part = part.take(pa.array(keep))
        if not len(keep):
            continue
        d1, d2 = _digests(h, np.concatenate([ends[:-1][keep], ends[-1:]]))
        offsets = pa.array(np.concatenate([ends[:-1][keep], ends[-1:]]).astype(np.int32))
        sets = pa.ListArray.from_arrays(offsets, pa.array(h.view(np.int64)))
        yield pa.RecordBatch.from_arrays([part["_id"], pa.array(d1), pa.array(d2), sets], ["_id", "d1", "d2", "items"])


def _verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose full sets reach the threshold."""
    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    rep = nodes.join(wanted, "node").select("node", F.col("rep").alias("_id"), "d1", "d2")
    texts = docs.join(rep.select("_id").distinct(), "_id", "left_semi")
    sets = texts.mapInArrow(_set_batches, "_id bigint, d1 bigint, d2 bigint, items array<bigint>")
    # an id can be listed twice with other texts: the digests say which is meant
    sets = materialize(sets.join(rep, ["_id", "d1", "d2"]).select("node", "items").dropDuplicates(["node"]), "near-sets")
    both = (pairs.join(sets.select(F.col("node").alias("a"), F.col("items").alias("x")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("items").alias("y")), "b"))
    common = both.select("a", "b", F.size(F.array_intersect("x", "y")).alias("i"), (F.size("x") + F.size("y")).alias("s"))
    return common.where(F.col("i").cast("bigint") * 100 >= PERCENT * (F.col("s") - F.col("i"))).select(F.col("a").alias("u"), F.col("b").alias("v"))


def _leaders(nodes: DataFrame) -> DataFrame:
    """(a, b, rank): each node b with the leaders of its buckets in the first
    bands, those it shares most of them with first; FIRST_BANDS at most."""
    rows = nodes.select("node", "regs").mapInArrow(_bands(FIRST_BANDS), "key bigint, node bigint")
    lead = rows.groupBy("key").agg(F.min("node").alias("lead"), F.max("node").alias("most")).where("lead < most").select("key", "lead")
    votes = rows.join(lead, "key").where("node > lead").groupBy("node", "lead").agg(F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("n"), "lead"))
    return materialize(votes.select(F.col("lead").alias("a"), F.col("node").alias("b"), rank.alias("rank")), "near-leaders")


def _contracted(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, component) by verified links that tie most of every large group
    together, from a bounded number of comparisons per node."""
    leaders, label, tried = _leaders(nodes), None, 0
    for tries in TRIES:
        pairs = leaders.where((F.col("rank") > tried) & (F.col("rank") <= tries)).select("a", "b")
        if label is not None:  # not those that are already tied
            side = lambda x: label.select(F.col("node").alias(x), F.col("component").alias(f"_{x}"))  # noqa: E731,B023
            pairs = pairs.join(side("a"), "a", "left").join(side("b"), "b", "left").where(
                F.coalesce("_a", "a") != F.coalesce("_b", "b")).select("a", "b")
        links = materialize(_verified(materialize(pairs, "near-pairs"), nodes, docs), "near-links")
        label, tried = materialize(components(links, label), "near-label"), tries
    return label


def _rest_pairs(nodes: DataFrame, label: DataFrame) -> DataFrame:
    """Pairs of different components that share any band and may reach the threshold."""
    spark = nodes.sparkSession
    known = nodes.select("node", "n", "regs", "odd").join(label, "node", "left").select(
        "node", "n", "regs", "odd", F.coalesce("component", "node").alias("comp"))
    rows = known.select("node", "comp", "regs").mapInArrow(_bands(BANDS), "key bigint, node bigint, comp bigint")
    mixed = (rows.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("size"))
             .where("lo != hi").select("key", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")))
    members = materialize(rows.join(mixed, "key"), "near-buckets")
    own = members.withColumn("blk", F.pmod(F.xxhash64("node", "key"), F.col("blocks").cast("bigint")).cast("int"))
    units = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    units = units.select("key", F.least("blk", "other").alias("i"), F.greatest("blk", "other").alias("j"), "blk", "node", "comp")
    units = units.join(known.select("node", "n", "regs", "odd"), "node")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = units.repartition(parts, "key", "i", "j").sortWithinPartitions("key", "i", "j")
    return dealt.select("key", "i", "j", "blk", "node", "comp", "n", "regs", "odd").mapInArrow(_block_pairs, _PAIRS)


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every input row.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased.  Null, empty and
    word-less texts have no shingles and link with nothing.  A row with a
    null id is listed, links with nothing and isn't kept; a repeated row is
    listed as often as it occurs.  An empty table gives an empty result."""
    texts = documents(docs, id_col, text_col)
    rows = materialize(texts.mapInArrow(_sketch_batches, _SKETCHES), "near-sketches")
    classes = (rows.where("n > 0 and _id is not null").groupBy("d1", "d2", "n")
               .agg(F.min("_id").alias("rep"), F.first("regs").alias("regs"), F.first("odd").alias("odd")))
    nodes = materialize(classes.withColumn("node", F.monotonically_increasing_id()), "near-nodes")
    first = _contracted(nodes, texts)
    rest = materialize(_rest_pairs(nodes, first), "near-pairs")
    label = components(materialize(_verified(rest, nodes, texts), "near-links"), first)
    named = nodes.select("node", "rep", "d1", "d2", "n").join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
    # written, so that the join is one of two plain shuffles, whose hot component adaptive execution splits
    least = materialize(named.groupBy("component").agg(F.min("rep").alias("component_id")), "near-least")
    named = named.join(least, "component").select("d1", "d2", "n", "component_id")
    out = rows.where("n > 0 and _id is not null").select("_id", "n", "d1", "d2").join(named, ["d1", "d2", "n"]).select("_id", "n", "component_id")
    alone = rows.where("n = 0 or _id is null").select("_id", "n", F.col("_id").alias("component_id"))
    return out.unionByName(alone).select(F.col("_id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id",
                                         F.coalesce(F.col("_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one document of each group, with all
    their columns; rows without an id stay."""
    goes = near_dedup(docs, id_col, text_col).where("not kept and doc_id is not null").select(F.col("doc_id").alias("_gone"))
    return docs.join(goes, F.col(id_col).cast("bigint") == F.col("_gone"), "left_anti")
