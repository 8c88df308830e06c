"""Phrase collocations by dynamic itemset counting.

The texts are dealt into shards, written once.  Step after step scans the
next shard, in a cycle, and counts phrases of all lengths side by side.
Single words count from the first step.  A longer phrase is active as soon
as both its subphrases, without the last and without the first word, have
reached the threshold in what has been counted of them so far; it counts for
one full cycle from then on, wherever that begins, and so over every text
exactly once.  The steps end when no phrase is active.

A step writes the counts of its own shard.  A phrase that reaches the
threshold within its cycle has a shard's share of it in one step at least:
only such phrases' counts are summed over steps.

Which phrases have reached the threshold by a step is kept in a bitmap of
fixed size, the only thing that scans are given.  It depends on the bitmaps
alone from which step on a phrase is active: another phrase's bit may begin
its cycle too early, and then it is counted in vain, but every cycle is full
and no count is missed.  Counts are of phrases as written, not of hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from priceloom.llm.common import batch_words, materialize, mix, scratch_path, text_bytes, text_slices
from priceloom.session import delete_folder, stages_in

LEAST = 100  # occurrences of a phrase
LONGEST = 5  # words of a phrase
SHARDS = 3
TOP = 2000
#: A language's phrases are ranked in so many parts before those that lead them are ranked together.
PARTS = 64
#: 2**25 bits, 4 MB a bitmap; a fuller one begins more cycles in vain.
BITMAP_BITS = 25
SCAN_BYTES = 4 << 20
#: Languages up to which their totals (a row each) are broadcast.
FEW_LANGS = 100_000

_BREAK = np.zeros(256, bool)
_BREAK[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
#: 0 for bytes of words, 1 for spaces, 2 for what ends a piece.
_KIND = bytes(1 if k in (0x20, 0x09) else 2 if _BREAK[k] else 0 for k in range(256))
_LOWER = bytes(range(256)).lower()
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _begin(lang: str) -> np.uint64:
    """What phrases of a language start their hash from."""
    return mix(batch_words(pa.array(["lang-" + lang.encode().hex()], pa.large_string()))[0])[0]


def _slots(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)


def _has(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    slot = _slots(h)
    return (bits[slot >> 6] >> (slot & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


def _blocks(text: pa.LargeStringArray, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bytes of all texts in blocks of about ``size``, and which of them
    begin a text.  Blocks are cut at texts and, in long texts, where pieces
    are, so that no phrase is cut; only a longer piece is a longer block."""
    data, bounds = text_bytes(text)
    first = np.zeros(len(data), bool)
    first[bounds[bounds < len(data)]] = True
    at = 0
    while at < len(data):
        to = min(len(data), at + size)
        while to < len(data):
            ahead = np.flatnonzero(first[to:to + size] | _BREAK[data[to:to + size]])
            if len(ahead):
                to += int(ahead[0])
                break
            to = min(len(data), to + size)
        yield data[at:to], first[at:to]
        at = to


def _words(data: np.ndarray, first: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of a block (A-Z lower-cased), each word's number in
    order, and the number of the piece that it lies in."""
    text = data.tobytes().translate(_LOWER)
    kind = np.frombuffer(text.translate(_KIND), np.uint8)
    inside = kind == 0
    new = inside.copy()
    new[1:] &= ~inside[:-1] | first[1:]
    starts = np.flatnonzero(new)
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    ends = np.zeros(len(starts) + 1, np.int64)  # of the words, without what parts them
    np.cumsum(np.flatnonzero(last) + 1 - starts, out=ends[1:])
    flat = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(np.frombuffer(text, np.uint8)[inside]))
    found = flat.dictionary_encode()
    cuts = np.searchsorted(starts, np.flatnonzero((kind == 2) | first))  # the words that they come before
    piece = np.cumsum(np.bincount(cuts, minlength=len(starts) + 1))[:len(starts)]
    return found.dictionary, found.indices.to_numpy(zero_copy_only=False).astype(np.int64), piece


def _counted(keys: np.ndarray, at: np.ndarray, number: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Of phrases of ``size`` words that begin at ``at``: a place of each
    distinct one and how often it occurs.  Equal hashes only bring phrases
    together, their words are compared."""
    found = pa.array(keys).dictionary_encode()
    group, times = found.indices.to_numpy(zero_copy_only=False), np.zeros(0, np.int64)
    heads = np.zeros(len(found.dictionary), np.int64)
    if len(at):
        times = np.bincount(group)
        heads[group[::-1]] = at[::-1]  # the first place of each is set last
    head = heads[group]
    if any((number[head + j] != number[at + j]).any() for j in range(size)):
        rows, heads, times = np.unique(np.stack([number[at + j] for j in range(size)], axis=1), axis=0, return_index=True, return_counts=True)
        heads = at[heads]
    return heads, times


def phrases_of(text: pa.LargeStringArray, lang: str, words: bool, now: np.ndarray | None, before: np.ndarray | None,
               longest: int = LONGEST, block: int = SCAN_BYTES) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """(size, phrases, times), block by block, of the phrases active by the
    bitmaps: single words if ``words``, longer ones with all subphrases in
    ``now`` and not all of them in ``before``."""
    for data, first in _blocks(text, block):
        values, number, piece = _words(data, first)
        if words and len(values):
            yield 1, values, np.bincount(number, minlength=len(values))
        if now is None or not len(values):
            continue
        own = batch_words(values)[0]
        # of the shorter phrase at each place, where it is known
        h = mix(own + _begin(lang))[number]
        known = _has(now, h)
        done = _has(before, h) if before is not None else None
        for size in range(2, min(longest, len(number)) + 1):
            n = len(number) - size + 1
            at = np.flatnonzero(known[:-1] & known[1:] & (piece[:n] == piece[size - 1:]))
            if not len(at):
                break
            hashes = mix(h[at] * _STEP + own[number[at + size - 1]])
            active, keys = at, hashes
            if done is not None:
                both = done[at] & done[at + 1]
                active, keys = at[~both], hashes[~both]
            if len(active):
                heads, times = _counted(keys, active, number, size)
                yield size, pc.binary_join_element_wise(*(values.take(pa.array(number[heads + j])) for j in range(size)), pa.scalar(" ", values.type)), times
            if size < longest:
                h[at] = hashes
                known = np.zeros(n, bool)
                known[at] = _has(now, hashes)
                if done is not None:
                    done = np.zeros(n, bool)
                    done[at[both]] = _has(before, hashes[both])


def _scan(words: bool, now, before, longest: int):
    """The scan of a shard's rows, with broadcast bitmaps."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = [b.value if b is not None else None for b in (now, before)]
        for part in text_slices(batches, limit=SCAN_BYTES):
            for lang in part["_lang"].unique().to_pylist():
                text = part["_text"].filter(pc.equal(part["_lang"], lang))
                for _, phrases, times in phrases_of(text, lang, words, *bits, longest):
                    yield pa.RecordBatch.from_arrays([pa.repeat(lang, len(phrases)), phrases.cast(pa.string()),
                                                      pa.array(times.astype(np.int64))], ["lang", "phrase", "n"])
    return run


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bitmap words and bits of phrases."""
    for batch in batches:
        own, bounds = batch_words(batch["phrase"].cast(pa.large_string()))
        langs = batch["lang"].dictionary_encode()
        h = np.array([_begin(x) for x in langs.dictionary.to_pylist()], np.uint64)[langs.indices.to_numpy(zero_copy_only=False)]
        size = np.diff(bounds)
        for j in range(int(size.max(initial=0))):
            some = size > j
            word = own[bounds[:-1][some] + j]
            h[some] = mix(h[some] + word) if j == 0 else mix(h[some] * _STEP + word)
        slot = _slots(h)
        yield pa.RecordBatch.from_arrays([pa.array(slot >> 6), pa.array((np.uint64(1) << (slot & 63).astype(np.uint64)).view(np.int64))], ["at", "bit"])


def _mark(bits: np.ndarray, reached: DataFrame) -> np.ndarray:
    """``bits`` with those of the phrases reached: a row for each 64 bits of
    the bitmap comes to the driver at most, however many phrases there are."""
    found = reached.mapInArrow(_marks, "at bigint, bit bigint").groupBy("at").agg(F.bit_or("bit").alias("bit")).toArrow()
    out = bits.copy()
    at = found["at"].to_numpy()
    out[at] |= found["bit"].to_numpy().view(np.uint64)
    return out


#: Words of a phrase: none holds a space.
_SIZE = "length(phrase) - length(replace(phrase, ' ', '')) + 1"
#: A phrase's row and bit in a table of bits, 64 a row and 2**25 in all.
_ROW = "shiftrightunsigned(xxhash64(lang, phrase), 45)"
_BIT = "shiftleft(1L, cast(xxhash64(lang, phrase) & 63 as int))"


def _often(counts: DataFrame, least: int) -> DataFrame:
    """The bits of phrases with ``least`` occurrences or more in a step."""
    return counts.filter(F.col("n") >= least).groupBy(F.expr(_ROW).alias("row")).agg(F.bit_or(F.expr(_BIT)).alias("bits"))


def _sums(counts: list[DataFrame], often: list[DataFrame], least: int) -> DataFrame:
    """(lang, size, phrase, n) of phrases with ``least`` occurrences or more in
    some steps together.  Such a phrase has its share of them in one step at
    least, which ``often`` says; other phrases' counts needn't be brought
    together.  The bits are a row for each 64 at most, however many phrases."""
    every, marked = counts[0], often[0]
    for more, marks in zip(counts[1:], often[1:]):
        every, marked = every.unionByName(more), marked.unionByName(marks)
    if len(counts) > 1:
        marked = F.broadcast(marked.groupBy("row").agg(F.bit_or("bits").alias("bits")))
        every = every.withColumn("row", F.expr(_ROW)).join(marked, "row").filter(f"bits & {_BIT} != 0") \
            .groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    return every.filter(F.col("n") >= least).select("lang", F.expr(_SIZE).alias("size"), "phrase", "n")


def frequent_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, longest: int = LONGEST,
                     shards: int = SHARDS) -> tuple[DataFrame, DataFrame]:
    """(lang, size, phrase, n) of all phrases of 1 to ``longest`` words that
    occur ``least`` times or more in a language, and (lang, n) with the number
    of word occurrences of each language.

    Phrases lie within pieces, cut at ``[.,;:!?\\x0A-\\x0D]``; words are
    ``[^\\x20\\x09]+`` with A-Z lower-cased.  Null texts have no words, a null
    language is ``und``, repeated rows count as often as they occur."""
    spark = docs.sparkSession
    context = spark.sparkContext
    folder = scratch_path(spark, "phrase-shards-" + np.random.default_rng().bytes(6).hex())
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("_lang"), F.col(text_col).cast("string").alias("_text"))
    rows.withColumn("shard", F.pmod(F.monotonically_increasing_id(), F.lit(shards)).cast("int")).write.partitionBy("shard").parquet(folder)
    texts = spark.read.schema("_lang string, _text string, shard int").parquet(folder)

    empty = np.zeros(1 << (BITMAP_BITS - 6), np.uint64)
    reached: list[np.ndarray] = []  # by the end of each step
    counts: list[DataFrame] = []  # of each step alone
    often: list[DataFrame] = []
    sums: list[DataFrame] = []
    totals, step = None, 0
    while step < shards or not np.array_equal(reached[step - 1], reached[step - 1 - shards] if step > shards else empty):
        now = context.broadcast(reached[step - 1]) if step else None
        before = context.broadcast(reached[step - 1 - shards]) if step > shards else None
        fresh = texts.filter(F.col("shard") == step % shards).select("_lang", "_text") \
            .mapInArrow(_scan(step < shards, now, before, longest), "lang string, phrase string, n bigint")
        with stages_in(f"{folder}-{step}"):
            counts.append(materialize(fresh.groupBy("lang", "phrase").agg(F.sum("n").alias("n")), "phrases"))
        often.append(materialize(_often(counts[step], -(-least // shards)), f"phrases-often-{step}"))
        # A phrase's cycle is ``shards`` steps in a row: the last ones hold all of it, or what there is so far.
        sums.append(materialize(_sums(counts[-shards:], often[-shards:], least), f"phrases-reached-{step}"))
        reached.append(_mark(reached[-1] if reached else empty, sums[step].filter(F.col("size") < longest).select("lang", "phrase")))
        if step == shards - 1:
            words = counts[0]
            for more in counts[1:]:
                words = words.unionByName(more)
            totals = materialize(words.filter("instr(phrase, ' ') = 0").groupBy("lang").agg(F.sum("n").alias("n")), "phrase-totals")
        # never looked at again
        if step > shards:
            reached[step - 1 - shards] = None
        if step >= shards - 1:
            delete_folder(spark, f"{folder}-{step - shards + 1}")
        for b in (now, before):
            if b is not None:
                b.unpersist()
        step += 1
    found = sums[0]
    for more in sums[1:]:
        found = found.unionByName(more)
    # sums from before or after the end of a phrase's cycle are parts of the one at its end
    found = found.groupBy("lang", "size", "phrase").agg(F.max("n").alias("n"))
    return materialize(found, "frequent-phrases"), totals


#: Products may pass 64 bits: decimals of 38 digits, and a division that cuts off.
_SCORE = """(cast(1000 * a as decimal(19, 0)) * cast(n as decimal(19, 0)))
            div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))"""


def score_cuts(found: DataFrame, totals: DataFrame) -> DataFrame:
    """lang, phrase, size, a, l, r, n, score of every phrase of two words or
    more, at its cut of the lowest score (ties: the earliest)."""
    words = F.split("phrase", " ")
    long = found.filter("size > 1").select("lang", "phrase", "size", F.col("n").alias("a"), words.alias("w"))
    cuts = long.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", "size", "a", "k", F.array_join(F.expr("slice(w, 1, k)"), " ").alias("first"),
        F.array_join(F.expr("slice(w, k + 1, size - k)"), " ").alias("rest"))
    if totals.count() <= FEW_LANGS:
        totals = F.broadcast(totals)
    left = found.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    right = found.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    rated = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(totals, "lang").withColumn("score", F.expr(_SCORE))
    best = F.min(F.struct("score", "k", "l", "r", "n", "a", "size")).alias("b")
    return rated.groupBy("lang", "phrase").agg(best).select("lang", "phrase", *[F.col(f"b.{x}").alias(x) for x in ("size", "a", "l", "r", "n", "score")])


def drop_covered(rated: DataFrame) -> DataFrame:
    """Without phrases that lie inside a longer one found as often.

    Any such longer phrase has a part, one word longer than the phrase, that
    occurs as often as both: looking one word further is enough."""
    longer = rated.filter("size > 2").withColumn("w", F.split("phrase", " "))
    parts = longer.select("lang", "a", F.explode(F.array(F.expr("slice(w, 1, size - 1)"), F.expr("slice(w, 2, size - 1)"))).alias("w"))
    covers = parts.groupBy("lang", F.array_join("w", " ").alias("phrase")).agg(F.max("a").alias("longer"))
    return rated.join(covers, ["lang", "phrase"], "left").filter(F.coalesce(F.col("longer"), F.lit(0)) < F.col("a")).drop("longer")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, longest: int = LONGEST,
                 top: int = TOP, shards: int = SHARDS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's phrases of the
    highest scores (ties: more occurrences, then byte order).

    An empty table, null or empty texts and rare words give no rows; a null
    language is ``und``; other columns of the input are not looked at."""
    rated = materialize(score_cuts(*frequent_phrases(docs, text_col, lang_col, least, longest, shards)), "phrase-scores")
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    # a language's first ones are among the first of each of its parts, which are ranked apart
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    first = drop_covered(rated).withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    ranked = first.filter(F.col("rank") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))) \
        .filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
