"""Periodic runs of words, by an online sparse diagonal DP.

A text's words are compared with themselves: the pairs (i, i - lag) of equal
words lie on the diagonal of that lag, and a stretch of matches on it is a
stretch of words with that period.  Going through the words, each one's
earlier occurrences lengthen the match of their lag; a diagonal that gets no
match at a word ends there, and its stretch is a run if it is long enough.

Of a word's earlier occurrences only those can matter whose context recurs
as well.  Lags are taken by scale, [2^k, 2^(k+1)).  A run of such a period
has at least four periods, so the last 3 * 2^k words before some place in it
occur one period earlier, and nowhere nearer: as long as a period or longer,
they recur inside a run by whole periods only.  So at each scale a word has
one earlier occurrence that counts, the nearest one of the 3 * 2^k words
that end there, and of the lags of a scale at most one is active.  A text of
n words takes O(n log n) steps, however often its words occur.

These nearest occurrences come from sorting numbered word sequences, in
which equal numbers mean equal words (no hashing); a scale only looks at
sequences whose halves occur twice in their text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from priceloom.llm.common import documents, text_slices

LEAST_WORDS = 6  # of a run
LEAST_PERIODS = 4  # the scales above rely on four or more


def _grouped(keys: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For sequences with these keys, ending at the ascending places ``at``:
    a number for each distinct key, the place of the nearest earlier equal one
    (-1: none) and whether there is any other."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    number, earlier, twice = np.zeros(len(keys), np.int64), np.full(len(keys), -1), np.zeros(len(keys), bool)
    if len(keys):
        number[order] = np.concatenate([[0], np.cumsum(~same)])
        earlier[order[1:][same]] = at[order[:-1][same]]
        twice[order[1:]] = same
        twice[order[:-1]] |= same
    return number, earlier, twice


def matches(word: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and lags of the earlier occurrences that count, by place.

    ``word`` numbers the words of all texts in a line, ``bounds`` are the
    bounds of each text's words."""
    lens = np.diff(bounds)
    owner, kinds = np.repeat(np.arange(len(lens)), lens), int(word.max(initial=0)) + 1
    if len(lens) * kinds * kinds >= 1 << 63:
        raise ValueError("too many distinct words in one slice")
    first = np.repeat(bounds[:-1], lens)
    at = np.flatnonzero((np.arange(len(word)) > first) & np.repeat(lens >= LEAST_PERIODS, lens))
    number, _, twice = _grouped((owner[at] * kinds + word[at - 1]) * kinds + word[at], at)  # of two words
    at, number = at[twice], number[twice]
    follows = np.flatnonzero(np.diff(at) == 1) + 1
    follows = follows[first[at[follows]] < at[follows] - 1]  # the pair before lies in the same text
    keys, at = number[follows - 1] * kinds + word[at[follows]], at[follows]  # of three words
    places, lags, size, low = [], [], 3, 1
    while len(at):
        number, earlier, twice = _grouped(keys, at)
        lag = at - earlier
        found = (earlier >= 0) & (lag >= low) & (lag < 2 * low)
        places.append(at[found])
        lags.append(lag[found])
        at, number = at[twice], number[twice]
        # twice as long: all the parts of this size occur twice, too
        whole = np.flatnonzero(at[size:] - at[:-size] == size)
        keys = number[whole] * (int(number.max(initial=0)) + 1) + number[whole + size]
        at, size, low = at[whole + size], 2 * size, 2 * low
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    place, lag = np.concatenate(places), np.concatenate(lags)
    order = np.argsort(place, kind="stable")
    return place[order], lag[order]


def runs(word: np.ndarray, bounds: np.ndarray, least_words: int = LEAST_WORDS,
         least_periods: int = LEAST_PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of the texts in a line, ``start``
    counted in that line, in the order in which the runs end."""
    place, lag = matches(word, bounds)
    first = bounds[np.searchsorted(bounds, place, side="right") - 1]
    size = 3 << np.frexp(lag)[1].astype(np.int64) >> 1
    # a match of exactly the context's length: before it the diagonal has none
    before = place - size
    fresh = (before - lag < first) | (word[before] != word[np.maximum(before - lag, 0)])
    ends = np.zeros(len(word) + 1, bool)
    ends[bounds] = True
    out: list[tuple[int, int, int]] = []
    active: dict[int, list[int]] = {}  # lag -> [last matching word, match length]

    def end(gone: int, last: int, matched: int) -> None:
        stopped = ends[last + 1] or word[last + 1] != word[last + 1 - gone]
        if stopped and matched + gone >= max(least_words, least_periods * gone):
            out.append((last - matched - gone + 1, matched + gone, gone))

    now = -1
    for i, d, new, m in zip(place.tolist(), lag.tolist(), fresh.tolist(), size.tolist()):
        if i != now:
            if active:
                for other in [x for x, (last, _) in active.items() if last < i - 1]:
                    end(other, *active.pop(other))
            now = i
        state = active.get(d)
        if state is not None and not ends[i]:
            state[0], state[1] = i, state[1] + 1
        elif new:
            if state is not None:
                end(d, *state)
            active[d] = [i, m]
    for d, state in active.items():
        end(d, *state)
    return out


def _numbered(text: pa.LargeStringArray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words, each word's number in order, and the texts' bounds."""
    parts = pc.ascii_split_whitespace(text)
    bounds = parts.offsets.to_numpy().astype(np.int64)
    flat = parts.values.slice(bounds[0], bounds[-1] - bounds[0])
    some = pc.greater(pc.binary_length(flat), 0)
    bounds = np.concatenate([[0], np.cumsum(some.to_numpy(zero_copy_only=False))])[bounds - bounds[0]]
    found = flat.filter(some).dictionary_encode()
    return found.dictionary, found.indices.to_numpy(zero_copy_only=False).astype(np.int64), bounds


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_RUNS = "doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"


def periodic_runs(docs: DataFrame, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """doc_id, n_words, runs, collapsed of every row, without a shuffle.

    ``runs`` are stretches of words with a smallest period q and at least
    ``least_words`` words and ``least_periods`` * q of them, by start, then
    period (start counts words from 0); ``collapsed`` has the words, joined by
    one space, that no run repeats (all but those after a run's first q).

    Null, empty and blank texts have no words, no runs and an empty collapsed
    text; a null id and repeated rows are listed as they are; an empty table
    gives an empty result; other columns of the input are not looked at."""
    if least_periods < 4 or least_words < 4:
        raise ValueError("runs have four periods and four words at least")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            words, number, bounds = _numbered(part["_text"])
            found = sorted((int(np.searchsorted(bounds, s, side="right")) - 1, s, q, n) for s, n, q in runs(number, bounds, least_words, least_periods))
            texts, starts, periods, lengths = np.array(found, np.int64).reshape(-1, 4).T
            repeated = np.zeros(len(number) + 1, np.int64)
            np.add.at(repeated, starts + periods, 1)
            np.add.at(repeated, starts + lengths, -1)
            kept = np.cumsum(repeated)[:-1] == 0
            left = np.concatenate([[0], np.cumsum(kept)])[bounds]
            listed = pa.StructArray.from_arrays([pa.array(starts - bounds[texts]), pa.array(lengths), pa.array(periods)], fields=list(_RUN))
            offsets = np.searchsorted(texts, np.arange(len(bounds))).astype(np.int32)
            lines = pa.ListArray.from_arrays(pa.array(left.astype(np.int32)), words.take(pa.array(number[kept])))
            yield pa.RecordBatch.from_arrays([part["_id"], pa.array(np.diff(bounds)), pa.ListArray.from_arrays(pa.array(offsets), listed),
                                              pc.binary_join(lines, pa.scalar(" ", words.type)).cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"])
    return documents(docs, id_col, text_col).mapInArrow(run, _RUNS)


def planted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text with runs planted by a fixed rule: where the checksum of
    the id divides by ten, the words from some place on repeat a first few.
    A null id plants nothing."""
    words = F.regexp_extract_all(F.col("_text"), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    n, h = F.size(words).cast("bigint"), F.crc32(F.col("_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    a = F.try_mod(g, n)
    p = 1 + F.floor((n - a) / (3 + g % 8))

    def part(x: Column, start: Column, length: Column) -> Column:
        return F.slice(x, start.cast("int"), length.cast("int"))
    times = F.ceil((n - a) / p)
    tail = part(F.flatten(F.array_repeat(part(words, a + 1, p), times.cast("int"))), F.lit(1), n - a)
    text = F.array_join(F.concat(part(words, F.lit(1), a), tail), " ")
    return documents(docs, id_col, text_col).select(
        F.col("_id").alias("doc_id"), F.when((h % 10 == 0) & (n > 0), text).otherwise(F.col("_text")).alias("text"))


def run_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_runs, the longest run, and digests of all runs and of the
    collapsed text, from the runs and texts that ``periodic_runs`` gives."""
    found = periodic_runs(planted(docs, id_col, text_col))
    best = F.array_min(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"), r["length"].alias("length"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))), "")
    return found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("best"), F.sha2(lines, 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
