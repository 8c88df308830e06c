"""Collocations against brute force and the DuckDB SQL."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

PIECES = re.compile(r"[.,;:!?\n-\r]")
WORDS = re.compile(r"[^ \t]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute(rows, least, longest, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in PIECES.split(lower(text)):
            w = WORDS.findall(piece)
            n[lang] += len(w)
            for size in range(1, longest + 1):
                f.update((lang, tuple(w[i:i + size])) for i in range(len(w) - size + 1))
    candidates = {k: a for k, a in f.items() if a >= least and len(k[1]) > 1}
    inside = {}
    for (lang, p), a in candidates.items():
        for size in range(2, len(p)):
            for i in range(len(p) - size + 1):
                inside[lang, p[i:i + size]] = max(a, inside.get((lang, p[i:i + size]), 0))
    out = []
    for (lang, p), a in candidates.items():
        if 100 * inside.get((lang, p), 0) >= 100 * a:
            continue
        score, _, l, r = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        out.append((lang, -score, -a, " ".join(p).encode(), l, r))
    rows, rank = [], Counter()
    for lang, score, a, phrase, l, r in sorted(out):
        rank[lang] += 1
        if rank[lang] <= top:
            rows.append((lang, rank[lang], phrase.decode(), -a, l, r, n[lang], -score))
    return rows


def corpus(seed, rows=300):
    rnd = random.Random(seed)
    words = ["the", "The", "of", "a", "é", "É", "new", "york", "x", "\xa0", "ß", "york's"]
    fixed = ["new york city hall of", "once upon a time there", "a a a a a a", "in the end"]
    out = []
    for _ in range(rows):
        text = "".join((rnd.choice(fixed) if rnd.random() < 0.2 else rnd.choice(words) if rnd.random() < 0.9 else f"w{rnd.randint(0, 40)}")
                       + rnd.choice([" "] * 8 + ["\t", "  ", ". ", ",", "\n", "\x0b", "; "]) for _ in range(rnd.randint(0, 60)))
        out.append((rnd.choice(["en", "en", "en", "fr", None, ""]), text))
    return out + [("en", None), ("fr", ""), (None, " \n"), ("rare", "one two"), ("und", "new york new york")]


@pytest.mark.parametrize("least, longest, top, shards", [(20, 5, 2000, 3), (8, 4, 10, 4), (30, 5, 2000, 1), (2, 3, 50, 2)])
def test_rows_are_those_of_brute_force(spark, least, longest, top, shards):
    from priceloom.llm.collocations import collocations
    rows = corpus(shards)
    docs = spark.createDataFrame([(k, t, g, 1, "x") for k, (g, t) in enumerate(rows)], "doc_id bigint, text string, lang string, n int, phrase string")
    got = collocations(docs.repartition(5), least=least, longest=longest, top=top, shards=shards)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = brute(rows, least, longest, top)
    assert len(want) > 20 and sorted(map(tuple, got.collect())) == sorted(want)


def test_a_full_bitmap_only_adds_phrases(monkeypatch):
    """Bits shared by many phrases begin cycles too early, counts stay exact."""
    from priceloom.llm import collocations as c
    monkeypatch.setattr(c, "BITMAP_BITS", 7)
    full, some = np.full(2, np.uint64(0xFFFFFFFFFFFFFFFF)), np.full(2, np.uint64(0xFFFF0F0FFF3FFFFF))
    array = pa.array([t or "" for _, t in corpus(9, 100)], pa.large_string())
    every = {p: int(k) for _, phrases, times in c.phrases_of(array, "en", True, full, None) for p, k in zip(phrases.to_pylist(), times)}
    seen = {p: int(k) for _, phrases, times in c.phrases_of(array, "en", False, some, None) for p, k in zip(phrases.to_pylist(), times)}
    assert 0 < len(seen) < len(every) and all(every[p] == k for p, k in seen.items())
    # what a phrase's cycle still counts and what it has counted make up the whole
    rest = {p: int(k) for _, phrases, times in c.phrases_of(array, "en", False, full, some) for p, k in zip(phrases.to_pylist(), times)}
    assert not set(rest) & set(seen) and {**rest, **seen} == {p: k for p, k in every.items() if " " in p}


def test_blocks_of_long_texts_cut_no_phrase():
    from collections import defaultdict
    from priceloom.llm import collocations as c
    full = np.full(1 << (c.BITMAP_BITS - 6), np.uint64(0xFFFFFFFFFFFFFFFF))
    texts = ["", " ".join(t for _, t in corpus(3, 60) if t), "no break at all " * 400, "", "a.b" * 300, "."]
    array = pa.array(texts, pa.large_string())
    for start in (0, 1):  # of a slice, too
        want = defaultdict(int)
        for text in texts[start:]:
            for piece in PIECES.split(lower(text)):
                w = WORDS.findall(piece)
                for size in range(1, 6):
                    for i in range(len(w) - size + 1):
                        want[" ".join(w[i:i + size])] += 1
        for block in (1, 50, 1000, 1 << 20):
            got = defaultdict(int)
            for _, phrases, times in c.phrases_of(array.slice(start), "en", True, full, None, block=block):
                for p, k in zip(phrases.to_pylist(), times):
                    got[p] += int(k)
            assert got == want


def test_equal_hashes_do_not_join_phrases():
    from priceloom.llm.collocations import _counted
    number = np.array([1, 2, 1, 2, 3, 4, 1, 2])
    at, times = _counted(np.zeros(4, np.uint64), np.array([0, 2, 4, 6]), number, 2)
    assert sorted(zip(at.tolist(), times.tolist())) == [(0, 3), (4, 1)]


def test_a_step_writes_its_own_counts_only(spark, monkeypatch):
    """Counts of earlier steps aren't written again, and go when no step needs them."""
    import os
    from priceloom.llm import collocations as c
    docs = spark.createDataFrame([("en", "one two three four")] * 30, "lang string, text string").repartition(3)
    keep, written, there, write = getattr(c, "delete_folder", None), [], [], c.materialize

    def seen(df, name):
        out = write(df, name)
        if name.startswith("phrases") and "n" in out.columns and "size" not in out.columns:
            written.append({row.phrase: row.n for row in out.collect()})
        return out

    def gone(session, folder):
        assert keep(session, folder) and not os.path.exists(folder)
        there.append(folder)
    monkeypatch.setattr(c, "materialize", seen)
    monkeypatch.setattr(c, "delete_folder", gone, raising=False)
    rated = c.frequent_phrases(docs, least=5, shards=3)[0]
    phrases = {row.phrase: row.n for row in rated.collect()}
    assert phrases["one two three four"] == phrases["two"] == 30 and len(phrases) == 10
    assert all(sum(step.get(p, 0) for step in written) == n for p, n in phrases.items())
    assert len(there) == len(written) - 2


@pytest.mark.parametrize("spread, n", [([34, 33, 33], 100), ([98, 1, 1], 100), ([0, 0, 100], 100), ([33, 33, 33], None), ([34, 34, 31], None)])
def test_counts_of_steps_that_make_up_the_threshold(spark, spread, n):
    from priceloom.llm import collocations as c
    steps = [spark.createDataFrame([("en", "a b", k), ("en", "x", 50)], "lang string, phrase string, n bigint").filter("n > 0") for k in spread]
    rows = {(row.phrase, row.size): row.n for row in c._sums(steps, [c._often(s, 34) for s in steps], 100).collect()}
    assert rows == {("x", 1): 150, **({("a b", 2): n} if n else {})}


def test_empty_tables_and_rare_words(spark):
    from priceloom.llm.collocations import collocations
    docs = spark.createDataFrame([("en", "one two three"), (None, None)], "lang string, text string")
    assert collocations(docs).count() == 0 and collocations(docs.limit(0)).count() == 0


def test_products_may_pass_64_bits(spark):
    from priceloom.llm.collocations import score_cuts
    big = 3_000_000_000_007
    found = spark.createDataFrame([("en", 1, "a", big), ("en", 1, "b", big + 1), ("en", 2, "a b", big - 9)], "lang string, size int, phrase string, n bigint")
    totals = spark.createDataFrame([("en", 987_654_321_987_654)], "lang string, n bigint")
    row = score_cuts(found, totals).collect()[0]
    assert row.score == 1000 * (big - 9) * 987_654_321_987_654 // (big * (big + 1))
