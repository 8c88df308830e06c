"""Periodic runs against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(w, least_words=6, least_periods=4):
    """Every lag at every word: maximal stretches whose smallest period is the lag."""
    out = []
    for q in range(1, len(w) // least_periods + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            n = j - i + q
            if n >= max(least_words, least_periods * q) and not any(w[i:i + n - d] == w[i + d:i + n] for d in range(1, q)):
                out.append((i, n, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def some_words(rnd):
    k = rnd.randint(1, 4)
    w = [rnd.randint(0, k) for _ in range(rnd.choice([0, 1, 3, 6, 10, 30, 60, 120]))]
    for _ in range(rnd.randint(0, 3)):
        block = [rnd.randint(0, k) for _ in range(rnd.randint(1, 12))]
        at = rnd.randint(0, len(w))
        w[at:at] = (block * 8)[:rnd.randint(1, 6 * len(block))]
    return w * rnd.choice([1, 1, 1, 4, 5])


def test_runs_are_those_of_brute_force():
    from priceloom.llm.periodic_runs import runs
    rnd = random.Random(2)
    for least_words, least_periods in ((6, 4), (4, 4), (20, 5)):
        for _ in range(300):
            texts = [some_words(rnd) for _ in range(rnd.randint(0, 5))]
            bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
            got = runs(np.array([x for t in texts for x in t], np.int64), bounds, least_words, least_periods)
            assert sorted(got) == sorted((s + int(b), n, q) for t, b in zip(texts, bounds) for s, n, q in brute(t, least_words, least_periods))


def test_time_does_not_grow_with_the_square_of_a_words_count():
    from priceloom.llm.periodic_runs import matches, runs
    n = 200_000
    word = np.zeros(n, np.int64)
    assert len(matches(word, np.array([0, n]))[0]) < n  # a naive table of earlier occurrences would hold n * n / 2
    assert runs(word, np.array([0, n])) == [(0, n, 1)]
    rare = np.where(np.random.default_rng(1).random(n) < 0.5, 0, np.arange(n))
    assert len(matches(rare, np.array([0, n]))[0]) < n


def test_operator_gives_runs_and_texts(spark):
    from priceloom.llm.periodic_runs import periodic_runs
    rows = [(1, "x a b\ta b a  b a b y", 0), (2, None, 0), (3, "", 0), (4, " \n ", 0), (None, "é " * 7, 0), (1, "x a b\ta b a  b a b y", 0), (5, "A a A a A a A a", 9)]
    got = sorted((str(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.collapsed)
                 for r in periodic_runs(spark.createDataFrame(rows, "doc_id bigint, text string, runs int")).collect())
    assert got == [("1", 10, [(1, 8, 2)], "x a b y"), ("1", 10, [(1, 8, 2)], "x a b y"), ("2", 0, [], ""), ("3", 0, [], ""), ("4", 0, [], ""),
                   ("5", 8, [(0, 8, 2)], "A a"), ("None", 7, [(0, 7, 1)], "é")]
    assert periodic_runs(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
    with pytest.raises(ValueError):
        periodic_runs(spark.createDataFrame(rows, "doc_id bigint, text string, runs int"), least_periods=3)


def contract(doc_id, text):
    w = WORDS.findall(text or "")
    n, h = len(w), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]
    found = brute(w)
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{m},{q}\n" for s, m, q in found)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_rows_of_the_query(spark):
    from priceloom.llm.periodic_runs import run_digests
    rnd = random.Random(7)
    rows = [(i, " ".join("abcde"[x] for x in some_words(rnd)) if i % 9 else rnd.choice([None, "", " \t\n", "one", "\x0bone two\x0c"])) for i in range(-50, 400)]
    rows += [(i, rnd.choice([" ", "\n", "  "]).join(f"w{rnd.randint(0, 500)}" for _ in range(rnd.randint(1, 300)))) for i in range(400, 700)]
    rows += [(None, "a b " * 9), (20, "c d " * 7), (20, "c d " * 7)]
    docs = spark.createDataFrame([(i, t, 1, "z") for i, t in rows], "doc_id bigint, text string, period int, _id string")
    got = run_digests(docs)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows) > 50
    assert sorted(map(tuple, got.collect()), key=str) == sorted((contract(i, t) for i, t in rows), key=str)
    assert run_digests(docs.limit(0)).count() == 0
