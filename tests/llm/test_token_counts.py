"""Token counts against the tokenizers library."""

import random

import pyarrow as pa
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


def library(texts):
    from tokenizers import Tokenizer
    return [len(e.ids) for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]


def test_counts_are_the_librarys():
    from priceloom.llm.token_counts import Counter
    rnd = random.Random(1)
    letters = " \t\n\x0b\x0c\r\x1c\x85\xa0 　  abcXYZ'sStTéÉÜßİΣσς́̈..,,!?0129<|>½²ⅷ中文字각가🙂‍ſÅÅ_-/\\\"’\x00\x7f�"
    parts = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "it's", "they'll", "I'D", "don't.", "foo,", "É", "́x", "a<|endoftext|>b", " ", "\n"]
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60))) for _ in range(3000)]
    texts += ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 8))) for _ in range(1000)]
    texts += ["", "a" * 5000, "é" * 3000, "ab" * 4000 + " x", "<|endoftext|>" * 100]
    assert Counter(PATH).counts(pa.array(texts, pa.large_string())).tolist() == library(texts)


def test_tables_of_a_worker_start_anew_when_full(monkeypatch):
    from priceloom.llm import token_counts
    monkeypatch.setattr(token_counts, "TABLE_CHUNKS", 5)
    counter, texts = token_counts.Counter(PATH), ["one two three, four five six seven eight"] * 3 + ["nine ten"]
    for _ in range(3):
        assert counter.counts(pa.array(texts, pa.large_string())).tolist() == library(texts)
    assert len(counter._chunks) <= 16


def test_ties_merge_from_the_left():
    from priceloom.llm.token_counts import PairMerger
    symbols = [*map(chr, [*range(33, 127), *range(161, 173), *range(174, 256), *range(256, 324)]), "aa", "aab"]
    merger = PairMerger({"type": "BPE", "vocab": {s: k for k, s in enumerate(symbols)}, "merges": [["a", "a"], ["aa", "b"]]})
    assert [merger.count(x) for x in (b"", b"a", b"aa", b"aaa", b"aaab", b"aaaab", b"aabaab")] == [0, 1, 1, 2, 3, 2, 2]
    with pytest.raises(ValueError):
        PairMerger({"type": "BPE", "vocab": {"a": 0}, "merges": []})


def test_rows_of_the_query(spark):
    from priceloom.llm.token_counts import count_tokens
    rows = [(1, "Hello world", 5, "n"), (2, None, 6, "n"), (3, "", 7, "n"), (None, "été", 8, "n"), (1, "Hello world", 5, "n"), (4, "word " * 3000, 1, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens int, _text string")
    got = sorted(((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in count_tokens(docs, PATH).collect()), key=str)
    want = [(i, len((t or "").encode()), n, n > 2048) for (i, t, *_), n in zip(rows, library([t or "" for _, t, *_ in rows]))]
    assert got == sorted(want, key=str)
    assert count_tokens(docs.limit(0), PATH).count() == 0
