"""The distinct-chunk table, and the codec that encodes new chunks side by side."""

import random

import numpy as np
import pyarrow as pa
import pytest

from priceloom.llm.chunk_table import ChunkTable

public_tokenizers = pytest.importorskip("public_tokenizers")


def _ids(table, chunks):
    ids, lens = table.gather(table.rows(chunks))
    ends = np.cumsum(lens)
    return [ids[e - n:e].tolist() for e, n in zip(ends, lens)]


@pytest.mark.parametrize("flat", [False, True])
def test_a_full_table_keeps_what_is_met_again(flat):
    asked = []

    def encode(chunks):
        asked.extend(chunks)
        ids = [[ord(c) for c in x] for x in chunks]
        return (np.array([i for x in ids for i in x], np.uint16), np.array([len(x) for x in ids])) if flat else ids
    rnd = random.Random(1)
    table, often = ChunkTable(encode, most=60), [f"o{k}" for k in range(20)]
    for call in range(200):
        chunks = often + [f"r{call}-{k}" for k in range(rnd.randint(0, 30))] + [""] * (call % 2)
        rnd.shuffle(chunks)
        assert _ids(table, chunks) == [[ord(c) for c in x] for x in chunks]
        assert len(table._index) <= 60 + len(chunks)
    assert sum(asked.count(x) for x in often) == len(often)  # encoded once, though the table filled many times
    assert len(asked) > 10 * 60


def test_frequent_chunks_of_half_the_table_stay():
    table = ChunkTable(lambda chunks: [[len(x)] for x in chunks], most=10)
    for _ in range(5):
        assert _ids(table, [f"{k:0{k + 1}}" for k in range(12)]) == [[max(k + 1, len(str(k)))] for k in range(12)]
        assert len(table._index) <= 10 + 12


def test_chunks_side_by_side_have_the_ids_of_whole_texts():
    from tokenizers import Tokenizer
    from priceloom.llm.token_files import Encoder
    path = public_tokenizers.path("byte_bpe_50k.json")
    own, tok = Encoder(path), Tokenizer.from_file(path)
    rnd = random.Random(5)
    letters = "   \t\n\r\x85\xa0　\x1cabcXYZ'sStTéß中🙂̈..,,!?019<|>_-/\x00�Ġ"
    parts = ["<|endoftext|>", "it's", "I'LL", "don't.", "été,", "a<|endoftext|>b", "Ġ", "x\ny", "\xa0z"]
    plain = ["".join(rnd.choice("abcdeé.") for _ in range(rnd.randint(1, 9))) for _ in range(3000)]
    for texts in (["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 40))) for _ in range(2000)],
                  [" ".join(rnd.choice(parts) for _ in range(rnd.randint(0, 9))) for _ in range(1000)],
                  [" ".join(rnd.sample(plain, 50)) for _ in range(100)], ["", " ", "a", " a", "a "]):
        ids, ends = own.encode(pa.array(texts, pa.large_string()))
        want = [e.ids for e in tok.encode_batch_fast(texts, add_special_tokens=False)]
        assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])] == want
