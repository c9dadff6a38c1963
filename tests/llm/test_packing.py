from __future__ import annotations

import random
import zlib

import numpy as np
from hypothesis import given
from hypothesis import strategies as st

from shopfunnel.llm import tokens
from shopfunnel.llm.packing import lengths_of, pack
from shopfunnel.llm.tokens import Encoder, vocabulary_path


def whole(texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary_path())
    return [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


TEXTS = ["", " ", "\n\n", "a b", "a  b\n\n  c", "x \n y", "tab\tbed \x1c z\x85 q", "<|endoftext|> it's 123 we'll", "né à  ü　　z", "!\x1c?\x1f", "\r\n \r\n a"]


def test_encoding_by_pieces_is_that_of_the_whole():
    rng = random.Random(3)
    alphabet = list("ab'sé1! \n\t\r\x0b\x0c\x1c\x85\xa0 　漢🙂.,-") + ["'ll", "the", "  "]
    texts = TEXTS + ["".join(rng.choices(alphabet, k=rng.randrange(60))) for _ in range(3000)]
    encoder = Encoder(vocabulary_path())
    assert [np.frombuffer(ids, "<u4").tolist() for k in range(0, len(texts), 50) for ids in encoder.encode(texts[k : k + 50])] == whole(texts)


@given(st.integers(0, 20_000))
def test_pieces_add_up(total):
    lengths = lengths_of(total)
    assert sum(lengths) == total
    assert all(n & (n - 1) == 0 and n <= 2048 for n in lengths)
    assert len([n for n in lengths if n < 2048]) == len({n for n in lengths if n < 2048})


def test_every_id_lies_in_one_piece(spark):
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(50, None), (50, None), (None, "no id"), (60, "long words here " * 4000)]
    docs = spark.createDataFrame([(k, t, 1, "x") for k, t in rows], "doc_id long, text string, start int, ids string").repartition(3)
    got = pack(docs).collect()
    expected = {k: w + [1] for (k, _), w in zip(rows, whole([t or "" for _, t in rows]))}
    assert len({r.sequence_id for r in got}) == len(got)
    assert {r.sequence_id for r in got} == set(range(len(got)))
    assert [r.length for r in sorted(got, key=lambda r: r.sequence_id)] == sorted(r.length for r in got)
    found: dict = {}
    for r in sorted(got, key=lambda r: (r.doc_id is None, r.doc_id, r.start)):
        assert r.ids_crc32 == zlib.crc32(r.ids) and len(r.ids) == 4 * r.length and r.offset == 0
        assert r.doc_tokens == len(expected[r.doc_id])
        if r.doc_id != 50:
            assert r.start == len(found.setdefault(r.doc_id, []))
            found[r.doc_id] += np.frombuffer(r.ids, "<u4").tolist()
    assert sum(r.doc_id == 50 for r in got) == 2
    assert found == {k: v for k, v in expected.items() if k != 50}


def test_empty_table(spark):
    assert pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_forgotten_and_colliding_pieces(monkeypatch):
    """Neither a full memory nor pieces of one hash change any id."""
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["ab", "abc", "x1", "né", "12 34"]) + str(rng.randrange(30)) for _ in range(40)) for _ in range(60)]
    for name, value in (("MEMO_PIECES", 40), ("hashes_of", lambda data, places: np.zeros(len(places) - 1, np.uint64))):
        monkeypatch.setattr(tokens, name, value)
        encoder = Encoder(vocabulary_path())
        assert [np.frombuffer(ids, "<u4").tolist() for k in range(0, 60, 7) for ids in encoder.encode(texts[k : k + 7])] == whole(texts)
