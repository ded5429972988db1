"""Token ids, the range coder and the corpus format."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from strata.llm import rangecoder, token_io
from strata.llm.tokens import Pieces
from tests.llm.conftest import tricky_rows

FILES = ("byte_bpe_50k.json", "word_bpe_49k.json")
KNOWN = {f: Pieces(public_tokenizers.path(f)) for f in FILES}
TEXT = st.text(
    st.sampled_from(list("abcdefgstZÉéßñIi'’.,!# \n\t0123456789_") + ["́", "İ", "日", " ", "\0"])
)


@pytest.mark.parametrize("file", FILES)
@settings(max_examples=300, deadline=None)
@given(text=TEXT)
def test_pieces_give_the_ids_of_whole_texts(file, text):
    known = KNOWN[file]
    assert known.ids(text) == known.whole(text)


def library(file):
    return Tokenizer.from_file(public_tokenizers.path(file))


@pytest.mark.parametrize("file", FILES)
def test_tricky_texts(file):
    t = library(file)
    for row in tricky_rows():
        want = np.array(t.encode(row[1] or "", add_special_tokens=False).ids, "<u2").tobytes()
        assert KNOWN[file].ids(row[1]) == want


@pytest.mark.parametrize("file", FILES)
def test_many_texts_at_once(file, monkeypatch):
    """Slices, repeated and odd texts, and strings of added tokens, as the
    library reads them or as ordinary text."""
    from strata.llm import tokens

    monkeypatch.setattr(tokens, "_SLICE_BYTES", 300)
    monkeypatch.setattr(tokens, "TABLE_BYTES", 5000)
    texts = [row[1] for row in tricky_rows()] * 2 + ["a <|endoftext|> b", "<|startoftext|>", "<|ENDOFTEXT|>x", "end\nof text"]
    for special_text in (False, True):
        t = library(file)
        t.encode_special_tokens = special_text
        want = [np.array(t.encode(x or "", add_special_tokens=False).ids, "<u2").tobytes() for x in texts]
        assert Pieces(public_tokenizers.path(file), special_text).many(texts) == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 299), max_size=700), st.integers(0, 3))
def test_coder_round_trip(ids, cuts):
    ids = ids * (cuts + 1)
    block = rangecoder.encode_block([1, None], [len(ids) - len(ids) // 3, len(ids) // 3], ids, 300)
    keys, lengths, back = rangecoder.decode_block(block)
    assert keys == [1, None] and list(lengths) == [len(ids) - len(ids) // 3, len(ids) // 3]
    assert list(back) == ids


@pytest.mark.parametrize("kind", ["constant", "uniform", "zipf", "period"])
def test_coder_on_large_blocks(kind):
    rng = np.random.default_rng(3)
    n, symbols = 60_000, 50_257
    ids = {
        "constant": np.full(n, 7),
        "uniform": rng.integers(0, symbols, n),
        "zipf": np.minimum(rng.zipf(1.3, n), symbols - 1),
        "period": np.arange(n) % 900,
    }[kind]
    block = rangecoder.encode_block([0], [n], ids, symbols)
    assert (rangecoder.decode_block(block)[2] == ids).all()
    bits = 8 * len(block) / n
    assert bits < {"constant": 0.8, "uniform": 17, "zipf": 8, "period": 8}[kind]


def test_damage_is_noticed():
    ids = np.arange(5000) % 97
    block = bytearray(rangecoder.encode_block([3], [5000], ids, 100))
    rng = random.Random(1)
    for _ in range(40):
        at = rng.randrange(len(block))
        block[at] ^= 1 << rng.randrange(8)
        with pytest.raises(Exception):  # noqa: B017 - any refusal will do, silence will not
            if (rangecoder.decode_block(bytes(block))[2] == ids).all():
                assert rangecoder.decode_block(bytes(block))[0] != [3]
                raise ValueError("another key")
        block = bytearray(rangecoder.encode_block([3], [5000], ids, 100))
    with pytest.raises(ValueError):
        rangecoder.encode_block([0], [1], [100], 100)


def test_corpus_against_brute_force(spark, folder, monkeypatch):
    monkeypatch.setattr(token_io, "BLOCK_IDS", 3000)
    got = [tuple(r) for r in token_io.op1_context_mixing_tokens(spark, folder).collect()]
    t = library("byte_bpe_50k.json")
    ids = [t.encode(r[1] or "", add_special_tokens=False).ids + [2] for r in tricky_rows()]
    want = [(r[0], len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for r, i in zip(tricky_rows(), ids, strict=True)]
    assert sorted(((d, n, c) for d, _, n, c in got), key=repr) == sorted(want, key=repr)
    got.sort(key=lambda r: r[1])
    at = 0
    for _, start, n, _ in got:
        assert start == at
        at += n
    named = [d for d, *_ in got]
    nulls = named.count(None)
    assert named[:nulls] == [None] * nulls and named[nulls:] == sorted(named[nulls:])


def test_corpus_gives_the_ids_back(spark, tricky, tmp_path):
    path = f"{tmp_path}/corpus"
    token_io.write_corpus(tricky, path, public_tokenizers.path("byte_bpe_50k.json"))
    back = token_io.read_corpus(spark, path, texts=True).collect()
    t = library("byte_bpe_50k.json")
    texts = sorted(t.decode(np.frombuffer(r["ids"], "<u4")[:-1].tolist(), skip_special_tokens=False) for r in back)
    want = [r[1] or "" for r in tricky_rows()]
    assert texts == sorted(want)


def test_blocks_are_smaller_than_the_entropy_of_their_ids():
    """Whole texts of a given table, against the plain order-0 entropy of the same ids."""
    import pyarrow.parquet as pq

    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column(0).to_pylist()
    ids = np.frombuffer(b"".join(KNOWN[FILES[0]].many(texts)), "<u2")
    shares = np.bincount(ids)[np.unique(ids)] / len(ids)
    block = rangecoder.encode_block([0], [len(ids)], ids, 50_257)
    assert (rangecoder.decode_block(block)[2] == ids).all()
    assert 8 * len(block) / len(ids) < -(shares * np.log2(shares)).sum()


def test_the_coded_words_of_known_ids_stay():
    i = np.arange(60_000, dtype=np.int64)
    ids = ((i * i % 9973) * (i % 7) + i % 13) % 50_300
    used, words = rangecoder._code(ids, *rangecoder._lanes(len(ids)), 50_300)
    assert zlib.crc32(words.astype("<u4").tobytes(), zlib.crc32(used.astype("<u4").tobytes())) == 4135462420


@pytest.mark.parametrize("file", FILES)
def test_distinct_words_are_looked_up_once_without_their_punctuation(file, monkeypatch):
    seen = []
    known = Pieces(public_tokenizers.path(file))
    monkeypatch.setattr(known, "known", lambda units: seen.append(units) or Pieces.known(known, units))
    text = 'Żółw one, one. one\none! "one" straße; straße İ! Å. x1, ... 100% a\u00d7b.'
    assert known.ids(text) == known.whole(text)
    (units,) = seen
    assert len(units) == len(set(units)) and {"one", "\0one", "\0,", "\0.", "\0!"} <= set(units)
    assert not {"one,", "one.", "\0one!"} & set(units)


def test_frames_are_gathered_whole(monkeypatch):
    import pandas as pd

    monkeypatch.setattr(token_io, "GATHER_CHARS", 10)
    frames = [pd.DataFrame({"doc_id": [str(i), None], "text": ["x" * 4, None]}) for i in range(7)]
    got = list(token_io.gathered(iter(frames)))
    assert [len(ids) for ids, _ in got] == [6, 6, 2]
    assert [t for _, texts in got for t in texts] == ["xxxx", None] * 7
    assert [i for ids, _ in got for i in ids] == [x for i in range(7) for x in (str(i), None)]
