import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from docweave.llm import byte_bpe
from docweave.llm.byte_bpe import Encoder, decode, encode, read_ranks
from docweave.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
ALPHABET = "ab cdeéß漢字 \t\n\r\x1c\x1f\x85\xa0᠎ 　'’strelmd'²½Ⅷ٣०!?.,$€😀́﻿\x00"


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(5)
    made = ["".join(rng.choices(ALPHABET, k=rng.randint(0, 40))) for _ in range(3000)]
    made += ["a" * 5000, "the" * 700, "x y" * 500, " " * 900, "\n" * 301 + "a", "", " ", " a", "a ", "a  b", "a \nb", "<|endoftext|>"]
    return made


@pytest.mark.parametrize("at_once", [1, 9, 1 << 20])
def test_ids_are_those_of_the_library(reference, monkeypatch, at_once):
    monkeypatch.setattr(byte_bpe, "_AT_ONCE", at_once)
    monkeypatch.setattr(byte_bpe, "_REMEMBERED", 50)
    with open(PATH, "rb") as file:
        encoder = Encoder(read_ranks(file.read()), public_tokenizers.PATTERN)
    made = texts()
    for at in range(0, len(made), 500):
        some = made[at : at + 500]
        for text, ids in zip(some, encoder.encode(some), strict=True):
            assert [int.from_bytes(ids[i : i + 4], "little") for i in range(0, len(ids), 4)] == reference.encode_ordinary(text), repr(text)


def test_every_case_round_trips(documents, reference):
    pairs = [(1, "one two"), (1, "one two"), (2, None), (3, ""), (None, "no id"), (4, "word " * 300_000), (5, "é" * 999)]
    docs = documents(pairs)
    encoded = encode(docs, PATH, public_tokenizers.PATTERN)
    assert encoded.columns == [*docs.columns, "ids"]
    rows = decode(encoded, PATH).collect()
    assert sorted(((r.doc_id, r.text) for r in rows), key=str) == sorted(pairs, key=str)
    for r in rows:
        assert list(r.ids) == reference.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()
        assert r.id == 7 and r.key == "extra"


def test_columns_of_that_name_are_replaced_and_no_rows_give_none(documents):
    docs = documents([(1, "a b")]).withColumnsRenamed({"key": "ids", "twin": "Decoded"})
    again = decode(encode(docs, PATH, public_tokenizers.PATTERN), PATH)
    assert [c.lower() for c in again.columns].count("ids") == [c.lower() for c in again.columns].count("decoded") == 1
    assert again.first().decoded == b"a b"
    assert decode(encode(documents([]), PATH, public_tokenizers.PATTERN), PATH).count() == 0


def test_wide_pieces(reference):
    """Pieces of tens of thousands of letters, one by one and side by side with others of their width."""
    rng = random.Random(6)
    with open(PATH, "rb") as file:
        encoder = Encoder(read_ranks(file.read()), public_tokenizers.PATTERN)
    made = ["".join(rng.choices("abcdefghijkl", k=n)) for n in (20_000, 40_000, *[70 + k for k in range(60)])]
    for text, ids in zip(made, encoder.encode(made), strict=True):
        assert list(memoryview(ids).cast("i")) == reference.encode_ordinary(text)


def test_decoding_along_with_encoding(documents):
    docs = documents([(1, "a b é"), (2, None)]).withColumnRenamed("key", "decoded").withColumnRenamed("id", "__text")
    rows = {r.doc_id: r for r in encode(docs, PATH, public_tokenizers.PATTERN, decoded="decoded").collect()}
    assert bytes(rows[1].decoded) == "a b é".encode() and bytes(rows[2].decoded) == b"" and list(rows[2].ids) == []
    assert rows[1]["__text"] == 7


def test_an_id_that_is_no_token():
    with open(PATH, "rb") as file:
        decoder = byte_bpe.Decoder(read_ranks(file.read()))
    for ids in ([-1], [10**9]):
        with pytest.raises((KeyError, IndexError)):
            decoder.decode(byte_bpe.np.array(ids))


def test_query(spark, reference):
    folder = "/root/testdata/sf0.001"
    got = {tuple(r) for r in QUERIES["op7_byte_bpe"](spark, folder).collect()}
    want = set()
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        ids = reference.encode_ordinary(r.text)
        joined = " ".join(map(str, ids)).encode()
        want.add((r.doc_id, len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256(r.text.encode()).hexdigest()))
    assert got == want
