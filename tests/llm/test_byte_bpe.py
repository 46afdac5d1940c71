import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import byte_bpe, queries


@pytest.fixture(scope="module")
def reference():
    ranks = byte_bpe.read_ranks(queries.RANKS)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ours(text):
    return np.frombuffer(byte_bpe.codec(queries.RANKS, public_tokenizers.PATTERN).encode(text), "<u4").tolist()


HARD = ["", " ", "\n\n \t x", "it's we'll I'D", "ñandú été", "日本語テキスト", "👩‍👩‍👧", "\u0000\u0001 ﻿​", "a" * 5000, "ab" * 3000 + " " * 700, "<|endoftext|>", "1234567890" * 50, "▁▁ Ġ Ċ", "\r\n\x0b\x0c\x85\xa0", "\U000e0001\U0010ffff"]


@pytest.mark.parametrize("text", HARD)
def test_ids_equal_the_public_library(reference, text):
    assert ours(text) == reference.encode_ordinary(text)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    bpe = byte_bpe.codec(queries.RANKS, public_tokenizers.PATTERN)
    ranks = bpe.ranks
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert ours(text) == own.encode_ordinary(text)
    assert bpe.decode(np.frombuffer(bpe.encode(text), "<u4")) == text.encode()


def test_every_token_of_the_vocabulary(reference):
    bpe = byte_bpe.codec(queries.RANKS, public_tokenizers.PATTERN)
    words = [t.decode() for t in bpe.bytes_of if t.decode("utf-8", "ignore").encode() == t]
    assert [ours(w) for w in words] == reference.encode_ordinary_batch(words)


def test_query_equals_the_public_library(spark, sf, reference):
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = {r.doc_id: r for r in queries.op6_byte_bpe(spark, sf).collect()}
    assert len(got) == len(rows)
    for row in rows:
        ids = np.array(reference.encode_ordinary(row.text), "<u4")
        r = got[row.doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(row.text.encode()).hexdigest()


def test_frames_and_edge_cases(docs, reference):
    long = "word and more " * 60_000
    rows = docs((1, None), (2, ""), (3, long), (3, long), (None, "a b")).withColumnRenamed("n_chars", "ids")
    encoded = byte_bpe.encode(rows, queries.RANKS, public_tokenizers.PATTERN)
    assert encoded.columns == ["doc_id", "lang", "source", "ids"]
    got = {r.doc_id: r for r in byte_bpe.decode(encoded, queries.RANKS, public_tokenizers.PATTERN).collect()}
    assert got[1].ids == got[2].ids == [] and got[1].decoded == b""
    assert bytes(got[3].decoded).decode() == long and got[3].ids == reference.encode_ordinary(long)
    assert byte_bpe.round_trip_digests(rows, queries.RANKS, public_tokenizers.PATTERN).count() == 5
    assert byte_bpe.round_trip_digests(rows.limit(0), queries.RANKS, public_tokenizers.PATTERN).count() == 0


def test_gaps_in_ranks_are_refused():
    with pytest.raises(ValueError):
        byte_bpe.serialise_model({b"a": 0, b"b": 2})


def test_checked_encoding_of_odd_rows(docs):
    """Nulls, repeats, long texts and clashing columns in the pipeline's last stage."""
    rows = [(1, None), (2, ""), (3, "z" * 50_000), (4, "one two"), (4, "one two"), (None, "ü 日本")]
    odd = docs(*rows).withColumn("ids", F.lit("x")).withColumn("n_tokens", F.lit("y")).withColumn("decoded", F.lit("z"))
    got = byte_bpe.encode_checked(odd, queries.RANKS, public_tokenizers.PATTERN)
    assert got.columns == ["doc_id", "lang", "source", "n_chars", "decoded", "n_tokens", "ids"]
    bpe = byte_bpe.codec(queries.RANKS, public_tokenizers.PATTERN)
    found = sorted(((r.doc_id, bpe.decode(np.array(r.ids, int)), r.n_tokens == len(r.ids), r.decoded) for r in got.collect()), key=repr)
    assert found == sorted(((i, (t or "").encode(), True, "z") for i, t in rows), key=repr)
    assert byte_bpe.encode_checked(odd.limit(0), queries.RANKS, public_tokenizers.PATTERN).count() == 0
