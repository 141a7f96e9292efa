"""Encoding and counting against the libraries that the vocabularies come from."""
import hashlib

import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from edge_tables import SF0001, edge_docs, empty_docs  # noqa: F401
from heartspark.llm import byte_bpe, queries, token_count

VOCABULARY = queries.rank_file("byte_bpe_50k.json").decode()
RANKS = queries.rank_file()
ODD = ["", " ", "a", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "it's we'LL 12 345½ ²x́ 日本語\U0001F600  ", "x" * 3000, "ab" * 700, "é" * 501,
       "\t\n  \r\n x \x1c\x85\xa0 y", "­​", "aaaaaaab" * 9]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})


@pytest.fixture(scope="module")
def hub():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_odd_texts(library, hub):
    codec = byte_bpe.Codec(RANKS, public_tokenizers.PATTERN)
    count = token_count._counter(1, VOCABULARY, public_tokenizers.PATTERN)
    for text in ODD:
        ids = library.encode_ordinary(text)
        assert codec.encode(text) == ids
        assert codec.decode(ids) == text.encode()
        assert count(text) == (len(hub.encode(text, add_special_tokens=False).ids),)


def test_op1_whole_table(spark, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()}
    got = queries.op1_byte_bpe(spark, SF0001).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = library.encode_ordinary(docs[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


def test_op10_whole_table(spark, hub):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()}
    got = queries.op10_token_counts(spark, SF0001).collect()
    assert len(got) == len(docs)
    for r in got:
        n = len(hub.encode(docs[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), n, n > 1024)


def test_edges(spark, edge_docs, empty_docs, library):
    ids = byte_bpe.encode(edge_docs, RANKS, public_tokenizers.PATTERN)
    assert ids.columns == ["doc_id", "ids", "n_tokens", "exact"] and ids.count() == 11
    assert all(r.exact and r.n_tokens == len(r.ids) for r in ids.collect())
    texts = sorted(bytes(r.decoded) for r in byte_bpe.decode(ids, RANKS).collect())
    assert texts == sorted((r.text or "").encode() for r in edge_docs.collect())
    counts = token_count.token_counts(edge_docs, VOCABULARY, public_tokenizers.PATTERN).collect()
    assert sorted(r.n_tokens for r in counts) == sorted(r.n_tokens for r in ids.collect())
    assert byte_bpe.encode_digests(empty_docs, RANKS, public_tokenizers.PATTERN).count() == 0
    assert token_count.token_counts(empty_docs, VOCABULARY, public_tokenizers.PATTERN).count() == 0
