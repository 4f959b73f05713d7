from __future__ import annotations

import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers as public
import pytest
import tiktoken
from cases import awkward, documents
from conftest import SF_DIR, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tripmart.llm import byte_bpe, packed_ids, token_counts
from tripmart.llm.queries import BYTE_JSON, BYTE_RANKS, WORD_JSON

RANKS, JSON, WORDS = (public.path(name) for name in (BYTE_RANKS, BYTE_JSON, WORD_JSON))


def whole(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


def digests(reference, text: str | None) -> tuple[int, str, str]:
    ids = reference.encode_ordinary(text or "")
    sha = hashlib.sha256
    return len(ids), sha(np.array(ids, "<u4").tobytes()).hexdigest(), sha((text or "").encode()).hexdigest()


@pytest.mark.parametrize("source", [whole, awkward])
@pytest.mark.parametrize("chunk", [byte_bpe.CHUNK, 700])
def test_byte_bpe_equals_the_library(spark, reference, source, chunk, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CHUNK", chunk)
    docs = source(spark)
    found = byte_bpe.with_tokens(docs, RANKS, public.PATTERN)
    got = rows(found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256"))
    assert got == sorted([(r["doc_id"], *digests(reference, r["text"])) for r in docs.collect()], key=repr)
    assert rows(byte_bpe.with_tokens(docs.limit(0), RANKS, public.PATTERN)) == []


def test_special_strings_and_white_space(spark, reference):
    texts = ["<|endoftext|> a", "a  \n\n  b   ", "   ", "don't we'll I'M", " x\u0085y z", "12345 ١٢٣"]
    docs = documents(spark, list(enumerate(texts)))
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in byte_bpe.encoded(docs, RANKS, public.PATTERN).collect()}
    assert got == {i: digests(reference, t) for i, t in enumerate(texts)}


@pytest.mark.parametrize("source", [whole, awkward])
def test_counts_equal_the_library(spark, source):
    tokenizer, docs = Tokenizer.from_file(JSON), source(spark)
    got = rows(token_counts.token_counts(docs, JSON, public.PATTERN))

    def expected(doc_id, text):
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        return doc_id, len((text or "").encode()), n, n > token_counts.LIMIT

    assert got == sorted([expected(r["doc_id"], r["text"]) for r in docs.collect()], key=repr)
    assert rows(token_counts.token_counts(docs.limit(0), JSON, public.PATTERN)) == []


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40))
def test_merge_counts(text):
    tokenizer = Tokenizer.from_file(JSON) if not hasattr(test_merge_counts, "t") else test_merge_counts.t
    test_merge_counts.t = tokenizer
    assert token_counts.counter(JSON, public.PATTERN).count(text) == len(tokenizer.encode(text, add_special_tokens=False).ids)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 50_000), st.integers(0, 2**64 - 1)), max_size=400))
def test_words_round_trip(ids):
    values = np.array(ids, np.uint64)
    assert (packed_ids.unpack(packed_ids.pack(values)) == values).all()


def test_blocks_decode_alone():
    ids = np.random.default_rng(1).integers(0, 50_000, 60_000).astype(np.uint64)
    words = packed_ids.pack(ids)
    offsets, size = packed_ids.block_offsets(words), packed_ids.BLOCK_WORDS
    assert len(offsets) > 2
    for at, first in enumerate(offsets):
        own = packed_ids.unpack(words[at * size : (at + 1) * size])
        assert (own == ids[first : first + len(own)]).all()


@pytest.mark.parametrize("source", [whole, awkward])
def test_shards_equal_the_library(spark, folder, source, monkeypatch):
    monkeypatch.setattr(packed_ids, "ROW_IDS", 5000)
    tokenizer, docs = Tokenizer.from_file(WORDS), source(spark)
    found = packed_ids.round_trip(docs, f"{folder}/shards", WORDS).collect()
    expected, start = {}, 0
    for r in sorted(found, key=lambda r: r["start"]):
        assert r["start"] == start
        start += r["n_tokens"]
        ids = np.frombuffer(r["ids"], "<u4")
        assert r["n_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(r["ids"])
        expected.setdefault(r["doc_id"], []).append(ids.tolist())
    order = [r["doc_id"] for r in sorted(found, key=lambda r: r["start"])]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    wanted = {}
    for r in docs.collect():
        ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids
        wanted.setdefault(r["doc_id"], []).append([*ids, packed_ids.END_ID])
    assert {k: sorted(v) for k, v in expected.items()} == {k: sorted(v) for k, v in wanted.items()}


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from("abcdéß'st.,;! |<>0\x1c\x85\xa0"), st.characters(max_codepoint=0x3000, exclude_categories=["Cs"])), max_size=30))
def test_chunks_have_the_ids_of_the_whole(text):
    ids = packed_ids.ids_of(WORDS)
    for own in (text, f"x {text}<|endoftext|>{text.upper()}"):
        assert np.frombuffer(ids.encode(own), "<u4").tolist() == ids.tokenizer.encode(own, add_special_tokens=False).ids


def test_shards_of_nothing(spark, folder):
    assert rows(packed_ids.round_trip(whole(spark).limit(0), f"{folder}/shards", WORDS)) == []


def test_chunks_of_ascii_letters_go_to_the_model_as_they_are():
    ids, library = packed_ids.Ids(WORDS), Tokenizer.from_file(WORDS)
    ids.symbols = {}
    text = "Plain letters, HERE and there: ionthe xqzvk A a (No) end."
    assert np.frombuffer(ids.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    text = "é déjà Ünder <|endoftext|> a<|startoftext|>b café, 1984 İstanbul straße K k"
    assert np.frombuffer(packed_ids.Ids(WORDS).encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_a_word_is_encoded_once_whatever_its_case_and_the_signs_beside_it(monkeypatch):
    ids, library, asked = packed_ids.Ids(WORDS), Tokenizer.from_file(WORDS), []
    compute = ids.packed.compute
    monkeypatch.setattr(ids.packed, "compute", lambda chunk: asked.append(chunk) or compute(chunk))
    text = "Zwölfton zwölfton, ZWÖLFTON; (zwölfton) zwölfton&&& \"zwölfton\"? zwölfton2024 it's 'twas',don't <|x|"
    plain = text.removesuffix(" <|x|")
    for one in (plain, f"{plain} — ж", text):
        asked.clear()
        assert np.frombuffer(ids.encode(one), "<u4").tolist() == library.encode(one, add_special_tokens=False).ids
        if one == plain:
            assert [chunk for chunk in asked if "zwölfton" in chunk.lower()] == ["zwölfton"]
