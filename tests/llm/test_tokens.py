from __future__ import annotations

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from small_docs import ROWS, documents, odd
from hypothesis import given, settings, strategies as st

from lotwise.llm import byte_bpe, packing, token_store, tokens
from lotwise.session import scratch_path

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
REFERENCE = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=tokens.read_ranks(RANKS), special_tokens={})
PLAIN = tokens.load(JSON)
BY_RANKS = tokens.Encoder(tokens.from_ranks(RANKS, PATTERN))
BY_JSON = tokens.Encoder(tokens.load(JSON))


def packed(ids) -> bytes:
    return np.array(ids, dtype="<u4").tobytes()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t\x00'.,!asdltvremAé1² \x1c"))))
def test_cut_texts_give_the_ids_of_whole_texts(text):
    assert BY_RANKS.encode([text])[0] == packed(REFERENCE.encode_ordinary(text))
    assert BY_JSON.encode([text])[0] == packed(PLAIN.encode(text, add_special_tokens=False).ids)


def test_memory_that_overflows_changes_no_ids(monkeypatch):
    small = tokens.Encoder(tokens.load(JSON))
    small.pieces.most = 20
    texts = [r[1] or "" for r in ROWS]
    for _ in range(2):
        assert small.encode(texts) == [packed(PLAIN.encode(t, add_special_tokens=False).ids) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=1500))
def test_every_code_is_found_at_its_place(ids):
    levels = [dict(zip(("chunks", "bitmap", "ranks"), level)) for level in token_store.pack(np.array(ids, dtype="<u4"))]
    segment = token_store.Segment(levels)
    assert segment.slice(0, len(ids)).tolist() == ids if ids else True
    for at in {0, len(ids) // 2, len(ids) - 1, 511, 512, 513} & set(range(len(ids))):
        assert segment.token(at) == ids[at]
        assert segment.slice(at, len(ids)).tolist() == ids[at:]


def expected(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    at, out = 0, []
    for doc_id, text, *_ in rows:
        ids = [*PLAIN.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((doc_id, at, len(ids), zlib.crc32(packed(ids))))
        at += len(ids)
    return out


def test_store_reads_back_what_was_encoded(spark):
    path = scratch_path(spark, "test-store")
    token_store.write(odd(spark), path, JSON, 0)
    rows = token_store.documents(spark, path).collect()
    found = [(r["doc_id"], r["start"], r["n_tokens"], zlib.crc32(r["ids"])) for r in sorted(rows, key=lambda r: r["start"])]
    assert found == expected(ROWS)
    whole = np.concatenate([np.frombuffer(r["ids"], "<u4") for r in sorted(rows, key=lambda r: r["start"])])
    places = [0, 1, len(whole) // 2, len(whole) - 1]
    wanted = spark.createDataFrame([(p,) for p in [*places, len(whole)]], "position long")
    got = {r["position"]: r["token"] for r in token_store.tokens_at(spark, path, wanted).collect()}
    assert got == {p: int(whole[p]) for p in places}


def test_store_of_no_documents(spark):
    path = scratch_path(spark, "test-store")
    token_store.write(documents(spark, []), path, JSON, 0)
    assert token_store.documents(spark, path).collect() == []


def test_byte_bpe_goes_there_and_back(spark):
    ids = byte_bpe.encode(odd(spark), RANKS, PATTERN, with_offsets=True)
    rows = {r["doc_id"]: r for r in ids.collect()}
    decoded = {r["doc_id"]: r["decoded"] for r in byte_bpe.with_decoded(ids, RANKS, PATTERN).collect()}
    for doc_id, text, *_ in ROWS:
        assert rows[doc_id]["ids"] == packed(REFERENCE.encode_ordinary(text or ""))
        assert hashlib.sha256(decoded[doc_id]).digest() == hashlib.sha256((text or "").encode()).digest()
        places = rows[doc_id]["offsets"]
        assert (places[-1]["end"] if places else 0) == len(text or "")
    assert byte_bpe.encode(documents(spark, []), RANKS, PATTERN).collect() == []


def test_split_characters(spark):
    text = "\U0001f600é"
    ids = BY_RANKS.encode([text])[0]
    table = [b""] * 50256
    for token, rank in tokens.read_ranks(RANKS).items():
        table[rank] = token
    assert "".join(byte_bpe.token_texts(ids, table)) == text
    assert byte_bpe.offsets(ids, table)[-1][1] == len(text)


@pytest.mark.parametrize("capacity", [64, 2048])
def test_packing_places_every_piece_once(spark, capacity):
    rows = packing.pack(odd(spark), JSON, 0, capacity).collect()
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    want = []
    for doc_id, text, *_ in ROWS:
        ids = [*PLAIN.encode(text or "", add_special_tokens=False).ids, 0]
        begin, end, piece = 0, len(ids) % capacity or capacity, 0
        while begin < len(ids):
            want.append((doc_id, piece, begin, packed(ids[begin:end])))
            begin, end, piece = end, end + capacity, piece + 1
    got = [(r["doc_id"], r["piece"], r["start"], r["ids"]) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    total = sum(r["length"] for r in rows)
    assert len(sequences) <= -(-total // capacity) + 2
    assert packing.pack(documents(spark, []), JSON, 0, capacity).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 100), st.integers(1, 50), max_size=30))
def test_configurations_hold_each_length_as_often_as_it_occurs(counts):
    held = {}
    for pattern, number in packing.configurations(counts, 100):
        assert number > 0 and sum(x * k for x, k in pattern) <= 100
        for x, k in pattern:
            held[x] = held.get(x, 0) + k * number
    assert held == counts
