import hashlib
import struct

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from nightwave.llm.byte_bpe import ByteBPE, decode_documents, encode_documents, merge_bytes, round_trip
from nightwave.llm.queries import RANK_FILE

PATH = public_tokenizers.path(RANK_FILE)
BPE = ByteBPE(PATH, public_tokenizers.PATTERN)
TIK = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=BPE.ranks, special_tokens={})


def ids(packed):
    return list(struct.unpack(f"<{len(packed) // 4}I", packed))


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet="abe thing", max_size=200)))
def test_equals_the_library_and_decodes(text):
    assert ids(BPE.encode(text)) == TIK.encode_ordinary(text)
    assert BPE.decode(BPE.encode(text)) == text.encode()


@pytest.mark.parametrize("text", ["", "a" * 30_000, "éèà" * 4000, "<|endoftext|>", " \n\n\t x", "ab" * 9999 + "!" * 5000])
def test_long_and_odd_texts(text):
    assert ids(BPE.encode(text)) == TIK.encode_ordinary(text)


def test_small_ranks_take_the_leftmost_pair():
    ranks = {b"a": 0, b"b": 1, b"aa": 2, b"ab": 3, b"aab": 4}
    assert merge_bytes(b"aaab", ranks) == [2, 3] and merge_bytes(b"b", ranks) == [1]


def test_frames(spark):
    rows = [(1, "Hello wörld", 5), (2, None, 6), (2, None, 6), (None, "", None), (2**60 + 1, "x " * 20_000, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in round_trip(docs, PATH, public_tokenizers.PATTERN).collect()}
    want = set()
    for i, t, _ in rows:
        x = TIK.encode_ordinary(t or "")
        want.add((i, len(x), hashlib.sha256(struct.pack(f"<{len(x)}I", *x)).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == want
    back = decode_documents(encode_documents(docs, PATH, public_tokenizers.PATTERN), PATH, public_tokenizers.PATTERN)
    assert sorted(bytes(r.decoded).decode() for r in back.collect()) == sorted(t or "" for _, t, _ in rows)
    assert round_trip(docs.limit(0), PATH, public_tokenizers.PATTERN).count() == 0
