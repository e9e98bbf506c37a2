"""Byte-level BPE by a segment tree over byte positions.

Text is split by the pattern; each match is merged by itself. The leaves of the tree are the byte positions; a leaf
holds the rank of the pair that starts there and an inner node the smallest (rank, position) below it, so the root is
the leftmost pair of least rank. A merge changes at most three leaves (the merged piece, its left neighbour and the
piece swallowed), each in a logarithmic number of steps: n bytes take O(n log n) even without a space in them.

Spark deals out the documents in Arrow batches; a task keeps the ids of the matches it has seen in a bounded table.

Defined cases: a null or empty text has no ids (n_tokens 0, digest of no bytes); strings of special tokens are ordinary
text; lone surrogates cannot occur in Spark strings; repeated rows give repeated results; ids outside the vocabulary are
an error in `decode_ids`.
"""

from __future__ import annotations

import base64
import hashlib
from array import array

import pyarrow as pa
from pyspark.sql import DataFrame

from nightwave.llm.common import map_batches, text_of

CACHE = 300_000
_NONE = 1 << 62


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one match."""
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    width = 1
    while width < n:
        width *= 2
    mask = width - 1
    shift = width.bit_length()
    tree = [_NONE] * (2 * width)
    get = ranks.get
    for i in range(n - 1):
        rank = get(piece[i:i + 2])
        if rank is not None:
            tree[width + i] = rank << shift | i
    for i in range(width - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a < b else b
    end = list(range(1, n + 1))  # of the live piece that starts at i
    left = list(range(-1, n))  # start of the live piece before i; left[n] is of the last piece

    def put(i: int, value: int) -> None:
        i += width
        tree[i] = value
        i >>= 1
        while i:
            a, b = tree[2 * i], tree[2 * i + 1]
            a = a if a < b else b
            if tree[i] == a:
                return
            tree[i] = a
            i >>= 1

    while tree[1] != _NONE:
        i = tree[1] & mask
        gone = end[i]
        stop = end[gone]
        end[i] = stop
        left[stop] = i
        put(gone, _NONE)
        rank = get(piece[i:end[stop]]) if stop < n else None
        put(i, _NONE if rank is None else rank << shift | i)
        before = left[i]
        if before >= 0:
            rank = get(piece[before:stop])
            put(before, _NONE if rank is None else rank << shift | before)
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i:end[i]]])
        i = end[i]
    return ids


class ByteBPE:
    """An encoder for one rank file and split pattern, with a table of at most `cache` matches seen before."""

    def __init__(self, path: str, pattern: str, cache: int = CACHE):
        import regex

        self.ranks, self.find, self.cache = load_ranks(path), regex.compile(pattern).findall, cache
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        self.seen: dict[str, bytes] = {}

    def _match(self, match: str) -> bytes:
        if len(self.seen) >= self.cache:
            self.seen.clear()
        packed = array("I", merge_bytes(match.encode(), self.ranks)).tobytes()
        if len(match) <= 64:
            self.seen[match] = packed
        return packed

    def encode(self, text: str) -> bytes:
        """Ids as unsigned 32-bit integers in the machine's order (little-endian on every platform that Spark supports here)."""
        seen, new = self.seen.get, self._match
        return b"".join([seen(m) or new(m) for m in self.find(text)])

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, array("I", packed)))


_ENCODERS: dict[tuple[str, str], ByteBPE] = {}


def encoder(path: str, pattern: str) -> ByteBPE:
    """One for each worker process."""
    return _ENCODERS.get((path, pattern)) or _ENCODERS.setdefault((path, pattern), ByteBPE(path, pattern))


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and ids (binary, little-endian unsigned 32-bit) of every row."""
    return map_batches(docs.select("doc_id", text_of().alias("text")), ["doc_id"], {"ids": pa.binary()},
                       lambda b: [[encoder(path, pattern).encode(t) for t in b["text"].to_pylist()]])


def decode_documents(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and decoded (binary) of rows with ids."""
    return map_batches(encoded.select("doc_id", "ids"), ["doc_id"], {"decoded": pa.binary()},
                       lambda b: [[encoder(path, pattern).decode(x) for x in b["ids"].to_pylist()]])


def round_trip(docs: DataFrame, path: str, pattern: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep`, n_tokens, ids_sha256, decoded_sha256 of every row: encoded, then decoded from the ids, in one pass over the texts."""
    def sha(x: bytes) -> str:
        return hashlib.sha256(x).hexdigest()

    def digests(b: pa.RecordBatch) -> list:
        bpe = encoder(path, pattern)
        ids = [bpe.encode(t) for t in b["text"].to_pylist()]
        return [[len(x) // 4 for x in ids], [sha(x) for x in ids], [sha(bpe.decode(x)) for x in ids]]

    return map_batches(docs.select(*keep, text_of().alias("text")), [*keep],
                       {"n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}, digests)
