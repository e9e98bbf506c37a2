"""Repeated passages: every byte covered by a string of `length` bytes that also starts earlier is removed.

1. Each window of `length` bytes has an anchor, the place of the least of its K-byte hashes, so that equal windows have
   equal anchors. A run of windows with one anchor is a stretch, and its key is the anchor's hash. Keys are counted by
   shard; those that occur once can hold no repeated window.
2. Texts come back by bundle with their repeated keys. Whole stretches that repeat within the bundle are covered at once,
   so that a passage that a third of all documents share is one stretch a bundle. The rest move to the shard of their key.
   Keys beyond `HOT` occurrences are cut finer first, in stretches of at most FINE windows keyed by the bytes these share.
3. A shard sorts the suffixes that start its windows: by the first eight bytes, then by a mergesort whose comparisons find
   the common extension of two suffixes by binary search over prefix polynomial hashes. Neighbours that agree over the
   whole length are compared byte by byte; where hashes collide, the bytes decide.
4. Covered starts return to the bundle of their document, where runs are merged and the rest of the text is hashed.

Defined cases: a null text counts as empty; null doc_ids come after all others; documents that share a doc_id are ordered
by the text's SHA-256; rows that repeat both doc_id and text are one document and share its result; texts shorter than
`length` lose nothing; an empty table gives an empty result; other columns play no part, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightwave.llm.common import text_of, written

LENGTH, K = 100, 36
BUNDLE_BYTES, SHARD_BYTES, HOT, FINE = 8 << 20, 4 << 20, 4096, 8
SLICE, FLUSH, PAIRS = 1 << 17, 1 << 20, 1 << 14
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = np.random.default_rng(20).integers(0, 1 << 63, 256, dtype=_U) * _U(2) + _U(1)
_GROWN: dict[int, np.ndarray] = {}


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return h ^ (h >> _U(32))


def _powers(base: int, n: int) -> np.ndarray:
    if len(have := _GROWN.get(base, ())) < n:
        have = np.full(max(n, SLICE + 1), base, _U)
        have[0] = 1
        _GROWN[base] = have = np.cumprod(have, dtype=_U)
    return have[:n]


class Prefixes:
    """Polynomial hashes, modulo 2 ** 64, of any part of a run of bytes."""

    def __init__(self, data: np.ndarray):
        self.data, n = data, len(data)
        self.sums = np.zeros(n + 1, _U)
        np.cumsum(_BYTES[data] * _powers(_BASE, n), out=self.sums[1:])
        self.back = _powers(_INVERSE, n + 1)

    def of(self, at: np.ndarray, length) -> np.ndarray:
        return (self.sums[at + length] - self.sums[at]) * self.back[at]

    def common(self, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
        """How many bytes the suffixes at a and b have in common, at most `most`, by binary search."""
        low = np.where(self.of(a, most) == self.of(b, most), most, 0)
        k = np.flatnonzero(low == 0)
        x, y, lo, hi = a[k], b[k], np.zeros(len(k), np.int64), np.full(len(k), most)
        for _ in range(int(most).bit_length()):
            mid = (lo + hi) // 2
            same = self.of(x, mid) == self.of(y, mid)
            lo, hi = np.where(same, mid, lo), np.where(same, hi, mid)
        low[k] = lo
        return low

    def words(self, at: np.ndarray) -> np.ndarray:
        """The first eight bytes as numbers in the order of the bytes."""
        return np.lib.stride_tricks.sliding_window_view(self.data, 8)[at].copy().view(">u8")[:, 0].astype(_U)


def _after(p: Prefixes, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """1, 0 or -1 as the suffix at a is after, equal to or before the one at b, over `length` bytes."""
    first = p.words(a + 8), p.words(b + 8)
    out = np.where(first[0] > first[1], 1, -1)
    k = np.flatnonzero(first[0] == first[1])
    x, y = a[k], b[k]
    n = p.common(x, y, length)
    inside = np.minimum(n, length - 1)
    out[k] = np.where(n >= length, 0, np.where(p.data[x + inside] > p.data[y + inside], 1, -1))
    return out


def _merged(p: Prefixes, at: np.ndarray, rank: np.ndarray, start: np.ndarray, size: np.ndarray, length: int) -> np.ndarray:
    """The order of the suffixes `at`, sorted within each run (start, size) by mergesort, all runs side by side; equal ones by rank."""
    order, width = np.arange(len(at)), 1
    head, end = np.repeat(start, size), np.repeat(start + size, size)
    while width < (size.max() if len(size) else 0):
        place = np.arange(len(at))
        left = head + (place - head) // (2 * width) * (2 * width)
        mid, stop = np.minimum(left + width, end), np.minimum(left + 2 * width, end)
        first = place < mid
        lo, hi = np.where(first, mid, left), np.where(first, stop, mid)
        low0 = lo.copy()
        open_ = np.flatnonzero(lo < hi)
        while len(open_):
            m = (lo[open_] + hi[open_]) // 2
            a, b = order[open_], order[m]
            c = _after(p, at[a], at[b], length)
            beyond = (c > 0) | ((c == 0) & (rank[a] > rank[b]))
            lo[open_], hi[open_] = np.where(beyond, m + 1, lo[open_]), np.where(beyond, hi[open_], m)
            open_ = open_[lo[open_] < hi[open_]]
        new = np.empty_like(order)
        new[np.where(first, place + lo - low0, place - mid + lo)] = order
        order, width = new, width * 2
    return order


def _spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each, size of them."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size - start, size)


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where a new value begins in sorted columns."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def _same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the bytes at a and b are equal, each over its size."""
    out = np.ones(len(a), bool)
    for s in range(0, len(a), PAIRS):
        part = slice(s, s + PAIRS)
        n = size[part]
        equal = data[_spread(a[part], n)] == data[_spread(b[part], n)]
        out[part] = np.logical_and.reduceat(equal, np.cumsum(n) - n)
    return out


def repeated_windows(data: np.ndarray, at: np.ndarray, group: np.ndarray, rank: np.ndarray, length: int) -> np.ndarray:
    """Of the windows of data at `at`, which equal one of the same group and smaller rank."""
    p = Prefixes(data)
    word = p.words(at)
    order = np.lexsort((rank, word, group))
    new = _runs(group[order], word[order])
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, len(order)))
    tied = np.repeat(size > 1, size)
    order, size = order[tied], size[size > 1]
    order = order[_merged(p, at[order], rank[order], np.cumsum(size) - size, size, length)]
    out = np.zeros(len(at), bool)
    new = np.zeros(len(order), bool)
    new[np.cumsum(size) - size] = True
    k = np.flatnonzero(~new)
    new[k] = p.common(at[order[k - 1]], at[order[k]], length) < length
    first = np.flatnonzero(new)[np.cumsum(new) - 1] if len(order) else order
    k = np.flatnonzero(~new)
    fine = _same_bytes(data, at[order[k]], at[order[first[k]]], np.full(len(k), length))
    out[order[k[fine]]] = True
    for f in np.unique(first[k[~fine]]):  # hashes collide: the bytes of the run's windows decide
        seen = set()
        for i in order[np.flatnonzero(first == f)]:
            w = data[at[i]:at[i] + length].tobytes()
            out[i] = w in seen
            seen.add(w)
    return out


def _slices(starts: np.ndarray, ends: np.ndarray, length: int):
    """(from, to) of parts of the texts (starts, ends) laid end to end, short ones together; every window is in one part."""
    k = 0
    while k < len(starts):
        if ends[k] - starts[k] > SLICE:
            yield from ((s, min(s + SLICE, ends[k])) for s in range(starts[k], ends[k] - length + 1, SLICE - length + 1))
            k += 1
        else:
            m = max(k + 1, int(np.searchsorted(ends, starts[k] + SLICE, "right")))
            yield starts[k], ends[m - 1]
            k = m


def stretches(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int, k: int):
    """Of each part of the texts: text number, first window, number of windows, anchor and key of its stretches."""
    for a, b in _slices(starts, ends, length):
        n = int(b - a)
        if n < length:
            continue
        p = Prefixes(data[a:b])
        h = _mix((p.sums[k:] - p.sums[:-k]) * p.back[:n - k + 1])
        low = (h & ~_U(SLICE * 2 - 1)) | np.arange(len(h), dtype=_U)
        m, width, w = low, 1, length - k + 1
        while width * 2 <= w:
            m, width = np.minimum(m[:-width], m[width:]), width * 2
        if width < w:
            m = np.minimum(m[:n - length + 1], m[w - width:])
        anchor = (m & _U(SLICE * 2 - 1)).astype(np.int64)
        i, j = int(np.searchsorted(ends, a, "right")), int(np.searchsorted(starts, b, "left"))
        text = np.repeat(np.arange(i, j), np.minimum(ends[i:j], b) - np.maximum(starts[i:j], a))[:len(m)]
        whole = np.arange(a, a + len(m)) + length <= ends[text]
        at, anchor, text = np.flatnonzero(whole), anchor[whole], text[whole]
        first = np.flatnonzero(_runs(anchor, text))
        yield text[first], at[first] + a, np.diff(np.append(first, len(at))), anchor[first] + a, h[anchor[first]]


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an array of large strings, and where each begins and the last ends."""
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    edges = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1].copy()
    return np.frombuffer(data if data is not None else b"", np.uint8)[edges[0]:edges[-1]], edges - edges[0]


def _flat(table: pa.Table, name: str = "text") -> pa.Array:
    column = table[name].cast(pa.large_string())
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_string())


def _packed(by: np.ndarray, *columns: np.ndarray):
    """(value of by, bytes of each column) of rows sorted by `by`."""
    cut = np.append(np.flatnonzero(_runs(by)), len(by))
    for s, e in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
        yield int(by[s]), [c[s:e].tobytes() for c in columns]


def _key_rows(bundles: int, shards: int, length: int, k: int):
    """Texts (row, text) to (shard, bundle, keys, counts): how often each bundle of a batch has each key."""
    def flush(held):
        key, bundle = (np.concatenate(c) for c in zip(*held, strict=True))
        order = np.lexsort((key, bundle, key % _U(shards)))
        key, bundle = key[order], bundle[order]
        first = np.flatnonzero(_runs(key, bundle))
        count = np.diff(np.append(first, len(key))).astype(np.uint32)
        key, bundle = key[first], bundle[first]
        rows = list(_packed((key % _U(shards)).astype(np.int64) * bundles + bundle, key, count))
        place = np.array([r[0] for r in rows])
        return pa.RecordBatch.from_arrays([pa.array(place // bundles), pa.array(place % bundles), pa.array([r[1][0] for r in rows], pa.binary()), pa.array([r[1][1] for r in rows], pa.binary())], names=["shard", "bundle", "keys", "counts"])

    def run(batches):
        held, size = [], 0
        for b in batches:
            data, edges = _texts(b.column(1).cast(pa.large_string()))
            home = b.column(0).to_numpy() % bundles
            for text, _, _, _, key in stretches(data, edges[:-1], edges[1:], length, k):
                held.append((key, home[text]))
                size += len(key)
                if size > FLUSH:
                    yield flush(held)
                    held, size = [], 0
        if size:
            yield flush(held)
    return run


def _repeated_keys(hot_from: int):
    """Of a shard's keys, those with two or more occurrences, by bundle: (bundle, keys, hot)."""
    return lambda t: _repeated(t, hot_from)


def _repeated(t: pa.Table, hot_from: int) -> pa.Table:
    key = np.frombuffer(b"".join(t["keys"].to_pylist()), _U)
    count = np.frombuffer(b"".join(t["counts"].to_pylist()), np.uint32).astype(np.int64)
    bundle = np.repeat(t["bundle"].to_numpy(), [len(x) // 8 for x in t["keys"].to_pylist()])
    _, at = np.unique(key, return_inverse=True)
    total = np.bincount(at, count)[at]
    key, bundle, hot = key[total > 1], bundle[total > 1], total[total > 1] > hot_from
    order = np.lexsort((key, bundle))
    rows = list(_packed(bundle[order], key[order], hot[order]))
    return pa.table({"bundle": pa.array([r[0] for r in rows], pa.int64()), "keys": pa.array([r[1][0] for r in rows], pa.binary()), "hot": pa.array([r[1][1] for r in rows], pa.binary())})


def _finer(p: Prefixes, first, count, anchor, key, extra, length: int):
    """Stretches cut where the distance from the anchor passes a multiple of FINE, keyed by the bytes that all windows of that span share."""
    far, near = anchor - first, anchor - first - count + 1  # distances of the first and of the last window
    pieces = far // FINE - near // FINE + 1
    span = np.repeat(far // FINE, pieces) - (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    far, near, anchor = np.minimum(np.repeat(far, pieces), span * FINE + FINE - 1), np.maximum(np.repeat(near, pieces), span * FINE), np.repeat(anchor, pieces)
    core = p.of(anchor - span * FINE, length - FINE + 1)  # inside of the text, as the span's last window is or reaches beyond it
    return anchor - far, far - near + 1, anchor, _mix(core + span.astype(_U)), [np.repeat(e, pieces) for e in extra]


def _bundle_stretches(shards: int, length: int, k: int):
    """A bundle's texts and repeated keys to rows for the shards: (shard, bundle, kind, and arrays); kind 0 are stretches, 1 covered starts."""
    def run(texts: pa.Table, keys: pa.Table) -> pa.Table:
        out = []
        if len(texts) and len(keys):
            bundle = keys["bundle"][0].as_py()
            known, hot = np.frombuffer(b"".join(keys["keys"].to_pylist()), _U), np.frombuffer(b"".join(keys["hot"].to_pylist()), bool)
            order = np.argsort(known)
            known, hot = known[order], hot[order]
            row = texts["row"].to_numpy()
            data, edges = _texts(_flat(texts))
            parts = []
            for text, first, count, anchor, key in stretches(data, edges[:-1], edges[1:], length, k):
                at = np.minimum(np.searchsorted(known, key), len(known) - 1)
                seen = np.flatnonzero(known[at] == key)
                text, first, count, anchor, key, h = text[seen], first[seen], count[seen], anchor[seen], key[seen], hot[at[seen]]
                if not len(seen):
                    continue
                base = int(first[0])
                p = Prefixes(data[base:int((first + count).max()) + length - 1])
                if h.any():
                    f = _finer(p, first[h] - base, count[h], anchor[h] - base, key[h], [text[h]], length)
                    first, count, anchor, key, text = np.append(first[~h], f[0] + base), np.append(count[~h], f[1]), np.append(anchor[~h], f[2] + base), np.append(key[~h], f[3]), np.append(text[~h], f[4][0])
                parts.append((text, first, count, anchor, key, p.of(first - base, count + length - 1)))
            if parts:
                text, first, count, anchor, key, whole = (np.concatenate(c) for c in zip(*parts, strict=True))
                place = first - edges[text]
                order = np.lexsort((place, row[text], whole, count, anchor - first, key))
                text, first, count, anchor, key, whole, place = (c[order] for c in (text, first, count, anchor, key, whole, place))
                new = _runs(key, anchor - first, count, whole)
                head = np.flatnonzero(new)[np.cumsum(new) - 1]
                again = np.flatnonzero(~new)
                again = again[_same_bytes(data, first[again], first[head[again]], count[again] + length - 1)]
                left = np.ones(len(text), bool)
                left[again] = False
                covered = [row[text[again]], place[again], count[again].astype(np.uint16)]
                text, first, count, anchor, key, place = (c[left] for c in (text, first, count, anchor, key, place))
                shard = (key % _U(shards)).astype(np.int64)
                order = np.lexsort((key, shard))
                shard, text, first, count, anchor, key, place = (c[order] for c in (shard, text, first, count, anchor, key, place))
                size = count + length - 1
                cut = np.append(np.flatnonzero(_runs(shard)), len(shard))
                for s, e in zip(cut[:-1], cut[1:], strict=True):
                    pieces = [key[s:e], row[text[s:e]], place[s:e], count[s:e].astype(np.uint16), (anchor - first)[s:e].astype(np.uint8), data[_spread(first[s:e], size[s:e])]]
                    out.append((int(shard[s]), bundle, 0, *[x.tobytes() for x in pieces[:5]], pa.compress(pieces[5].tobytes(), codec="zstd", asbytes=True), len(pieces[5])))
                if len(again):
                    out.append((bundle % shards, bundle, 1, b"", *[x.tobytes() for x in covered], b"", b"", 0))
        names = [f.split()[0] for f in _STRETCHES.split(", ")]
        types = [pa.int64(), pa.int64(), pa.int32(), *[pa.binary()] * 6, pa.int64()]
        return pa.table({n: pa.array([r[i] for r in out], t) for i, (n, t) in enumerate(zip(names, types, strict=True))})
    return run


_STRETCHES = "shard long, bundle long, kind int, keys binary, rows binary, places binary, counts binary, offsets binary, bytes binary, n_bytes long"


def _shard_covered(length: int):
    """A shard's stretches to covered starts (bundle, rows, places, counts)."""
    def run(t: pa.Table) -> pa.Table:
        kind = t["kind"].to_numpy()
        read = lambda name, rows, dtype: np.frombuffer(b"".join(rows[name].to_pylist()), dtype)
        done, rows = t.filter(pa.array(kind == 1)), t.filter(pa.array(kind == 0))
        out = [(b, r, p, c) for b, r, p, c in zip(*(done[n].to_pylist() for n in ("bundle", "rows", "places", "counts")), strict=True)]
        if len(rows):
            key, row, place = read("keys", rows, _U), read("rows", rows, np.int64), read("places", rows, np.int64)
            count, offset = read("counts", rows, np.uint16).astype(np.int64), read("offsets", rows, np.uint8).astype(np.int64)
            bundle = np.repeat(rows["bundle"].to_numpy(), [len(x) // 8 for x in rows["keys"].to_pylist()])
            data = np.concatenate([np.frombuffer(pa.decompress(b, n, codec="zstd"), np.uint8) for b, n in zip(rows["bytes"].to_pylist(), rows["n_bytes"].to_pylist(), strict=True)])
            size = count + length - 1
            first = np.cumsum(size) - size
            _, number = np.unique(key, return_inverse=True)
            by_place = np.empty(len(row), np.int64)
            by_place[np.lexsort((place, row))] = np.arange(len(row))
            # whole stretches first, each against the earliest that is the same
            p = Prefixes(data)
            whole = p.of(first, size)
            order = np.lexsort((by_place, whole, count, offset, number))
            new = _runs(number[order], offset[order], count[order], whole[order])
            head = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
            again, head = order[~new], head[~new]
            fine = _same_bytes(data, first[again], first[head], size[again])
            left = np.ones(len(row), bool)
            left[again[fine]] = False
            found = [(again[fine], np.zeros(int(fine.sum()), np.int64), count[again[fine]])]
            # then the windows of what is left, where a key has several stretches
            left = np.flatnonzero(left & (np.bincount(number[left])[number] > 1)) if left.any() else np.zeros(0, np.int64)
            which = np.repeat(left, count[left])
            step = _spread(np.zeros(len(left), np.int64), count[left])
            hit = repeated_windows(data, first[which] + step, number[which] * 256 + offset[which] - step, by_place[which], length) if len(which) else np.zeros(0, bool)
            which, step = which[hit], step[hit]
            start = np.flatnonzero(_runs(which, step - np.arange(len(step))))
            found.append((which[start], step[start], np.diff(np.append(start, len(which)))))
            which, step, n = (np.concatenate(c) for c in zip(*found, strict=True))
            order = np.argsort(bundle[which], kind="stable")
            which, step, n = which[order], step[order], n[order]
            out += [(b, *x) for b, x in _packed(bundle[which], row[which], place[which] + step, n.astype(np.uint16))]
        return pa.table({n: pa.array([r[i] for r in out], c) for i, (n, c) in enumerate({"bundle": pa.int64(), "rows": pa.binary(), "places": pa.binary(), "counts": pa.binary()}.items())})
    return run


def _bundle_kept(length: int, fields: list[str]):
    """A bundle's texts and covered starts to (fields, n_bytes, n_removed, n_spans, kept_sha256)."""
    def run(texts: pa.Table, covered: pa.Table) -> pa.Table:
        read = lambda name, dtype: np.frombuffer(b"".join(covered[name].to_pylist()), dtype)
        row, place, count = read("rows", np.int64), read("places", np.int64), read("counts", np.uint16).astype(np.int64)
        order = np.lexsort((place, row))
        row, low, high = row[order], place[order], (place + count + length - 1)[order]
        own = texts["row"].to_numpy()
        data, edges = _texts(_flat(texts))
        a, b = np.searchsorted(row, own), np.searchsorted(row, own, "right")
        out = []
        for k in range(len(own)):
            text = data[edges[k]:edges[k + 1]]
            removed = spans = 0
            sha, at = hashlib.sha256(), 0
            if a[k] < b[k]:
                lo, hi = low[a[k]:b[k]], np.maximum.accumulate(high[a[k]:b[k]])
                new = np.flatnonzero(np.append(True, lo[1:] > hi[:-1]))
                ends = hi[np.append(new[1:], len(lo)) - 1]
                spans, removed = len(new), int((ends - lo[new]).sum())
                for s, e in zip(lo[new].tolist(), ends.tolist(), strict=True):
                    sha.update(text[at:s])
                    at = e
            sha.update(text[at:])
            out.append((len(text), removed, spans, sha.hexdigest()))
        return pa.table({f: texts[f] for f in fields} | {n: pa.array([r[i] for r in out], t) for i, (n, t) in enumerate({"n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept_sha256": pa.string()}.items())})
    return run


def _with_rows(docs: DataFrame) -> tuple[DataFrame, bool]:
    """row (a long in the documents' order), doc_id, text; and whether doc_ids had to be numbered."""
    texts = docs.select("doc_id", text_of().alias("text"))
    whole = docs.schema["doc_id"].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint")
    odd = texts.groupBy("doc_id").count().filter("doc_id is null or doc_id < 0 or count > 1") if whole else texts
    if odd.isEmpty():
        return texts.select(F.col("doc_id").cast("long").alias("row"), "doc_id", "text"), False
    shaped = texts.select("doc_id", F.sha2("text", 256).alias("sha"))
    key = [F.col("doc_id").asc_nulls_last(), "sha"]
    order = written(shaped.distinct().repartitionByRange(*key).sortWithinPartitions(*key).withColumn("row", F.monotonically_increasing_id()), "order")
    both = texts.dropDuplicates(["doc_id", "text"]).withColumn("sha", F.sha2("text", 256)).alias("t").join(order.alias("o"), F.expr("t.doc_id <=> o.doc_id and t.sha = o.sha"))
    return written(both.select("row", "t.doc_id", "text"), "texts"), True


def without_repeats(docs: DataFrame, length: int = LENGTH, k: int = K, bundle_bytes: int = BUNDLE_BYTES, shard_bytes: int = SHARD_BYTES, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row of docs (doc_id, text)."""
    texts, renumbered = _with_rows(docs)
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    least = docs.sparkSession.sparkContext.defaultParallelism
    bundles, shards = max(least, total // bundle_bytes + 1), max(least, total // shard_bytes + 1)

    found = texts.select("row", "text").mapInArrow(_key_rows(bundles, shards, length, k), "shard long, bundle long, keys binary, counts binary")
    repeated = found.groupBy("shard").applyInArrow(_repeated_keys(hot), "bundle long, keys binary, hot binary")
    home = texts.withColumn("bundle", F.pmod("row", F.lit(bundles)))
    sent = home.select("bundle", "row", "text").groupBy("bundle").cogroup(repeated.groupBy("bundle")).applyInArrow(_bundle_stretches(shards, length, k), _STRETCHES)
    covered = sent.groupBy("shard").applyInArrow(_shard_covered(length), "bundle long, rows binary, places binary, counts binary")
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = home.groupBy("bundle").cogroup(covered.groupBy("bundle")).applyInArrow(
        _bundle_kept(length, ["doc_id"] + ["row"] * renumbered), f"doc_id {kind}, " + "row long, " * renumbered + "n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    if not renumbered:
        return out
    each = docs.select("doc_id", F.sha2(text_of(), 256).alias("sha")).alias("d")
    shas = texts.select("row", F.col("doc_id").alias("id"), F.sha2("text", 256).alias("sha")).join(out.drop("doc_id"), "row").alias("o")
    return each.join(shas, F.expr("d.doc_id <=> o.id and d.sha = o.sha")).select("d.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
