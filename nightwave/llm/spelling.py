"""Spelling variants: words one edit apart, each led to the more common form, by Bloom-guided neighbourhoods.

Words are counted by document and task before they meet. The vocabulary's blocked Bloom filter, one shard a word length,
is broadcast; each word's edits (code points deleted, or replaced by greater ones of the alphabet, which finds every pair
once) are probed by hash alone, in numpy, and only positives become text and move to an exact join with the vocabulary,
which removes the false ones. The filter is at most `MAX_FILTER_BYTES` long: a vocabulary beyond that makes more false
positives, not other results. Forms are followed to the root by pointer doubling.

Defined cases: a null text has no words; a null doc_id counts as empty in the checksum; a row that is there twice counts
twice; an empty table or vocabulary gives an empty result; other columns play no part, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightwave.llm.common import written

RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: What a lower-cased run is made of.
ALPHABET = np.array([*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)], np.uint32)
MIN_LENGTH, MIN_COUNT, TYPO_EVERY = 5, 3, 97
BITS_A_WORD, MAX_FILTER_BYTES, PROBES = 16, 64 << 20, 5
FLUSH, EDITS_AT_ONCE, WORDS_A_TASK = 500_000, 2_000_000, 20_000

_BASE = 0x9E3779B97F4A7C15
_POWERS = np.array([pow(_BASE, k, 1 << 64) for k in range(64)], np.uint64)


def mutated(word: str, doc_id) -> str:
    """The run without one code point where 97 divides the checksum of `<doc_id>:<run>`."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
    if h % TYPO_EVERY:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1:]


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """word, n: what the runs of all texts become, of `min_length` code points and `min_count` occurrences or more."""
    def run(batches):
        counts: Counter = Counter()
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                prefix = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for w, n in Counter(RUN.findall(text.encode().lower().decode())).items():  # bytes.lower is A-Z alone
                    if zlib.crc32(w.encode(), prefix) % TYPO_EVERY == 0:
                        w = mutated(w, doc_id)
                    if len(w) >= min_length:
                        counts[w] += n
                if len(counts) > FLUSH:
                    yield pa.RecordBatch.from_pydict({"word": list(counts), "n": list(counts.values())})
                    counts.clear()
        if counts:
            yield pa.RecordBatch.from_pydict({"word": list(counts), "n": list(counts.values())})

    parts = docs.filter(F.col("text").isNotNull()).select(F.col("doc_id").cast("string"), "text").mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def _values(points: np.ndarray) -> np.ndarray:
    return _mix(points.astype(np.uint64) + np.uint64(1))


def _powers(n: int) -> np.ndarray:
    return _POWERS[:n] if n <= len(_POWERS) else np.array([pow(_BASE, k, 1 << 64) for k in range(n)], np.uint64)


def _points(words: list[str], length: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(-1, length)


def _hashes(points: np.ndarray) -> np.ndarray:
    """Sum of value times power of the place, of each row."""
    return (_values(points) * _powers(points.shape[1])).sum(1, dtype=np.uint64)


def _slots(h: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit block of each hash, and its bits in there."""
    a, b = _mix(h), _mix(h + np.uint64(_BASE))
    mask = np.zeros(len(a), np.uint64)
    for k in range(PROBES):
        mask |= np.uint64(1) << ((b >> np.uint64(6 * k)) & np.uint64(63))
    return ((a >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32), mask


def shards(vocabulary: DataFrame, max_bytes: int = MAX_FILTER_BYTES) -> dict[int, np.ndarray]:
    """Length to the 64-bit blocks of its words: at most max_bytes in all, and one block a length besides."""
    sizes = {r.length: r["count"] for r in vocabulary.groupBy(F.char_length("word").alias("length")).count().collect()}  # a row a length
    per_word = min(BITS_A_WORD, max_bytes * 8 / max(1, sum(sizes.values()))) / 64
    blocks = {n: min(1 << 31, int(c * per_word) + 1) for n, c in sizes.items()}

    def run(batches):
        for b in batches:
            by: dict[int, list[str]] = {}
            for w in b.column(0).to_pylist():
                by.setdefault(len(w), []).append(w)
            for n, words in by.items():
                at, mask = _slots(_hashes(_points(words, n)), blocks[n])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), n, np.int32)), pa.array(at.astype(np.int64)), pa.array(mask.view(np.int64))], names=["length", "block", "bits"])

    # the blocks of a filter whose size is bounded above
    rows = vocabulary.select("word").mapInArrow(run, "length int, block long, bits long").groupBy("length", "block").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = {n: np.zeros(k, np.uint64) for n, k in blocks.items()}
    length, block, bits = (rows[c].to_numpy() for c in ("length", "block", "bits"))
    for n, filled in out.items():
        own = length == n
        filled[block[own]] = bits[own].view(np.uint64)
    return out


def _probe(h: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    at, mask = _slots(h, len(blocks))
    return (blocks[at] & mask) == mask


def candidates(words: list[str], length: int, filters: dict[int, np.ndarray]):
    """(k, edit) of the edits of words[k], all of that length, that the filters let pass."""
    points, power = _points(words, length), _powers(length)
    values = _values(points) * power
    total = values.sum(1, dtype=np.uint64)
    if (shorter := filters.get(length - 1)) is not None:
        before = np.cumsum(values, 1, dtype=np.uint64)
        rest = (total[:, None] - before) * np.uint64(pow(_BASE, -1, 1 << 64))  # what stands behind moves up by one
        edits = before - values + rest
        first = np.ones(points.shape, bool)
        first[:, 1:] = points[:, 1:] != points[:, :-1]  # of equal neighbours one deletion is enough
        k, j = np.nonzero(first)
        hit = _probe(edits[k, j], shorter)
        for a, b in zip(k[hit].tolist(), j[hit].tolist(), strict=True):
            yield a, words[a][:b] + words[a][b + 1:]
    same, letters = filters.get(length), _values(ALPHABET)
    if same is not None:
        for j in range(length):
            k, c = np.nonzero(points[:, j, None] < ALPHABET)
            hit = _probe(total[k] + (letters[c] * power[j] - values[k, j]), same)
            for a, b in zip(k[hit].tolist(), ALPHABET[c[hit]].tolist(), strict=True):
                yield a, words[a][:j] + chr(b) + words[a][j + 1:]


def near_pairs(vocabulary: DataFrame, filters: dict[int, np.ndarray]) -> DataFrame:
    """a, n_a, b, n_b: each pair of words one edit apart, once."""
    context = vocabulary.sparkSession.sparkContext
    shared = context.broadcast(filters)
    tasks = max(context.defaultParallelism, vocabulary.count() // WORDS_A_TASK + 1)

    def run(batches):
        for batch in batches:
            by: dict[int, list[tuple[str, int]]] = {}
            for w, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                by.setdefault(len(w), []).append((w, n))
            for length, rows in by.items():
                step = max(1, EDITS_AT_ONCE // (length * len(ALPHABET)))
                for s in range(0, len(rows), step):
                    part = rows[s:s + step]
                    found = list(candidates([w for w, _ in part], length, shared.value))
                    if found:
                        yield pa.RecordBatch.from_pydict({"a": [part[k][0] for k, _ in found], "n_a": [part[k][1] for k, _ in found], "b": [e for _, e in found]})

    positives = vocabulary.select("word", "n").repartition(tasks, "word").mapInArrow(run, "a string, n_a long, b string")
    return positives.join(vocabulary.select(F.col("word").alias("b"), F.col("n").alias("n_b")), "b").select("a", "n_a", "b", "n_b")


def roots(forms: DataFrame) -> DataFrame:
    """word, root: each word with a form, led to the end of its chain; a form is at least twice as common, so chains end."""
    state = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = state.select(F.col("word").alias("root"), F.col("root").alias("further"))
        state = written(state.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        moved, state = state.filter("moved").isEmpty(), state.drop("moved")
        if moved:
            return state


def variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, max_filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of docs (doc_id, text).

    form: the near word of largest n, the first in code-point order of several, if it is at least twice as common; else null.
    """
    vocabulary = written(word_counts(docs, min_length, min_count), "vocabulary")
    pairs = near_pairs(vocabulary, shards(vocabulary, max_filter_bytes))
    ways = F.array(F.struct(F.col("a").alias("word"), F.col("n_a").alias("n"), F.col("b").alias("near"), F.col("n_b").alias("near_n")),
                   F.struct(F.col("b").alias("word"), F.col("n_b").alias("n"), F.col("a").alias("near"), F.col("n_a").alias("near_n")))
    each = pairs.select(F.inline(ways))
    best = each.groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("top"))
    led = -F.col("top.less") >= 2 * F.col("n")
    near = written(best.select("word", "n_near", F.when(led, F.col("top.near")).alias("form"), F.when(led, -F.col("top.less")).alias("form_n")), "near_words")
    chains = roots(near.filter("form is not null"))
    return vocabulary.join(near, "word", "left").join(chains, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
