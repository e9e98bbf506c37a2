"""Toxicity by a factorization machine over hashed terms.

Terms of a text are its distinct lower-case words and their beginnings of `PREFIXES` letters, hashed to 2 ** `BITS` slots,
every one of which the machine has. It scores w0 + sum of w_i x_i + sum of <v_i, v_j> x_i x_j over the pairs of present
slots, so a pair that is toxic only together (an insult and a group's name) gets a weight that no sum of single weights
can express. x is a slot's value, 1 / (1 + (`STEADY` / g) ** 2): g is how far its toxic documents are from the expected,
squared and in units of their variance, so what chance explains enters faintly, and nothing is left out.

Learning uses at most `max_rows` labelled documents of the training folds, those with the smallest hash of doc_id
(the bound is a parameter, the sample does not depend on partitioning). Documents of a slot are counted on the executors;
the machine is fitted on the driver over the slots of these documents, and goes out with the tasks (2 ** bits *
(rank + 1) numbers, whatever the corpus). Scoring is one pass over whole texts.

Defined cases: a null text is the empty text and scores the bias alone; rows without doc_id are never trained on and
not held out; a document with several labels counts as toxic if one says so, null labels are ignored; without both
classes among the labels every text scores the smoothed share of toxic labels; repeated rows score alike; an empty
table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightwave.llm.common import map_batches, text_of

PREFIXES, FOLDS = (4, 5, 6), 5
MAX_ROWS, BITS, RANK, EPOCHS, STEADY = 5_000, 18, 8, 12, 30.0
CACHE = 300_000
_FIND = re.compile(r"\w+").findall


def terms(word: str) -> list[str]:
    """A lower-case word and its beginnings."""
    return [word] + [f"{word[:k]}*" for k in PREFIXES if len(word) > k]


class Slots(dict):
    """Slots of the terms of a word; forgets all when full."""

    def __init__(self, bits: int = BITS):
        super().__init__()
        self.mask = (1 << bits) - 1

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= CACHE:
            self.clear()
        self[word] = at = tuple(xxhash.xxh64_intdigest(t) & self.mask for t in terms(word))
        return at

    def of(self, text: str) -> np.ndarray:
        """The distinct slots of a text, in order."""
        found = {s for w in set(_FIND(text.lower())) for s in self[w]}
        return np.sort(np.fromiter(found, np.int32, len(found)))


@dataclass
class FactorizationMachine:
    """weight and factor by slot, both times the slot's value."""
    bias: float
    weight: np.ndarray
    factor: np.ndarray
    _slots: Slots | None = field(default=None, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "_slots": None}

    def raw(self, rows: list[np.ndarray]) -> np.ndarray:
        return _raw(self.bias, self.weight, self.factor, *_flat(rows))[0]

    def score(self, texts: list[str]) -> np.ndarray:
        if self._slots is None:
            self._slots = Slots(len(self.weight).bit_length() - 1)
        out = []
        for k in range(0, len(texts), 256):
            out.append(1 / (1 + np.exp(-np.clip(self.raw([self._slots.of(t) for t in texts[k:k + 256]]), -30, 30))))
        return np.concatenate(out) if out else np.zeros(0)


def _flat(rows: list) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate([np.asarray(r, np.int64) for r in rows]) if rows else np.zeros(0, np.int64), np.array([len(r) for r in rows], np.int64)


def _sums(x: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sums of consecutive parts of x, n[i] rows each."""
    out = np.zeros((len(n), *x.shape[1:]))
    if len(x):
        out[n > 0] = np.add.reduceat(x, (np.cumsum(n) - n)[n > 0], axis=0, dtype=np.float64)
    return out


def _raw(bias, weight, factor, at, n):
    v = factor[at]
    total = _sums(v, n)
    return bias + _sums(weight[at], n) + 0.5 * (total**2 - _sums(v**2, n)).sum(axis=1), total, v


def slot_values(n: np.ndarray, toxic: np.ndarray, share: float, steady: float = STEADY) -> np.ndarray:
    """Values of slots with n documents, of which some are toxic; share is that of all documents."""
    gain = (toxic - n * share) ** 2 / ((n + 3) * max(share * (1 - share), 1e-12))
    return np.where(gain > 0, 1 / (1 + (steady / np.maximum(gain, 1e-12)) ** 2), 0).astype(np.float32)


def fit_machine(values: np.ndarray, rows: list[np.ndarray], y: np.ndarray, rank: int = RANK, epochs: int = EPOCHS, seed: int = 0, rate: float = 0.1, decay: float = 2e-4) -> FactorizationMachine:
    """Logistic loss by minibatches with Adagrad over slots with values; the same rows in the same order give the same machine."""
    prior = (y.sum() + 0.05) / (len(y) + 1)
    bias, weight = float(np.log(prior / (1 - prior))), np.zeros(len(values), np.float32)
    rng = np.random.default_rng(seed)
    factor = rng.normal(0, 0.02, (len(values), rank)).astype(np.float32)
    if 0 < y.sum() < len(y):
        lift = np.where(y > 0, ((len(y) - y.sum()) / y.sum()) ** 0.5, 1.0)  # the rarer class counts more
        g0, gw, gv = 1.0, np.ones_like(weight), np.ones_like(factor)
        for _ in range(epochs):
            for part in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // 256)):
                at, n = _flat([rows[i] for i in part])
                x = values[at]
                used, place = np.unique(at, return_inverse=True)
                v = factor[at] * x[:, None]
                total = _sums(v, n)
                raw = bias + _sums(weight[at] * x, n) + 0.5 * (total**2 - _sums(v**2, n)).sum(axis=1)
                err = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - y[part]) * lift[part]
                each = np.repeat(err, n) * x
                slope = each[:, None] * (np.repeat(total, n, axis=0) - v)
                dw = np.bincount(place, weights=each, minlength=len(used)) + decay * len(part) * weight[used]
                dv = np.stack([np.bincount(place, weights=c, minlength=len(used)) for c in slope.T], axis=1) + decay * len(part) * factor[used]
                g0 += err.sum() ** 2
                gw[used] += dw**2
                gv[used] += dv**2
                bias -= rate * err.sum() / g0**0.5
                weight[used] -= rate * dw / gw[used] ** 0.5
                factor[used] -= rate * dv / gv[used] ** 0.5
    return FactorizationMachine(float(bias), weight * values, factor * values[:, None])


def held_out(doc_id: str = "doc_id"):
    """Whether a document belongs to the fold that is never trained on."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == 0, F.lit(False))


def _count_rows(train: DataFrame, bits: int) -> DataFrame:
    """slot, n, toxic: a row for each slot of each batch, with the batch's documents and toxic documents that have it."""
    def run(batches):
        slots = Slots(bits)
        for b in batches:
            found = [slots.of(t) for t in b["text"].to_pylist()]
            if found:
                toxic = np.repeat(b["toxic"].to_numpy(zero_copy_only=False), [len(t) for t in found])
                slot, at = np.unique(np.concatenate(found), return_inverse=True)
                counts = np.bincount(at, minlength=len(slot)), np.bincount(at, weights=toxic, minlength=len(slot))
                yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (slot, *counts)], names=["slot", "n", "toxic"])

    return train.select("text", "toxic").mapInArrow(run, "slot long, n long, toxic long")


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, bits: int = BITS, rank: int = RANK) -> FactorizationMachine:
    """A machine learnt from at most max_rows labelled documents outside the held-out fold."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max("toxic").cast("long").alias("toxic"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    train = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(known), "doc_id")  # max_rows pairs of numbers
    counts = _count_rows(train, bits).groupBy("slot").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic")).toArrow()  # 2 ** bits rows at most
    whole, bad = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    values, at = np.zeros(1 << bits, np.float32), counts["slot"].to_numpy()
    values[at] = slot_values(counts["n"].to_numpy(), counts["toxic"].to_numpy(), bad / max(whole, 1))
    slots = Slots(bits)
    found = map_batches(train.select("doc_id", "toxic", "text"), ["doc_id", "toxic"], {"at": pa.binary()}, lambda b: [[slots.of(t).tobytes() for t in b["text"].to_pylist()]])
    rows = found.toArrow().to_pydict()  # max_rows documents, 2 ** bits slots each at most
    order = sorted(range(len(rows["at"])), key=lambda i: (rows["doc_id"][i], rows["at"][i]))
    return fit_machine(values, [np.frombuffer(rows["at"][i], np.int32) for i in order], np.array([rows["toxic"][i] for i in order], float), rank)


def with_score(docs: DataFrame, machine: FactorizationMachine, column: str) -> DataFrame:
    """docs with a score from 0 to 1 in a new column."""
    text = docs.columns.index("text")
    return map_batches(docs, docs.columns, {column: pa.float64()}, lambda b: [machine.score([t or "" for t in b.column(text).to_pylist()])])


def score(docs: DataFrame, machine: FactorizationMachine) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of docs."""
    return with_score(docs.select("doc_id", "text"), machine, "score").select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
