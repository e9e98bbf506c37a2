"""Secret scans: fixed patterns, and a linear-chain conditional random field that adds spans beside them.

Tokens are the runs of non-space characters of a line; a line is a sequence. Labels are outside, begin, inside. A token's
scores are sums over features of its shape (characters, length, entropy, known beginnings, key words), the same
features of the two tokens before and of the one after, and features of the whole text (length, share of tokens with
digits or symbols). The features of a distinct token, the same for all lengths, are computed in arrays once a task and kept in a bounded table; scores of
all tokens are then array sums. Viterbi decoding runs on the lines where a secret can win: a line in which no token's
best secret score plus the dearest transitions beats `outside` has the all-outside path as its optimum, exactly.

The field is fitted on a bounded sample (`max_docs` documents with pattern matches and as many without, by smallest hash
of doc_id, and of the stretches around all their secrets and in other lines `max_lines`, by hash), whose tokens under
pattern matches are the labels, with invented secrets of other shapes set into it. Stretches are cut where the texts are.

Spans are code points, end exclusive, of kind assign, access, hex (pattern matches) or crf. A crf span is the core of its tokens, without
quotes, key and punctuation around, and is left out where it overlaps a pattern match. Defined cases: a null text is empty and has no spans; rows without doc_id are scanned,
not learnt from; repeated rows give repeated results; without documents the field marks nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import itertools
import math
import random
import re
import string
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightwave.llm.common import map_batches, text_of, written

KINDS = ("assign", "access", "hex", "crf")
KEYS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS, _HEX = re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]{32,}")
_FIRST, _KEY, _LAST = re.compile("[A-Za-z0-9]"), re.compile(r"""[A-Za-z_.-]+["']?[:=]["']?(?=[A-Za-z0-9])"""), re.compile("[A-Za-z0-9+/_=-]")
_TOKEN = re.compile(r"\S+")
MAX_DOCS, MAX_LINES, CACHE, SHAPES, WIDE = 1500, 6000, 400_000, 128, 24
O, B, I = 0, 1, 2
_ROLES = 4  # the token itself, one before, two before, one after


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Pattern matches as (kind, start, end), by start, then kind as listed."""
    found = []
    low = text.lower()
    if any(k in low for k in KEYS):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return [(KINDS[k], s, e) for s, k, e in sorted(found)]


def _value_spans(text: str) -> list[tuple[int, int]]:
    """What is secret in the pattern matches."""
    return [m.span(2) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8] + [m.span() for m in _ACCESS.finditer(text) if len(m[0]) >= 16] + [m.span() for m in _HEX.finditer(text)]


#: Beginnings of usual access tokens, and words that announce a secret; fixed values.
STARTS = ("AKIA", "ASIA", "ghp_", "gho_", "github_pat_", "glpat-", "sk-", "pk_", "sk_", "xox", "eyJ", "AIza", "ya29", "Bearer", "-----BEGIN")
ANNOUNCE = ("password", "passwd", "pwd", "secret", "token", "apikey", "api_key", "api-key", "auth", "bearer", "credential", "key", "private")

_NAMES = ["bias", "edge", *(f"len{k}" for k in (1, 3, 6, 10, 16, 24, 32, 48, 999)), "digit", "mostdigit", "alldigit", "upper", "mixed", "hexlong", "b64long", "symbol", "quote", "assignsign", "inner", "url", "mail", "novowel",
          *(f"entropy{k}" for k in range(6)), *(f"turns{k}" for k in range(4)), "announce", "start", *(f"shape{k}" for k in range(SHAPES))]
_AT = {n: i for i, n in enumerate(_NAMES)}
_FILE = ("long", "middle", "short", "plain", "some", "many")


class _Kinds(dict):
    """Kind of a character: digit, capital, letter, quote, sign of assignment, any other."""

    def __missing__(self, o):
        c = chr(o)
        self[o] = k = "0" if c.isdigit() else "A" if "A" <= c <= "Z" else "a" if c.isalpha() else c if c in "\"'=:@/" else "-"
        return k


_KINDS = _Kinds()
_ANNOUNCED = re.compile("|".join(map(re.escape, ANNOUNCE)), re.IGNORECASE).search


def _own(w: str) -> str:
    return w.strip("\"'`.,;:!?()[]{}<>#*%&$")


def _entropy(counts) -> float:
    m = sum(counts)
    return math.log2(m) - sum(c * math.log2(c) for c in counts) / m if m else 0.0


def entropies(words: list[str]) -> np.ndarray:
    """Bits a character of each word, in array steps for words of up to WIDE characters."""
    size = np.array([len(w) for w in words], np.int64)
    out = np.zeros(len(words))
    for k in np.flatnonzero(size > WIDE):
        out[k] = _entropy(Counter(words[k]).values())
    short = np.flatnonzero((size > 0) & (size <= WIDE))
    logs = np.log2(np.maximum(1, np.arange(WIDE + 1)))
    for s in range(0, len(short), 4096):
        at = short[s:s + 4096]
        width = int(size[at].max())
        x = np.frombuffer("".join(words[k].ljust(width, "\0") for k in at).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(at), width)
        live = np.arange(width)[None] < size[at][:, None]
        same = (x[:, :, None] == x[:, None, :]).sum(axis=2)
        out[at] = logs[size[at]] - np.where(live, logs[np.minimum(same, WIDE)], 0).sum(axis=1) / size[at]
    return out


_VOWEL = re.compile("[aeiou]", re.IGNORECASE | re.ASCII).search


def kinds_of(words: list[str]) -> list[tuple[str, bool, tuple]]:
    """What the features of each token depend on: its characters' kinds, whether it announces a secret, and what its own characters tell, whatever its length."""
    own = [_own(w) for w in words]
    bits = np.minimum(5, np.floor(entropies(own) + 1e-9)).astype(int).tolist()
    tell = [(b, o.startswith(STARTS), len(o) > 5 and _VOWEL(o) is None, len(o) >= 16 and not o.strip(string.hexdigits), len(o) >= 16 and not o.strip(string.ascii_letters + string.digits + "+/=_-")) for b, o in zip(bits, own)]
    return [(w.translate(_KINDS), _ANNOUNCED(w) is not None, t) for w, t in zip(words, tell)]


def is_odd(kinds: str) -> bool:
    """Not a word with at most one other character at its end."""
    return bool(kinds[:-1].strip("aA"))


def token_features(kinds: str, announced: bool, tell: tuple) -> list[int]:
    """Indices of the features of a token."""
    core = kinds.strip("-\"':=@/")
    n = len(core)
    digits, upper, lower = core.count("0"), core.count("A"), core.count("a")
    out = ["bias", next(f"len{k}" for k in (1, 3, 6, 10, 16, 24, 32, 48, 999) if n <= k or k == 999)]
    out += ["digit"] * (digits > 0) + ["mostdigit"] * (2 * digits > n > 0) + ["alldigit"] * (digits == n > 0) + ["upper"] * (upper == n > 0) + ["mixed"] * (upper > 1 and lower > 0 and digits > 0)
    out += ["symbol"] * (len(kinds) > n) + ["quote"] * (kinds[:1] in "\"'" or kinds[-1:] in "\"'") + ["assignsign"] * (kinds[-1:] in "=:") + ["inner"] * ("=" in core or ":" in core) + ["url"] * ("//" in core) + ["mail"] * ("@" in core)
    turns = sum(a != b for a, b in zip(core, core[1:]))
    squeezed = "".join(a for a, b in zip(core, " " + core) if a != b)
    out += [f"turns{min(3, (turns + 1) // 3)}", f"shape{xxhash.xxh32_intdigest(squeezed) % SHAPES}"] + ["announce"] * announced
    bits, *flags = tell
    out += [f"entropy{bits}", *(name for name, on in zip(("start", "novowel", "hexlong", "b64long"), flags) if on)]
    return [_AT[x] for x in out]


def _file_features(n_tokens: int, odd: int) -> list[int]:
    share = odd / max(1, n_tokens)
    return [0 if n_tokens > 1000 else 1 if n_tokens > 100 else 2, 3 if share < 0.02 else 4 if share < 0.2 else 5]


@dataclass
class Field:
    """weight: (feature, place, label); file: (feature, label); step: transitions, the start and the end count as outside."""
    weight: np.ndarray
    file: np.ndarray
    step: np.ndarray
    _ids: dict = field(default_factory=dict, repr=False)  # token to row of the table
    _kinds: dict = field(default_factory=dict, repr=False)  # kind to row of the table
    _table: np.ndarray | None = field(default=None, repr=False)
    _odd: np.ndarray | None = field(default=None, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "_ids": {}, "_kinds": {}, "_table": None, "_odd": None}

    def _room(self, n: int) -> None:
        """Place for n more distinct tokens; row 0 of the table is what lies beyond the ends of a line."""
        if self._table is None or len(self._ids) + n + 1 > len(self._table):
            self._ids.clear()
            self._kinds.clear()
            self._table, self._odd = np.zeros((max(CACHE, n + 1), _ROLES, 3), np.float32), np.zeros(max(CACHE, n + 1), bool)
            self._table[0, 1:] = self.weight[_AT["edge"], 1:]

    def _learn(self, words: list[str]) -> None:
        """Rows of the table for words that it does not have."""
        for word, kind in zip(words, kinds_of(words)):
            k = self._kinds.get(kind)
            if k is None:
                k = self._kinds[kind] = len(self._kinds) + 1
                self._table[k] = self.weight[token_features(*kind)].sum(axis=0)
                self._odd[k] = is_odd(kind[0])
            self._ids[word] = k

    def _gather(self, texts: list[list[list[str]]]) -> tuple[np.ndarray, np.ndarray]:
        """Scores of all tokens of some texts, lines parted by two rows of edge; and to which text each row belongs."""
        self._room(sum(len(w) for t in texts for w in t))
        ids, known, sizes = [], self._ids, []
        self._learn(list({w for lines in texts for words in lines for w in words}.difference(known)))
        for lines in texts:
            before = len(ids)
            ids += (0, 0)
            for words in lines:
                ids += [known[w] for w in words]
                ids += (0, 0)
            sizes.append(len(ids) - before)
        at = np.array(ids, np.int64)
        score = self._table[at, 0]
        score[1:] += self._table[at[:-1], 1]
        score[2:] += self._table[at[:-2], 2]
        score[:-1] += self._table[at[1:], 3]
        owner = np.repeat(np.arange(len(texts)), sizes)
        odd = np.bincount(owner, weights=self._odd[at], minlength=len(texts))
        n = np.bincount(owner, weights=at > 0, minlength=len(texts))
        score += np.stack([self.file[_file_features(int(a), int(b))].sum(axis=0) for a, b in zip(n, odd)]).astype(np.float32)[owner]
        score[at == 0] = (0, -1e9, -1e9)
        return score, owner

    def hot(self, score: np.ndarray) -> np.ndarray:
        """Rows that can be part of a secret that beats the path outside."""
        s = self.step
        dear = max(s[a, b] for a in (O, B, I) for b in (B, I) if (a, b) != (O, I)) - s[O, O] + max(0.0, s[B, O] - s[O, O], s[I, O] - s[O, O])
        return np.maximum(score[:, B], score[:, I]) - score[:, O] + dear > 0

    def decode(self, score: np.ndarray) -> list[int]:
        """Viterbi: the best labels of a line."""
        best, back = self.step[O] + score[0] + np.array([0, 0, -1e9]), []
        for row in score[1:]:
            to = best[:, None] + self.step
            back.append(to.argmax(axis=0))
            best = to.max(axis=0) + row
        label = int((best + self.step[:, O]).argmax())
        path = [label]
        for b in reversed(back):
            path.append(label := int(b[label]))
        return path[::-1]

    def spans(self, texts: list[str]) -> list[list[tuple[int, int]]]:
        """Core of each tagged secret of each text."""
        out: list[list[tuple[int, int]]] = [[] for _ in texts]
        part, first, size = [], 0, 0
        for i, text in enumerate(texts):
            part.append(text.split("\n"))
            size += len(text)
            if size > 400_000 or i == len(texts) - 1:
                self._some(part, out, first)
                part, first, size = [], i + 1, 0
        return out

    def _some(self, texts: list[list[str]], out: list, first: int) -> None:
        split = [[line.split() for line in lines] for lines in texts]
        score, _ = self._gather(split)
        at = np.flatnonzero(self.hot(score))
        k, row = 0, 0
        for i, lines in enumerate(split):
            row += 2
            start = 0
            for line, words in zip(texts[i], lines):
                stop = row + len(words)
                while k < len(at) and at[k] < row:
                    k += 1
                if k < len(at) and at[k] < stop:
                    self._line(line, start, self.decode(score[row:stop]), out[first + i])
                start += len(line) + 1
                row = stop + 2

    @staticmethod
    def _line(line: str, start: int, path: list[int], out: list) -> None:
        run = None
        for m, label in zip([*_TOKEN.finditer(line), None], [*path, O]):
            if label != I and run:
                c = _core(line, *run)
                if c:
                    out.append((start + c[0], start + c[1]))
                run = None
            if label == B:
                run = m.span()
            elif label == I and run:
                run = (run[0], m.end())


def _core(line: str, a: int, b: int) -> tuple[int, int] | None:
    """Where the secret of a run of tokens is: from its first letter or digit, behind a key, to its last character that secrets have. One walk from each end."""
    first = _FIRST.search(line, a, b)
    if first is None:
        return None
    key = _KEY.match(line, first.start(), b)
    at = key.end() if key else first.start()
    while not _LAST.match(line, b - 1):
        b -= 1
    return at, b


def _labels(lines: list[str], secrets: list[tuple[int, int]]):
    """The labels of each line's tokens. Tokens and secrets are walked together."""
    secrets, at, start = sorted(secrets), 0, 0
    for line in lines:
        out, before = [], None
        for m in _TOKEN.finditer(line):
            while at < len(secrets) and secrets[at][1] <= start + m.start():
                at += 1
            hit = at if at < len(secrets) and secrets[at][0] < start + m.end() else None
            out.append(O if hit is None else I if hit == before else B)
            before = hit
        yield out
        start += len(line) + 1


def _invented(rng: random.Random) -> str:
    """A secret of a usual shape."""
    pick = lambda chars, n: "".join(rng.choice(chars) for _ in range(n))
    word, b64 = string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/"
    return rng.choice([lambda: "ghp_" + pick(word, 36), lambda: "sk-" + pick(word, rng.randint(20, 48)), lambda: "eyJ" + pick(word, 30) + "." + pick(word, 40), lambda: pick(b64, rng.randint(24, 64)) + "=", lambda: pick("0123456789abcdef", rng.choice([24, 32, 40])),
                       lambda: pick("0123456789ABCDEF", 32), lambda: "xoxb-" + pick(string.digits, 11) + "-" + pick(word, 24), lambda: "AKIA" + pick(string.ascii_uppercase + string.digits, 16), lambda: pick(word, rng.randint(20, 40)), lambda: pick(string.ascii_letters, rng.randint(20, 40))])()


def training_lines(texts: list[str], radius: int = 8) -> list[tuple[list[str], list[int], list[int]]]:
    """(tokens, labels, file features) of stretches around secrets, real and invented, and of others without."""
    out = []
    for text in texts:
        rng = random.Random(xxhash.xxh64_intdigest(text))
        lines = text.split("\n")
        n = len(text.split())
        odd = sum(is_odd(w.translate(_KINDS)) for w in text.split())
        for line, label in zip(lines, _labels(lines, _value_spans(text))):
            words = line.split()
            marked = [k for k, x in enumerate(label) if x == B]
            for k in marked or ([rng.randrange(len(words))] if words and rng.random() < 0.25 else []):
                a, b = max(0, k - radius), k + radius
                part, tags = words[a:b], label[a:b]
                if tags and tags[0] == I:
                    tags[0] = B
                out.append((part, tags, _file_features(n, odd)))
                if not marked and rng.random() < 0.4:
                    key = rng.choice([[], [], [rng.choice(ANNOUNCE), "="], [rng.choice(ANNOUNCE) + ":"]])
                    mark = rng.choice(['"', "'", ""])
                    at = rng.randint(0, len(part))
                    out.append((part[:at] + key + [mark + _invented(rng) + mark + rng.choice(["", "", ",", "."])] + part[at:], tags[:at] + [O] * len(key) + [B] + tags[at:], _file_features(n, odd)))
    return out


def fit_field(lines: list[tuple[list[str], list[int], list[int]]], epochs: int = 8, rate: float = 0.3, decay: float = 1e-4, seed: int = 0) -> Field:
    """Conditional likelihood by Adagrad over minibatches, gradients by forward-backward in log space."""
    model = Field(np.zeros((len(_NAMES), _ROLES, 3)), np.zeros((len(_FILE), 3)), np.zeros((3, 3)))
    model.step[O, I] = -1e9
    lines = [x for x in lines if x[0]]
    if not lines:
        model.weight[_AT["bias"], 0] = (0, -10, -10)
        return model
    cache: dict[str, np.ndarray] = {}

    def vector(w: str) -> np.ndarray:
        if w not in cache:
            v = cache[w] = np.zeros(len(_NAMES))
            v[token_features(*kinds_of([w])[0])] = 1
        return cache[w]

    edge = np.zeros(len(_NAMES))
    edge[_AT["edge"]] = 1
    longest = max(len(x[0]) for x in lines)
    n = np.array([len(v[0]) for v in lines])
    rng = np.random.default_rng(seed)
    grads = [np.full_like(p, 1e-2) for p in (model.weight, model.file, model.step)]
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(len(lines)), max(1, len(lines) // 64)):
            xs, fs = np.zeros((len(part), longest, _ROLES, len(_NAMES))), np.zeros((len(part), len(_FILE)))
            ys, ns = np.zeros((len(part), longest), np.int64), n[part]
            for k, (words, tags, own) in enumerate(lines[i] for i in part):
                v = np.stack([edge, edge, *map(vector, words), edge])
                for role, off in enumerate((2, 1, 0, 3)):
                    xs[k, :len(words), role] = v[off:off + len(words)]
                ys[k, :len(words)], fs[k, own] = tags, 1
            score = np.einsum("btrf,frl->btl", xs, model.weight, optimize=True) + (fs @ model.file)[:, None]
            node, pair = _marginals(score, ns, model.step)
            live = np.arange(longest)[None] < ns[:, None]
            hot = np.eye(3)[ys] * live[..., None]
            diff = (node - hot) / len(part)
            true = np.zeros((3, 3))
            prev = np.concatenate([np.zeros((len(part), 1), np.int64), ys[:, :-1]], axis=1)
            np.add.at(true, (prev[live], ys[live]), 1)
            np.add.at(true, (ys[np.arange(len(part)), ns - 1], 0), 1)
            update = (np.einsum("btrf,btl->frl", xs, diff, optimize=True) + decay * model.weight, fs.T @ diff.sum(axis=1) + decay * model.file, (pair - true) / len(part))
            for p, g, u in zip((model.weight, model.file, model.step), grads, update):
                g += u**2
                p -= rate * u / np.sqrt(g)
            model.step[O, I] = -1e9
    return model


def _marginals(score: np.ndarray, n: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Label probabilities (b, t, 3), zero beyond the end, and expected transitions (3, 3) with those from the start and to the end."""
    b, t, _ = score.shape
    lse = lambda v, axis: np.log(np.exp(v - (m := v.max(axis=axis, keepdims=True))).sum(axis=axis)) + m.squeeze(axis)
    fore, aft = np.zeros_like(score), np.zeros_like(score)
    fore[:, 0] = step[O] + score[:, 0]
    for k in range(1, t):
        fore[:, k] = lse(fore[:, k - 1, :, None] + step, 1) + score[:, k]
    last = n - 1
    for k in range(t - 1, -1, -1):
        inner = lse(step + (score[:, k + 1] + aft[:, k + 1])[:, None, :], 2) if k + 1 < t else np.zeros((b, 3))
        aft[:, k] = np.where((k == last)[:, None], step[:, O], inner)
    z = lse(fore[np.arange(b), last] + step[:, O], 1)
    live = np.arange(t)[None] < n[:, None]
    node = np.exp(np.minimum(fore + aft - z[:, None, None], 0)) * live[..., None]
    pair = np.zeros((3, 3))
    pair[O] += node[:, 0].sum(axis=0)
    pair[:, O] += node[np.arange(b), last].sum(axis=0)
    for k in range(1, t):
        joint = np.exp(np.minimum(fore[:, k - 1, :, None] + step + (score[:, k] + aft[:, k])[:, None, :] - z[:, None, None], 0))
        pair += joint[live[:, k]].sum(axis=0)
    return node, pair


def fit(docs: DataFrame, max_docs: int = MAX_DOCS, max_lines: int = MAX_LINES) -> Field:
    """A field learnt from at most max_lines stretches of at most 2 * max_docs documents."""
    rows = docs.filter(F.col("doc_id").isNotNull()).select("doc_id", text_of().alias("text"))
    hit = F.col("text").rlike(r"(?i:password|passwd|secret|token|api_?key)[\"']? *[:=] *[\"']?[A-Za-z0-9+/_.=-]{8}|AKIA[A-Z0-9]{12}|[0-9a-f]{32}")
    known = written(rows.select("doc_id", hit.alias("hit")), "hits")  # so that no text is sorted
    ids = [known.filter(f).select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs) for f in (F.col("hit"), ~F.col("hit"))]
    chosen = rows.join(F.broadcast(ids[0].union(ids[1]).distinct()), "doc_id")  # 2 * max_docs ids
    kind = pa.list_(pa.struct([("k", pa.int64()), ("words", pa.list_(pa.string())), ("tags", pa.list_(pa.int32())), ("file", pa.list_(pa.int32()))]))

    def cut(b: pa.RecordBatch) -> list:
        return [[[{"k": k, "words": w, "tags": t, "file": f} for k, (w, t, f) in enumerate(training_lines([text]))] for text in b["text"].to_pylist()]]

    lines = map_batches(chosen, ["doc_id"], {"x": kind}, cut).select("doc_id", F.explode("x").alias("x")).select("doc_id", "x.*")
    found = lines.orderBy(F.xxhash64("doc_id", "k"), "doc_id", "k", "words").limit(max_lines).collect()  # max_lines stretches of some 20 tokens
    return fit_field([(r.words, r.tags, r.file) for r in found])


def all_spans(texts: list[str], model: Field) -> list[list[tuple[str, int, int]]]:
    """(kind, start, end) of each text, by start, then kind as listed."""
    out = []
    for text, own in zip(texts, model.spans(texts)):
        base = base_spans(text)
        starts, reach = [a for _, a, _ in base], list(itertools.accumulate((b for _, _, b in base), max))
        added = [("crf", s, e) for s, e in own if not ((k := bisect.bisect_left(starts, e)) and reach[k - 1] > s)]
        out.append(sorted(base + added, key=lambda x: (x[1], KINDS.index(x[0]))))
    return out


SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def scan(docs: DataFrame, model: Field) -> DataFrame:
    """doc_id and spans (array of kind, start, end) of every row of docs."""
    return map_batches(docs.select("doc_id", text_of().alias("text")), ["doc_id"], {"spans": SPAN},
                       lambda b: [[[{"kind": k, "start": s, "end": e} for k, s, e in x] for x in all_spans(b["text"].to_pylist(), model)]])
