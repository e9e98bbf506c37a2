"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks at its block-level tags. A block is a vector of its tag path (tags, hashed class and id
words), all its words, hashed and in shares of their number, its length, its share of linked text and its place; a bidirectional LSTM in numpy reads the
whole sequence of blocks and labels each one, so a block is judged with all of the page before and after it.

It learns from a bounded sample (`max_pages` pages, by smallest hash of page_id) whose own markup tells: blocks in
article or main, and in none of the elements for menus, asides, forms and the like, are content. So that it does not
live on that markup alone, pages are learnt from again with these tags turned into div, and with invented menus, notices,
side bars and comments around and between. The pages are cut and labelled where they are read; what is learnt from are
at most `max_windows` stretches of `WINDOW` blocks that cover whole pages.

Cutting a page takes time in proportion to its length, however it is formed: a tag whose end is hidden in quotes is text,
and from there on quotes hide nothing. Defined cases: null or empty html, and pages without content, give the empty text; white space is what Unicode says; character
references are decoded once, unknown ones stay; unclosed and stray tags are taken as they come; without
a page that tells, blocks under the usual content tags are content; repeated rows give repeated results; an empty table an empty result.
"""

from __future__ import annotations

import html
import random
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightwave.llm.common import map_batches

MAX_PAGES, MAX_WINDOWS, HIDDEN, EPOCHS, WINDOW = 240, 800, 16, 6, 48
ROWS, CHARS = 16_384, 4_000_000  # blocks and characters held at a time
_STOP, _NAME = re.compile("[\"'>]"), re.compile(r"[a-zA-Z][^\s/>]*")
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
#: Elements whose content is not text of the page, that do not end a block, elements without an end tag, and elements whose start ends an open one of the same name.
HIDDEN_TEXT = frozenset("script style noscript template svg textarea select".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr br".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ALONE = frozenset("p li td th tr option dt dd".split())
CONTENT, OTHER = frozenset(("article", "main")), frozenset("nav header footer aside form head title button menu dialog".split())
OTHER_WORDS = frozenset("ad ads advert advertisement promo sponsor sponsored banner nav menu sidebar comment comments footer header cookie notice popup share social related newsletter breadcrumb login search widget".split())
TAGS = sorted({"article", "main", "section", "div", "p", "h1", "h2", "h3", "h4", "ul", "ol", "li", "table", "tr", "td", "blockquote", "pre", "figure", "figcaption", "body", "html", "dl", "dt", "dd"} | OTHER)
_TAG_AT = {t: i for i, t in enumerate(TAGS)}
_CLASSES, _WORDS = 48, 128
_PATH_SIZE = len(TAGS) * 2 + _CLASSES
SIZE = _PATH_SIZE + _WORDS + 6


class Path:
    """A place in the tree of tags; blocks under the same tags share one, and each knows its parent alone."""

    __slots__ = ("tag", "words", "parent", "content", "other", "kids", "_vector")
    made = 0

    def __init__(self, tag: str = "", words: tuple[str, ...] = (), parent: Path | None = None):
        self.tag, self.words, self.parent, self.kids, self._vector = tag, words, parent, {}, None
        self.content = tag in CONTENT or bool(parent and parent.content)
        self.other = tag in OTHER or bool(OTHER_WORDS & set(words)) or bool(parent and parent.other)

    def child(self, tag: str, words: tuple[str, ...] = ()) -> Path:
        key = (tag, words)
        if key not in self.kids:
            self.kids[key] = Path(tag, words, self)
            Path.made += 1
        return self.kids[key]

    def vector(self) -> np.ndarray:
        chain = []
        at: Path | None = self
        while at is not None and at._vector is None:
            chain.append(at)
            at = at.parent
        for p in reversed(chain):
            v = np.zeros(_PATH_SIZE, np.float32) if p.parent is None else p.parent._vector.copy()
            v[len(TAGS):2 * len(TAGS)] = 0
            if p.tag in _TAG_AT:
                v[_TAG_AT[p.tag]] = v[len(TAGS) + _TAG_AT[p.tag]] = 1
            for w in p.words:
                v[2 * len(TAGS) + xxhash.xxh32_intdigest(w) % _CLASSES] += 1
            p._vector = v
        return self._vector


_ROOT = [Path()]


def _root() -> Path:
    """The tree's root, a new one when the tree has grown large."""
    if Path.made > 20_000:
        Path.made, _ROOT[0] = 0, Path()
    return _ROOT[0]


@dataclass
class Block:
    path: Path
    text: str
    linked: int


def _end_of_tag(source: str, at: int) -> int:
    """Place of the > that ends the tag, quoted ones aside; -1 if there is none. A quote without its pair is a plain sign."""
    lone = set()
    m = _STOP.search(source, at)
    while m:
        if m[0] == ">":
            return m.start()
        close = -1 if m[0] in lone else source.find(m[0], m.end())
        if close < 0:
            lone.add(m[0])
        m = _STOP.search(source, m.end() if close < 0 else close + 1)
    return -1


def pieces(source: str):
    """(text, "", False, "") of each run of text and ("", tag, closing, attributes) of each tag outside comments and hidden elements."""
    at, n, last, quotes = 0, len(source), source.rfind(">"), True
    while at < n:
        if source[at] != "<":
            stop = source.find("<", at)
            stop = n if stop < 0 else stop
            yield source[at:stop], "", False, ""
            at = stop
            continue
        if source.startswith("<!--", at):
            stop = source.find("-->", at + 4)
            at = n if stop < 0 else stop + 3
            continue
        if at > last:  # no tag ends any more
            yield source[at:], "", False, ""
            return
        if source[at + 1] in "!?":
            at = source.find(">", at) + 1
            continue
        closing = source[at + 1] == "/"
        first = at + 1 + closing
        if not source[first:first + 1].isascii() or not source[first:first + 1].isalpha():
            yield "<", "", False, ""
            at += 1
            continue
        stop = _end_of_tag(source, first) if quotes else source.find(">", first)
        if stop < 0:
            quotes = False
            yield "<", "", False, ""
            at += 1
            continue
        name = _NAME.match(source, first, stop)[0]
        at = stop + 1
        if name.lower() in HIDDEN_TEXT and not closing:
            end = re.compile(rf"</{name}\s*>", re.IGNORECASE).search(source, at)
            at = end.end() if end else n
        else:
            yield "", name.lower(), closing, source[first + len(name):stop]


def blocks(source: str) -> list[Block]:
    """Leaf blocks of a page with text, in order; references decoded, white space squeezed."""
    out: list[Block] = []
    path = root = _root()
    opened: Counter[str] = Counter()
    text: list[str] = []
    linked, in_link = 0, 0

    def end():
        nonlocal linked
        if text:
            words = " ".join("".join(text).split())
            if words:
                out.append(Block(path, words, linked))
            text.clear()
            linked = 0

    for plain, name, closing, attributes in pieces(source):
        if not name:
            plain = html.unescape(plain)
            text.append(plain)
            if in_link:
                linked += len(plain)
            continue
        if name in INLINE:
            if name == "a":
                in_link = 0 if closing else 1
            elif name == "br":
                text.append(" ")
            continue
        end()
        if closing:
            if opened[name]:
                while True:
                    gone, path = path.tag, path.parent
                    opened[gone] -= 1
                    if gone == name:
                        break
        elif name not in VOID:
            if name in ALONE and path.tag == name:
                opened[name] -= 1
                path = path.parent
            words = tuple(w for a in _ATTRIBUTE.finditer(attributes) for w in re.split(r"[^a-z]+", (a[2] or a[3] or a[4] or "").lower()) if w) if attributes else ()
            path = path.child(name, words)
            opened[name] += 1
    end()
    return out


def told(block: Block) -> bool:
    """Whether the page's own markup says content."""
    return block.path.content and not block.path.other


def vectors(page: list[Block], first: int = 0, stop: int | None = None) -> np.ndarray:
    """A row of features of each of the page's blocks first .. stop - 1."""
    own = page[first:stop]
    out = np.zeros((len(own), SIZE), np.float32)
    k = _PATH_SIZE
    for row, b in enumerate(own):
        i = first + row
        out[row, :k] = b.path.vector()
        words = b.text.split()
        out[row, k:-6] = np.bincount([xxhash.xxh32_intdigest(w) % _WORDS for w in b.text.lower().split()], minlength=_WORDS) * (2.4 / len(words))
        n = len(b.text)
        out[row, -6:] = (np.log1p(len(words)) / 5, b.linked / n, b.text[-1] in ".!?…", b.text[:1].isupper(), i / len(page), 1 / (1 + i))
    return out


class Lazy:
    """The features of a page, made where they are read."""

    def __init__(self, page: list[Block]):
        self.page = page

    def __len__(self) -> int:
        return len(self.page)

    def __getitem__(self, part: slice) -> np.ndarray:
        return vectors(self.page, part.start, part.stop)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """A bidirectional LSTM with one logit a block; parameters a direction: input, recurrent and bias weights of four gates."""

    def __init__(self, size: int = SIZE, hidden: int = HIDDEN, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.hidden = hidden
        make = lambda *s: (rng.normal(size=s) / np.sqrt(s[0])).astype(np.float32)
        self.p = {f"{n}{d}": v for d in "fb" for n, v in (("x", make(size, 4 * hidden)), ("h", make(hidden, 4 * hidden)), ("c", np.repeat(np.float32([0, 1, 0, 0]), hidden)))}
        self.p |= {"o": make(2 * hidden, 1), "k": np.zeros(1, np.float32)}

    def _run(self, x: np.ndarray, live: np.ndarray, d: str) -> tuple[np.ndarray, list]:
        """Hidden states (b, t, hidden) from left to right, and what backpropagation needs. Padding keeps the state."""
        b, t, _ = x.shape
        n, h, c, tape = self.hidden, np.zeros((b, self.hidden), np.float32), np.zeros((b, self.hidden), np.float32), []
        out = np.zeros((b, t, n), np.float32)
        pre = x @ self.p["x" + d] + self.p["c" + d]
        for k in range(t):
            z = pre[:, k] + h @ self.p["h" + d]
            i, f, o = (_sigmoid(z[:, g * n:(g + 1) * n]) for g in range(3))
            g, m = np.tanh(z[:, 3 * n:]), live[:, k, None]
            c2 = f * c + i * g
            th = np.tanh(c2)
            tape.append((h, c, i, f, o, g, th, m))
            h, c = np.where(m, o * th, h), np.where(m, c2, c)
            out[:, k] = h
        return out, tape

    def _back(self, x: np.ndarray, d: str, tape: list, dout: np.ndarray, grad: dict) -> None:
        n = self.hidden
        dh, dc = np.zeros_like(dout[:, 0]), np.zeros_like(dout[:, 0])
        dpre = np.zeros((*x.shape[:2], 4 * n), np.float32)
        for k in range(x.shape[1] - 1, -1, -1):
            h, c, i, f, o, g, th, m = tape[k]
            dh = dh + dout[:, k]
            a, s = np.where(m, dh, 0), np.where(m, dc, 0)
            s = s + a * o * (1 - th**2)
            dz = np.concatenate([s * g * i * (1 - i), s * c * f * (1 - f), a * th * o * (1 - o), s * i * (1 - g**2)], axis=1)
            dpre[:, k] = dz
            grad["h" + d] += h.T @ dz
            dh, dc = np.where(m, 0, dh) + dz @ self.p["h" + d].T, np.where(m, 0, dc) + s * f
        grad["x" + d] += np.einsum("bti,btj->ij", x, dpre, optimize=True)
        grad["c" + d] += dpre.sum(axis=(0, 1))

    @staticmethod
    def _turned(x: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Each sequence backwards, padding still at the end."""
        at = np.arange(x.shape[1])[None]
        at = np.where(at < n[:, None], n[:, None] - 1 - at, at)
        return np.take_along_axis(x, at[..., None] if x.ndim == 3 else at, axis=1)

    def _forward(self, x: np.ndarray, n: np.ndarray):
        live = np.arange(x.shape[1])[None] < n[:, None]
        f, tape_f = self._run(x, live, "f")
        turned = self._turned(x, n)
        b, tape_b = self._run(turned, live, "b")
        both = np.concatenate([f, self._turned(b, n)], axis=2)
        return (both @ self.p["o"] + self.p["k"])[..., 0], both, turned, tape_f, tape_b, live

    def gradients(self, x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, dict]:
        """Mean logistic loss of the live blocks and its gradients."""
        logit, both, turned, tape_f, tape_b, live = self._forward(x, n)
        grad = {k: np.zeros_like(v) for k, v in self.p.items()}
        err = ((_sigmoid(logit) - y) * live / live.sum()).astype(np.float32)
        loss = float(((np.logaddexp(0, logit) - y * logit) * live).sum() / live.sum())
        grad["o"] = np.einsum("bti,bt->i", both, err)[:, None]
        grad["k"] = err.sum(keepdims=True)[0]
        dboth = err[..., None] * self.p["o"][:, 0]
        self._back(x, "f", tape_f, dboth[..., :self.hidden], grad)
        self._back(turned, "b", tape_b, self._turned(dboth[..., self.hidden:], n), grad)
        return loss, grad

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS, seed: int = 0, rate: float = 0.01, batch: int = 16) -> Labeller:
        rng = np.random.default_rng(seed)
        mean, square, step = {k: np.zeros_like(v) for k, v in self.p.items()}, {k: np.zeros_like(v) for k, v in self.p.items()}, 0
        for _ in range(epochs):
            order = sorted(rng.permutation(len(pages)), key=lambda i: len(pages[i][0]))
            for part in rng.permutation(np.arange(0, len(order), batch)):
                own = [pages[i] for i in order[part:part + batch]]
                x, n = _padded([v for v, _ in own])
                y = np.zeros(x.shape[:2], np.float32)
                for i, (_, labels) in enumerate(own):
                    y[i, :len(labels)] = labels
                step += 1
                for k, g in self.gradients(x, y, n)[1].items():
                    mean[k] = 0.9 * mean[k] + 0.1 * g
                    square[k] = 0.99 * square[k] + 0.01 * g * g
                    self.p[k] = (self.p[k] - rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
        return self

    def _side(self, pages: list, n: np.ndarray, d: str, step: int) -> np.ndarray:
        """What one direction adds to the logits (b, t): `step` blocks at a time, of which only the state is carried on."""
        p, own = self.p, self.hidden
        weight = p["o"][:own, 0] if d == "f" else p["o"][own:, 0]
        h, c = (np.zeros((len(pages), own), np.float32) for _ in range(2))
        out = np.zeros((len(pages), n.max()), np.float32)
        for s in range(0, n.max(), step):
            t = min(step, n.max() - s)
            x = np.zeros((len(pages), t, len(p["x" + d])), np.float32)
            for i, m in enumerate(n):
                if m > s:
                    e = min(s + t, m)
                    x[i, :e - s] = pages[i][s:e] if d == "f" else pages[i][m - e:m - s][::-1]
            pre = x @ p["x" + d] + p["c" + d]
            states = np.empty((len(pages), t, own), np.float32)
            for k in range(t):
                z = pre[:, k] + h @ p["h" + d]
                gates = _sigmoid(z[:, :3 * own])
                c = gates[:, own:2 * own] * c + gates[:, :own] * np.tanh(z[:, 3 * own:])
                h = gates[:, 2 * own:] * np.tanh(c)
                states[:, k] = h
            out[:, s:s + t] = states @ weight
        return out

    def label(self, pages: list, batch: int = 64, rows: int = ROWS) -> list[np.ndarray]:
        """Whether each block is content, of pages as arrays or `Lazy`.

        Pages of like length go together, as many as have `rows` blocks when filled up to the longest; a longer page goes
        alone. Features of at most `rows` blocks are held at a time, and of the hidden states only what they add to the logits.
        """
        out: list = [np.zeros(0, bool)] * len(pages)
        order, k = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i])), 0
        while k < len(order):
            own = [i for j, i in enumerate(order[k:k + batch]) if not j or (j + 1) * len(pages[i]) <= rows]
            k += len(own)
            held, n = [pages[i] for i in own], np.array([len(pages[i]) for i in own])
            step = max(1, rows // len(own))
            if n.max() <= step:  # in one slice: both directions read the same features
                held = [p[0:len(p)] for p in held]
            ahead, back = (self._side(held, n, d, step) for d in "fb")
            for i, m, a, b in zip(own, n, ahead, back):
                out[i] = a[:m] + b[:m][::-1] + self.p["k"][0] > 0
        return out


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    n = np.array([len(p) for p in pages])
    x = np.zeros((len(pages), n.max(), pages[0].shape[1]), np.float32)
    for i, p in enumerate(pages):
        x[i, :len(p)] = p
    return x, n


def _varied(page: list[Block], labels: list[bool], rng: random.Random) -> tuple[list[Block], list[bool]]:
    """The page with its telling tags turned into div and invented blocks that are no content."""
    plain = rng.random() < 0.5
    top = Path()
    new: dict[int, Path] = {}

    def renamed(path: Path) -> Path:
        chain = []
        while path.parent is not None and id(path) not in new:
            chain.append(path)
            path = path.parent
        at = top if path.parent is None else new[id(path)]
        for p in reversed(chain):
            at = new[id(p)] = at.child("div") if plain and p.tag in CONTENT else at.child(p.tag, p.words)
        return at

    out = [(Block(renamed(b.path), b.text, b.linked), y) for b, y in zip(page, labels)]
    root = top.child("html").child("body")
    words = [w for b in page for w in b.text.split()[:20]] or ["text"]

    def some(tag: str, names: tuple[str, ...], leaf: str, count: int, length: tuple[int, int], linked: bool):
        made = []
        for _ in range(count):
            text = " ".join(rng.choices(words, k=rng.randint(*length)))
            place = root.child(tag, names)
            made.append((Block(place.child(leaf) if leaf else place, text, len(text) if linked else 0), False))
        return made

    pick = lambda *names: (rng.choice(names),)
    for where, extra in ((0, some("header", (), "", 1, (1, 6), False)), (0, some(rng.choice(["nav", "div"]), pick("menu", "nav"), "li", rng.randint(2, 7), (1, 2), True)), (0, some("div", pick("cookie", "notice", "banner"), "p", 1, (6, 25), False)), (1, some(rng.choice(["aside", "div"]), pick("sidebar", "related", "widget"), rng.choice(["li", "p"]), rng.randint(1, 5), (2, 9), True)),
                         (1, some(rng.choice(["div", "section"]), pick("comment", "comments"), "p", rng.randint(1, 5), (5, 30), False)), (1, some("form", pick("login", "search", "newsletter"), "", 1, (1, 8), False)), (1, some("footer", (), "p", rng.randint(1, 2), (3, 12), False)), (1, some("div", pick("ad", "ads", "promo", "sponsored"), "", 1, (4, 20), False))):
        if rng.random() < 0.4:
            out = extra + out if where == 0 else out + extra
    return [b for b, _ in out], [y for _, y in out]


def training_windows(sources: list[str], window: int = WINDOW) -> list[tuple[np.ndarray, np.ndarray]]:
    """(vectors, labels) of stretches of up to `window` blocks of pages whose markup tells, as they are and varied."""
    out = []
    for source in sources:
        page = blocks(source)
        labels = [told(b) for b in page]
        if not any(labels):
            continue
        for own, y in ((page, labels), _varied(page, labels, random.Random(xxhash.xxh64_intdigest(source)))):
            v = vectors(own)
            out += [(v[k:k + window], np.array(y[k:k + window], np.float32)) for k in range(0, len(own), window)]
    return out


def invented_pages(count: int = 120, seed: int = 1) -> list[str]:
    """Plain pages to learn from where no page tells."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghijklmnoprstu") for _ in range(rng.randint(2, 8)))
    line = lambda n: " ".join(word() for _ in range(n)).capitalize() + "."
    return [f"<html><body><nav><ul>{''.join(f'<li><a href=x>{word()}</a></li>' for _ in range(rng.randint(2, 6)))}</ul></nav><div class=ad>{line(6)}</div><article><h1>{line(4)}</h1>{''.join(f'<p>{line(rng.randint(5, 40))}</p>' for _ in range(rng.randint(1, 8)))}</article><footer>{line(4)}</footer></body></html>" for _ in range(count)]


def fit(pages: DataFrame, max_pages: int = MAX_PAGES, max_windows: int = MAX_WINDOWS) -> Labeller:
    """A labeller learnt from at most max_windows stretches of at most max_pages pages."""
    known = pages.filter(F.col("page_id").isNotNull() & F.col("html").isNotNull())
    ids = known.select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(max_pages)
    rows = known.select("page_id", "html").join(F.broadcast(ids), "page_id")  # max_pages ids

    def cut(b: pa.RecordBatch) -> list:
        made = [training_windows([s]) for s in b["html"].to_pylist()]
        return [[[{"k": k, "x": v.astype(np.float16).tobytes(), "y": y.astype(np.int8).tobytes()} for k, (v, y) in enumerate(own)] for own in made]]

    kind = pa.list_(pa.struct([("k", pa.int32()), ("x", pa.binary()), ("y", pa.binary())]))
    windows = map_batches(rows, ["page_id"], {"w": kind}, cut).select("page_id", F.explode("w").alias("w")).select("page_id", "w.*")
    found = windows.orderBy(F.xxhash64("page_id", "k"), "page_id", "k", "x").limit(max_windows).collect()  # max_windows stretches
    made = [(np.frombuffer(r.x, np.float16).astype(np.float32).reshape(-1, SIZE), np.frombuffer(r.y, np.int8).astype(np.float32)) for r in found]
    return Labeller().fit(made if len(made) >= 20 else made + training_windows(invented_pages()))


def extract(sources: list[str], model: Labeller, at_once: int = 256) -> list[str]:
    """Main text of each page: its content blocks in order, joined by a space."""
    out, k = [], 0
    while k < len(sources):
        stop, size = k + 1, len(sources[k])
        while stop < len(sources) and stop < k + at_once and size + len(sources[stop]) <= CHARS:
            size, stop = size + len(sources[stop]), stop + 1
        pages = [blocks(s) for s in sources[k:stop]]
        out += [" ".join(b.text for b, y in zip(page, keep) if y) for page, keep in zip(pages, model.label([Lazy(p) for p in pages]))]
        k = stop
    return out


def main_text(pages: DataFrame, model: Labeller) -> DataFrame:
    """page_id, url, text of every row of pages."""
    return map_batches(pages.select("page_id", "url", "html"), ["page_id", "url"], {"text": pa.string()}, lambda b: [extract([s or "" for s in b["html"].to_pylist()], model)])
