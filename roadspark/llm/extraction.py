"""Main text of web pages by a recurrent block labeller.

A page is read as a sequence of blocks: the text between block-level tags, each
with the path of tags, classes and ids above it. Path and words are hashed into
short vectors, a bidirectional LSTM in numpy reads the whole sequence, and every
block is classified with the page around it in view. The blocks kept are joined
in page order.

The network is fitted on the driver to a bounded sample of pages. Their marks
come from page structure: what stands in navigation, footers, asides, forms or
in elements named for adverts, notices, comments and the like is none of the
article. The sample's pages are also rebuilt with their blocks under other
containers, so that the network learns names beyond those of one site.

Scripts, styles and comments of the markup never are blocks. Null and empty html
gives the empty text, pages are read whole whatever their length, repeated rows
give equal rows, an empty table an empty one, and columns other than
``page_id``, ``url`` and ``html`` are ignored.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PATHS, WORDS, EXTRAS = 1024, 64, 4
INPUT, HIDDEN = 24, 16
# Pages of the sample, and the bytes and blocks of the longest one.
SAMPLE, LONGEST, MOST_BLOCKS = 160, 40_000, 120

# Elements that open a block, that hold no text of the page, and that have no end tag.
_BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section"
    " select summary table tbody td tfoot th thead tr ul".split()
)
_SILENT = ("script", "style", "noscript", "template", "svg", "iframe", "object", "textarea", "title", "head")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose end tag is often left out: a new one ends the old.
_IMPLIED = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"},
            "tr": {"td", "th", "tr"}, "option": {"option"}}
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(?P<silent>" + "|".join(_SILENT[:-2]) + r")\b[^>]*?(?<!/)>.*?(?:</(?P=silent)\s*>|\Z)"
    r"|<title\b[^>]*>.*?(?:</title\s*>|\Z)"
    r"""|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:"[^"]*"|'[^']*'|[^>"'])*)>""",
    re.S | re.I,
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

# Names of elements, classes, ids and roles that stand for what is not the article.
OUTSIDE_TAGS = frozenset("nav header footer aside form menu dialog select button".split())
OUTSIDE_NAMES = frozenset(
    "ad ads advert adverts advertisement banner sponsor sponsored promo promotion promoted nav navigation navbar menu"
    " breadcrumb breadcrumbs header masthead footer copyright sidebar aside widget widgets related recommended"
    " comment comments disqus reply replies discussion respond share sharing social cookie cookies consent gdpr notice"
    " notices alert popup modal overlay newsletter subscribe subscription signup login search pagination pager toolbar"
    " tags complementary contentinfo dialog".split()
)


# Names of containers that may hold anything, for rebuilt pages.
_NEUTRAL = (
    "content container wrapper main body post entry article story text page inner outer row col column box area site"
    " layout grid block section primary single detail news blog"
).split()

_LEAVES = "h1 h2 h3 li td div blockquote pre figcaption dd".split()


class Block:
    """Text of one block and the open elements above it, as (tag, names)."""

    __slots__ = ("text", "path", "linked")

    def __init__(self, text: str, path: tuple, linked: int):
        self.text, self.path, self.linked = text, path, linked


def blocks(page: str) -> list[Block]:
    """Blocks of a page in order: white space made one space, references decoded, empty ones left out."""
    out: list[Block] = []
    stack: list[tuple[str, tuple]] = []
    parts: list[str] = []
    linked = at = 0
    in_link = False

    def close() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split()) if parts else ""
        if text:
            out.append(Block(text, tuple(stack), linked))
        parts.clear()
        linked = 0

    for tag in _TAG.finditer(page):
        if tag.start() > at:
            parts.append(page[at : tag.start()])
            if in_link:
                linked += tag.start() - at
        at = tag.end()
        name = tag["name"]
        if name is None:
            continue
        name = name.lower()
        if name == "br":
            parts.append(" ")
            continue
        if name == "a":
            in_link = not tag["end"]
        if name in _BLOCK_TAGS:
            close()
        if tag["end"]:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    del stack[depth:]
                    break
        elif name not in _VOID and not tag["rest"].endswith("/"):
            if stack and stack[-1][0] in _IMPLIED.get(name, ()):
                stack.pop()
            if name in _BLOCK_TAGS or tag["rest"]:
                stack.append((name, _names(tag["rest"])))
            else:
                stack.append((name, ()))
    if at < len(page):
        parts.append(page[at:])
    close()
    return out


def _names(attributes: str) -> tuple:
    if "=" not in attributes:
        return ()
    found = (a or b or c for a, b, c in _NAMES.findall(attributes))
    return tuple(p.lower() for value in found for p in _NAME_PART.findall(value))


def outside(path: tuple) -> bool:
    """Whether structure says that a block is not of the article."""
    return any(tag in OUTSIDE_TAGS or not OUTSIDE_NAMES.isdisjoint(names) for tag, names in path)


class Features:
    """Hashed vectors of blocks; hashes seen are remembered up to a bound."""

    def __init__(self):
        self._path: dict[tuple, np.ndarray] = {}
        self._word: dict[str, int] = {}

    def _of_path(self, path: tuple) -> np.ndarray:
        found = self._path.get(path)
        if found is None:
            found = np.zeros(PATHS, np.float32)
            for tag, names in path:
                for token in (tag, *("." + n for n in names)):
                    found[zlib.crc32(token.encode()) % PATHS] = 1
            if len(self._path) > 20_000:
                self._path.clear()
            self._path[path] = found
        return found

    def __call__(self, page: list[Block]) -> np.ndarray:
        out = np.zeros((len(page), PATHS + WORDS + EXTRAS), np.float32)
        known = self._word
        if len(known) > 300_000:
            known.clear()
        for i, block in enumerate(page):
            out[i, :PATHS] = self._of_path(block.path)
            words = block.text.split(" ")
            for word in set(words).difference(known):
                known[word] = zlib.crc32(word.lower().encode("utf-8")) % WORDS
            counts = np.bincount(np.fromiter(map(known.__getitem__, words), np.int64, len(words)), minlength=WORDS)
            out[i, PATHS : PATHS + WORDS] = counts / len(words)
            size = len(block.text)
            out[i, -EXTRAS:] = (
                np.log1p(size) / 8, min(1.0, block.linked / size), block.text[-1] in ".!?:;\"'”»…", i / len(page),
            )
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class BlockLabeller:
    """Projection, an LSTM in each direction, and one logistic unit per block."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        draw = lambda *shape: (rng.normal(0, 1, shape) / np.sqrt(shape[0])).astype(np.float32)
        self.parameters = {"project": draw(PATHS + WORDS + EXTRAS, INPUT), "project_bias": np.zeros(INPUT, np.float32)}
        for way in ("on", "back"):
            bias = np.zeros(4 * HIDDEN, np.float32)
            bias[HIDDEN : 2 * HIDDEN] = 1
            self.parameters |= {f"{way}_in": draw(INPUT, 4 * HIDDEN), f"{way}_state": draw(HIDDEN, 4 * HIDDEN), f"{way}_bias": bias}
        self.parameters |= {"out": draw(2 * HIDDEN + INPUT), "out_bias": np.zeros(1, np.float32)}

    def _pass(self, x: np.ndarray, mask: np.ndarray, way: str):
        """States of every step of one direction; ``x`` is (steps, pages, INPUT)."""
        p = self.parameters
        steps, pages = x.shape[:2]
        given = x @ p[f"{way}_in"] + p[f"{way}_bias"]
        h, c = np.zeros((pages, HIDDEN), np.float32), np.zeros((pages, HIDDEN), np.float32)
        out, memory = np.zeros((steps, pages, HIDDEN), np.float32), []
        for t in range(steps) if way == "on" else range(steps - 1, -1, -1):
            gates = given[t] + h @ p[f"{way}_state"]
            i, f, o = (_sigmoid(gates[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(gates[:, 3 * HIDDEN :])
            new_c = f * c + i * g
            tanh_c = np.tanh(new_c)
            m = mask[t][:, None]
            memory.append((t, h, c, i, f, o, g, tanh_c, m))
            h, c = np.where(m, o * tanh_c, h), np.where(m, new_c, c)
            out[t] = h
        return out, memory

    def _forward(self, raw: np.ndarray, mask: np.ndarray):
        p = self.parameters
        x = np.tanh(raw @ p["project"] + p["project_bias"])
        on, on_memory = self._pass(x, mask, "on")
        back, back_memory = self._pass(x, mask, "back")
        joined = np.concatenate([on, back, x], axis=2)
        return x, joined, (on_memory, back_memory), joined @ p["out"] + p["out_bias"][0]

    def _pass_back(self, x, slope, memory, way, grads):
        """Gradients of one direction, from the slopes of its states."""
        p = self.parameters
        dx = np.zeros_like(x)
        dh, dc = np.zeros((x.shape[1], HIDDEN), np.float32), np.zeros((x.shape[1], HIDDEN), np.float32)
        for t, h, c, i, f, o, g, tanh_c, m in reversed(memory):
            total = dh + slope[t]
            here = np.where(m, total, 0)
            inner = np.where(m, dc, 0) + here * o * (1 - tanh_c**2)
            gates = np.concatenate([inner * g * i * (1 - i), inner * c * f * (1 - f), here * tanh_c * o * (1 - o), inner * i * (1 - g**2)], axis=1)
            grads[f"{way}_in"] += x[t].T @ gates
            grads[f"{way}_state"] += h.T @ gates
            grads[f"{way}_bias"] += gates.sum(axis=0)
            dx[t] += gates @ p[f"{way}_in"].T
            dh = np.where(m, gates @ p[f"{way}_state"].T, total)
            dc = np.where(m, inner * f, dc)
        return dx

    def _gradients(self, raw, mask, labels):
        p = self.parameters
        grads = {k: np.zeros_like(v) for k, v in p.items()}
        x, joined, memory, logits = self._forward(raw, mask)
        error = np.where(mask, _sigmoid(logits) - labels, 0).astype(np.float32) / max(1, mask.sum())
        grads["out"] += np.einsum("tp,tpk->k", error, joined)
        grads["out_bias"] += error.sum()
        slope = error[:, :, None] * p["out"]
        dx = slope[:, :, 2 * HIDDEN :].copy()
        for way, part, steps in (("on", slope[:, :, :HIDDEN], memory[0]), ("back", slope[:, :, HIDDEN : 2 * HIDDEN], memory[1])):
            dx += self._pass_back(x, part, steps, way, grads)
        inner = dx * (1 - x**2)
        grads["project"] += np.einsum("tpi,tpk->ik", raw, inner)
        grads["project_bias"] += inner.sum(axis=(0, 1))
        return grads

    def fit(self, pages: list[np.ndarray], labels: list[np.ndarray], epochs: int = 6, batch: int = 16, rate: float = 0.02):
        """Adam on the log loss of all blocks."""
        rng = np.random.default_rng(3)
        first = {k: np.zeros_like(v) for k, v in self.parameters.items()}
        second = {k: np.zeros_like(v) for k, v in self.parameters.items()}
        step, total = 0, epochs * -(-len(pages) // batch)
        for _ in range(epochs):
            order = np.argsort([len(p) + rng.random() * 4 for p in pages])
            parts = np.array_split(order, -(-len(pages) // batch))
            for k in rng.permutation(len(parts)):
                step += 1
                raw, mask = padded([pages[r] for r in parts[k]])
                marks = np.zeros(mask.shape, np.float32)
                for j, r in enumerate(parts[k]):
                    marks[: len(labels[r]), j] = labels[r]
                pace = rate * (1 - step / (total + 1)) + 0.001
                for name, g in self._gradients(raw, mask, marks).items():
                    first[name] = 0.9 * first[name] + 0.1 * g
                    second[name] = 0.99 * second[name] + 0.01 * g * g
                    move = first[name] / (1 - 0.9**step) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-6)
                    self.parameters[name] -= (pace * move).astype(np.float32)

    def keeps(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Which blocks of each page are of the article; pages of like length are read together."""
        out: list = [None] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        at = 0
        while at < len(order):
            n = 1
            while at + n < len(order) and n < 256 and (n + 1) * len(pages[order[at + n]]) <= 8192:
                n += 1
            some = order[at : at + n]
            raw, mask = padded([pages[i] for i in some])
            logits = self._forward(raw, mask)[3]
            for j, i in enumerate(some):
                out[i] = logits[: len(pages[i]), j] > 0
            at += n
        return [np.zeros(0, bool) if o is None else o for o in out]


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(p) for p in pages)
    raw = np.zeros((steps, len(pages), PATHS + WORDS + EXTRAS), np.float32)
    mask = np.zeros((steps, len(pages)), bool)
    for j, p in enumerate(pages):
        raw[: len(p), j], mask[: len(p), j] = p, True
    return raw, mask


def rebuilt(page: list[Block], rng: np.random.Generator) -> tuple[list[Block], list[bool]]:
    """A page of the same blocks under other containers, with the marks those give."""
    names = sorted(OUTSIDE_NAMES)
    tags = sorted(OUTSIDE_TAGS)
    shell = (("html", ()), ("body", ()))
    inside = [b for b in page if not outside(b.path)] or page
    strange = [b for b in page if outside(b.path)] or page

    def plain() -> tuple:
        """Names of a neutral container: common ones, or letters that mean nothing."""
        made = ["".join(rng.choice(list("abcdefghiklmnoprstuvwy"), int(rng.integers(3, 9)))) for _ in range(2)]
        pool = [*_NEUTRAL, *made]
        return tuple(pool[rng.integers(len(pool))] for _ in range(int(rng.integers(0, 4))))

    wraps = shell
    for _ in range(int(rng.integers(1, 4))):
        wraps = (*wraps, (("div", "div", "section", "main", "article")[rng.integers(5)], plain()))
    out, marks = [], []

    def beside(many: int, under: tuple) -> None:
        for _ in range(many):
            source = (strange if rng.random() < 0.5 else inside)
            name, tag = names[rng.integers(len(names))], tags[rng.integers(len(tags))]
            box = (tag, ()) if rng.random() < 0.4 else (("div", "div", "section", "ul")[rng.integers(4)], (*plain(), name))
            for _ in range(int(rng.integers(1, 5))):
                block = source[rng.integers(len(source))]
                linked = len(block.text) if rng.random() < 0.4 else 0
                leaf = ("p" if rng.random() < 0.4 else _LEAVES[rng.integers(len(_LEAVES))], ())
                inner = ((("div", plain()),) if rng.random() < 0.3 else ())
                out.append(Block(block.text, (*under, box, *inner, leaf), linked))
                marks.append(False)

    beside(int(rng.integers(0, 4)), shell)
    for block in inside:
        leaf = "p" if rng.random() < 0.5 else _LEAVES[rng.integers(len(_LEAVES))]
        list_ = (("ul", ()),) if leaf == "li" else ()
        out.append(Block(block.text, (*wraps, *list_, (leaf, ())), block.linked))
        marks.append(True)
        if rng.random() < 0.08:
            beside(1, wraps)
    beside(int(rng.integers(0, 4)), shell if rng.random() < 0.7 else wraps)
    return out, marks


def training_sample(pages: DataFrame, n: int = SAMPLE, longest: int = LONGEST) -> list[str]:
    """One page of each of the ``n`` ids with the smallest hashes, of the pages up to ``longest`` bytes.

    Ids are chosen first, so that no more than ``n`` pages reach the driver from
    however many partitions; of pages that share an id the smallest is taken.
    """
    rows = pages.where(F.col("html").isNotNull() & (F.octet_length("html") <= longest)).select("page_id", F.col("html").cast("string").alias("html"))
    order = (F.xxhash64("page_id"), F.col("page_id"))
    ids = [r[0] for r in rows.select("page_id").distinct().orderBy(*order).limit(n).collect()]
    chosen = F.col("page_id").isin([i for i in ids if i is not None])
    if None in ids:
        chosen = chosen | F.col("page_id").isNull()
    found = {r["page_id"]: r["html"] for r in rows.where(chosen).groupBy("page_id").agg(F.min("html").alias("html")).collect()}
    return [found[i] for i in ids if i in found]


def fit(pages: DataFrame, n: int = SAMPLE, longest: int = LONGEST) -> BlockLabeller:
    """A labeller fitted to a sample of the pages as they are and rebuilt."""
    features, rng = Features(), np.random.default_rng(17)
    labeller, inputs, marks = BlockLabeller(), [], []
    for page in training_sample(pages, n, longest):
        found = blocks(page)[:MOST_BLOCKS]
        if not found:
            continue
        versions = [(found, [not outside(b.path) for b in found])] + [rebuilt(found[:30], rng) for _ in range(5)]
        for version, own in versions:
            inputs.append(features(version))
            marks.append(np.array(own, np.float32))
    if inputs:
        labeller.fit(inputs, marks)
    return labeller


def _extracted(batches: Iterator[pa.RecordBatch], labeller: BlockLabeller) -> Iterator[pa.RecordBatch]:
    features = Features()
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            some = batch.slice(at, 256)
            found = [blocks(h or "") for h in some.column(2).to_pylist()]
            keeps = labeller.keeps([features(f) for f in found])
            texts = ["\n\n".join(b.text for b, k in zip(f, kept.tolist()) if k) for f, kept in zip(found, keeps)]
            yield pa.RecordBatch.from_arrays(
                [some.column(0), some.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )


def extract(pages: DataFrame, labeller: BlockLabeller) -> DataFrame:
    """page_id, url, main text and its length in code points, of every row. Rows do not move."""
    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(
        lambda batches: _extracted(batches, labeller), "page_id long, url string, text string, n_chars long"
    )


def op3_recurrent_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return extract(pages, fit(pages))
