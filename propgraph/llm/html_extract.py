"""Main text of web pages: a recurrent block labeller.

A page becomes the sequence of its leaf blocks: runs of text that no block element begins or ends in. A block is seen through
two vectors of hashed features, one of the path of elements (names, classes, ids, roles) that leads to it and one of its
words. A bidirectional LSTM in numpy reads the whole sequence both ways and says of every block whether it belongs to the
main text, so that each decision rests on the whole page.

No table marks blocks of pages, so the labels to learn from are those that the markup of the sampled pages itself gives away
(an article element, or a menu). To make the network learn names that the sample's layout does not have, training pages are
composed anew: blocks of the sampled pages are laid out under element names from the lists of fixed values below.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propgraph.llm.common import rows_mapper

#: Pages to learn from, at most, and blocks of one page in a training sequence.
SAMPLE_PAGES = 400
TRAIN_BLOCKS = 48
PATH_BUCKETS = 4096
WORD_BUCKETS = 4096
DIM = 12
HIDDEN = 12
EPOCHS = 6
BATCH = 16
#: Blocks of a page whose states are held at once; longer sequences are read in pieces, states carried over both ways.
PIECE = 4096
# A block's vector is made of all its words, each once: however long the block, of WORD_BUCKETS rows at most.

# Elements by what they do to text.
BLOCK_ELEMENTS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select "
    "summary table tbody td tfoot th thead title tr ul".split()
)
VOID_ELEMENTS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN_ELEMENTS = frozenset("head title script style noscript template svg iframe object canvas audio video textarea select".split())
#: Elements that do not end an open head.
HEAD_ELEMENTS = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
FOREIGN_ELEMENTS = frozenset("svg math".split())
#: Elements that end an open element of the same kind, as a new paragraph ends the one before.
IMPLIED_ENDS = {
    "p": frozenset("p".split()),
    "li": frozenset("li p".split()),
    "dt": frozenset("dt dd p".split()),
    "dd": frozenset("dt dd p".split()),
    "tr": frozenset("tr td th p".split()),
    "td": frozenset("td th p".split()),
    "th": frozenset("td th p".split()),
    "option": frozenset("option".split()),
}
#: Elements that close an open paragraph.
ENDS_PARAGRAPH = BLOCK_ELEMENTS - {"button", "caption", "legend", "option", "summary", "td", "th", "tr", "tbody", "thead", "tfoot"}

# Names that pages give to what is the main text and to what is not.
MAIN_NAMES = "article main content post entry story body text article-body post-content entry-content main-content".split()
OTHER_NAMES = (
    "nav menu navbar navigation breadcrumb breadcrumbs header masthead banner top footer bottom copyright sidebar aside widget "
    "related recommended trending ad ads advert advertisement promo sponsor sponsored cookie cookies consent notice alert popup "
    "modal overlay newsletter subscribe signup login search form comment comments reply replies discussion respond share social "
    "sharing tags toolbar pagination pager legal disclaimer skip"
).split()
OTHER_ELEMENTS = "nav header footer aside form".split()

_SPACES = re.compile(r"\s+")
_NAME = re.compile(r"[a-z]+")
_WORD = re.compile(r"\w+")


class BlockParser(HTMLParser):
    """Leaf blocks of a page, in order: (path, text). A path lists (element, names) from the root down."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, tuple[str, ...]]] = []
        self.blocks: list[tuple[tuple, str]] = []
        self.text: list[str] = []
        self.path: tuple | None = None

    def flush(self) -> None:
        text = _SPACES.sub(" ", "".join(self.text)).strip()
        if text:
            self.blocks.append((self.path or (), text))
        self.text, self.path = [], None

    def end_head(self, tag: str | None) -> None:
        """Close an open head that leaves out its end tag, before an element (or text, None) that no head has."""
        at = next((i for i, (name, _) in enumerate(self.open) if name == "head"), None)
        if at is None or tag in HEAD_ELEMENTS:
            return
        inside = {name for name, _ in self.open[at + 1 :]}
        if not inside & HIDDEN_ELEMENTS or (tag == "body" and "template" not in inside):
            del self.open[at:]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.end_head(tag)
        if tag == "br":
            self.text.append(" ")
        if tag in BLOCK_ELEMENTS:
            self.flush()
        ends = IMPLIED_ENDS.get(tag, frozenset())
        if tag in ENDS_PARAGRAPH:
            ends = ends | {"p"}
        # An open element that this one ends, but not across the element that holds both.
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] in ends:
                del self.open[i:]
                break
            if self.open[i][0] in BLOCK_ELEMENTS and self.open[i][0] not in ("p",):
                break
        if tag not in VOID_ELEMENTS:
            named = " ".join(str(v) for k, v in attrs if k in ("class", "id", "role", "aria-label") and v).lower()
            self.open.append((tag, tuple(_NAME.findall(named))))

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK_ELEMENTS:
            self.flush()
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                break

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        # In foreign content the slash closes; a hidden element closed by it holds nothing that it could hide.
        if tag not in VOID_ELEMENTS and (tag in HIDDEN_ELEMENTS or any(name in FOREIGN_ELEMENTS for name, _ in self.open)):
            self.open.pop()

    def handle_data(self, data: str) -> None:
        if not data.isspace():
            self.end_head(None)
        if any(tag in HIDDEN_ELEMENTS for tag, _ in self.open):
            return
        if self.path is None and not data.isspace():
            self.path = tuple(self.open)
        self.text.append(data)


def parse_blocks(html: str | None) -> list[tuple[tuple, str]]:
    """The visible leaf blocks of a page; none for a null or empty one. Broken markup is read as far as it can be."""
    parser = BlockParser()
    parser.feed(html or "")
    parser.close()
    parser.flush()
    return parser.blocks


def _bucket(text: str, size: int) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass")) % size


@lru_cache(maxsize=1 << 14)
def path_features(path: tuple) -> list[int]:
    """Buckets of a path: its elements and names, where they are block level."""
    found = set()
    for tag, names in path:
        if tag in ("html", "body"):
            continue
        if tag in BLOCK_ELEMENTS or names:
            found.add("e:" + tag)
        found.update("n:" + name for name in names)
    return sorted(_bucket(x, PATH_BUCKETS) for x in found) or [_bucket("none", PATH_BUCKETS)]


def word_features(text: str, linked: bool) -> list[int]:
    """Buckets of all of a block's words, and of its size and marks; each once."""
    words = _WORD.findall(text.lower())
    found = {"w:" + w for w in words}
    found.add(f"words:{len(words).bit_length()}")
    found.add("ends" if text[-1:] in ".!?" else "open")
    if linked:
        found.add("link")
    if "©" in text:
        found.add("mark")
    return sorted({_bucket(x, WORD_BUCKETS) for x in found})


Features = tuple[list[int], list[int]]


def block_features(block: tuple[tuple, str]) -> Features:
    path, text = block
    return path_features(path), word_features(text, any(tag == "a" for tag, _ in path))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class BlockModel:
    """Weights of the labeller: embeddings, one LSTM for each direction, and the output layer."""

    path_table: np.ndarray
    word_table: np.ndarray
    lstm: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)  # input, state, bias
    out: np.ndarray | None = None
    bias: np.ndarray | None = None

    @classmethod
    def start(cls, seed: int = 1) -> BlockModel:
        random = np.random.default_rng(seed)

        def weights(*shape: int) -> np.ndarray:
            return random.normal(0, 1 / np.sqrt(shape[0]), shape)

        lstm = []
        for _ in range(2):
            bias = np.zeros(4 * HIDDEN)
            bias[HIDDEN : 2 * HIDDEN] = 1.0
            lstm.append((weights(2 * DIM, 4 * HIDDEN), weights(HIDDEN, 4 * HIDDEN), bias))
        return cls(
            random.normal(0, 0.1, (PATH_BUCKETS, DIM)),
            np.zeros((WORD_BUCKETS, DIM)),
            lstm,
            weights(2 * HIDDEN + 2 * DIM),
            np.zeros(1),
        )

    def embed(self, page: list[Features]) -> np.ndarray:
        """Of each block the mean of its path's rows and the mean of its words' rows, side by side."""
        sides = []
        for table, lists in ((self.path_table, [p for p, _ in page]), (self.word_table, [w for _, w in page])):
            n = np.array([len(x) for x in lists])
            rows = table[np.fromiter((i for x in lists for i in x), dtype=np.int64, count=n.sum())]
            sides.append(np.add.reduceat(rows, np.cumsum(n) - n, axis=0) / n[:, None])
        return np.concatenate(sides, axis=1)

    def run(self, k: int, x: np.ndarray, mask: np.ndarray, state: tuple[np.ndarray, np.ndarray] | None = None) -> tuple:
        """One direction over (steps, rows, inputs). Rows whose mask is 0 keep their state. Returns states and a trace."""
        wx, wh, b = self.lstm[k]
        h, c = state or (np.zeros((x.shape[1], HIDDEN)), np.zeros((x.shape[1], HIDDEN)))
        drive, hs, trace = x @ wx + b, [], []
        for t in range(len(x)):
            z = drive[t] + h @ wh
            i, f, o = (_sigmoid(z[:, j * HIDDEN : (j + 1) * HIDDEN]) for j in (0, 1, 2))
            g = np.tanh(z[:, 3 * HIDDEN :])
            on = mask[t][:, None]
            new_c = f * c + i * g
            tanh_c = np.tanh(new_c)
            trace.append((i, f, o, g, c, tanh_c, h, on))
            c = on * new_c + (1 - on) * c
            h = on * (o * tanh_c) + (1 - on) * h
            hs.append(h)
        return np.array(hs).reshape(len(x), x.shape[1], HIDDEN), trace, (h, c)

    def logits(self, x: np.ndarray, mask: np.ndarray) -> tuple:
        ahead, trace_a, _ = self.run(0, x, mask)
        back, trace_b, _ = self.run(1, x[::-1], mask[::-1])
        features = np.concatenate([ahead, back[::-1], x], axis=2)
        return features @ self.out + self.bias[0], features, (trace_a, trace_b)

    def label(self, pages: list[list[Features]]) -> list[np.ndarray]:
        """Which blocks of each page are main text. Pages of like length are read together, very long ones alone."""
        out: list = [np.zeros(0, dtype=bool)] * len(pages)
        order = sorted((i for i in range(len(pages)) if pages[i]), key=lambda i: len(pages[i]))
        while order:
            longest = len(pages[order[-1]])
            if longest > PIECE:
                i = order.pop()
                out[i] = self._label_long(pages[i])
                continue
            n = max(1, min(len(order), PIECE * 4 // longest))
            rows, order = order[-n:], order[:-n]
            x, mask = _batch([self.embed(pages[i]) for i in rows])
            z = self.logits(x, mask)[0]
            for r, i in enumerate(rows):
                out[i] = z[: len(pages[i]), r] > 0
        return out

    def _label_long(self, page: list[Features]) -> np.ndarray:
        """One page of any length: the backward states at the pieces' ends are computed first and kept."""
        starts = list(range(0, len(page), PIECE))
        ends, state = {}, None
        for s in reversed(starts):
            ends[s] = state
            x = self.embed(page[s : s + PIECE])[:, None]
            state = self.run(1, x[::-1], np.ones(x.shape[:2]), state)[2]
        out, state = [], None
        for s in starts:
            x = self.embed(page[s : s + PIECE])[:, None]
            ones = np.ones(x.shape[:2])
            ahead, _, state = self.run(0, x, ones, state)
            back = self.run(1, x[::-1], ones, ends[s])[0][::-1]
            out.append((np.concatenate([ahead, back, x], axis=2) @ self.out + self.bias[0])[:, 0] > 0)
        return np.concatenate(out)


def _batch(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    x = np.zeros((max(map(len, pages)), len(pages), 2 * DIM))
    mask = np.zeros(x.shape[:2])
    for r, page in enumerate(pages):
        x[: len(page), r] = page
        mask[: len(page), r] = 1
    return x, mask


def _back_through(weights: tuple, x: np.ndarray, trace: list, dh_out: np.ndarray) -> tuple:
    """Gradients of one direction: inputs, and the three weights."""
    wx, wh, _ = weights
    dz_all, dh, dc = np.zeros((len(x), x.shape[1], 4 * HIDDEN)), np.zeros(dh_out.shape[1:]), np.zeros(dh_out.shape[1:])
    dwh = np.zeros_like(wh)
    for t in range(len(x) - 1, -1, -1):
        i, f, o, g, c_before, tanh_c, h_before, on = trace[t]
        dh = dh + dh_out[t]
        live, dh_kept, dc_kept = dh * on, dh * (1 - on), dc * (1 - on)
        d = dc * on + live * o * (1 - tanh_c**2)
        dz = np.concatenate([d * g * i * (1 - i), d * c_before * f * (1 - f), live * tanh_c * o * (1 - o), d * i * (1 - g**2)], axis=1)
        dz_all[t] = dz
        dwh += h_before.T @ dz
        dh, dc = dz @ wh.T + dh_kept, d * f + dc_kept
    flat = dz_all.reshape(-1, 4 * HIDDEN)
    return dz_all @ wx.T, x.reshape(-1, x.shape[2]).T @ flat, dwh, flat.sum(0)


class _Adam:
    def __init__(self, shape: tuple, rate: float = 0.01) -> None:
        self.m, self.v, self.t, self.rate = np.zeros(shape), np.zeros(shape), 0, rate

    def step(self, weight: np.ndarray, gradient: np.ndarray) -> None:
        self.t += 1
        self.m += 0.1 * (gradient - self.m)
        self.v += 0.01 * (gradient**2 - self.v)
        weight -= self.rate * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.99**self.t)) + 1e-8)


def fit(pages: list[list[Features]], labels: list[np.ndarray], epochs: int = EPOCHS, seed: int = 1) -> BlockModel:
    """Train on sequences of blocks with a label each."""
    model, random = BlockModel.start(seed), np.random.default_rng(seed)
    steps = {"path": _Adam(model.path_table.shape), "word": _Adam(model.word_table.shape), "out": _Adam(model.out.shape), "bias": _Adam((1,))}
    cells = [[_Adam(w.shape) for w in side] for side in model.lstm]
    by_length = sorted((i for i in range(len(pages)) if pages[i]), key=lambda i: len(pages[i]))
    batches = [by_length[i : i + BATCH] for i in range(0, len(by_length), BATCH)]
    for _ in range(epochs):
        for chosen in random.permutation(len(batches)):
            rows = batches[chosen]
            x, mask = _batch([model.embed(pages[i]) for i in rows])
            y = np.zeros(mask.shape)
            for r, i in enumerate(rows):
                y[: len(pages[i]), r] = labels[i]
            z, features, traces = model.logits(x, mask)
            error = mask * (_sigmoid(z) - y) / mask.sum()
            steps["out"].step(model.out, np.einsum("tb,tbf->f", error, features) + 1e-4 * model.out)
            steps["bias"].step(model.bias, np.array([error.sum()]))
            d = error[:, :, None] * model.out
            dx = d[:, :, 2 * HIDDEN :].copy()
            for k, flip in ((0, 1), (1, -1)):
                grads = _back_through(model.lstm[k], x[::flip], traces[k], d[::flip, :, k * HIDDEN : (k + 1) * HIDDEN])
                dx += grads[0][::flip]
                for weight, step, g in zip(model.lstm[k], cells[k], grads[1:], strict=True):
                    step.step(weight, g)
            for name, table, part, side in (("path", model.path_table, slice(0, DIM), 0), ("word", model.word_table, slice(DIM, None), 1)):
                total = np.zeros_like(table)
                for r, i in enumerate(rows):
                    for t, block in enumerate(pages[i]):
                        total[block[side]] += dx[t, r, part] / len(block[side])
                steps[name].step(table, total)
    return model


def markup_label(path: tuple) -> bool | None:
    """What a block's markup gives away: main text, something else, or None where it says nothing.

    Names count by the nearest element that has one: comments inside an article are comments.
    """
    for tag, names in reversed(path):
        if tag in OTHER_ELEMENTS or any(name in OTHER_NAMES for name in names):
            return False
        if tag in ("article", "main") or any(name in MAIN_NAMES for name in names):
            return True
    return None


def _layout(random: np.random.Generator, main: list[str], other: list[str]) -> tuple[list[tuple[tuple, str]], list[bool]]:
    """A page composed of given texts: boxes of other texts before, inside and after the main text."""
    outer: list[tuple] = [(("html", ()), ("body", ()))]
    if random.random() < 0.5:
        outer.append((*outer[0], ("div", (str(random.choice(["page", "wrapper", "container", "site", "layout"])),))))
    root = outer[-1]
    blocks: list[tuple[tuple, str]] = []
    labels: list[bool] = []

    def box(at: tuple) -> None:
        if not other:
            return
        name = str(random.choice(OTHER_NAMES))
        kind = random.random()
        if kind < 0.35:
            holder = (str(random.choice(OTHER_ELEMENTS)), ())
        elif kind < 0.5:
            holder = (str(random.choice(OTHER_ELEMENTS)), (name,))
        else:
            holder = (str(random.choice(["div", "section", "ul", "p", "aside"])), (name,))
        inner = [("ul", ()), ("li", ()), ("a", ())] if random.random() < 0.5 else [("p", ())] if random.random() < 0.6 else []
        for _ in range(int(random.integers(1, 5))):
            # Other texts may be as long as paragraphs, so that length alone decides nothing.
            text = str(random.choice(main if main and random.random() < 0.4 else other))
            blocks.append(((*at, holder, *inner), text))
            labels.append(False)

    kind = random.random()
    if kind < 0.5:
        article = (*root, ("article", ()))
    elif kind < 0.65:
        article = (*root, ("main", ()), ("article", ()))
    else:
        article = (*root, (str(random.choice(["div", "section", "main"])), (str(random.choice(MAIN_NAMES)),)))
    for _ in range(int(random.integers(0, 4))):
        box(root)
    for k, text in enumerate(main):
        inner = ("h1", ()) if k == 0 else (str(random.choice(["p"] * 8 + ["h2", "li", "blockquote", "td", "pre"])), ())
        blocks.append(((*article, inner), text))
        labels.append(True)
        if random.random() < 0.1:
            box(article)
    if random.random() < 0.5:
        box(article)
    for _ in range(int(random.integers(0, 4))):
        box(root)
    return blocks, labels


def training_pages(htmls: list[str], seed: int = 1) -> tuple[list[list[Features]], list[np.ndarray]]:
    """Sequences and labels from sampled pages: each as it is, where its markup gives labels away, and laid out anew twice."""
    random = np.random.default_rng(seed)
    pages, labels, pool = [], [], []

    def add(blocks: list[tuple[tuple, str]], marks: list) -> None:
        """All blocks of a page; of a long page in sequences of ``TRAIN_BLOCKS``."""
        for i in range(0, len(blocks), TRAIN_BLOCKS):
            pages.append([block_features(b) for b in blocks[i : i + TRAIN_BLOCKS]])
            labels.append(np.array([bool(m) for m in marks[i : i + TRAIN_BLOCKS]], dtype=float))

    for html in htmls:
        blocks = parse_blocks(html)
        known = [markup_label(path) for path, _ in blocks]
        if True in known:
            add(blocks, known)
        else:
            known = [len(text.split()) > 12 for _, text in blocks]
        pool.append(([t for (_, t), k in zip(blocks, known, strict=True) if k], [t for (_, t), k in zip(blocks, known, strict=True) if not k]))
    spare = [text for _, other in pool for text in other] or ["menu", "about us", "read more"]
    for main, other in pool:
        for _ in range(2):
            some = [str(x) for x in random.choice(spare, size=min(4, len(spare)))]
            add(*_layout(random, main, other + some))
    return pages, labels


def train(pages: DataFrame, bound: int = SAMPLE_PAGES) -> BlockModel:
    """A labeller from at most ``bound`` pages, chosen by a hash of their id. Only page_id and html are read. Pages are learned
    from whole, however long; of rows that repeat an id the one with the least html. Without pages it is trained on composed
    pages of a few stock words."""
    chosen = pages.select("page_id").where("page_id IS NOT NULL").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(bound)
    rows = (
        pages.select("page_id", "html")
        .where("html IS NOT NULL")
        .join(F.broadcast(chosen.withColumnRenamed("page_id", "c_id")), F.col("page_id") == F.col("c_id"))
        .groupBy("page_id")
        .agg(F.min("html").alias("html"))
        .collect()
    )
    htmls = [row["html"] for row in sorted(rows, key=lambda r: r["page_id"])]
    return fit(*training_pages(htmls or ["<article><h1>Title</h1><p>Some text.</p></article>"] * 8))


def main_text(blocks: list[tuple[tuple, str]], keep: np.ndarray) -> str:
    return "\n".join(text for (_, text), k in zip(blocks, keep, strict=True) if k)


def extract(pages: DataFrame, model: BlockModel) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars, n_blocks, n_main.

    The text is the main blocks in page order, one line each; it is empty where there are none, and for null and empty html.
    Whole pages are read, however long. Repeated rows stay; a null id or url stays null. Other columns are not read. An empty
    table gives no rows.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def each(rows: Iterator[tuple]) -> Iterator[tuple]:
        held: list[tuple] = []
        size = 0

        def labelled() -> Iterator[tuple]:
            parsed = [parse_blocks(html) for _, _, html in held]
            marks = shared.value.label([[block_features(b) for b in blocks] for blocks in parsed])
            for (page_id, url, _), blocks, keep in zip(held, parsed, marks, strict=True):
                text = main_text(blocks, keep)
                yield page_id, url, text, len(text), len(blocks), int(keep.sum())

        for row in rows:
            held.append(row)
            size += len(row[2] or "")
            if len(held) >= 64 or size >= 4 << 20:
                yield from labelled()
                held, size = [], 0
        yield from labelled()

    schema = pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())]
        + [("n_blocks", pa.int64()), ("n_main", pa.int64())]
    )
    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(
        rows_mapper(each, schema), "page_id long, url string, text string, n_chars long, n_blocks long, n_main long"
    )
