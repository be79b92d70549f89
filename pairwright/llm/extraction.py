"""Main text of web pages by a recurrent block labeller.

A page is a sequence of leaf blocks. A bidirectional LSTM reads of each block
the hashed features of its tag path, the hashed vectors of its words, and a
few numbers, and labels it with the whole page before and after it in view.
It is trained on texts of the given pages that are laid out anew, with the
role of each block known (``block_layouts``), and on the pages themselves where their
markup names the role of a block (``markup_label``).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairwright.llm.block_layouts import labelled_page
from pairwright.llm.common import encode_words, slices, split_words
from pairwright.llm.html_blocks import Block, read_blocks

# Numbers of a block: hashed path, hashed words, others.
PATH_DIMS, WORD_DIMS, OTHERS = 64, 32, 9
INPUTS = PATH_DIMS + WORD_DIMS + OTHERS
HIDDEN = 24
# Training: pages that are read for their texts (smallest hashes of the id), pages laid out anew, and passes.
MAX_PAGES, MAX_PAGE_BYTES, LAYOUTS, EPOCHS, PAGES_AT_ONCE, RATE = 300, 200_000, 2_000, 14, 24, 0.01
# A block is kept from this probability on.
THRESHOLD = 0.5
# Blocks that go through the network at once, with padding; what a worker remembers.
CELLS, MEMORY = 20_000, 100_000

# Words of class, id, role or itemprop that name a block's role.
MAIN_NAMES = frozenset("c:article c:articlebody c:post c:entry c:story".split())
OTHER_NAMES = frozenset("""c:ad c:ads c:advert c:advertisement c:sponsored c:promo c:nav c:navigation c:menu c:breadcrumb c:sidebar c:related c:share c:social c:comment c:comments
 c:cookie c:consent c:notice c:newsletter c:footer c:widget""".split())


def markup_label(path: tuple[str, ...]) -> str:
    """1 or 0 where the open elements say what a block is, else -."""
    named = set(path)
    if named & OTHER_NAMES or named & {"t:nav", "t:footer", "t:aside", "t:form"}:
        return "0"
    return "1" if "t:article" in named or named & MAIN_NAMES else "0" if "t:header" in named else "-"


# --- inputs ------------------------------------------------------------------


def _hashed(name: str, dims: int) -> tuple[int, int, float, float]:
    """Two places and signs of a name's random vector."""
    h = xxhash.xxh64_intdigest(name)
    return h % dims, (h >> 16) % dims, 1.0 if h >> 40 & 1 else -1.0, 1.0 if h >> 41 & 1 else -1.0


class Vectors:
    """Vectors of tag paths and of words, remembered; forgotten when too many."""

    def __init__(self):
        self.paths: dict[tuple[str, ...], np.ndarray] = {}
        self.names: dict[str, tuple[int, int, float, float]] = {}
        self.words: dict[str, int] = {}
        self.table = np.zeros((MEMORY, WORD_DIMS), np.float32)

    def path(self, path: tuple[str, ...]) -> np.ndarray:
        found = self.paths.get(path)
        if found is None:
            if len(self.paths) >= MEMORY // 10:
                self.paths.clear()
            found = np.zeros(PATH_DIMS, np.float32)
            names = {n for n in path if n not in ("t:html", "t:body")}
            last = next((n for n in reversed(path) if n.startswith("t:")), "")
            for name in [*names, "last " + last]:
                if name not in self.names:
                    if len(self.names) >= MEMORY:
                        self.names.clear()
                    self.names[name] = _hashed(name, PATH_DIMS)
                i, j, a, b = self.names[name]
                found[i] += a
                found[j] += b
            self.paths[path] = found = np.clip(found, -3, 3)
        return found

    def word_rows(self, words: list[str]) -> np.ndarray:
        """Vectors of distinct words."""
        if len(words) > MEMORY:
            return np.concatenate([self.word_rows(words[k:k + MEMORY]) for k in range(0, len(words), MEMORY)])
        fresh = [w for w in words if w not in self.words]
        if len(self.words) + len(fresh) > MEMORY:
            self.words.clear()
            fresh = words
        if fresh:
            at = np.arange(len(self.words), len(self.words) + len(fresh))
            i, j, a, b = (np.array(x) for x in zip(*[_hashed(w, WORD_DIMS) for w in fresh]))
            self.table[at] = 0
            np.add.at(self.table, (at, i), a)
            np.add.at(self.table, (at, j), b)
            self.words.update(zip(fresh, at.tolist()))
        return self.table[np.fromiter((self.words[w] for w in words), np.int64, len(words))]


def block_inputs(pages: list[list[Block]], vectors: Vectors) -> np.ndarray:
    """A row of INPUTS numbers for each block of all pages in a row."""
    blocks = [b for page in pages for b in page]
    out = np.zeros((len(blocks), INPUTS), np.float32)
    if not blocks:
        return out
    out[:, :PATH_DIMS] = np.stack([vectors.path(b.path) for b in blocks])
    texts = pa.array([b.text for b in blocks], pa.large_string())
    words, ends = split_words(pc.utf8_lower(texts))
    distinct, codes = encode_words(words)
    n = np.diff(ends)
    if len(codes):
        rows, filled = vectors.word_rows(distinct), n > 0
        for k in range(WORD_DIMS):  # a column at a time holds little
            sums = np.add.reduceat(rows[codes, k], ends[:-1][filled])
            out[filled, PATH_DIMS + k] = sums / np.sqrt(n[filled])
        np.clip(out[:, PATH_DIMS:PATH_DIMS + WORD_DIMS], -3, 3, out=out[:, PATH_DIMS:PATH_DIMS + WORD_DIMS])
    sizes = np.array([len(p) for p in pages])
    place = np.arange(len(blocks)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    own = np.repeat(sizes, sizes)
    chars = np.array([len(b.text) for b in blocks])
    other = out[:, PATH_DIMS + WORD_DIMS:]
    other[:, 0] = np.log1p(n) / 2
    other[:, 1] = np.array([b.linked for b in blocks]) / chars
    other[:, 2] = [b.text[-1] in ".!?…\"»“”)" for b in blocks]
    other[:, 3] = place / own
    other[:, 4] = np.log1p(own) / 4
    other[:, 5] = np.array([len(b.path) for b in blocks]) / 10
    other[:, 6] = [any(ch.isdigit() for ch in b.text[:200]) for b in blocks]
    other[:, 7] = np.log1p(chars / np.maximum(n, 1)) / 3
    other[:, 8] = place == 0
    return out


# --- network -----------------------------------------------------------------


@dataclass
class Labeller:
    """Weights by name: of each direction wx, wh, b (gates in the order input, forget, output, cell), and of the output."""

    weights: dict[str, np.ndarray]

    @staticmethod
    def new(random: np.random.Generator) -> Labeller:
        w = {}
        for side in ("f", "b"):
            w[side + "wx"] = random.normal(0, 1 / np.sqrt(INPUTS), (INPUTS, 4 * HIDDEN))
            w[side + "wh"] = random.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN))
            w[side + "b"] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
        w["out"] = random.normal(0, 1 / np.sqrt(2 * HIDDEN), 2 * HIDDEN)
        w["bias"] = np.zeros(1)
        return Labeller({k: v.astype(np.float32) for k, v in w.items()})

    def logits(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """For pages x blocks x INPUTS; ``mask`` is 0 after a page's last block."""
        return self._forward(x, mask)[0]

    def _forward(self, x: np.ndarray, mask: np.ndarray, keep: bool = False):
        w, sides = self.weights, {}
        states = np.zeros((*mask.shape, 2 * HIDDEN), x.dtype)
        for s, side in enumerate(("f", "b")):
            z = x @ w[side + "wx"] + w[side + "b"]
            h = c = np.zeros((len(x), HIDDEN), x.dtype)
            kept = []
            for t in range(x.shape[1]) if side == "f" else range(x.shape[1] - 1, -1, -1):
                gates = z[:, t] + h @ w[side + "wh"]
                on = 1 / (1 + np.exp(-np.clip(gates[:, :3 * HIDDEN], -30, 30)))
                i, f, o = on[:, :HIDDEN], on[:, HIDDEN:2 * HIDDEN], on[:, 2 * HIDDEN:]
                g, m = np.tanh(gates[:, 3 * HIDDEN:]), mask[:, t:t + 1]
                before, h_before = c, h
                c = (f * c + i * g) * m  # a padded place leaves an empty state
                tanh = np.tanh(c)
                h = o * tanh * m
                states[:, t, s * HIDDEN:(s + 1) * HIDDEN] = h
                if keep:
                    kept.append((t, i, f, o, g, before, h_before, tanh, m))
            sides[side] = kept
        return states @ w["out"] + w["bias"], states, sides

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray, used: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean log loss over the blocks that are ``used``, and its gradient by back-propagation through time."""
        w, n = self.weights, max(1.0, float(used.sum()))
        logits, states, sides = self._forward(x, mask, keep=True)
        loss = float((np.logaddexp(0, -(2 * y - 1) * logits) * used).sum() / n)
        error = (1 / (1 + np.exp(-np.clip(logits, -30, 30))) - y) * used / n
        grads = {"out": np.einsum("pt,pth->h", error, states), "bias": np.array([error.sum()])}
        for s, side in enumerate(("f", "b")):
            from_out = error[:, :, None] * w["out"][s * HIDDEN:(s + 1) * HIDDEN]
            dz = np.zeros((*mask.shape, 4 * HIDDEN), x.dtype)
            dwh, dh, dc = np.zeros_like(w[side + "wh"]), 0.0, 0.0
            for t, i, f, o, g, before, h_before, tanh, m in reversed(sides[side]):
                dh = (from_out[:, t] + dh) * m
                dc = (dc + dh * o * (1 - tanh * tanh)) * m
                gates = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tanh * o * (1 - o), dc * i * (1 - g * g)], axis=1)
                dz[:, t] = gates
                dwh += h_before.T @ gates
                dh, dc = gates @ w[side + "wh"].T, dc * f
            grads[side + "wx"] = np.einsum("pti,ptg->ig", x, dz, optimize=True)
            grads[side + "wh"], grads[side + "b"] = dwh, dz.sum(axis=(0, 1))
        return loss, grads


def padded(sizes: list[int]) -> Iterator[list[int]]:
    """Pages by length in groups that hold at most CELLS blocks with padding, or one page."""
    group: list[int] = []
    for k in sorted(range(len(sizes)), key=lambda k: sizes[k]):
        if group and (len(group) + 1) * sizes[k] > CELLS:
            yield group
            group = []
        group.append(k)
    if group:
        yield group


def _stacked(inputs: np.ndarray, starts: np.ndarray, group: list[int], sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    longest = max(1, max(sizes[k] for k in group))
    x, mask = np.zeros((len(group), longest, INPUTS), np.float32), np.zeros((len(group), longest), np.float32)
    for row, k in enumerate(group):
        x[row, :sizes[k]] = inputs[starts[k]:starts[k] + sizes[k]]
        mask[row, :sizes[k]] = 1
    return x, mask


def fit(pages: list[list[Block]], labels: list[list[str]], seed: int = 7, epochs: int = EPOCHS) -> Labeller:
    """Adam over groups of pages; blocks labelled - count for nothing."""
    random = np.random.default_rng(seed)
    model = Labeller.new(random)
    chosen = [k for k, page in enumerate(pages) if page]
    sizes = [len(p) for p in pages]
    starts = np.concatenate(([0], np.cumsum(sizes)))
    inputs = block_inputs(pages, Vectors())
    first, second = ({k: np.zeros_like(v) for k, v in model.weights.items()} for _ in range(2))
    step = 0
    # Pages of like length share a group, so there is little padding.
    ordered = sorted(chosen, key=lambda k: sizes[k])
    groups = [ordered[k:k + PAGES_AT_ONCE] for k in range(0, len(ordered), PAGES_AT_ONCE)]
    for epoch in range(epochs):
        for at in random.permutation(len(groups)):
            group = groups[at]
            x, mask = _stacked(inputs, starts, group, sizes)
            y, used = np.zeros_like(mask), np.zeros_like(mask)
            for row, k in enumerate(group):
                y[row, :sizes[k]] = [v == "1" for v in labels[k]]
                used[row, :sizes[k]] = [v in "01" for v in labels[k]]
            step += 1
            rate = RATE * (1 - epoch / epochs)
            _, grads = model.gradients(x, mask, y, used)
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            for k, g in grads.items():
                g = g * min(1.0, 5.0 / (norm + 1e-9))
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                model.weights[k] = (model.weights[k] - rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return model


def training_set(pages: list[str], seed: int = 11, layouts: int = LAYOUTS) -> tuple[list[list[Block]], list[list[str]]]:
    """Blocks and labels: the given pages by their markup, and texts of theirs laid out anew."""
    random = np.random.default_rng(seed)
    read = [read_blocks(p) for p in pages]
    out, labels = list(read), [[markup_label(b.path) for b in page] for page in read]
    main = [[b.text for b, y in zip(*pair) if y == "1"] or [b.text for b, y in zip(*pair) if y == "-" and len(b.text) > 40] for pair in zip(read, labels)]
    texts = [t for t in main if t] or [["A page without any text of its own."]]
    every = [b.text for page in read for b in page] or texts[0]
    for _ in range(layouts):
        own = texts[int(random.integers(len(texts)))]
        n = int(random.integers(1, 20))
        at = int(random.integers(max(1, len(own) - n + 1)))
        paragraphs = [" ".join(t.split()[:int(random.choice([2, 8, 30, 200]))]) for t in own[at:at + n]]
        page = read_blocks(labelled_page(random, paragraphs, every))
        out.append(page)
        labels.append([b.label or "0" for b in page])
    return out, labels


def training_pages(pages: DataFrame, html: str = "html", limit: int = MAX_PAGES) -> list[str]:
    """``limit`` distinct pages of at most MAX_PAGE_BYTES: those with the smallest hashes of their html.

    Only pages under a hash that about four times as many fall below are
    looked at, so what is sent to the driver does not grow with the table.
    """
    sized = pages.select(F.col(html).alias("html")).filter((F.octet_length("html") > 0) & (F.octet_length("html") <= MAX_PAGE_BYTES))
    rows = sized.count()
    hashed = sized.withColumn("hash", F.xxhash64("html"))
    if rows > 4 * limit:
        hashed = hashed.filter(F.col("hash") < int(2 ** 64 * 4 * limit / rows) - 2 ** 63)
    distinct = hashed.groupBy("hash").agg(F.min("html").alias("html"))
    return [r["html"] for r in distinct.orderBy("hash").limit(limit).collect()]


def train(pages: DataFrame, html: str = "html") -> Labeller:
    """A labeller from MAX_PAGES pages; without a page it is trained on layouts of a single sentence."""
    return fit(*training_set(training_pages(pages, html)))


# --- extraction --------------------------------------------------------------


def kept_blocks(model: Labeller, pages: list[list[Block]], vectors: Vectors) -> list[list[bool]]:
    """For each block of each page whether it is main text."""
    sizes = [len(p) for p in pages]
    starts = np.concatenate(([0], np.cumsum(sizes)))
    inputs = block_inputs(pages, vectors)
    out: list[list[bool]] = [[] for _ in pages]
    cut = np.log(THRESHOLD / (1 - THRESHOLD))
    for group in padded(sizes):
        if sizes[group[-1]]:
            x, mask = _stacked(inputs, starts, group, sizes)
            main = model.logits(x, mask) >= cut
            for row, k in enumerate(group):
                out[k] = main[row, :sizes[k]].tolist()
    return out


def _extractor(shared, html: str):
    def extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, vectors = shared.value, Vectors()
        for batch in slices(batches, html):
            pages = [read_blocks(p) for p in batch.column(batch.schema.get_field_index(html)).to_pylist()]
            kept = kept_blocks(model, pages, vectors)
            texts = ["\n".join(b.text for b, k in zip(page, keep) if k) for page, keep in zip(pages, kept)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             ["page_id", "url", "text", "n_chars"])
    return extract


def extract_text(pages: DataFrame, model: Labeller, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text, n_chars, a row for each row of ``pages``: the blocks labelled as main text, one on each line.

    Null or empty html, and a page without a block of main text, give an empty
    text. Ids may be null or repeated; equal rows give equal results; other
    columns are not looked at. A page is read whole, however long; pages are
    not shuffled. An empty table gives no rows.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)  # about 100,000 bytes
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    return rows.mapInArrow(_extractor(shared, "html"), f"page_id {types['page_id']}, url {types['url']}, text string, n_chars long")
