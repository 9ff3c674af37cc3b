"""Main text of HTML pages by a linear-chain conditional random field over leaf blocks.

Each block is described by its own and its ancestors' tags, the words of their names, and its text
(length, links, punctuation).  Two labels, main and other, with weights of features and of
neighbouring labels, are fitted to labelled pages by the gradient of the conditional likelihood
(forward and backward sums); a page is labelled by Viterbi.

Character references are decoded, white space within a block becomes one space, and the blocks labelled main are
joined by one space in page order.  A null, empty or blockless page has the empty text.  Repeated rows
are extracted each; an empty table gives an empty result.  Very long and very deep pages are read whole,
in time by their length.  Null ids and urls stay null.  Only page_id, url and html are read, so further
columns of any name don't matter.
"""

from __future__ import annotations

import re
from collections.abc import Container, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import lean
from paperloom.llm.html_blocks import Block, Node, blocks_of
from paperloom.llm.labelled_pages import MARK, Pages

#: How a line on copyright begins, and how long one is at most.
COPYRIGHT, LEGAL = re.compile(r"©|\(c\)|copyright\b", re.I), 200
#: Pages that the default model is fitted on.
TRAIN_PAGES = 1500
NEUTRAL = frozenset("html body div span section p".split())
#: Elements that hold blocks side by side.
BOXES = frozenset("html body div section article main aside nav header footer form dialog td li ol ul ins".split())
#: Elements whose presence on a page, and around a block, tells how to read the rest.
SIGNS = ("article", "main", "nav", "header", "footer", "aside", "form")


class Around:
    """What a block has from its ancestors: kept at each node, so that a page costs its length whatever its depth."""

    __slots__ = ("box", "deep", "depth", "inner", "names", "near", "signs")

    def __init__(self):
        self.names: frozenset[str] = frozenset()
        self.inner: tuple[str, ...] = ()
        self.signs: frozenset[str] = frozenset()
        self.near, self.deep, self.box, self.depth = "-", 0, None, 0


OUTSIDE = Around()


def around(node: Node | None, known: Container[str] | None) -> Around:
    """``Around`` of a node; only names in ``known`` are carried on (all, if it is None)."""
    chain = []
    while node is not None and node.memo is None:
        chain.append(node)
        node = node.parent
    above = node.memo if node is not None else OUTSIDE
    for n in reversed(chain):
        a = n.memo = Around()
        new = [] if n.tag in NEUTRAL else [f"in={n.tag}"]
        new += [x for w in n.words for x in (f"name={w}", f"name4={w[:4]}")]
        new = [x for x in new if x not in above.names and (known is None or x in known)]
        a.names = above.names.union(new) if new else above.names
        a.inner = n.words or above.inner
        a.signs = above.signs | {n.tag} if n.tag in SIGNS and n.tag not in above.signs else above.signs
        a.near = n.tag if n.tag not in NEUTRAL else above.near
        a.deep = 0 if n.tag not in NEUTRAL or n.words else min(above.deep + 1, 4)
        a.box = n if n.tag in BOXES else above.box
        a.depth = min(above.depth + 1, 9)
        above = a
    return above


def share(part: float, whole: float) -> int:
    """A share in quarters; 4 for the whole."""
    return int(4 * part / whole) if whole else 0


def features(blocks: list[Block], known: Container[str] | None = None) -> list[list[str]]:
    """The names of each block's features."""
    seen = [around(b.node, known) for b in blocks]
    prose: dict[int, int] = {}  # by box: characters outside links of the blocks right in it
    for b, a in zip(blocks, seen, strict=True):
        prose[id(a.box)] = prose.get(id(a.box), 0) + max(0, len(b.text) - b.link_chars)
    most, total = max(prose.values(), default=0), sum(prose.values())
    page = frozenset().union(*{a.signs for a in seen}) if seen else frozenset()
    signs = "".join(t[0] for t in SIGNS if t in page)
    lead = "a" if "article" in page else "m" if "main" in page else "-"
    out = []
    for k, (b, a) in enumerate(zip(blocks, seen, strict=True)):
        n, own = len(b.text), b.node.tag if b.node is not None else ""
        above = around(b.node.parent, known) if b.node is not None else OUTSIDE
        linked = b.link_chars / n
        f = ["1", f"tag={own}", f"size={min(n.bit_length(), 11)}", f"links={int(min(linked, 1) * 4)}", f"tag,links={own},{linked > 0.5}"]
        f += a.names
        f += [x for w in a.inner for x in (f"inner={w}", f"inner4={w[:4]}")]
        near = above.near
        plain = not a.signs and not a.inner
        f += [f"deep={above.deep}", f"near={near}", f"named={bool(a.inner)}", f"plain={plain}", f"signs={''.join(t[0] for t in SIGNS if t in a.signs)}"]
        inside = (lead == "a" and "article" in a.signs) or (lead == "m" and "main" in a.signs)
        f += [f"lead={lead},{inside}", f"lead,tag={lead},{inside},{own}", f"page={signs},{plain}", f"page,in={bool(page)},{inside},{plain}"]
        mine = prose[id(a.box)]
        f += [f"box={share(mine, most)}", f"boxall={share(mine, total)}", f"box,plain={share(mine, most)},{plain},{lead}", f"boxes={min(len(prose), 4)},{plain}"]
        last = b.text[-1]
        f += [f"end={last if last in '.!?:;,|' else 'a'}", f"mark={b.text[0] in '©®™'}", f"legal={n < LEGAL and bool(COPYRIGHT.match(b.text))}", f"bars={min(b.text.count('|'), 2)}"]
        f += [f"first={k == 0}", f"last={k == len(blocks) - 1}", f"many={b.links > 2}", f"blocks={min(len(blocks), 4)},{plain}"]
        f.append(f"same={k > 0 and seen[k - 1].box is a.box}")
        out.append(f)
    return out


class Crf:
    """Weights of features for main against other, and of pairs of neighbouring labels."""

    def __init__(self):
        self.weights: dict[str, float] = {}
        self.pairs = np.zeros((2, 2))
        self.ends = np.zeros(2)

    def scores(self, names: list[list[str]]) -> np.ndarray:
        get = self.weights.get
        return np.array([[0.0, sum(get(f, 0.0) for f in x)] for x in names])

    def labels(self, blocks: list[Block]) -> list[int]:
        """1 for each block of the main text, 0 for others."""
        return self.viterbi(self.scores(features(blocks, self.weights))) if blocks else []

    def viterbi(self, scores: np.ndarray) -> list[int]:
        if not len(scores):
            return []
        pairs, best, back = self.pairs.tolist(), (scores[0] + self.ends).tolist(), []
        for s in scores[1:].tolist():
            came = [0 if best[0] + pairs[0][y] >= best[1] + pairs[1][y] else 1 for y in (0, 1)]
            best = [best[came[y]] + pairs[came[y]][y] + s[y] for y in (0, 1)]
            back.append(came)
        label = [0 if best[0] >= best[1] else 1]
        for came in reversed(back):
            label.append(came[label[-1]])
        return label[::-1]

    def marginals(self, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of each block's label, and the expected counts of neighbouring labels."""
        n = len(scores)
        a, b = np.zeros((n, 2)), np.zeros((n, 2))
        a[0] = scores[0] + self.ends
        for i in range(1, n):
            a[i] = scores[i] + np.logaddexp(a[i - 1][0] + self.pairs[0], a[i - 1][1] + self.pairs[1])
        for i in range(n - 2, -1, -1):
            t = self.pairs + scores[i + 1] + b[i + 1]
            b[i] = np.logaddexp(t[:, 0], t[:, 1])
        z = np.logaddexp(*(a[-1]))
        single = np.exp(a + b - z)
        pairs = np.exp(a[:-1, :, None] + self.pairs + (scores + b)[1:, None, :] - z).sum(0) if n > 1 else np.zeros((2, 2))
        return single, pairs

    def fit(self, pages: Iterable[tuple[list[list[str]], list[int]]], epochs: int = 5, rate: float = 0.2, l2: float = 1e-4) -> Crf:
        """Stochastic steps along the likelihood's gradient, each weight with its own rate (squared sums)."""
        pages = [p for p in pages if p[1]]
        squares: dict[str, float] = {}
        pair_squares, end_squares = np.full((2, 2), 1e-2), np.full(2, 1e-2)
        for _ in range(epochs):
            for names, labels in pages:
                single, pairs = self.marginals(self.scores(names))
                seen = np.zeros((2, 2))
                np.add.at(seen, (labels[:-1], labels[1:]), 1)
                for x, p, y in zip(names, single[:, 1].tolist(), labels, strict=True):
                    for f in x:
                        w = self.weights.get(f, 0.0)
                        g = y - p - l2 * w
                        squares[f] = s = squares.get(f, 1e-2) + g * g
                        self.weights[f] = w + rate * g / s**0.5
                g = seen - pairs
                pair_squares += g * g
                self.pairs += rate * g / pair_squares**0.5
                g = np.eye(2)[labels[0]] - single[0]
                end_squares += g * g
                self.ends += rate * g / end_squares**0.5
        return self


def labelled(pages: Iterable[str]) -> Iterator[tuple[list[list[str]], list[int]]]:
    """Features and labels of pages whose main blocks begin with the mark."""
    for page in pages:
        blocks = blocks_of(page)
        labels = [int(MARK in b.text) for b in blocks]
        for b in blocks:
            b.text = b.text.replace(MARK, "")
        keep = [i for i, b in enumerate(blocks) if b.text]
        yield features([blocks[i] for i in keep]), [labels[i] for i in keep]


def default_model(pages: int = TRAIN_PAGES, seed: int = 0) -> Crf:
    source = Pages(seed)
    return Crf().fit(labelled(source.page() for _ in range(pages)))


def main_text(model: Crf, page: str | None) -> str:
    blocks = blocks_of(page)
    return " ".join(b.text for b, y in zip(blocks, model.labels(blocks), strict=True) if y)


def extract(pages: DataFrame, model: Crf | None = None) -> DataFrame:
    """page_id, url, text, n_chars, n_blocks and n_main of every page."""
    model = model or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, of, main = [], [], []
            for page in batch.column("html").to_pylist():
                blocks = blocks_of(page)
                labels = model.labels(blocks)
                texts.append(" ".join(b.text for b, y in zip(blocks, labels, strict=True) if y))
                of.append(len(blocks))
                main.append(sum(labels))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64()), pa.array(of, pa.int64()), pa.array(main, pa.int64())],
                ["page_id", "url", "text", "n_chars", "n_blocks", "n_main"],
            )

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(lean(run), "page_id long, url string, text string, n_chars long, n_blocks long, n_main long")
