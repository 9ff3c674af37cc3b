"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages (``PASSAGE`` words each, the whole text).  Each passage is encoded as a
vector of how it is written: word shapes, repeats, lengths.  A hidden layer h = tanh(A x) embeds it, gated attention
a = softmax(w . (tanh(V h) * sigmoid(U h))) weighs the passages, and the weighted mean of h is scored.
Only document labels are needed: the weights of attention are learned from them.

The model is fitted on at most ``TRAIN_DOCUMENTS`` labelled documents, taken in the order of a hash of
their ids, as long as they have no more than ``TRAIN_PASSAGES`` passages in all, which bounds the driver's
memory; documents held out of training never reach it.  A bag is all passages of its text, and scoring
covers every passage of every text.

A null, empty or blank text is one passage of zeros.  A null id isn't held out and has no label.
Repeated rows are scored each; for training, repeated rows of one id, text and label count once.  Without
labelled rows, or with one class only, the score is the rate of label 1 (0.5 without rows).  An empty
table gives an empty result.  Only doc_id and text are read from documents, so further columns of any
name don't matter.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import lean, stored, training_rows
from paperloom.llm.tokens import Memo

TRAIN_DOCUMENTS = 6000
#: Passages of all training documents together, 240 bytes each on the driver: where there are more, fewer documents are taken.
TRAIN_PASSAGES = 300_000
PASSAGE = 96
SHAPES = 48
THRESHOLD = 0.3
NUMBERS = re.compile(r"[0-9]+")
RUNS = ((re.compile(r"[A-ZÀ-ÖØ-Þ]+"), "A"), (re.compile(r"[a-zß-öø-ÿ]+"), "a"), (NUMBERS, "0"), (re.compile(r"[^\x00-ÿ]+"), "u"))


def shape(word: str) -> int:
    """The bucket of a word's shape: runs of capitals, small letters and digits become one letter each."""
    for run, letter in RUNS:
        word = run.sub(letter, word)
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % SHAPES


FEATURES = SHAPES + 12


class Encoder:
    """Vectors of a text's passages."""

    def __init__(self):
        self.shapes = Memo(shape, 200_000)

    def passage(self, words: list[str]) -> np.ndarray:
        n = len(words)
        x = np.zeros(FEATURES)
        x[:SHAPES] = np.sqrt(np.bincount(list(map(self.shapes.__getitem__, words)), minlength=SHAPES) / n)
        joined = "".join(words)
        size = len(joined)
        x[SHAPES:] = (
            len(set(words)) / n,
            sum(map(eq, words, words[1:])) / n,
            sum(map(eq, words, words[2:])) / n,
            min(size / n, 40) / 10,
            max(map(len, words)) / (10 + size),
            sum(map(joined.count, "#*$%&|<>")) / size,
            sum(map(joined.count, "!?")) / size,
            sum(map(joined.count, ".,;:")) / size,
            sum(map(joined.count, "0123456789")) / size,
            sum(map(str.isupper, joined)) / size,
            len(set(joined.lower())) / min(size, 200),
            min(n, PASSAGE) / PASSAGE,
        )
        return x

    def passages(self, text: str | None) -> Iterator[np.ndarray]:
        words = text.split() if text else []
        if not words:
            yield np.zeros(FEATURES)
        for at in range(0, len(words), PASSAGE):
            yield self.passage(words[at : at + PASSAGE])

    def bag(self, text: str | None) -> np.ndarray:
        return np.array(list(self.passages(text)))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


class GatedAttention:
    """Parameters and their gradients; bags lie one after the other, ``starts`` says where."""

    HIDDEN, ATTENTION = 16, 8

    def __init__(self, seed: int = 0):
        r = np.random.default_rng(seed)
        h, a = self.HIDDEN, self.ATTENTION
        self.mean, self.scale = np.zeros(FEATURES), np.ones(FEATURES)
        self.p = {"A": r.normal(0, FEATURES**-0.5, (FEATURES, h)), "a": np.zeros(h), "V": r.normal(0, h**-0.5, (h, a)), "U": r.normal(0, h**-0.5, (h, a)), "w": r.normal(0, a**-0.5, a), "o": np.zeros(h), "b": np.zeros(1)}

    def forward(self, x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, dict]:
        p, sizes = self.p, np.diff(np.append(starts, len(x)))
        x = (x - self.mean) / self.scale
        h = np.tanh(x @ p["A"] + p["a"])
        t, g = np.tanh(h @ p["V"]), sigmoid(h @ p["U"])
        e = (t * g) @ p["w"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), sizes))
        alpha = e / np.repeat(np.add.reduceat(e, starts), sizes)
        z = np.add.reduceat(alpha[:, None] * h, starts)
        y = sigmoid(z @ p["o"] + p["b"][0])
        return y, {"x": x, "h": h, "t": t, "g": g, "alpha": alpha, "z": z, "sizes": sizes}

    def gradient(self, x: np.ndarray, starts: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        y, s = self.forward(x, starts)
        p, d = self.p, (y - label) / len(label)
        out = {"o": s["z"].T @ d, "b": np.array([d.sum()])}
        dz = np.repeat(d[:, None] * p["o"], s["sizes"], 0)
        dalpha = (dz * s["h"]).sum(1)
        de = s["alpha"] * (dalpha - np.repeat(np.add.reduceat(s["alpha"] * dalpha, starts), s["sizes"]))
        out["w"] = (s["t"] * s["g"]).T @ de
        dt, dg = de[:, None] * p["w"] * s["g"] * (1 - s["t"] ** 2), de[:, None] * p["w"] * s["t"] * s["g"] * (1 - s["g"])
        out["V"], out["U"] = s["h"].T @ dt, s["h"].T @ dg
        dh = s["alpha"][:, None] * dz + dt @ p["V"].T + dg @ p["U"].T
        da = dh * (1 - s["h"] ** 2)
        out["A"], out["a"] = s["x"].T @ da, da.sum(0)
        return out

    def fit(self, bags: list[np.ndarray], labels: np.ndarray, epochs: int = 40, batch: int = 64, rate: float = 0.01, decay: float = 1e-4, seed: int = 0) -> GatedAttention:
        everything = np.concatenate(bags)
        self.mean, self.scale = everything.mean(0), everything.std(0) + 0.05
        r, step = np.random.default_rng(seed), 0
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        epochs = max(epochs, min(400, 40 * 1500 // len(bags)))
        total = epochs * -(-len(bags) // batch)
        for _ in range(epochs):
            order = r.permutation(len(bags))
            for at in range(0, len(order), batch):
                pick, step = order[at : at + batch], step + 1
                part = [bags[i] for i in pick]
                starts = np.concatenate([[0], np.cumsum([len(b) for b in part])[:-1]])
                for k, g in self.gradient(np.concatenate(part), starts, labels[pick]).items():
                    g = g + decay * self.p[k]
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.p[k] = self.p[k] - rate * (1 - step / total) * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        return self

    def score(self, bag: np.ndarray) -> tuple[float, float]:
        """A document's score and its largest weight of attention."""
        y, s = self.forward(bag, np.array([0]))
        return float(y[0]), float(s["alpha"].max())


def held_out(doc_id) -> F.Column:
    """Whether an id's crc32, as text, is a multiple of 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_bags(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_DOCUMENTS, passages: int = TRAIN_PASSAGES) -> tuple[list[np.ndarray], np.ndarray]:
    """Bags and labels of at most ``limit`` labelled documents that aren't held out: the first by a hash until they have ``passages`` in all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder()
        for batch in batches:
            for k, text in enumerate(batch.column("text").to_pylist()):
                bag = encoder.bag(text)
                yield pa.RecordBatch.from_arrays([pa.array([bag.astype("<f4").tobytes()], pa.binary()), pa.array([len(bag)], pa.int64()), batch.column("label").slice(k, 1), batch.column("row").slice(k, 1)], ["bag", "size", "label", "row"])

    known = labels.where(~held_out(F.col("doc_id").cast("long")))
    rows = training_rows(docs, known, "quality", limit)
    bags = stored(rows.mapInArrow(lean(run), "bag binary, size long, label int, row string"), "training-bags")
    sizes = bags.select("row", "label", "size").collect()  # at most ``limit`` narrow rows
    taken, total = [], 0
    for r in sorted(sizes, key=lambda r: (zlib.crc32(r["row"].encode()), r["row"], r["label"])):
        if total >= passages:
            break  # fewer documents, none passed over for its length
        taken.append((r["row"], r["label"]))
        total += r["size"]
    if len(taken) < len(sizes):
        picked = docs.sparkSession.createDataFrame(taken, "r string, l int")
        bags = bags.join(F.broadcast(picked), (F.col("row") == F.col("r")) & (F.col("label") == F.col("l")), "left_semi")
    got = sorted(bags.select("row", "label", "bag").collect(), key=lambda r: (r["row"], r["label"]))  # so that a fit doesn't hang on the order of tasks
    return [np.frombuffer(r["bag"], "<f4").reshape(-1, FEATURES).astype(float) for r in got], np.array([r["label"] for r in got], float)


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted, passages, attention (the largest weight of a passage)."""
    bags, truth = training_bags(docs, labels)
    rate = float(truth.mean()) if len(truth) else 0.5
    model = GatedAttention().fit(bags, truth) if 0 < rate < 1 and len(truth) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder()
        for batch in batches:
            scores, attention, sizes = [], [], []
            for text in batch.column("text").to_pylist():
                bag = encoder.bag(text)
                y, a = model.score(bag) if model else (rate, 1 / len(bag))
                scores.append(y)
                attention.append(a)
                sizes.append(len(bag))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores), pa.array(sizes, pa.int64()), pa.array(attention)], ["doc_id", "score", "passages", "attention"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = rows.mapInArrow(lean(run), "doc_id long, score double, passages long, attention double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "passages", "attention")
