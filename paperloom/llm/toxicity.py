"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

P(grade >= k) = sigmoid(w . x - c_k), with one weight vector for all grades and ordered thresholds
c_1 <= ... <= c_K.  The expected severity is the sum of P(grade >= k) over k, from 0 to K.

Labels tell toxic from clean.  The grade of a toxic training document comes from a scorer that hasn't seen
it: training documents are dealt to two folds, each fold's documents are scored by how toxic their words are in the
other fold's labels (log-odds, a mean over the text), and the toxic ones are cut into ``GRADES`` equal
parts by that score.  Features are the presence of words and of their beginnings (3 to 6 letters), as
toxic words may be inflected, whether there is any, and the share of tell-tale words.  Those words and
beginnings are candidates that are in two toxic training documents at least; those are kept that are
toxic in at least half of their documents and whose log-likelihood ratio against the label reaches
``LEAST_LLR`` and twice the logarithm of the number of candidates, the ``MAX_FEATURES`` of the highest
ratio if there are more: the width of the model.  It is fitted on at most ``TRAIN_DOCUMENTS`` labelled
documents, in the order of a hash of their ids.  Everything else covers whole texts of all documents.

A null, empty or wordless text has no features.  A null id has no label.  Repeated rows are graded
each; for training, repeated rows of one id, text and label count once.  Without toxic or without clean
labels every severity is 0.  An empty table gives an empty result.  Only doc_id and text are read from
documents, so further columns of any name don't matter.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import dropped, lean, stored, training_rows
from paperloom.llm.tokens import Memo

TRAIN_DOCUMENTS = 20_000
LEAST_LLR = 10.0
MAX_FEATURES = 4096
#: Grades of toxic documents: 0 is clean, 1 to GRADES are toxic.
GRADES = 3
#: Counts that a worker holds at once; more are added up by Spark.
HELD_COUNTS = 200_000
BEGINNINGS = range(3, 7)
WORDS = re.compile(r"[^\W\d_]+")


def features_of(word: str) -> tuple[str, ...]:
    """A word and its beginnings, as feature names."""
    return (word, *(word[:n] + "-" for n in BEGINNINGS if n <= len(word)))


def log_likelihood_ratio(n: F.Column, bad: F.Column, docs: int, bad_docs: int) -> F.Column:
    """Twice the log-likelihood ratio of a feature in ``n`` documents, ``bad`` of them toxic; negative if it tells of clean ones."""

    def ll(k: F.Column, of: F.Column) -> F.Column:
        rate = F.greatest(F.lit(1e-12), F.least(F.lit(1 - 1e-12), k / F.greatest(of, F.lit(1))))
        return k * F.log(rate) + (of - k) * F.log(1 - rate)

    value = 2 * (ll(bad, n) + ll(bad_docs - bad, docs - n) - ll(F.lit(bad_docs), F.lit(docs)))
    return F.when(bad * docs > bad_docs * n, value).otherwise(-value)


class Features:
    """Sparse vectors of texts over selected features; beside them the share of tell-tale words."""

    def __init__(self, names: list[str], telling: set[str]):
        self.place = {x: i for i, x in enumerate(names)}
        self.telling = telling
        self.memo = Memo(self._word, 100_000)

    def _word(self, word: str) -> tuple[frozenset[int], bool] | None:
        names = features_of(word)
        found = frozenset(self.place[x] for x in names if x in self.place)
        return (found, any(x in self.telling for x in names)) if found else None

    def __call__(self, text: str | None) -> tuple[list[int], float]:
        words = WORDS.findall(text.lower()) if text else []
        hits = [x for x in map(self.memo.__getitem__, words) if x]
        places = set().union(*(x[0] for x in hits))
        return sorted(places), 100 * sum(x[1] for x in hits) / len(words) if words else 0.0


class CumulativeLink:
    """w, and thresholds c_1 and the gaps above it (kept positive by an exponential)."""

    def __init__(self, n: int, grades: int):
        self.w, self.c = np.zeros(n + 2), np.arange(grades, dtype=float)

    @staticmethod
    def matrix(rows: list[tuple[list[int], float]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Owners and places of the sparse features; and beside them whether there is any, and the share."""
        owner = np.repeat(np.arange(len(rows)), [len(x) for x, _ in rows])
        dense = np.array([(4.0 * bool(x), np.log1p(r)) for x, r in rows]).reshape(-1, 2)
        return owner, np.array([i for x, _ in rows for i in x], np.int64), dense

    def latent(self, owner: np.ndarray, place: np.ndarray, dense: np.ndarray) -> np.ndarray:
        return np.bincount(owner, self.w[place], len(dense)) + dense @ self.w[-2:]

    def fit(self, rows: list[tuple[list[int], float]], grade: np.ndarray, steps: int = 300, rate: float = 0.1, l2: float = 0.02) -> CumulativeLink:
        owner, place, dense = self.matrix(rows)
        first, gaps = 0.0, np.zeros(len(self.c) - 1)
        params = [self.w, np.array([first]), gaps]
        m, v = [np.zeros_like(x) for x in params], [np.zeros_like(x) for x in params]
        for step in range(1, steps + 1):
            self.w = params[0]
            c = params[1][0] + np.concatenate([[0], np.cumsum(np.exp(params[2]))])
            eta = self.latent(owner, place, dense)
            # The likelihood of each grade: the difference of neighbouring cumulative probabilities.
            p = np.concatenate([np.ones((len(eta), 1)), 1 / (1 + np.exp(np.clip(c - eta[:, None], -60, 60))), np.zeros((len(eta), 1))], 1)
            i = np.arange(len(eta))
            high, low = p[i, grade], p[i, grade + 1]
            like = np.maximum(high - low, 1e-9)
            dhigh, dlow = high * (1 - high) / like, low * (1 - low) / like
            d = -(dhigh - dlow) / len(eta)
            dc = np.zeros(len(c))
            np.add.at(dc, np.maximum(grade - 1, 0), np.where(grade > 0, dhigh, 0) / len(eta))
            np.add.at(dc, np.minimum(grade, len(c) - 1), np.where(grade < len(c), -dlow, 0) / len(eta))
            gw = np.bincount(place, d[owner], len(self.w))
            gw[-2:] = d @ dense
            gw += l2 * self.w / len(eta) ** 0.5
            tail = np.cumsum(dc[::-1])[::-1]
            grads = [gw, np.array([dc.sum()]), tail[1:] * np.exp(params[2])]
            for k, g in enumerate(grads):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                params[k] = params[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        self.w, self.c = params[0], params[1][0] + np.concatenate([[0], np.cumsum(np.exp(params[2]))])
        return self

    def cumulative(self, rows: list[tuple[list[int], float]]) -> np.ndarray:
        """P(grade >= k) for each row and k."""
        eta = self.latent(*self.matrix(rows))
        return 1 / (1 + np.exp(np.clip(self.c - eta[:, None], -60, 60)))


def fold_of(row: str) -> int:
    """0 or 1, by a hash of a training document."""
    return zlib.crc32(row.encode()) >> 7 & 1


def grades(share: np.ndarray, fold: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """0 for clean documents; for toxic ones 1 to GRADES, in equal parts of each fold by the other fold's score."""
    out = np.zeros(len(toxic), int)
    for f in (0, 1):
        here = np.flatnonzero((fold == f) & toxic)
        cuts = np.quantile(share[here], np.arange(1, GRADES) / GRADES) if len(here) else np.zeros(GRADES - 1)
        out[here] = 1 + np.searchsorted(cuts, share[here], "left")
    return out


def fit(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_DOCUMENTS) -> tuple[Features, CumulativeLink] | None:
    """The selected features and the fitted regression; None if the labels hold one class only."""
    train = training_rows(docs, labels, "toxic", limit)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [Counter() for _ in range(4)]  # by fold and label

        def counted() -> Iterator[pa.RecordBatch]:
            for k, part in enumerate(seen):
                n = [pa.array(list(part.values()), pa.int64()) if j == k else pa.array([0] * len(part), pa.int64()) for j in range(4)]
                yield pa.RecordBatch.from_arrays([pa.array(list(part), pa.string()), *n], ["feature", "clean0", "bad0", "clean1", "bad1"])
                part.clear()

        for batch in batches:
            for text, toxic, row in zip(*(batch.column(c).to_pylist() for c in ("text", "label", "row")), strict=True):
                found = {x for w in set(WORDS.findall(text.lower()) if text else ()) for x in features_of(w)}
                found.add("")  # counts documents
                seen[2 * fold_of(row) + bool(toxic)].update(found)
            if sum(map(len, seen)) > HELD_COUNTS:
                yield from counted()
        yield from counted()

    parts = ("clean0", "bad0", "clean1", "bad1")
    counts = train.mapInArrow(lean(count), "feature string, clean0 long, bad0 long, clean1 long, bad1 long").groupBy("feature").agg(*(F.sum(c).alias(c) for c in parts))
    counts = stored(counts.select("*", (F.col("bad0") + F.col("bad1")).alias("bad"), (F.col("clean0") + F.col("bad0") + F.col("clean1") + F.col("bad1")).alias("n")), "toxicity-counts")
    whole = counts.where("feature = ''").first()
    if whole is None or not 0 < whole["bad"] < whole["n"]:
        return None
    candidates = counts.where("bad >= 2 and feature <> ''")
    ratio = log_likelihood_ratio(F.col("n"), F.col("bad"), whole["n"], whole["bad"])
    # Of so many candidates some stand out by chance: the bar rises with their number.
    bar = max(LEAST_LLR, 2 * float(np.log(max(1, candidates.count()))))
    found = candidates.withColumn("ratio", ratio).where((F.col("ratio") >= bar) & (2 * F.col("bad") >= F.col("n"))).orderBy(F.desc("ratio"), "feature").limit(MAX_FEATURES).collect()
    if not found:
        return None
    # How toxic a feature is by the labels of one fold alone.
    odds = {r["feature"]: tuple(max(0.0, float(np.log((r[f"bad{f}"] + 0.5) / (whole[f"bad{f}"] + 1)) - np.log((r[f"clean{f}"] + 0.5) / (whole[f"clean{f}"] + 1)))) for f in (0, 1)) for r in found}
    features = Features([r["feature"] for r in found], {r["feature"] for r in found if r["bad"] >= 0.8 * r["n"]})

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, row in zip(batch.column("text").to_pylist(), batch.column("row").to_pylist(), strict=True):
                words, fold = WORDS.findall(text.lower()) if text else [], fold_of(row)
                score = sum(max((odds[x][1 - fold] for x in features_of(w) if x in odds), default=0.0) for w in words) / max(1, len(words))
                out.append((*features(text), fold, score))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, *_ in out], pa.list_(pa.int32())), *(pa.array([r[k] for r in out]) for k in (1, 2, 3)), batch.column("label")], ["x", "share", "fold", "score", "label"])

    got = sorted((tuple(r) for r in train.mapInArrow(lean(vectors), "x array<int>, share double, fold long, score double, label int").collect()), key=lambda r: (r[1:], r[0]))
    dropped(docs.sparkSession, train, counts)
    _, _, fold, score, toxic = zip(*got, strict=True)
    grade = grades(np.array(score), np.array(fold), np.array(toxic, bool))
    return features, CumulativeLink(len(features.place), GRADES).fit([(list(x), share) for x, share, *_ in got], grade)


def grade_documents(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_DOCUMENTS) -> DataFrame:
    """doc_id, severity (expected grade), grade (the likeliest), p_toxic = P(grade >= 1), toxic (p_toxic >= 0.5)."""
    run = _scorer(fit(docs, labels, limit))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lean(run), "doc_id long, severity double, grade int, p_toxic double, toxic boolean")


def _scorer(model: tuple[Features, CumulativeLink] | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if model is None:
                p = np.zeros((batch.num_rows, 1))
            else:
                features, link = model
                p = link.cumulative([features(x) for x in batch.column("text").to_pylist()])
            each = np.concatenate([np.ones((len(p), 1)), p], 1) - np.concatenate([p, np.zeros((len(p), 1))], 1)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p.sum(1)), pa.array(each.argmax(1).astype(np.int32)), pa.array(p[:, 0]), pa.array(p[:, 0] >= 0.5)], ["doc_id", "severity", "grade", "p_toxic", "toxic"])

    return run


def clean(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_DOCUMENTS) -> DataFrame:
    """The documents that aren't toxic, with all their columns; each row is judged where it stands."""
    score, schema = _scorer(fit(docs, labels, limit)), docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = next(i for i, f in enumerate(schema) if f.name.lower() == "text")
            rows = pa.RecordBatch.from_arrays([pa.nulls(batch.num_rows, pa.int64()), batch.column(at).cast(pa.string())], ["doc_id", "text"])
            (got,) = score([rows])
            yield batch.filter(pa.compute.invert(got.column("toxic")))

    return docs.mapInArrow(lean(run), schema)
