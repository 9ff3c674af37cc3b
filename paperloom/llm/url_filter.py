"""URL filters: rules on host and path, and for the other URLs a ratio of two character models.

Rules decide first: a rule fits its host and all subdomains where the path begins with the rule's; the longest
wins.  Two variable-order Markov models of characters are made of the URLs that rules (or the caller's own labels) accept and
reject, each distinct URL once; a URL is judged by the difference of its two log-likelihoods for each of its characters,
calibrated to a probability of rejection.

A model counts each character after contexts of up to ``ORDER`` characters, from a mark at the URL's begin to one at its end.
Its probability is interpolated (Witten and Bell): p(c | context) = (n(context c) + w p(c | shorter context)) / (n(context) + w), where w
is the number of different characters after the context.  A gram is kept if it is at least one in ``SHARE`` of its model's
characters, whatever their number, so tables of the same shares keep the same grams; counts of others go to w.  An unknown context leaves the shorter one's
probability, so the order varies with what was seen.

All URLs are counted: tasks count their batches, partial sums are shuffled by gram.  A model in a task has at most ``SHARE``
grams of each order, as each makes up so large a part, and so has a bound at any size of table; only that is collected and broadcast.
Calibration: URLs are parted in two by a hash of their host, each part is scored by models of the other, and a logistic
curve is fitted to a histogram of these scores, both classes weighing alike.

A URL that is null or has no ``://`` has an empty host and path, and so has no rule; without any character after ``://`` there
is nothing to judge and it is allowed.  Where one class has no URL there are no models, and what no rule decides is allowed.
Very long URLs are counted and scored whole.  Repeated rows get a row each.  An empty table gives an empty
result.  Further columns, of any name, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import lean, stored

ORDER, SHARE = 5, 60_000
#: What is counted was seen so often at least: no gram goes for its count alone.
MIN_SEEN = 1
#: Characters that an unseen one is taken to be drawn from; bins of scores to one unit, and the largest score of a bin.
ALPHABET, BINS, WIDEST = 256, 256, 8
#: Rejected from this probability on.
REJECT_FROM = 0.5
#: The letters that are lower-cased, the marks of a URL's begin and end.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BEGIN, END = 0x110000, 0x110001
CHARS_AT_ONCE = 1 << 18
_STEP, _EMPTY = np.uint64(0x9E3779B97F4A7C15), np.int64(0)


@dataclass(frozen=True)
class Rule:
    """``verdict`` for a host, its subdomains, and paths that begin with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


def with_parts(urls: DataFrame, url: str = "url") -> DataFrame:
    """``host``, ``path`` and ``shown``, all that follows ``://`` with the host in lower case, beside the other columns."""
    text = F.coalesce(F.col(url).cast("string"), F.lit(""))
    part = lambda k: F.regexp_extract(text, "://([^/?#]*)(([^?#]*)[\\s\\S]*)", k)
    host = F.when(F.length(part(1)) == F.octet_length(part(1)), F.lower(part(1))).otherwise(F.translate(part(1), UPPER, LOWER))
    return urls.withColumns({"host": host, "path": part(3), "shown": F.concat(host, part(2))})


def ruled(parts: DataFrame, rules: list[Rule]) -> DataFrame:
    """``rule`` and ``ruling`` of the longest rule that fits, both null if none does; rules are a list of the caller's, tried by length."""
    rule = ruling = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.text)):
        fits = r.fits(F.col("host"), F.col("path"))
        rule, ruling = F.when(fits, r.text).otherwise(rule), F.when(fits, r.verdict).otherwise(ruling)
    return parts.withColumns({"rule": rule, "ruling": ruling})


def mixed(z: np.ndarray) -> np.ndarray:
    """A 64-bit mixing of whole numbers (the finaliser of SplitMix64, whose constants are fixed values)."""
    z = (z ^ z >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ z >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return z ^ z >> np.uint64(31)


class Grams:
    """The characters of several URLs, and for each order the keys of a character's gram and context."""

    def __init__(self, urls: list[str], order: int = ORDER) -> None:
        coded = [np.frombuffer(u.encode("utf-32-le", "surrogatepass"), np.uint32) for u in urls]
        self.sizes = np.array([len(c) + 1 for c in coded], np.int64)
        codes = np.concatenate([x for c in coded for x in (np.array([BEGIN], np.uint32), c, np.array([END], np.uint32))] or [np.zeros(0, np.uint32)])
        starts = np.cumsum(self.sizes + 1) - self.sizes - 1
        self.url = np.repeat(np.arange(len(urls)), self.sizes)
        #: Where each character to be told is, and how many characters come before it.
        self.depth = np.arange(len(self.url)) - np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes) + 1
        self.at = starts[self.url] + self.depth
        self.value, self.order = mixed(codes.astype(np.uint64) + _STEP), order

    def keys(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(order, rows, gram keys, context keys) by rising order: of characters that have so many before them."""
        rows, sums, before = np.arange(len(self.at)), np.zeros(len(self.value), np.uint64), None
        for k in range(self.order + 1):
            rows = rows[self.depth[rows] >= k]
            if not len(rows):
                return
            weight = np.uint64(pow(int(_STEP), k, 1 << 64))
            sums = sums + np.concatenate([np.zeros(k, np.uint64), self.value[: len(self.value) - k]]) * weight
            keys = mixed(sums + np.uint64(k + 1)).view(np.int64)
            at = self.at[rows]
            yield k, rows, keys[at], np.full(len(rows), _EMPTY) if before is None else before[at - 1]
            before = keys


def _slices(texts: list[str]) -> Iterator[slice]:
    """Texts in slices of about ``CHARS_AT_ONCE`` characters; a longer text is alone."""
    begin, size = 0, 0
    for k, text in enumerate(texts):
        if size and size + len(text) > CHARS_AT_ONCE:
            yield slice(begin, k)
            begin, size = k, 0
        size += len(text) + 2
    if begin < len(texts):
        yield slice(begin, len(texts))


def gram_counts(labelled: DataFrame, order: int = ORDER) -> DataFrame:
    """(kind, part, k, context, gram, n) of labelled URLs (shown, kind, part)."""
    fields = ["kind", "part", "k", "context", "gram", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = batch.column("kind").to_numpy() * 2 + batch.column("part").to_numpy()
            texts = batch.column("shown").to_pylist()
            for s in _slices(texts):
                grams = Grams(texts[s], order)
                own = kinds[s][grams.url]
                for k, rows, gram, context in grams.keys():
                    by = np.lexsort((gram, own[rows]))
                    which, gram, context = own[rows][by], gram[by], context[by]
                    first = np.flatnonzero(np.concatenate([[True], (gram[1:] != gram[:-1]) | (which[1:] != which[:-1])]))
                    n = np.diff(np.append(first, len(gram)))
                    columns = which[first] // 2, which[first] % 2, np.full(len(first), k), context[first], gram[first], n
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], fields)

    counted = labelled.select("shown", F.col("kind").cast("int").alias("kind"), F.col("part").cast("int").alias("part"))
    counted = counted.mapInArrow(lean(run, 4096), "kind int, part int, k int, context long, gram long, n long")
    return counted.groupBy("kind", "part", "k", "context", "gram").agg(F.sum("n").alias("n"))


class Model:
    """One class's model: sorted keys of grams with their counts, and of contexts with their kept counts and weights of the shorter context."""

    def __init__(self, gram: np.ndarray, context: np.ndarray, n: np.ndarray, total: np.ndarray, kinds: np.ndarray) -> None:
        """Of each kept gram its key, its context's key, its count, and of its context all counts and the number of different characters."""
        order = np.argsort(gram)
        self.grams, self.n = gram[order], n[order].astype(np.float64)
        self.contexts, first, place = np.unique(context, return_index=True, return_inverse=True)
        self.kept = np.bincount(place, n, len(self.contexts))
        self.back = kinds[first] + total[first] - self.kept

    @staticmethod
    def _look(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
        return at, keys[at] == wanted if len(keys) else np.zeros(len(wanted), bool)

    def log_likelihoods(self, grams: Grams) -> np.ndarray:
        """Of each URL, in natural logarithms."""
        p = np.full(len(grams.at), 1 / ALPHABET)
        for _, rows, gram, context in grams.keys():
            c, known = self._look(self.contexts, context)
            rows, gram, c = rows[known], gram[known], c[known]
            g, seen = self._look(self.grams, gram)
            n = np.zeros(len(rows))
            n[seen] = self.n[g[seen]]
            p[rows] = (n + self.back[c] * p[rows]) / (self.kept[c] + self.back[c])
        return np.bincount(grams.url, np.log(p), len(grams.sizes))


def models(counts: DataFrame) -> dict[tuple[int, int], Model]:
    """Models by (left-out part, kind): kind 1 is of rejected URLs; part 2 leaves none out.  ``counts`` is read twice.

    Collected are the grams that each make up one in ``SHARE`` of a model's characters, so at most
    ``SHARE`` for each order and model.
    """
    without = F.explode(F.array(F.lit(2), 1 - F.col("part")))
    every = counts.select("kind", "k", "context", "gram", "n", without.alias("without")).groupBy("without", "kind", "k", "context", "gram").agg(F.sum("n").alias("n"))
    contexts = every.groupBy("without", "kind", "k", "context").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
    sizes = counts.where("k = 0").groupBy("kind", "part").agg(F.sum("n").alias("n")).collect()
    of = {(w, kind): sum(r["n"] for r in sizes if r["kind"] == kind and r["part"] != w) for w in range(3) for kind in range(2)}
    least = F.create_map(*(F.lit(x) for (w, kind), n in of.items() for x in (w * 2 + kind, -(-n // SHARE))))
    kept = every.where(F.col("n") >= least[F.col("without") * 2 + F.col("kind")])
    rows = kept.join(contexts, ["without", "kind", "k", "context"]).select("without", "kind", "gram", "context", "n", "total", "kinds").toArrow()
    column = {c: rows.column(c).to_numpy() for c in rows.column_names}
    out = {}
    for key in of:
        own = (column["without"] == key[0]) & (column["kind"] == key[1])
        out[key] = Model(*(column[c][own] for c in ("gram", "context", "n", "total", "kinds")))
    return out


def ratio(texts: list[str], accepted: Model, rejected: Model) -> np.ndarray:
    """log p(accepted) - log p(rejected) for each character of each URL, its end included."""
    out = [np.zeros(0)]
    for s in _slices(texts):
        grams = Grams(texts[s])
        out.append((accepted.log_likelihoods(grams) - rejected.log_likelihoods(grams)) / grams.sizes)
    return np.concatenate(out)


def logistic(scores: np.ndarray, rejected: np.ndarray, weights: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """(a, b) of P(rejected) = 1 / (1 + exp(b score - a)) by Newton's method with a small ridge; b is never below 0."""
    x, beta = np.stack([np.ones(len(scores)), -scores], 1), np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -500, 500)))
        slope = x.T @ (weights * (rejected - p)) - 1e-3 * beta
        step = np.linalg.solve(x.T @ (x * (weights * p * (1 - p))[:, None]) + 1e-3 * np.eye(2), slope)
        beta = beta + step * min(1.0, 4 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return (float(beta[0]), float(beta[1])) if beta[1] > 0 else (0.0, 0.0)


@dataclass
class Filter:
    """Two models and the curve of their ratio; without models all is allowed."""

    accepted: Model | None = None
    rejected: Model | None = None
    offset: float = 0.0
    slope: float = 0.0

    def judged(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ratios, and probabilities of rejection (0 where there is nothing to judge by)."""
        if self.accepted is None or self.rejected is None:
            return np.zeros(len(texts)), np.zeros(len(texts))
        ratios = ratio(texts, self.accepted, self.rejected)
        p = 1 / (1 + np.exp(np.clip(self.slope * ratios - self.offset, -500, 500)))
        return ratios, np.where([bool(t) for t in texts], p, 0.0)


def fitted(labelled: DataFrame) -> Filter:
    """The filter of labelled URLs: ``shown``, ``host``, ``rejected`` (boolean); a URL with both labels counts for both."""
    spark = labelled.sparkSession
    rows = labelled.where("shown <> '' and rejected is not null").select("shown", F.col("rejected").cast("int").alias("kind"), F.pmod(F.xxhash64("host"), F.lit(2)).cast("int").alias("part"))
    rows = stored(rows.distinct(), "labelled-urls")
    if {r["kind"] for r in rows.select("kind").distinct().collect()} != {0, 1}:
        return Filter()
    found = models(stored(gram_counts(rows), "gram-counts"))
    shared = spark.sparkContext.broadcast(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = batch.column("part").to_numpy()
            texts, score = batch.column("shown").to_pylist(), np.zeros(batch.num_rows)
            for p in np.unique(part).tolist():
                own = np.flatnonzero(part == p)
                score[own] = ratio([texts[k] for k in own.tolist()], shared.value[p, 0], shared.value[p, 1])
            place = np.rint(np.clip(score, -WIDEST, WIDEST) * BINS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("kind"), pa.array(place)], ["kind", "place"])

    bins = rows.select("shown", "kind", "part").mapInArrow(lean(run, 4096), "kind int, place int").groupBy("kind", "place").agg(F.count("*").alias("n")).orderBy("kind", "place").toArrow()
    kind, place, n = (bins.column(c).to_numpy() for c in ("kind", "place", "n"))
    weights = np.where(kind == 1, n / n[kind == 1].sum(), n / n[kind == 0].sum()) * len(n)
    return Filter(found[2, 0], found[2, 1], *logistic(place / BINS, kind.astype(float), weights))


def judge(pages: DataFrame, rules: list[Rule], reject_from: float = REJECT_FROM) -> DataFrame:
    """(page_id, host, path, rule, verdict, ratio, p_reject) of every row of ``pages`` (page_id, url).

    The models learn from the URLs that the rules decide; ``ratio`` and ``p_reject`` are null for these.
    """
    parts = ruled(with_parts(pages.select("page_id", "url")), rules)
    learnt = parts.where("ruling is not null").select("shown", "host", (F.col("ruling") == "block").alias("rejected"))
    shared = pages.sparkSession.sparkContext.broadcast(fitted(learnt))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            verdict = batch.column("ruling").to_pylist()
            open_ = [k for k, v in enumerate(verdict) if v is None]
            texts = batch.column("shown").to_pylist()
            ratios: list[float | None] = [None] * batch.num_rows
            chances: list[float | None] = [None] * batch.num_rows
            for k, r, p in zip(open_, *(x.tolist() for x in shared.value.judged([texts[k] for k in open_])), strict=True):
                ratios[k], chances[k], verdict[k] = r, p, "block" if p >= reject_from else "allow"
            columns = [*map(batch.column, ("page_id", "host", "path", "rule")), pa.array(verdict, pa.string()), pa.array(ratios, pa.float64()), pa.array(chances, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "host", "path", "rule", "verdict", "ratio", "p_reject"])

    rows = parts.select(F.col("page_id").cast("long").alias("page_id"), "host", "path", "rule", "ruling", "shown")
    return rows.mapInArrow(lean(run, 4096), "page_id long, host string, path string, rule string, verdict string, ratio double, p_reject double")
