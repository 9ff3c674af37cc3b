"""Periodic runs of words, exactly: a harmonic grid, and common extensions by prefix hashes.

A run is a stretch of consecutive words with smallest period q, at least ``MIN_WORDS`` words and ``MIN_REPEATS``
periods long, which no neighbouring word extends.  Of such a run at least g = max((MIN_REPEATS - 1) q,
MIN_WORDS - q) places in a row hold the same word as the place q further on, so one of the places 0, g, 2g, ... of its text does:
the grid of a period, and over all periods a harmonic sum of n log n (period, grid point) pairs.  For all pairs of a
batch at once, those of equal words are extended to both sides: a binary search by NumPy for the longest
common extension, where stretches are compared by polynomial hashes of prefixes.

Hashes never miss what is equal, but may take what is unequal for equal.  So each stretch that is left,
under its smallest period (a stretch found under q is found under its multiples too), is compared word by word; should one
differ, the batch is searched anew by other bases and by numbers of its words instead of their hashes.  A stretch that was
taken for too long under a larger period than one that holds is a multiple of it, so nothing is lost where all hold.

Each text is one task's row: nothing is shuffled.  Pairs are made in chunks, and texts taken in batches, so memory goes
by the words of the longest text, not by its pairs.  Long texts are searched whole.  A null, empty or blank
text has no words and no runs.  A row whose doc_id is null is searched like any other.  Repeated rows get a
row each, an empty table gives an empty result, and further columns, of any name, are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import lean

MIN_WORDS, MIN_REPEATS = 24, 3
#: Words of texts that are searched at once (a longer text is alone), and (period, grid point) pairs of a chunk.
WORDS_AT_ONCE, PAIRS_AT_ONCE = 1 << 16, 1 << 19
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
#: Two hashes by powers of two bases, modulo the largest prime below 2^31, so that products fit in 64 bits.
PRIME, BASES = np.uint64(2**31 - 1), (np.uint64(1_103_515_245), np.uint64(1_664_525_001))
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


class PrefixHashes:
    """Sums of word x base^place up to every place: two equal stretches d places apart differ by the factor base^d."""

    def __init__(self, x: np.ndarray, bases: tuple[np.uint64, ...] = BASES) -> None:
        values = x.view(np.uint64) % PRIME
        self.powers = [self._powers(base, len(x) + 1) for base in bases]
        self.sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * power[:-1] % PRIME)]) for power in self.powers]

    @staticmethod
    def _powers(base: np.uint64, n: int) -> np.ndarray:
        out, step = np.ones(1, np.uint64), base
        while len(out) < n:
            out, step = np.concatenate([out, out * step % PRIME]), step * step % PRIME
        return out[:n]

    def alike(self, i: np.ndarray, apart: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the hashes of the stretches of a size at i and at i + apart agree."""
        j, same = i + apart, np.ones(len(i), bool)
        for power, total in zip(self.powers, self.sums, strict=True):
            same &= (total[i + size] - total[i]) % PRIME * power[apart] % PRIME == (total[j + size] - total[j]) % PRIME
        return same

    def extension(self, i: np.ndarray, apart: np.ndarray, most: np.ndarray, back: bool = False) -> np.ndarray:
        """How far the places from i on (``back``: before i) agree with those ``apart`` further, at most ``most``: all pairs in one binary search."""
        low, high = np.zeros(len(i), np.int64), most.copy()
        while True:
            todo = np.flatnonzero(low < high)
            if not len(todo):
                return low
            size = (low[todo] + high[todo] + 1) // 2
            same = self.alike(i[todo] - size if back else i[todo], apart[todo], size)
            low[todo[same]] = size[same]
            high[todo[~same]] = size[~same] - 1


def grid(sizes: np.ndarray, min_words: int, repeats: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, period, place) of every grid point of every period that a run can have, in chunks; places count from their text's begin."""
    most = np.where(sizes >= min_words, sizes // repeats, 0)
    text = np.repeat(np.arange(len(sizes)), most)
    period = np.arange(len(text)) - np.repeat(np.cumsum(most) - most, most) + 1
    step = np.maximum((repeats - 1) * period, min_words - period)
    points = -(-(sizes[text] - period) // step)
    ends, at = np.cumsum(points), 0
    while at < len(text):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + PAIRS_AT_ONCE, "right")))
        n = points[at:to]
        row = np.repeat(np.arange(at, to), n)
        k = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        yield text[row], period[row], k * step[row]
        at = to


def smallest(found: np.ndarray) -> np.ndarray:
    """Of rows (start, end, period) those of the smallest period of their stretch, in order."""
    found = found[np.lexsort(found[:, ::-1].T)]
    return found[np.concatenate([[True], (found[1:, :2] != found[:-1, :2]).any(1)])] if len(found) else found


def stretches(x: np.ndarray, sizes: np.ndarray, bases: tuple[np.uint64, ...], min_words: int, repeats: int) -> np.ndarray:
    """(start, end, smallest period) of the texts' runs in the word numbers x of all of them, as the hashes tell."""
    begins = np.concatenate([[0], np.cumsum(sizes)])
    hashes, found = PrefixHashes(x, bases), [np.zeros((0, 3), np.int64)]
    for text, period, place in grid(sizes, min_words, repeats):
        i = begins[text] + place
        equal = x[i] == x[i + period]
        text, period, i = text[equal], period[equal], i[equal]
        ahead = hashes.extension(i, period, begins[text + 1] - i - period)
        behind = hashes.extension(i, period, i - begins[text], back=True)
        long = ahead + behind + period >= np.maximum(min_words, repeats * period)
        found.append(smallest(np.stack([i - behind, i + period + ahead, period], 1)[long]))
    return smallest(np.concatenate(found))


def runs_of(texts: list[list[str]], min_words: int = MIN_WORDS, repeats: int = MIN_REPEATS) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of each text's runs, by start, then period."""
    sizes = np.array([len(t) for t in texts], np.int64)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not len(sizes) or sizes.max() < min_words:
        return out
    words = [w for t in texts for w in t]
    x, bases = np.fromiter(map(hash, words), np.int64, len(words)), BASES
    for seed in count(1):
        found = stretches(x, sizes, bases, min_words, repeats).tolist()
        if all(words[s : e - q] == words[s + q : e] for s, e, q in found):
            break
        numbers: dict[str, int] = {}
        x = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
        bases = tuple(np.random.default_rng(seed).integers(2, int(PRIME), 2, np.uint64))
    begins = np.concatenate([[0], np.cumsum(sizes)])
    text = np.searchsorted(begins, [s for s, _, _ in found], "right") - 1
    for k, (s, e, q) in sorted(zip(text.tolist(), found, strict=True), key=lambda r: (r[1][0], r[1][2])):
        out[k].append((s - int(begins[k]), e - s, q))
    return out


def collapsed(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    """The words without those that repeat: each run keeps its first period, unless another run drops of it."""
    if not runs:
        return " ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return " ".join([words[k] for k in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()])


def find(docs: DataFrame, min_words: int = MIN_WORDS, repeats: int = MIN_REPEATS, edited: Callable[[int | None, int], np.ndarray | None] | None = None) -> DataFrame:
    """(doc_id, n_words, runs, collapsed): every document's runs of (start, length, period), and its words without repeats.

    ``edited``, of a doc_id and a number of words, gives the numbers of the words that the text is taken to have instead, if any.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[tuple[int | None, list[str]]] = []
            size = 0
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                words = WORDS.findall(text.as_py() or "")
                places = edited(doc_id, len(words)) if edited else None
                if places is not None:
                    words = [words[k] for k in places.tolist()]
                if held and size + len(words) > WORDS_AT_ONCE:
                    yield searched(held)
                    held, size = [], 0
                held.append((doc_id, words))
                size += len(words)
            yield searched(held)

    def searched(held: list[tuple[int | None, list[str]]]) -> pa.RecordBatch:
        found = runs_of([words for _, words in held], min_words, repeats)
        rows = [[{"start": s, "length": n, "period": q} for s, n, q in runs] for runs in found]
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        texts = [collapsed(words, runs) for (_, words), runs in zip(held, found, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array([d for d, _ in held], pa.int64()), pa.array([len(w) for _, w in held], pa.int64()), pa.array(rows, kind), pa.array(texts, pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lean(run), f"doc_id long, n_words long, runs {RUNS}, collapsed string")


def strongest(runs: Column) -> Column:
    """The run of the greatest length / period, compared exactly; of equal ones the first."""
    return F.aggregate(runs, F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>"), lambda a, r: F.when(a.isNull() | (r.length * a.period > a.length * r.period), r).otherwise(a))


def digest(found: DataFrame) -> DataFrame:
    """What ``find`` gives as the number of runs, the strongest of them, and SHA-256 of all runs and of the collapsed text."""
    line = F.transform("runs", lambda r: F.concat(r.start.cast("string"), F.lit(","), r.length.cast("string"), F.lit(","), r.period.cast("string"), F.lit("\n")))
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    told = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), strongest(F.col("runs")).alias("best"), sha(F.array_join(line, "")).alias("runs_sha256"), sha(F.col("collapsed")).alias("collapsed_sha256"))
    exponent = F.call_function("div", 1000 * F.col("best.length"), F.col("best.period")).alias("exponent_milli")
    return told.select("doc_id", "n_runs", "best.start", "best.length", "best.period", exponent, "runs_sha256", "collapsed_sha256")


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """The repetition that one document in ten gets, by the CRC-32 of its id: from word a on, p words over and over.  Rows without an id get none."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate([np.arange(a), a + np.arange(n - a) % p])
