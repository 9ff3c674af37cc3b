"""Overlap of intervals by a plane sweep over ranges of starts (JOI7, JOI8).

Both sides are put in one order, by key and start, and cut into ranges of about equally many rows, whatever the lengths and
however many intervals a key or a time has.  A pair that overlaps is found in the range of the one that starts later; so a range
needs its own intervals, and those of earlier ranges that are still open where it begins.  An interval is carried to as many
ranges as it reaches, and in each of these it meets all intervals of the other side that start there: what is carried is bounded by
the rows and by the pairs that come out.

Within a range rows come in order.  Each meets the open ones of the other side, and those that ended are dropped: work goes by
rows and pairs.  A task holds a range's open intervals, and gives pairs out in batches.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Ranges at most, rows of the sample for each border, and pairs that are given out at once.
RANGES, SAMPLED, PAIRS = 4096, 32, 1 << 15


def _number(df: DataFrame, column: str) -> Column:
    """A start or end as a number that keeps the order."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(F.col(column).cast("timestamp"))
    if isinstance(kind, T.DateType):
        return F.unix_date(column)
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        return F.col(column).cast("double")
    return F.col(column).cast("long")


def _placed(df: DataFrame, side: str, on: Sequence[str]) -> DataFrame:
    """(k, s, h, e, row): the key's hash, the start, a hash that tells rows of one start apart, the end, and the whole row."""
    keys = [f"{side}_{k}" for k in on]
    own = F.xxhash64(*keys) if keys else F.lit(0).cast("long")
    start, end = _number(df, f"{side}_start"), _number(df, f"{side}_end")
    rows = df.select(own.alias("k"), start.alias("s"), F.xxhash64(*df.columns, F.lit(side)).alias("h"), end.alias("e"), F.struct(*df.columns).alias("row"))
    there = F.col("s").isNotNull() & F.col("e").isNotNull() & ~F.isnan(F.col("s").cast("double")) & ~F.isnan(F.col("e").cast("double"))
    for k in keys:
        there = there & F.col(f"row.`{k}`").isNotNull()
    return rows.where(there)


def _borders(placed: DataFrame, rows_a_task: int) -> list[tuple]:
    """The first (k, s, h) of each range but the first, out of a sample by hash: at most ``RANGES``."""
    n = placed.count()
    ranges = min(RANGES, -(-n // rows_a_task))
    if ranges < 2:
        return []
    one_in = max(1, n // (SAMPLED * ranges))
    sample = placed.where(F.pmod(F.xxhash64("h", F.lit(1)), F.lit(one_in)) == 0).select("k", "s", "h")
    found = sorted(tuple(r) for r in sample.collect())
    return sorted({found[i * len(found) // ranges] for i in range(1, ranges)}) if found else []


def overlap(left: DataFrame, right: DataFrame, on: Sequence[str] = (), closed: bool = False, rows_a_task: int = 1 << 16) -> DataFrame:
    """Pairs of rows whose [l_start, l_end) and [r_start, r_end) overlap: l_end > r_start and r_end > l_start; ``closed`` also those that touch.

    ``on`` names keys that must be equal, as columns l_<key> and r_<key>.  Starts and ends are numbers, dates or timestamps, of the
    same kind on both sides; rows where one is null or NaN, or a key is null, overlap nothing.
    """
    sides = {"l": _placed(left, "l", on), "r": _placed(right, "r", on)}
    borders = _borders(sides["l"].select("k", "s", "h").union(sides["r"].select("k", "s", "h")), rows_a_task)
    marks = [b[:2] for b in borders]

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each row's own range, then those that it is open in."""
        for batch in batches:
            lists = []
            for k, s, h, e in zip(*(batch.column(c).to_pylist() for c in ("k", "s", "h", "e")), strict=True):
                home = bisect_right(borders, (k, s, h))
                # The ranges that begin within the interval, and with its key.
                to = (bisect_right if closed else bisect_left)(marks, (k, e))
                lists.append(range(home, max(home + 1, to + 1)))
            rows = np.repeat(np.arange(batch.num_rows), [len(x) for x in lists])
            part = np.fromiter((p for x in lists for p in x), np.int32, len(rows))
            carried = np.concatenate([[False], rows[1:] == rows[:-1]]) if len(rows) else np.zeros(0, bool)
            for at in range(0, len(rows), PAIRS):
                cut = slice(at, at + PAIRS)
                taken = batch.take(pa.array(rows[cut]))
                yield pa.RecordBatch.from_arrays([pa.array(part[cut]), pa.array(~carried[cut]), *taken.columns], ["part", "own", *taken.schema.names])

    def dealt(side: str) -> DataFrame:
        df = sides[side]
        schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("own", T.BooleanType()), *df.schema.fields])
        out = df.mapInArrow(parts, schema)
        return out.select("part", "own", "k", "s", "h", "e", F.lit(side == "l").alias("is_left"), *((F.col("row") if x == side else F.lit(None).cast(sides[x].schema["row"].dataType)).alias(x) for x in "lr"))

    rows = dealt("l").union(dealt("r"))
    schema = T.StructType([*left.schema.fields, *right.schema.fields])
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema])

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is None:
                held = _Open(batch, closed)
            yield from held.met(batch)

    ordered = rows.repartition(max(1, len(borders) + 1), "part").sortWithinPartitions("part", "own", "k", "s", "h", "is_left")
    pairs = ordered.select("part", "own", "k", "s", "e", "is_left", "l", "r").mapInArrow(sweep, schema)
    for k in on:  # keys of one hash may differ
        pairs = pairs.where(F.col(f"l_{k}") == F.col(f"r_{k}"))
    return pairs


class _Open:
    """The open intervals of both sides of a range: rows, starts, ends and keys of the open ones."""

    def __init__(self, batch: pa.RecordBatch, closed: bool) -> None:
        self.closed, self.part = closed, None
        self.rows = {x: batch.column(x).slice(0, 0) for x in "lr"}
        self.open: dict[str, list[tuple]] = {"l": [], "r": []}
        self.known: dict[str, tuple[np.ndarray, ...] | None] = {"l": None, "r": None}

    def _arrays(self, x: str) -> tuple[np.ndarray, ...]:
        """(place, start, end) of a side's open intervals."""
        if self.known[x] is None:
            rows = self.open[x]
            self.known[x] = np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
        return self.known[x]

    def _keep(self, x: str, stay: np.ndarray) -> None:
        if not stay.all():
            self.known[x] = tuple(a[stay] for a in self._arrays(x))
            self.open[x] = [self.open[x][i] for i in np.flatnonzero(stay).tolist()]

    def met(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """Pairs that rows of a batch, in order, make with what is open."""
        is_left = batch.column("is_left").to_numpy(zero_copy_only=False)
        place_of = np.zeros(batch.num_rows, np.int64)
        for x in "lr":
            # Rows that are still open first, then the batch's own.
            places = pa.array([r[0] for r in self.open[x]], pa.int64())
            own = np.flatnonzero(is_left if x == "l" else ~is_left)
            before = len(places)
            self.open[x] = [(i, *r[1:]) for i, r in enumerate(self.open[x])]
            self.known[x] = None
            self.rows[x] = pa.concat_arrays([self.rows[x].take(places), batch.column(x).take(pa.array(own))])
            place_of[own] = before + np.arange(len(own))
        found: list[tuple[np.ndarray, np.ndarray]] = []
        size, key = 0, None
        columns = zip(*(batch.column(c).to_pylist() for c in ("part", "own", "k", "s", "e")), is_left.tolist(), place_of.tolist(), strict=True)
        for part, own, k, s, e, left, place in columns:
            if part != self.part:
                self.part, self.open, self.known = part, {"l": [], "r": []}, {"l": None, "r": None}
            mine, other = ("l", "r") if left else ("r", "l")
            if own:
                if k != key:
                    # Only carried intervals of another key can be open where a key begins, and those of this key stay.
                    for x in "lr":
                        self._keep(x, np.array([r[3] == k for r in self.open[x]], bool))
                    key = k
                where, starts, ends = self._arrays(other)
                if len(where):
                    self._keep(other, ends >= s if self.closed else ends > s)
                    where, starts, ends = self._arrays(other)
                    hit = where[starts <= e if self.closed else starts < e]
                    if len(hit):
                        found.append((hit, np.full(len(hit), place)) if not left else (np.full(len(hit), place), hit))
                        size += len(hit)
            self.open[mine].append((place, s, e, k))
            self.known[mine] = None
            if size >= PAIRS:
                yield from self._out(found)
                found, size = [], 0
        yield from self._out(found)

    def _out(self, found: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        if not found:
            return
        l, r = (np.concatenate(x) for x in zip(*found, strict=True))  # noqa: E741
        for at in range(0, len(l), PAIRS):
            sides = self.rows["l"].take(pa.array(l[at : at + PAIRS])), self.rows["r"].take(pa.array(r[at : at + PAIRS]))
            yield pa.RecordBatch.from_arrays([c for side in sides for c in side.flatten()], [f.name for side in sides for f in side.type])
