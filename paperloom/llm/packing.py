"""Mixture-controlled packing of documents into sequences of at most 1024 tokens.

Each source is a queue of token ids.  Deficit round-robin serves the queues in windows of
``WINDOW`` sequences: a window credits every queue with its share of the target mixture, the queue is
served its whole tokens of credit, and what is left of the credit (its deficit, under one token) is
carried to the next window.  Because the deficit is carried and documents may be cut anywhere, what a
queue has been served before window w is floor(credit before w): a function of w alone.  A task can
therefore place its documents without knowing what other tasks hold, and deficits carry over
partitions as they do over windows.  The served tokens form one stream, cut every 1024 tokens; the
stream's end is cut at powers of two, so that no sequence needs padding.

Targets default to the sources' own shares, which empty all queues together; with other targets, an
emptied queue's share goes to the rest in proportion.

The order in a queue is that of the scan.  The schedule is a table of ``MAX_QUEUES`` queues at most: the
sources that ``targets`` names and the largest ones have a queue each, all further ones share the last.
In that one documents lie in the order of how far they are in their own source, so that it holds its
sources' proportions all along too, to within a document of each; no source is left out or limited.

A null text counts as empty (a document of its end id alone), a null source is a queue of its own,
repeated rows and ids are packed each on its own, very long texts are cut over sequences like any other,
further columns of any name are not read, and an empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator, Mapping
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperloom.llm.common import lean, small_side, stored
from paperloom.llm.tokens import encoder

SEQUENCE = 1024
#: Sequences in a window: the mixture is held over each such run.
WINDOW = 64
MAX_QUEUES = 4096
#: Numbers of a worker's memo of windows, two for each queue of a window.
MEMO_NUMBERS = 1 << 20


class Mixture:
    """The schedule of deficit round-robin over queues of ``sizes`` tokens with integer ``weights``."""

    def __init__(self, sizes: list[int], weights: list[int] | None = None, window: int = WINDOW * SEQUENCE):
        self.sizes, self.weights, self.window = sizes, [max(0, w) for w in (weights or sizes)], window
        self.total = sum(sizes)
        #: Queues without weight are served after the others, by size.
        late = [s if w == 0 else 0 for s, w in zip(sizes, self.weights, strict=True)]
        on = [(Fraction(s, w), s, w) for s, w in zip(sizes, self.weights, strict=True) if w and s]
        self.late, self.early_total = late, sum(s for _, s, _ in on)
        #: Breakpoints: virtual time at which queues run dry, and the tokens served by then.
        self.times, self.served_by, self.rate = [Fraction(0)], [Fraction(0)], [sum(w for _, _, w in on)]
        for t, _, w in sorted(on):
            if t > self.times[-1]:
                self.served_by.append(self.served_by[-1] + self.rate[-1] * (t - self.times[-1]))
                self.times.append(t)
                self.rate.append(self.rate[-1])
            self.rate[-1] -= w
        self.known: dict[int, tuple[list[int], list[int], int]] = {}
        self.last: dict[int, int] = {}  # by queue: the window found last, where the next document often is too

    def _whole(self, w: int) -> list[int]:
        """Whole tokens that each queue has been served before window w."""
        credit = min(w * self.window, self.total)
        early = min(credit, self.early_total)
        k = max(0, min(bisect_right(self.served_by, early) - 1, len(self.times) - 1))
        time = self.times[k] if self.rate[k] == 0 else self.times[k] + (early - self.served_by[k]) / self.rate[k]
        rest = sum(self.late)
        share = Fraction(credit - early, rest) if rest else Fraction(0)
        n, d = time.numerator, time.denominator
        return [min(s, x * n // d) if x else int(s * share) for s, x in zip(self.sizes, self.weights, strict=True)]

    def at(self, w: int) -> tuple[list[int], list[int], int]:
        """Before window w: tokens served of each queue; where each queue's part of the window begins in the stream; the window's beginning."""
        if w not in self.known:
            here, after = self._whole(w), self._whole(w + 1)
            begin = sum(here)
            places = (begin + np.concatenate([[0], np.cumsum(np.subtract(after, here))[:-1]])).tolist() if here else []
            if len(self.known) * (len(self.sizes) + 1) > MEMO_NUMBERS:
                self.known.clear()
            self.known[w] = (here, places, begin)
        return self.known[w]

    def window_of(self, queue: int, token: int) -> int:
        """The window that serves a queue's token."""
        low, high = 0, -(-self.total // self.window)
        near = self.last.get(queue, token * self.total // max(1, self.sizes[queue]) // self.window)
        for guess in (near, near + 1, near - 1):
            if low <= guess < high:
                if self.at(guess)[0][queue] > token:
                    high = guess
                elif self.at(guess + 1)[0][queue] > token:
                    low = high = guess
                else:
                    low = guess + 1
        while high - low > 1:
            mid = (low + high) // 2
            low, high = (mid, high) if self.at(mid)[0][queue] <= token else (low, mid)
        self.last[queue] = low
        return low

    def pieces(self, queue: int, start: int, length: int) -> Iterator[tuple[int, int, int]]:
        """(from, length, place in the stream) of a document that takes [start, start + length) of its queue."""
        done, w = 0, self.window_of(queue, start)
        while done < length:
            here, places, _ = self.at(w)
            until = self.at(w + 1)[0][queue]
            n = min(length - done, until - (start + done))
            if n > 0:
                yield done, n, places[queue] + start + done - here[queue]
                done += n
            w += 1


def cuts(place: int, length: int, total: int) -> Iterator[tuple[int, int, int]]:
    """(length, sequence, offset) of a run of the stream: sequences of 1024, and powers of two at its end."""
    full = total // SEQUENCE
    while length:
        if place < full * SEQUENCE:
            k, offset = divmod(place, SEQUENCE)
            size = SEQUENCE
        else:
            k, begin, left = full, full * SEQUENCE, total - full * SEQUENCE
            size = 1 << (left.bit_length() - 1)
            while place >= begin + size:
                k, begin, left = k + 1, begin + size, left - size
                size = 1 << (left.bit_length() - 1)
            offset = place - begin
        n = min(length, size - offset)
        yield n, k, offset
        place, length = place + n, length - n


def encoded(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Ids of every whole text and its end id, with each source's tokens so far within the scan's task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, so_far, task = encoder(tokenizer), {}, TaskContext.get().partitionId()
        end = end_id.to_bytes(enc.width, "little")
        for batch in batches:
            ids = [enc.ids(x) + end for x in batch.column("text").to_pylist()]
            counts, local = [len(x) // enc.width for x in ids], []
            for source, n in zip(batch.column("source").to_pylist(), counts, strict=True):
                local.append(so_far.get(source, 0))
                so_far[source] = local[-1] + n
            yield pa.RecordBatch.from_arrays([pa.array([task] * batch.num_rows, pa.int64()), batch.column("doc_id"), batch.column("source"), pa.array(counts, pa.int64()), pa.array(local, pa.int64()), pa.array(ids, pa.binary())], ["task", "doc_id", "source", "n", "local", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lean(run), "task long, doc_id long, source string, n long, local long, ids binary")


def tempered(sizes: Mapping[str | None, int], power: float) -> dict[str | None, int]:
    """Targets by size ** power: under 1, small sources get more than their share while they last."""
    top = max(sizes.values(), default=1)
    return {k: max(1, round(1_000_000 * (n / top) ** power)) for k, n in sizes.items()}


def in_shared_order(rest: DataFrame, partitions: int) -> DataFrame:
    """(in_task, of, at_local, base): where each document of the shared queue begins in it.

    ``rest``: task, source, local (its place in the source within the task), base (the source's tokens before the
    task), n, size (the source's tokens).  The order is by how much of its source lies before a document's
    middle; sums go by ranges of that order, over one row for each range.
    """
    mark = (F.col("base") + F.col("local") + F.col("n") / 2) / F.col("size")
    ranged = rest.select("task", "source", "local", "n", mark.alias("mark")).repartitionByRange(partitions, "mark", F.xxhash64("source"), "task", "local")
    ranged = stored(ranged.withColumn("range", F.spark_partition_id()), "packing-ranges")
    sums = ranged.groupBy("range").agg(F.sum("n").alias("tokens"))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(F.col("range").alias("in_range"), F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("first"))
    within = Window.partitionBy("range").orderBy("mark", F.xxhash64("source"), "source", "task", "local").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("before", F.coalesce(F.sum("n").over(within), F.lit(0))).join(F.broadcast(starts), F.col("range") == F.col("in_range"))
    return placed.select(F.col("task").alias("in_task"), F.col("source").alias("of"), F.col("local").alias("at_local"), (F.col("first") + F.col("before")).alias("base"))


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, targets: Mapping[str | None, int] | None = None, power: float | None = None, max_queues: int = MAX_QUEUES) -> DataFrame:
    """Pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source, window.

    ``targets``: integer weights of sources; a source that isn't named is served after those that are.
    ``power`` gives targets instead: each queue's tokens to that power.
    """
    width_of, spark, targets = tokenizer, docs.sparkSession, None if targets is None else dict(targets)
    ids = stored(encoded(docs, tokenizer, end_id), "packing-ids")
    by_task = stored(ids.groupBy("task", "source").agg(F.sum("n").alias("n")), "packing-sums")
    by_source = stored(by_task.groupBy("source").agg(F.sum("n").alias("n")), "packing-sources")
    #: The mixture's table: a bounded number of rows.
    asked = F.col("source").isin([k for k in targets if k is not None]) if targets else F.lit(False)
    if targets and None in targets:
        asked = asked | F.col("source").isNull()
    asked = F.coalesce(asked, F.lit(False))
    largest = by_source.where(~asked).orderBy(F.desc("n"), "source").limit(max(0, max_queues - 1 - len(targets or ())))
    named = sorted(((r["source"], r["n"]) for r in by_source.where(asked).union(largest).collect()), key=lambda x: (-x[1], x[0] is not None, x[0] or ""))
    total = by_source.agg(F.sum("n")).first()[0] or 0
    other = total - sum(n for _, n in named)
    sizes = [n for _, n in named] + ([other] if other else [])
    if power is not None:
        weights = list(tempered(dict(enumerate(sizes)), power).values())
    else:
        weights = None if targets is None else [int(targets.get(source, 0)) for source, _ in named] + ([0] if other else [])
    queues = spark.createDataFrame([(s, k) for k, (s, _) in enumerate(named)], "source string, queue int")
    known = by_task.join(F.broadcast(queues), by_task["source"].eqNullSafe(queues["source"]), "left").select("task", by_task["source"], "n", "queue")
    before = Window.partitionBy("source").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = stored(known.select(F.col("task").alias("in_task"), F.col("source").alias("of"), "queue", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "packing-bases")
    here = (F.col("task") == F.col("in_task")) & F.col("source").eqNullSafe(F.col("of"))
    columns = ("doc_id", "source", "queue", "base", "local", "n", "ids")
    placed = ids.join(small_side(bases.where("queue is not null")), here).select(*columns)
    if other:
        own = bases.where("queue is null").drop("queue")
        rest = ids.drop("ids").join(small_side(own), here).drop("in_task", "of")
        whole = by_source.select(F.col("source").alias("of"), F.col("n").alias("size"))
        order = in_shared_order(rest.join(whole, F.col("source").eqNullSafe(F.col("of"))).drop("of"), max(1, min(2000, -(-other // 10_000_000))))
        at = here & (F.col("local") == F.col("at_local"))
        # ``base`` is the place itself here, so nothing is added to it.
        placed = placed.union(ids.join(order, at).select("doc_id", "source", F.lit(len(named)).alias("queue"), "base", F.lit(0).cast("long").alias("local"), "n", "ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixture, dtype = Mixture(sizes, weights), encoder(width_of).dtype
        for batch in batches:
            out: list[list] = [[] for _ in range(9)]
            for row in batch.to_pylist():
                raw = memoryview(np.frombuffer(row["ids"], dtype).astype("<u4").tobytes())
                for start, length, place in mixture.pieces(row["queue"], row["base"] + row["local"], row["n"]):
                    for n, sequence, offset in cuts(place, length, total):
                        for column, x in zip(out, (row["doc_id"], start, n, zlib.crc32(raw[4 * start : 4 * (start + n)]), row["n"], sequence, offset, row["source"], place // mixture.window), strict=True):
                            column.append(x)
                        start, place = start + n, place + n
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source", "window"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if k == "source" else pa.int64()) for k, c in zip(names, out, strict=True)], names)

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string, window long"
    return placed.mapInArrow(lean(run), schema)
