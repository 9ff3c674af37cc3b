"""Near-duplicate documents: SimHash anchors find candidates, exact Jaccard similarity of their shingles decides.

Nodes are the distinct texts.  Those that meet at an anchor of ``simhash.SIMILAR`` and differ in at most ``SENT_BITS``
bits of the part of their fingerprints that goes there are candidates.  A task passes on, of the candidates of an anchor, a lightest spanning forest by differing bits: each text with its
nearest one, and whatever else joins them, so a group of n near copies costs n - 1 pairs and not their square.  As a group meets in many
tasks, only the pairs among the ``KEPT`` nearest of one of their texts are kept of all.  Each of these pairs is then
held against the texts' sets of shingles: first each text's nearest pair, then of those that join what is
not joined yet each text's ``NEXT`` nearest, as all anchors together show many pairs of a large group.  Only pairs of at least
``similarity`` are links, and documents go only if links join them to the one that stays.

A candidate that no anchor shows, or that is left out while a lighter pair on its way fails, isn't found so.  Therefore an
exact step follows (``met_by_prefix``): sets of n and m shingles with a similarity t have one of the first n - ceil(t n) + 1 and
m - ceil(t m) + 1 in common, in any order that is the same for all sets.  Texts that share one there, aren't joined yet, and whose sizes and the
shingle's places leave it open, are held against each other too.  So all pairs of the similarity are joined, by a link or by
a chain of links.  Shingles that many texts have come last in the order, as a sample tells; that decides on the work, not on the links.
What two sets have in common begins with one shingle, and all of it lies from there on in both.  So a pair is met only where what is left of both sets
from that shingle on is enough: copies with a ninth of shingles of their own don't meet others of their length.

Sets are much larger than pairs, and a pair needs two of them in one place.  So a set also has a mark of about a bit for each shingle, the
parities of how many of its hashes end alike.  Marks differ in no more bits than sets in shingles: what differs in too many has no
such similarity, and only the pairs that are left are held against each other's sets.  Marks folded to 256 bits are there where texts
meet, and rule out most pairs of short texts before they are passed on.

Shingles are of 5 words (``simhash.WORDS``, A-Z lower-cased), each counting once; a text of fewer words is one shingle, and blank texts are
alike.  Sets hold 64-bit hashes.  Repeated and null ids, repeated rows, long texts and empty tables: as in ``simhash``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperloom.llm import simhash
from paperloom.llm.common import lean, small_side, stored
from paperloom.llm.components import components

SIMILARITY = 0.8
#: Words of a fingerprint that go to the anchors, and of their 128 bits those in which candidates differ at most: texts at 0.8
#: differ in some 20, with a deviation of 4, others in 64.
SENT, SENT_BITS = 2, 36
#: Pairs of each text that are held against their sets after its nearest one.
NEXT = 4
#: Candidates of each text that are kept of what all tasks pass on.
KEPT = 8
#: One text in ``TOLD_BY`` tells frequent shingles: those that ``FREQUENT`` of them have, ``MOST_FREQUENT`` at most.
TOLD_BY, FREQUENT, MOST_FREQUENT = 16, 3, 200_000
#: Words of a mark that are there where texts meet, which the smallest mark has.
SHORT = tuple(f"short{k}" for k in range(4))


def lightest_forest(a: np.ndarray, b: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The places of edges (a, b) of a lightest spanning forest: in rounds each tree takes its lightest edge out (ties: the first)."""
    label, taken = np.arange(max(a.max(initial=-1), b.max(initial=-1)) + 1), []
    order = np.argsort(weight, kind="stable")
    a, b = a[order], b[order]
    left = np.flatnonzero(a != b)
    while len(left):
        x, y = label[a[left]], label[b[left]]
        best = np.full(len(label), len(a))
        np.minimum.at(best, x, left)
        np.minimum.at(best, y, left)
        chosen = np.unique(best[best < len(a)])
        taken.append(chosen)
        nodes, roots = simhash.forest(label[a[chosen]], label[b[chosen]])
        up = np.arange(len(label))
        up[nodes] = roots
        label = up[label]
        left = left[label[a[left]] != label[b[left]]]
    return order[np.concatenate(taken)] if taken else np.zeros(0, int)


def candidates(nodes: DataFrame, cover: simhash.Cover = simhash.SIMILAR, limit: int = SENT_BITS, hot: int = simhash.HOT, sample: int = simhash.SAMPLE) -> DataFrame:
    """(a, b, bits) of numbered texts (number, and the fingerprint's words): of forests of those that meet within the limit, the nearest of each text."""
    sent = (*cover.names[:SENT], "number")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group_of_held, held = None, np.zeros((0, len(sent)), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            anchor, code = (batch.column(c).to_numpy() for c in ("anchor", "code"))
            row = np.stack([batch.column(c).to_numpy() for c in sent], 1)
            part, role = code >> 2, code & 3
            group = np.cumsum(np.concatenate([[False], (anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1])]))
            old = held if group_of_held == (anchor[0], part[0]) else held[:0]
            stay = role < 2
            met, met_group = np.concatenate([old, row[stay]]), np.concatenate([np.zeros(len(old), np.int64), group[stay]])
            low = np.searchsorted(met_group, group, "left")
            count = np.where(role == 1, 0, np.searchsorted(met_group, group, "right") - low)
            some = np.flatnonzero(count > (role == 0))
            yield from pairs(met, row, some, low, count)
            group_of_held, held = (anchor[-1], part[-1]), met[met_group == group[-1]]

    def pairs(met: np.ndarray, row: np.ndarray, some: np.ndarray, low: np.ndarray, count: np.ndarray) -> Iterator[pa.RecordBatch]:
        every = np.concatenate([met[:, -1], row[:, -1]])
        numbers, place = np.unique(every, return_inverse=True)
        ends, begin, found = np.cumsum(count[some]), 0, []
        while begin < len(some):
            base = ends[begin - 1] if begin else 0
            stop = max(begin + 1, int(np.searchsorted(ends, base + simhash.PAIRS, "right")))
            pick = some[begin:stop]
            n = count[pick]
            x = np.repeat(pick, n)
            y = np.repeat(low[pick] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            bits = sum(np.bitwise_count((row[x, k] ^ met[y, k]).view(np.uint64)).astype(np.int16) for k in range(len(sent) - 1))
            near = (bits <= limit) & (row[x, -1] != met[y, -1])
            a, b, bits = place[y[near]], place[len(met) + x[near]], bits[near]
            keep = lightest_forest(a, b, bits)
            found.append((a[keep], b[keep], bits[keep]))
            begin = stop
        if found:
            a, b, bits = map(np.concatenate, zip(*found, strict=True))
            keep = lightest_forest(a, b, bits)
            a, b = np.concatenate([a[keep], b[keep]]), np.concatenate([b[keep], a[keep]])  # either way
            yield pa.RecordBatch.from_arrays([pa.array(numbers[a]), pa.array(numbers[b]), pa.array(np.tile(bits[keep], 2).astype(np.int32))], ["a", "b", "bits"])

    rows = simhash.dealt(nodes, cover, hot, sample, carry=sent)
    by_anchor = rows.repartition(F.col("anchor"), F.shiftright("code", 2)).sortWithinPartitions("anchor", "code")
    met = by_anchor.mapInArrow(lean(run, 1 << 16), "a long, b long, bits int").groupBy("a", "b").agg(F.min("bits").alias("bits"))
    place = F.row_number().over(Window.partitionBy("a").orderBy("bits", "b"))
    nearest = met.withColumn("place", place).where(F.col("place") <= KEPT)
    return nearest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "bits").distinct()


def shingle_hashes(text: str | None, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles; none for a blank one."""
    found = simhash.WORDS.findall(text.translate(simhash.LOWER)) if text else []
    if not found:
        return np.zeros(0, np.int64)
    joined = " ".join(found).encode("utf-8", "surrogatepass")
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    n = max(1, len(found) - size + 1)
    starts = np.concatenate([[0], gaps + 1])[:n].tolist()
    ends = np.concatenate([gaps, [len(joined)]])[-n:].tolist()
    of, view = xxhash.xxh64_intdigest, memoryview(joined)
    return np.unique(np.fromiter([of(view[a:b], simhash.SEED) for a, b in zip(starts, ends, strict=True)], np.uint64, n)).view(np.int64)


def _lists(sets: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int64), *sets])))


def mark(shingles: np.ndarray) -> bytes:
    """The parities of a set's hashes by their last bits, at least one for each of the set's shingles and 256 in all."""
    width = 1 << max(6 + (len(SHORT) - 1).bit_length(), int(len(shingles) - 1).bit_length())
    return np.packbits(np.bincount(shingles & (width - 1), minlength=width) & 1, bitorder="little").tobytes()


def folded(x: bytes) -> np.ndarray:
    """A mark folded to the words of ``SHORT``, as signed longs."""
    return np.bitwise_xor.reduce(np.frombuffer(x, np.int64).reshape(-1, len(SHORT)))


def apart(x: bytes, y: bytes) -> int:
    """In how many bits two marks differ, the longer one folded to the other's length: never more than their sets differ in shingles."""
    a, b = sorted((np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)), key=len)
    return int(np.bitwise_count(a ^ np.bitwise_xor.reduce(b.reshape(-1, len(a)), axis=0)).sum())


def may_be_alike(pairs: DataFrame, marks: DataFrame, similarity: float) -> DataFrame:
    """(a, b) of the pairs whose marks (number, n, mark) leave this similarity open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            off = np.array([apart(x, y) for x, y in zip(batch.column("mark_a").to_pylist(), batch.column("mark_b").to_pylist(), strict=True)], np.int64)
            keep = off <= (1 - similarity) / (1 + similarity) * n + 1e-6
            yield pa.RecordBatch.from_arrays([pa.array(batch.column(c).to_numpy()[keep]) for c in "ab"], ["a", "b"])

    both = pairs.select("a", "b")
    for side in "ab":
        own = marks.select(F.col("number").alias(f"of_{side}"), F.col("n").alias(f"n_{side}"), F.col("mark").alias(f"mark_{side}"))
        both = both.join(own, F.col(side) == F.col(f"of_{side}")).drop(f"of_{side}")
    return both.mapInArrow(lean(run, 4096), "a long, b long")


def shingle_sets(texts: DataFrame, size: int = 5) -> DataFrame:
    """(number, n, mark, shingles) of numbered texts: sorted distinct hashes of their shingles, n of them; none for blank texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_hashes(x.as_py(), size) for x in batch.column("text")]
            n = pa.array([len(x) for x in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("number"), n, pa.array([mark(x) for x in sets], pa.binary()), _lists(sets)], ["number", "n", "mark", "shingles"])

    return texts.select("number", F.col("text").cast("string").alias("text")).mapInArrow(lean(run), "number long, n long, mark binary, shingles array<long>")


def _frequent(texts: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts) of the most frequent shingles of a sample of (key, text), by rising hash."""
    some = texts.where(F.pmod(F.xxhash64("key"), F.lit(TOLD_BY)) == 0).select(F.lit(0).cast("long").alias("number"), "text")
    counts = shingle_sets(some, size).select(F.explode("shingles").alias("shingle")).groupBy("shingle").agg(F.count("*").alias("n"))
    most = counts.where(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "shingle").limit(MOST_FREQUENT).toArrow()
    shingle, n = (most.column(c).to_numpy() for c in ("shingle", "n"))
    order = np.argsort(shingle)
    return shingle[order], n[order]


def met_by_prefix(docs: DataFrame, nodes: DataFrame, roots: DataFrame, size: int = 5, similarity: float = SIMILARITY) -> DataFrame:
    """(a, b) of numbered texts of different ``roots`` that may have this similarity, and with them all that have it.

    ``docs``: doc_id, text.  ``nodes``: number, row_key and ``least`` with the doc_id of one row of the text.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), simhash.row_key().alias("key"))
    shared = docs.sparkSession.sparkContext.broadcast(_frequent(texts, size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, times = shared.value
        for batch in batches:
            sets = [shingle_hashes(x.as_py(), size) for x in batch.column("text")]
            n = np.array([len(x) for x in sets], np.int64)
            first = []
            for x in sets:
                at = np.minimum(np.searchsorted(known, x), max(len(known) - 1, 0))
                often = np.where(known[at] == x, times[at], 0) if len(known) else np.zeros(len(x), np.int64)
                # A blank text has 0 in place of a shingle; a set's rounding never shortens its beginning.
                first.append(x[np.lexsort((x, often))][: len(x) - int(np.ceil(similarity * len(x) - 1e-6)) + 1] if len(x) else np.zeros(1, np.int64))
            marks = [mark(x) for x in sets]
            short = np.array([folded(x) for x in marks], np.int64).reshape(-1, len(SHORT))
            columns = [batch.column("doc_id"), batch.column("key"), pa.array(n), pa.array(marks, pa.binary()), *(pa.array(np.ascontiguousarray(x)) for x in short.T), _lists(first)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "key", "n", "mark", *SHORT, "first"])

    begun = texts.mapInArrow(lean(run), f"doc_id long, key string, n long, mark binary, {', '.join(f'{c} long' for c in SHORT)}, first array<long>")
    own = nodes.select("number", F.col("least.doc_id").alias("of_id"), F.col("row_key").alias("of_key"))
    numbered = begun.join(own, F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("key") == F.col("of_key"))).select("number", "n", "mark", *SHORT, "first")
    numbered = stored(numbered, "begun-sets")
    rooted = numbered.join(small_side(roots.withColumnRenamed("node", "of")), F.col("number") == F.col("of"), "left")
    placed = rooted.select("number", F.coalesce("root", "number").alias("root"), "n", *SHORT, F.posexplode("first").alias("place", "shingle"))
    sent = ("shingle", "root", "number", "n", "place", *SHORT)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, len(sent)), np.int64)
        for batch in batches:
            rows = np.concatenate([held, np.stack([batch.column(c).to_numpy().astype(np.int64) for c in sent], 1)])
            if len(rows):
                whole = int(np.searchsorted(rows[:, 0], rows[-1, 0], "left"))  # the last shingle may go on
                yield from pairs(rows[:whole])
                held = rows[whole:]
        yield from pairs(held)

    def pairs(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        shingle, root, number, n, place, *short = np.ascontiguousarray(rows.T)
        # Sets whose first common shingle is here have no more in common than is left of either from here on, so neither meets larger ones than this.
        most = np.floor((n - place) * (1 + similarity) / similarity + 1e-6).astype(np.int64) - n
        group = np.cumsum(np.concatenate([[True], shingle[1:] != shingle[:-1]])[: len(rows)])

        def near(pick: np.ndarray, low: np.ndarray, high: np.ndarray, other: np.ndarray) -> Iterator[pa.RecordBatch]:
            """Of the rows in pick, each with its rows other[low:high], the pairs that may be alike."""
            some = np.flatnonzero(high > low)
            ends, begin = np.cumsum(high[some] - low[some]), 0
            while begin < len(some):
                stop = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + simhash.PAIRS, "right")))
                at = some[begin:stop]
                count = high[at] - low[at]
                x = np.repeat(pick[at], count)
                y = other[np.repeat(low[at] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())]
                may = (most[x] >= n[y]) & (most[y] >= n[x]) & (np.minimum(n[x], n[y]) >= similarity * np.maximum(n[x], n[y]) - 1e-6) & (root[x] != root[y]) & (number[x] != number[y])
                x, y = x[may], y[may]
                off = sum(np.bitwise_count((k[x] ^ k[y]).view(np.uint64)).astype(np.int16) for k in short)
                may = off <= (1 - similarity) / (1 + similarity) * (n[x] + n[y]) + 1e-6
                if may.any():
                    both = np.unique(np.sort(np.stack([number[x[may]], number[y[may]]], 1), axis=1), axis=0)
                    yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(both[:, k])) for k in (0, 1)], ["a", "b"])
                begin = stop

        # Rows that meet sets of their own size and more meet those of their shingle whose root comes after their own.
        early = np.flatnonzero(most >= n)
        new = np.concatenate([[True], group[early][1:] != group[early][:-1]])[: len(early)]
        other = new | np.concatenate([[True], root[early][1:] != root[early][:-1]])[: len(early)]
        end = lambda begins: np.append(np.flatnonzero(begins), len(early))[np.cumsum(begins)]
        yield from near(early, end(other), end(new), early)
        # The others meet smaller sets alone, which are among the first kind.
        late, by_size = np.flatnonzero(most < n), early[np.lexsort((n[early], group[early]))]
        wide = int(n.max(initial=0)) + 1
        sizes = group[by_size] * wide + n[by_size]
        least = np.ceil(similarity * n[late] - 1e-6).astype(np.int64)
        yield from near(late, np.searchsorted(sizes, group[late] * wide + least), np.searchsorted(sizes, group[late] * wide + most[late], "right"), by_size)

    by_shingle = placed.repartition("shingle").sortWithinPartitions("shingle", "root", "number")
    met = by_shingle.mapInArrow(lean(meet, 1 << 16), "a long, b long").distinct()
    # Rows that are repeated have one mark.
    return may_be_alike(met, numbered.select("number", "n", "mark").dropDuplicates(["number"]), similarity)


def alike(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(a, b) of the pairs whose sets have at least this Jaccard similarity; two empty sets are alike."""
    of = lambda side: sets.select(F.col("number").alias(f"of_{side}"), F.col("shingles").alias(side))
    first = may_be_alike(pairs, sets, similarity).select(F.col("a").alias("pa"), F.col("b").alias("pb")).join(of("x"), F.col("pa") == F.col("of_x"))
    both = first.join(of("y"), F.col("pb") == F.col("of_y"))
    n, m = F.size("x"), F.size("y")
    common = F.size(F.array_intersect("x", "y"))
    # Sets of too different sizes aren't compared.
    close = F.least(n, m) >= similarity * F.greatest(n, m)
    return both.where(((n == 0) & (m == 0)) | (close & (common >= similarity * (n + m - common)) & (common > 0))).select(F.col("pa").alias("a"), F.col("pb").alias("b"))


def _nearest(edges: DataFrame) -> DataFrame:
    """Each node's lightest edge."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("other")), F.struct(F.col("b").alias("node"), F.col("a").alias("other")))).alias("e"), "bits")
    best = ends.groupBy("e.node").agg(F.min_by("e.other", F.struct("bits", "e.other")).alias("other"))
    return best.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()


def _next(edges: DataFrame) -> DataFrame:
    """(a, b) of the edges that are among the ``NEXT`` lightest of one of their ends."""
    ends = edges.select(F.explode(F.array("a", "b")).alias("node"), "a", "b", "bits")
    place = F.row_number().over(Window.partitionBy("node").orderBy("bits", "a", "b"))
    return ends.select("a", "b", place.alias("place")).where(F.col("place") <= NEXT).select("a", "b").distinct()


def _rooted(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """Edges with the roots of their ends, a node of no component being its own."""
    out = edges
    for side in "ab":
        own = roots.select(F.col("node").alias(f"node_{side}"), F.col("root").alias(f"root_{side}"))
        out = out.join(own, F.col(side) == F.col(f"node_{side}"), "left").drop(f"node_{side}").withColumn(f"root_{side}", F.coalesce(f"root_{side}", side))
    return out


def _sets_of(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, cover: simhash.Cover) -> DataFrame:
    """The shingle sets of the texts in pairs; one row of each text is read, which its id and text tell."""
    ends = stored(pairs.select(F.explode(F.array("a", "b")).alias("end")).distinct(), "ends-of-pairs")
    wanted = nodes.join(small_side(ends), nodes["number"] == ends["end"], "left_semi").select("number", F.col("least.doc_id").alias("of_id"), F.col("row_key").alias("of_key"))
    wanted = stored(wanted, "texts-of-pairs")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", simhash.row_key().alias("key"))
    rows = rows.join(small_side(wanted), F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("key") == F.col("of_key"))).select("number", "text")
    return stored(shingle_sets(rows, cover.shingle).dropDuplicates(["number"]), "shingle-sets")


def _joined(roots: DataFrame, more: DataFrame) -> DataFrame:
    """``roots`` (node, root) after further links, of which only the pairs of different roots go through the rounds of components."""
    ends = _rooted(more, roots).where("root_a <> root_b")
    ends = stored(ends.select(F.least("root_a", "root_b").alias("a"), F.greatest("root_a", "root_b").alias("b")).distinct(), "links-of-roots")
    if not ends.head(1):
        return roots
    up = stored(components(ends), "roots-of-roots").select(F.col("node").alias("of"), F.col("root").alias("least"))
    moved = roots.join(small_side(up), F.col("root") == F.col("of"), "left").select("node", F.coalesce("least", "root").alias("root"))
    new = up.join(roots, up["of"] == roots["node"], "left_anti").select(F.col("of").alias("node"), F.col("least").alias("root"))
    return stored(moved.union(new), "roots")


def joined(docs: DataFrame, nodes: DataFrame, cover: simhash.Cover = simhash.SIMILAR, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """(a, b) of numbered texts that are alike, joining all that are, and (node, root) of what they join.

    ``nodes``: number, row_key, the fingerprint's words, and ``least`` with the doc_id of one row of the text.
    """
    edges = stored(candidates(nodes, cover), "candidate-pairs")
    sets = _sets_of(edges, docs, nodes, cover)
    first = stored(alike(_nearest(edges), sets, similarity), "nearest-links")
    roots = stored(components(first), "roots-of-nearest")
    rest = _rooted(edges, roots).where("root_a <> root_b").select("a", "b", "bits")
    rest = _next(rest.join(_nearest(edges), ["a", "b"], "left_anti"))
    more = stored(alike(rest, sets, similarity), "next-links")
    roots = _joined(roots, more)
    # Exactly: whatever else is alike of what isn't joined yet.
    open_ = stored(met_by_prefix(docs, nodes, roots, cover.shingle, similarity), "open-pairs")
    last = stored(alike(open_, _sets_of(open_, docs, nodes, cover), similarity), "open-links")
    return first.union(more).union(last), _joined(roots, last)


def links(docs: DataFrame, nodes: DataFrame, cover: simhash.Cover = simhash.SIMILAR, similarity: float = SIMILARITY) -> DataFrame:
    """The links of ``joined``."""
    return joined(docs, nodes, cover, similarity)[0]


def surplus(docs: DataFrame, cover: simhash.Cover = simhash.SIMILAR, similarity: float = SIMILARITY) -> DataFrame:
    """(gone_id, gone_key, all_go) of rows that aren't the one of their component that stays: all rows of this id and text, or all but one.

    The row of the smallest (doc_id, ``row_key()``) stays, a null id after all others.
    """
    fps = stored(simhash.fingerprints(docs.withColumn("row_key", simhash.row_key()), cover, "row_key"), "fingerprints")
    same = fps.groupBy(*cover.names, "doc_id", "row_key").agg(F.count("*").alias("rows"))
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key")
    texts = same.groupBy(*cover.names, "row_key").agg(F.min(row).alias("least"), F.sum("rows").alias("rows"))
    nodes = stored(texts.withColumn("number", F.monotonically_increasing_id()), "distinct-texts")
    roots = joined(docs, nodes, cover, similarity)[1]
    rooted = nodes.join(small_side(roots), nodes["number"] == roots["node"], "left").select("row_key", "least", "rows", F.coalesce("root", "number").alias("root"), F.col("root").isNotNull().alias("linked"))
    # Texts of one row without links stay as they are.
    told = stored(rooted.where("linked or rows > 1"), "texts-of-groups")
    kept = told.groupBy("root").agg(F.min("least").alias("kept"))
    known = told.join(kept, "root").select(F.col("row_key").alias("key"), "kept")
    rows = fps.groupBy("doc_id", "row_key").agg(F.count("*").alias("rows"))
    judged = rows.join(small_side(known), F.col("row_key") == F.col("key"))
    stays = F.col("doc_id").eqNullSafe(F.col("kept.doc_id")) & (F.col("row_key") == F.col("kept.row_key"))
    return judged.where(~stays | (F.col("rows") > 1)).select(F.col("doc_id").alias("gone_id"), F.col("row_key").alias("gone_key"), (~stays).alias("all_go"))
