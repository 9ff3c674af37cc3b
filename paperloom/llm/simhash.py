"""SimHash fingerprints and near-duplicates by anchor-point covering.

Anchors are the points of a covering code: a product of perfect codes on blocks of a fingerprint's bits,
other bits left free.  In a perfect code of radius R every word is within R of just one point, so a
fingerprint has one home, the anchor within the radius in each block.  Two fingerprints that differ in t1,
t2, ... bits of the blocks, T in all at most, are both within R1 + t1, R2 + t2, ... of either's home, so each
fingerprint is replicated to every anchor within covering radius plus threshold and compared there
with those at home.  Both would meet twice, at either's home; a visit is made only to anchors
above the visitor's own home, which leaves one meeting and halves the replicas.

``CONTRACT`` finds all links of up to 3 of 64 bits: two binary Golay codes (23 bits, radius 3), 2^24 homes, 162
replicas a fingerprint; beyond ``LARGE`` distinct fingerprints a Hamming code (15 bits, radius 1) of 15 of
the free bits comes in, for 2^35 homes and 530 replicas.  Both find every link.

``SIMILAR`` is for texts that share at least 0.8 of their five-word shingles.  Their SimHashes differ in some 15
of 100 bits, where no covering code of useful size holds all pairs; there the fingerprint has 256 bits, and
``VIEWS`` anchor tables, each on 46 of them, are covered with a threshold of one bit more.  What meets there within
``SIMILAR_BITS`` are candidates, which ``similar`` decides on by their shingles.

Only distinct fingerprints are replicated, so copies cost nothing; a task emits a spanning forest of the
links it finds, not all pairs.  An anchor with many fingerprints is dealt to several tasks, its homes in
chunks and its visitors by salt, each pair of a chunk and a salt in one of them.

Words are runs of anything but space and U+0009 to U+000D, with A-Z lower-cased.  A text of fewer words than
a shingle has is one shingle; a null, empty or blank text has fingerprint 0 and is linked like any other.  Very
long texts are hashed whole.  Repeated rows and ids get a row each.  A null doc_id has a fingerprint and a
component, which is named by the smallest id that isn't null (null if there is none).  An empty table
gives an empty result.  Only doc_id and text are read, so further columns of any name don't matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import combinations, product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import lean, small_side, stored
from paperloom.llm.components import components

SEED = 42
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}
#: Pairs compared at once.
PAIRS = 1 << 20
#: Rows of one kind that an anchor may have before it is dealt to more tasks; the share of fingerprints it is told by.
HOT, SAMPLE = 1 << 15, 16
#: Distinct fingerprints beyond which ``CONTRACT`` takes the finer code.
LARGE = 1 << 30
HASHES_AT_ONCE = 255 * 256


@dataclass(frozen=True)
class Code:
    """A perfect cyclic code: its length, generator polynomial and covering radius."""

    length: int
    generator: int
    radius: int

    def syndromes(self, x: np.ndarray) -> np.ndarray:
        """Remainders of words by the generator."""
        x, degree = x.copy(), self.generator.bit_length() - 1
        for k in range(self.length - 1, degree - 1, -1):
            x = np.where(x >> k & 1, x ^ (self.generator << (k - degree)), x)
        return x

    @cache  # noqa: B019
    def patterns(self, excess: int) -> tuple[np.ndarray, np.ndarray]:
        """Error patterns of up to radius + excess bits, in order of syndrome and excess over the radius; where each such run begins."""
        words = np.array([sum(1 << i for i in c) for n in range(self.radius + excess + 1) for c in combinations(range(self.length), n)], np.int64)
        over = np.maximum(0, np.bitwise_count(words).astype(np.int64) - self.radius)
        run = self.syndromes(words) * (excess + 1) + over
        order = np.argsort(run, kind="stable")
        runs = (1 << (self.generator.bit_length() - 1)) * (excess + 1)
        return words[order], np.searchsorted(run[order], np.arange(runs + 1))


#: The generators x^11+x^10+x^6+x^5+x^4+x^2+1 of the binary Golay code and x^4+x+1 of the Hamming code.
GOLAY, HAMMING = Code(23, 0b110001110101, 3), Code(15, 0b10011, 1)


@dataclass(frozen=True)
class Cover:
    """How fingerprints are made and compared.

    ``words``: 64-bit words of a fingerprint.  ``views``: for each table of anchors the bits that its codes
    take, one after the other.  ``reach``: bits beyond the covering radius that a replica goes; ``limit``: differing
    bits up to which two fingerprints are linked.
    """

    shingle: int
    words: int
    codes: tuple[Code, ...]
    views: tuple[tuple[int, ...], ...]
    reach: int
    limit: int

    @property
    def names(self) -> list[str]:
        return ["fp"] if self.words == 1 else [f"fp{k}" for k in range(self.words)]


VIEWS, SIMILAR_BITS = 44, 44
CONTRACT = Cover(3, 1, (GOLAY, GOLAY), (tuple(range(46)),), 3, 3)
FINER = Cover(3, 1, (GOLAY, GOLAY, HAMMING), (tuple(range(61)),), 3, 3)
_draw = np.random.default_rng(SEED)
SIMILAR = Cover(5, 4, (GOLAY, GOLAY), tuple(tuple(_draw.permutation(256)[:46].tolist()) for _ in range(VIEWS)), 1, SIMILAR_BITS)


def mixed(h: np.ndarray, k: int) -> np.ndarray:
    """Further hashes out of 64-bit hashes (the finaliser of SplitMix64, whose constants are fixed values)."""
    z = h + np.uint64(k * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    z = (z ^ z >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ z >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return z ^ z >> np.uint64(31)


def bit_counts(h: np.ndarray) -> np.ndarray:
    """How many of the hashes (words, n) have each bit set, as (words, 64): byte lanes of up to 255 sums."""
    width = min(255, h.shape[1])
    h = np.pad(h, ((0, 0), (0, -h.shape[1] % width))).reshape(len(h), 1, -1, width)
    lanes = (h >> np.arange(8, dtype=np.uint64)[:, None, None] & np.uint64(0x0101010101010101)).sum(-1)
    by_lane = np.ascontiguousarray(lanes).view(np.uint8).reshape(len(h), 8, -1, 8).sum(2, dtype=np.int64)
    return by_lane.transpose(0, 2, 1).reshape(len(h), 64)


def fingerprint(text: str | None, size: int = 3, words: int = 1) -> list[int]:
    """The words of a whole text's fingerprint: a bit is 1 if set in over half the shingles' hashes (XXH64; from it, those of further words)."""
    found = WORDS.findall(text.translate(LOWER)) if text else []
    if not found:
        return [0] * words
    joined = " ".join(found).encode("utf-8", "surrogatepass")
    if len(found) <= size:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    else:
        gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
        starts = np.concatenate([[0], gaps + 1])[: len(found) - size + 1].tolist()
        ends = np.concatenate([gaps, [len(joined)]])[size - 1 :].tolist()
        of, view = xxhash.xxh64_intdigest, memoryview(joined)
        hashes = np.fromiter([of(view[a:b], SEED) for a, b in zip(starts, ends, strict=True)], np.uint64, len(starts))
    counts = np.zeros((words, 64), np.int64)
    for at in range(0, len(hashes), HASHES_AT_ONCE):
        part = hashes[at : at + HASHES_AT_ONCE]
        counts += bit_counts(np.stack([part, *(mixed(part, k) for k in range(1, words))]))
    return np.packbits(2 * counts > len(hashes), axis=1, bitorder="little").view(np.uint64)[:, 0].tolist()


def fingerprints(docs: DataFrame, cover: Cover = CONTRACT, carry: str | None = None) -> DataFrame:
    """doc_id and the fingerprint's words as signed longs; with ``carry`` also that string column as it is."""
    more = [carry] if carry else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(x, cover.shingle, cover.words) for x in batch.column("text").to_pylist()], np.uint64).reshape(-1, cover.words).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(fps[:, k]) for k in range(cover.words)), *map(batch.column, more)], ["doc_id", *cover.names, *more])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more)
    return rows.mapInArrow(lean(run), ", ".join(["doc_id long", *(f"{c} long" for c in cover.names), *(f"{c} string" for c in more)]))


def anchors(fps: np.ndarray, cover: Cover, view: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, excess): every anchor within covering radius plus reach of each fingerprint (rows of words); the home has excess 0."""
    bits = np.unpackbits(np.ascontiguousarray(fps).view(np.uint8).reshape(len(fps), -1), axis=1, bitorder="little")
    blocks, at = [], 0
    for code in cover.codes:
        value = bits[:, list(cover.views[view][at : at + code.length])].astype(np.int64) @ (1 << np.arange(code.length, dtype=np.int64))
        words, runs = code.patterns(cover.reach)
        blocks.append((code, value, words, runs, code.syndromes(value) * (cover.reach + 1)))
        at += code.length
    rows, keys, excess = [], [], []
    for over in product(range(cover.reach + 1), repeat=len(blocks)):
        if sum(over) > cover.reach:
            continue
        starts = [runs[s + e] for (_, _, _, runs, s), e in zip(blocks, over, strict=True)]
        counts = [runs[s + e + 1] - x for (_, _, _, runs, s), e, x in zip(blocks, over, starts, strict=True)]
        total = np.prod(counts, axis=0)
        row = np.repeat(np.arange(len(fps)), total)
        within = np.arange(len(row)) - np.repeat(np.cumsum(total) - total, total)
        key = np.full(len(row), view, np.int64)
        for (code, value, words, _, _), start, count in zip(blocks, starts, counts, strict=True):
            within, i = np.divmod(within, count[row])
            key = key << code.length | (value[row] ^ words[start[row] + i])
        rows.append(row)
        keys.append(key)
        excess.append(np.full(len(row), sum(over)))
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(excess)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node) that join the same nodes as the edges (a, b) of small whole numbers do."""
    label = np.arange(max(a.max(initial=-1), b.max(initial=-1)) + 1)
    while True:
        x, y = label[a], label[b]
        open_ = x != y
        if not open_.any():
            break
        x, y = x[open_], y[open_]
        least = np.minimum(x, y)
        np.minimum.at(label, x, least)
        np.minimum.at(label, y, least)
        while ((up := label[label]) != label).any():
            label = up
    nodes = np.flatnonzero(label != np.arange(len(label)))
    return nodes, label[nodes]


def replicas(distinct: DataFrame, cover: Cover, carry: tuple[str, ...] = ()) -> DataFrame:
    """(anchor, code, fingerprint) of distinct fingerprints: each at its home (code 0), and visiting the anchors above it (2).

    ``carry`` names longs that go there in place of the whole fingerprint.
    """
    sent_names = list(carry or cover.names)
    columns = list(dict.fromkeys([*cover.names, *sent_names]))
    sent_places = [columns.index(c) for c in sent_names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = np.stack([batch.column(c).to_numpy() for c in columns], 1)
            for at in range(0, len(given), 512):
                rows = given[at : at + 512]
                fps = rows[:, : cover.words]
                for view in range(len(cover.views)):
                    row, key, excess = anchors(fps, cover, view)
                    home = np.zeros(len(fps), np.int64)
                    home[row[excess == 0]] = key[excess == 0]
                    keep = (excess == 0) | (key > home[row])
                    sent = rows[row[keep]][:, sent_places]
                    yield pa.RecordBatch.from_arrays([pa.array(key[keep]), pa.array(np.where(excess[keep] > 0, 2, 0).astype(np.int32)), *(pa.array(np.ascontiguousarray(sent[:, k])) for k in range(len(sent_names)))], ["anchor", "code", *sent_names])

    return distinct.select(*columns).mapInArrow(lean(run, 4096), ", ".join(["anchor long", "code int", *(f"{c} long" for c in sent_names)]))


def dealt(distinct: DataFrame, cover: Cover, hot: int = HOT, sample: int = SAMPLE, carry: tuple[str, ...] = ()) -> DataFrame:
    """``replicas`` with hot anchors dealt to parts: code is 4 * part + role (0: at home, 1: at home and only met, 2: only meets).

    Which anchors are hot is told from the replicas of one in ``sample`` fingerprints, which decides on tasks, not on links.
    """
    rows = replicas(distinct, cover, carry)
    if distinct.limit(hot + 1).count() <= hot:
        return rows  # no anchor has more rows than there are fingerprints
    some = replicas(distinct.where(F.pmod(F.xxhash64(*cover.names, F.lit(1)), F.lit(sample)) == 0), cover)
    homes, visits = F.count_if(F.col("code") == 0) * sample, F.count_if(F.col("code") == 2) * sample
    sizes = some.groupBy("anchor").agg(homes.alias("homes"), visits.alias("visits")).where((F.col("homes") > hot) | (F.col("visits") > hot))
    parts = lambda c: F.ceil(F.greatest(F.col(c), F.lit(1)) / hot).cast("int")
    table = stored(sizes.select(F.col("anchor").alias("hot"), parts("homes").alias("chunks"), parts("visits").alias("salts")), "hot-anchors")
    if not table.head(1):
        return rows
    joined = rows.join(small_side(table), F.col("anchor") == F.col("hot"), "left")
    sent = carry or tuple(cover.names)
    own = lambda seed, n: F.pmod(F.xxhash64(*sent, F.lit(seed)), F.col(n)).cast("int")
    each = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    met = F.when(F.col("code") == 0, F.transform(each("salts"), lambda s: 4 * (own(2, "chunks") * F.col("salts") + s) + 1)).otherwise(F.array().cast("array<int>"))
    meets = F.transform(each("chunks"), lambda c: 4 * (c * F.col("salts") + own(3, "salts")) + 2)
    codes = F.when(F.col("hot").isNull(), F.array("code")).otherwise(F.concat(met, meets))
    return joined.select("anchor", F.explode(codes).alias("code"), *sent)


def links(distinct: DataFrame, cover: Cover = CONTRACT, hot: int = HOT, sample: int = SAMPLE) -> DataFrame:
    """Pairs of fingerprints (a0 .. and b0 .., a word each) that join all those that meet within the limit, as forests by task."""
    names = [f"{side}{k}" for side in "ab" for k in range(cover.words)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_group, held = None, np.zeros((0, cover.words), np.int64)  # the last group's fingerprints to be met
        for batch in batches:
            if not batch.num_rows:
                continue
            anchor, code = (batch.column(c).to_numpy() for c in ("anchor", "code"))
            fp = np.stack([batch.column(c).to_numpy() for c in cover.names], 1)
            part, role = code >> 2, code & 3
            new = np.concatenate([[False], (anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1])])
            group = np.cumsum(new)
            old = held if held_group == (anchor[0], part[0]) else held[:0]
            stay = role < 2
            met, met_group = np.concatenate([old, fp[stay]]), np.concatenate([np.zeros(len(old), np.int64), group[stay]])
            low = np.searchsorted(met_group, group, "left")
            count = np.where(role == 1, 0, np.searchsorted(met_group, group, "right") - low)
            some = np.flatnonzero(count > (role == 0))  # those at home meet more than themselves
            ends = np.cumsum(count[some])
            begin, found = 0, []
            while begin < len(some):
                base = ends[begin - 1] if begin else 0
                stop = max(begin + 1, int(np.searchsorted(ends, base + PAIRS, "right")))
                pick = some[begin:stop]
                n = count[pick]
                x = np.repeat(pick, n)
                y = np.repeat(low[pick] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                off = sum(np.bitwise_count((fp[x, k] ^ met[y, k]).view(np.uint64)).astype(np.int16) for k in range(cover.words))
                near = (off <= cover.limit) & (off > 0)
                if near.any():
                    found.append(forest(y[near], x[near] + len(met)))
                begin = stop
            if found:
                # The smallest fingerprint leads, so that anchors with the same ones give the same edges.
                a, b = map(np.concatenate, zip(*found, strict=True))
                used, place = np.unique(np.concatenate([a, b]), return_inverse=True)
                every = np.concatenate([met, fp])[used]
                order = np.lexsort(every.T[::-1])
                rank = np.empty(len(order), np.int64)
                rank[order] = np.arange(len(order))
                a, b = forest(rank[place[: len(a)]], rank[place[len(a) :]])
                every = every[order]
                sides = np.concatenate([every[a], every[b]], 1)
                sides = sides[(every[a] != every[b]).any(1)]
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(sides[:, k])) for k in range(2 * cover.words)], names)
            held_group = (anchor[-1], part[-1])
            held = met[met_group == group[-1]]

    rows = dealt(distinct, cover, hot, sample)
    by_anchor = rows.repartition(F.col("anchor"), F.shiftright("code", 2)).sortWithinPartitions("anchor", "code")
    return by_anchor.mapInArrow(lean(run, 1 << 16), ", ".join(f"{c} long" for c in names))


def rooted(distinct: DataFrame, cover: Cover = CONTRACT) -> DataFrame:
    """``distinct`` fingerprints with the root of their component: one node that all its links reach."""
    if cover is CONTRACT and distinct.count() > LARGE:
        cover = FINER
    edges = links(distinct, cover)
    if cover.words == 1:
        numbered, edges = distinct.withColumn("number", F.col("fp")), edges.select(F.col("a0").alias("a"), F.col("b0").alias("b"))
    else:
        numbered = stored(distinct.withColumn("number", F.monotonically_increasing_id()), "numbered-fingerprints")
        edges = stored(edges, "similar-fingerprints")
        for side in "ab":
            of = numbered.select(*(F.col(c).alias(f"n{k}") for k, c in enumerate(cover.names)), F.col("number").alias(side))
            same = [F.col(f"{side}{k}") == F.col(f"n{k}") for k in range(cover.words)]
            edges = edges.join(of, same).drop(*(f"n{k}" for k in range(cover.words)))
        edges = edges.select("a", "b")
    roots = components(edges)
    return numbered.join(roots, numbered["number"] == roots["node"], "left").select(*distinct.columns, F.coalesce("root", "number").alias("root"))


def row_key() -> Column:
    """A key of a row's text that any reading of the row gives again; with the doc_id it tells rows of different texts apart."""
    return F.coalesce(F.md5(F.col("text").cast("string")), F.lit(""))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id, n_same): the class of every document by ``CONTRACT``.

    ``component_id`` is the smallest doc_id that links of up to 3 bits reach; ``n_same``
    is how many rows have the very same fingerprint.
    """
    fps = stored(fingerprints(docs), "fingerprints")
    distinct = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n_same")), "distinct-fingerprints")
    linked = rooted(distinct)
    names = linked.groupBy("root").agg(F.min("least").alias("component_id")).withColumnRenamed("root", "of")
    classes = linked.join(names, linked["root"] == names["of"]).select(F.col("fp").alias("key"), "n_same", "component_id")
    named = fps.join(classes, fps["fp"] == classes["key"])
    return named.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "n_same")
