"""Exact top-k by inner product: ball trees over shards of near vectors, searched by branch and bound.

A ball's vectors v lie within r of its centre c, so q.v <= q.c + |q| r.  That bound is used twice.  Shards
are the vectors nearest to each of a bounded number of sampled centres, and a shard's ball is a row of a
small table: a query visits shards in the order of their bounds, a few a round, and its kth score so far
goes along to all shards of the next round; shards whose bound lies below it are never sent the query.
Within a shard each part has a ball tree (``BallTree``): a query goes down to its best leaf first, then from the root
down a node is opened for the queries whose kth score its bound reaches, and leaves are visited in each query's own
order of bounds, with the kth score rising after each turn.

Components x become floor(256 * x); scores are integers, exact as long as they are under 2^63.  Ties go
to the smaller id.  A vector that is null, or holds a null or non-finite component, takes no part, nor does a null
id; vectors of another length than the query's don't meet it; empty vectors score 0.  Repeated ids are
candidates each, but a row of the query's own id is never its candidate.  A repeated query id is one
query for each different vector it has: ``query`` tells them apart.  Fewer than k candidates give as many
ranks; an empty table gives none.  Only vec_id and embedding are read, so further columns of any name
don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperloom.llm.common import lean, small_side, stored

#: Vectors of a leaf, of a shard (as long as there are fewer than ``CENTRES`` shards), and of a task's part of a
#: shard; queries of a task, and those searched at once.
LEAF, SHARD, PART, BLOCK, TURN = 128, 32_768, 65_536, 32_768, 1024
#: Rows and numbers of the table of centres.
CENTRES, CENTRE_NUMBERS = 4096, 1 << 22
#: A query's shards by rank of bound that the rounds visit; the last one visits all that are left.
ROUNDS = (0, 1, 4, 16)
EXACT = 2.0**53


def margin(length: np.ndarray | float, reach: np.ndarray | float) -> np.ndarray | float:
    """What rounding may take from a bound of that size."""
    return 1e-6 + 1e-11 * length * reach


class BallTree:
    """A complete binary tree over integer vectors (rows of ``points``) with their ids; each node holds its ball."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, leaf: int = LEAF):
        depth = max(0, int(np.ceil(np.log2(max(1, len(ids)) / leaf))))
        order, levels = np.arange(len(ids)), [[(0, len(ids))]]
        floats = points.astype(np.float64)
        for _ in range(depth):
            below = []
            for low, high in levels[-1]:
                rows = order[low:high]
                here, middle = floats[rows], (low + high) // 2
                # Halves by the side of two far points: the farthest from the centre and the farthest from that.
                one = here[np.argmax(((here - here.mean(0)) ** 2).sum(1))]
                two = here[np.argmax(((here - one) ** 2).sum(1))]
                order[low:high] = rows[np.argsort(here @ (two - one), kind="stable")]
                below += [(low, middle), (middle, high)]
            levels.append(below)
        self.ids, self.points, self.spans = ids[order], points[order], levels[-1]
        floats = floats[order]
        self.balls = []  # by level: centres, radii and the centres' lengths
        for spans in levels:
            centres = np.array([floats[a:b].mean(0) for a, b in spans])
            radii = np.array([np.sqrt(((floats[a:b] - c) ** 2).sum(1).max()) for (a, b), c in zip(spans, centres, strict=True)])
            self.balls.append((centres, radii, np.sqrt((centres**2).sum(1))))
        self.largest = float(np.abs(floats).max(initial=0))

    def search(self, own: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(there, score, id) of each query's k best at or above its ``floor``, best first.

        ``own``: ids that aren't candidates, one for each query.
        """
        n = len(queries)
        floats = queries.astype(np.float64)
        # Sums of products are exact in floats below 2^53; beyond that integers multiply.
        exact = self.largest * float(np.abs(floats).max(initial=0)) * max(1, queries.shape[1]) < EXACT
        asked, points = (floats, self.points.astype(np.float64)) if exact else (queries, self.points)
        length = np.sqrt((floats**2).sum(1))
        there, scores, ids = np.zeros((n, k), bool), np.full((n, k), np.iinfo(np.int64).min), np.full((n, k), np.iinfo(np.int64).max)

        def bounds(depth: int, rows: np.ndarray, nodes: np.ndarray) -> np.ndarray:
            """Of rows of queries by nodes of a level, every pair of them."""
            centres, radii, far = (x[nodes] for x in self.balls[depth])
            return floats[rows] @ centres.T + length[rows, None] * radii + margin(length[rows, None], radii + far)

        def visit(row: np.ndarray, leaf: np.ndarray) -> None:
            """Scores the vectors of leaves, each for its query."""
            by = np.argsort(leaf, kind="stable")
            row, leaf = row[by], leaf[by]
            cuts = [0, *(np.flatnonzero(np.diff(leaf)) + 1).tolist(), len(leaf)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                low, high = self.spans[leaf[a]]
                rows, leaf_ids = row[a:b], self.ids[low:high]
                got = (asked[rows] @ points[low:high].T).astype(np.int64)
                new = leaf_ids[None, :] != own[rows, None]
                all_there, all_scores = np.concatenate([there[rows], new], 1), np.concatenate([scores[rows], got], 1)
                all_ids = np.concatenate([ids[rows], np.broadcast_to(leaf_ids, got.shape)], 1)
                first = np.lexsort((all_ids, ~all_scores, ~all_there), axis=1)[:, :k]  # ~x: larger first
                there[rows], scores[rows], ids[rows] = (np.take_along_axis(x, first, 1) for x in (all_there, all_scores, all_ids))

        def need() -> np.ndarray:
            """What a bound must reach: the query's floor, and its kth score once it has k."""
            return np.maximum(floor, np.where(there[:, -1], scores[:, -1].astype(np.float64), -np.inf))

        # Each query first goes down to its leaf of the best bounds, so that its kth score closes inner nodes from the root on.
        every, home = np.arange(n), np.zeros(n, np.int64)
        for depth in range(1, len(self.balls)):
            centres, radii, far = self.balls[depth]
            pair = 2 * home[:, None] + np.arange(2)
            two = np.einsum("ij,ikj->ik", floats, centres[pair]) + length[:, None] * radii[pair] + margin(length[:, None], radii[pair] + far[pair])
            home = pair[every, np.argmax(two, axis=1)]
        visit(every, home)
        opened, self.opened = np.ones((n, 1), bool), 0
        for depth in range(len(self.balls)):
            if depth:
                opened = np.repeat(opened, 2, 1)
            rows, nodes = np.flatnonzero(opened.any(1)), np.flatnonzero(opened.any(0))
            bound = np.full(opened.shape, -np.inf)
            bound[np.ix_(rows, nodes)] = bounds(depth, rows, nodes)
            opened &= bound >= need()[:, None]
            self.opened += int(opened.sum())
        opened[every, home] = False  # it has been there
        bound[~opened] = -np.inf
        turns, step, at = np.argsort(-bound, axis=1, kind="stable"), 1, 0
        while at < turns.shape[1]:
            now = turns[:, at : at + step]
            reach = np.take_along_axis(bound, now, 1)
            wanted = (reach >= need()[:, None]) & np.isfinite(reach)
            if not wanted.any():
                break
            row, column = np.nonzero(wanted)
            visit(row, now[row, column])
            at, step = at + step, 2 * step
        there &= scores >= floor[:, None]
        return there, scores, ids


FOUND = "query long, query_id long, vec_id long, score long"


def _search(k: int):
    """For a part of a shard and the queries sent to it: each query's candidates."""

    def run(rows: pa.Table) -> pa.Table:
        asks = rows["asks"].to_numpy()
        names = ["query", "query_id", "vec_id", "score"]
        if asks.all() or not asks.any():
            return pa.table({x: pa.array([], pa.int64()) for x in names})
        vectors = np.stack(rows["v"].to_numpy(zero_copy_only=False)).astype(np.int64).reshape(len(asks), -1)
        ids, query, floor = (rows[c].to_numpy() for c in ("vec_id", "query", "floor"))
        tree = BallTree(ids[~asks], vectors[~asks])
        out: list[list[np.ndarray]] = [[], [], [], []]
        at_all = np.flatnonzero(asks)
        for at in range(0, len(at_all), TURN):
            part = at_all[at : at + TURN]
            there, scores, found = tree.search(ids[part], vectors[part], floor[part], k)
            who = np.repeat(part, k).reshape(-1, k)[there]
            for column, x in zip(out, (query[who], ids[who], found[there], scores[there]), strict=True):
                column.append(x)
        return pa.table({x: pa.array(np.concatenate(c), pa.int64()) for x, c in zip(names, out, strict=True)})

    return run


def quantised(vectors: DataFrame) -> DataFrame:
    """(vec_id, v array<long>, length) of the vectors that take part."""
    good = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).where(good)
    return rows.select("vec_id", F.transform("embedding", lambda x: F.floor(x * 256)).alias("v"), F.size("embedding").alias("length"))


def centres_of(rows: DataFrame, length: int, n: int) -> np.ndarray:
    """At most ``n`` different vectors of a length, by a hash of their ids."""
    if not length:
        return np.zeros((0, 0))
    got = rows.where(F.col("length") == length).orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(2 * n).select("v").collect()
    return np.array(list(dict.fromkeys(tuple(r["v"]) for r in got))[:n], float).reshape(-1, length)


def sharded(rows: DataFrame, length: int, centres: np.ndarray) -> DataFrame:
    """``rows`` with their shard, the nearest centre, and the distance from it; vectors of other lengths are shard -1 of theirs."""
    squares = (centres**2).sum(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard, off = np.full(batch.num_rows, -1, np.int32), np.zeros(batch.num_rows)
            same = np.flatnonzero(batch.column("length").to_numpy() == length)
            if len(same) and length:
                v = batch.column("v").take(pa.array(same)).flatten().to_numpy().reshape(-1, length).astype(float)
                for at in range(0, len(v), TURN):
                    part = v[at : at + TURN]
                    near = np.argmin(squares - 2 * part @ centres.T, axis=1)
                    shard[same[at : at + TURN]] = near
                    off[same[at : at + TURN]] = np.sqrt(((part - centres[near]) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shard), pa.array(off)], [*batch.schema.names, "shard", "off"])

    return rows.mapInArrow(lean(run, 4096), "vec_id long, v array<long>, length int, shard int, off double")


def visits(asked: DataFrame, length: int, centres: np.ndarray, radii: np.ndarray, low: int, high: int | None) -> DataFrame:
    """(to, query, vec_id, v, length, floor): each query with the shards of ranks [low, high) by bound that its floor leaves."""
    far = np.sqrt((centres**2).sum(1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, TURN):
                batch = whole.slice(start, TURN)
                floor, size = batch.column("floor").to_numpy(), batch.column("length").to_numpy()
                same = np.flatnonzero((size == length) & (length > 0))
                rows, to = [], []
                if low == 0:  # other lengths have one shard each
                    rows, to = [np.flatnonzero((size != length) | (length == 0))], [np.full(int(((size != length) | (length == 0)).sum()), -1)]
                if len(same) and len(centres):
                    v = batch.column("v").take(pa.array(same)).flatten().to_numpy().reshape(-1, length).astype(float)
                    norm = np.sqrt((v**2).sum(1))[:, None]
                    bound = v @ centres.T + norm * radii + margin(norm, radii + far)
                    order = np.argsort(-bound, axis=1, kind="stable")[:, low:high]
                    row, column = np.nonzero(np.take_along_axis(bound, order, 1) >= floor[same][:, None])
                    rows, to = [*rows, same[row]], [*to, order[row, column]]
                if rows and sum(map(len, rows)):
                    sent = batch.take(pa.array(np.concatenate(rows)))
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(to).astype(np.int32)), *sent.columns], ["to", *sent.schema.names])

    return asked.mapInArrow(lean(run, 4096), "to int, query long, vec_id long, v array<long>, length int, floor double")


def best_of(found: DataFrame, k: int) -> DataFrame:
    """Each query's k best rows with their ``rank``; what can't be among them is left out before the shuffle."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, shard_rows: int = SHARD, part_rows: int = PART, block_rows: int = BLOCK) -> DataFrame:
    """(query, query_id, rank, vec_id, score): for every row whose id ``every`` divides, its k best other rows.

    A shard that many near or equal vectors fall to is dealt to several parts by a hash of the id, and the
    queries that come to it to blocks, so a task holds at most about ``part_rows`` and ``block_rows`` rows.
    """
    rows = stored(quantised(vectors), "vectors")
    common = rows.groupBy("length").count().orderBy(F.desc("count"), "length").first()
    length, n = (common["length"], common["count"]) if common else (0, 0)
    centres = centres_of(rows, length, int(max(1, min(CENTRES, CENTRE_NUMBERS // max(1, length), -(-n // shard_rows)))))
    homes = stored(sharded(rows, length, centres), "vectors-by-shard")
    shards = stored(homes.groupBy("length", "shard").agg(F.count("*").alias("n"), F.max("off").alias("radius")), "shards")
    radii = np.zeros(len(centres))
    for r in shards.where(F.col("shard") >= 0).collect():  # a row for each centre
        radii[r["shard"]] = r["radius"]
    parts = F.ceil(F.col("n") / part_rows).cast("int")
    of_part = small_side(shards.select(F.col("length").alias("in_length"), F.col("shard").alias("in_shard"), parts.alias("parts")))
    dealt = homes.select("vec_id", "v", "length", "shard").join(of_part, (F.col("length") == F.col("in_length")) & (F.col("shard") == F.col("in_shard")))
    part = F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int").alias("part")
    dealt = dealt.select("length", F.col("shard").alias("to"), part, "vec_id", "v")
    asked = rows.where(F.col("vec_id") % every == 0).distinct()
    asked = stored(asked.select(F.monotonically_increasing_id().alias("query"), "vec_id", "v", "length"), "queries")
    best = None
    for low, high in zip(ROUNDS, [*ROUNDS[1:], None], strict=True):
        if low and low >= len(centres):
            break
        floors = asked.withColumn("floor", F.lit(float("-inf")))
        if best is not None:
            kth = best.groupBy(F.col("query").alias("of")).agg(F.count("*").alias("there"), F.min("score").cast("double").alias("kth")).where(F.col("there") >= k)
            floors = asked.join(kth, asked["query"] == kth["of"], "left").select("query", "vec_id", "v", "length", F.coalesce("kth", F.lit(float("-inf"))).alias("floor"))
        sent = stored(visits(floors, length, centres, radii, low, high), "visits")
        blocks = sent.groupBy(F.col("length").alias("b_length"), F.col("to").alias("b_to")).agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks"))
        blocks = small_side(stored(blocks, "blocks"))
        at_block = lambda df: df.join(blocks, (F.col("length") == F.col("b_length")) & (F.col("to") == F.col("b_to")))
        each = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
        stay = at_block(dealt).select("length", "to", "part", each, F.lit(False).alias("asks"), F.lit(0).cast("long").alias("query"), "vec_id", "v", F.lit(0.0).alias("floor"))
        asking = at_block(sent).join(of_part, (F.col("length") == F.col("in_length")) & (F.col("to") == F.col("in_shard")))
        block = F.pmod(F.xxhash64("query", F.lit(7)), F.col("blocks")).cast("int").alias("block")
        asking = asking.select("length", "to", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), block, F.lit(True).alias("asks"), "query", "vec_id", "v", "floor")
        found = stay.union(asking).groupBy("length", "to", "part", "block").applyInArrow(_search(k), FOUND)
        if best is not None:
            found = found.union(best.select("query", "query_id", "vec_id", "score"))
        best = stored(best_of(found, k), "top-k")
    return best.select("query", "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
