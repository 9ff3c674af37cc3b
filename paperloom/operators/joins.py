"""Joins: equi, null-safe full, interval, top-k similarity, fuzzy and containment."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from functools import reduce
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions.arrow_udfs import sequence_ratio, token_set, token_set_ratio
from paperloom.session import with_checkpoints

#: A side of at most so many narrow rows may be broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 100_000
#: Scores that a top-k task holds at once.
SCORES = 1 << 20
#: Centres that vectors are dealt by, at most.
CENTRES = 4096


def sized(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, with a broadcast hint once it has been counted to be small."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def compared_fields(pred: DataFrame, gold: DataFrame, key: str) -> DataFrame:
    """Every path of either record of a document, and whether both sides are equal (JOI1, JOI2).

    Documents on one side only are left out.  Absent and null are equal; a text never equals a number.
    Both sides are read once and meet in one shuffle by document.
    """
    kind = F.when(F.col("vtype") != "null", F.when(F.col("vtype") == "boolean", "number").otherwise(F.col("vtype")))
    equal_by = F.when(F.col("vtype") == "boolean", F.when(F.col("value") == "true", "1.0").otherwise("0.0")).when(F.col("vtype") == "number", F.col("value").try_cast("double").cast("string")).otherwise(F.col("value"))
    side = lambda df, gold: df.select(key, "path", F.lit(gold).alias("is_gold"), F.struct("value", kind.alias("type"), equal_by.alias("by")).alias("x"))
    rows = side(pred, False).union(side(gold, True)).repartition(key)
    of = lambda gold: F.max_by("x", F.col("is_gold") == gold)
    has = lambda gold: F.bool_or(F.col("is_gold") == gold)
    both = rows.groupBy(key, "path").agg(F.when(has(False), of(False)).alias("p"), F.when(has(True), of(True)).alias("g"), has(False).alias("in_pred"), has(True).alias("in_gold"))
    document = Window.partitionBy(key)
    both = both.withColumn("shared", F.bool_or("in_pred").over(document) & F.bool_or("in_gold").over(document)).where("shared")
    same = F.col("p.type").eqNullSafe(F.col("g.type")) & F.col("p.by").eqNullSafe(F.col("g.by"))
    return both.select(key, "path", F.col("p.value").alias("pred_value"), F.col("g.value").alias("gold_value"), same.alias("correct"))


def field_reads(reads: DataFrame, documents: DataFrame, fields: DataFrame) -> DataFrame:
    """For each document and listed field the last read, or null (JOI3)."""
    last = reads.groupBy("document_id", "field").agg(F.max_by("value", "pos").alias("value"))
    listed = fields.agg(F.collect_set("field").alias("fields"))  # a document's fields: the columns of a form
    grid = documents.select("document_id").distinct().crossJoin(F.broadcast(listed)).select("document_id", F.explode("fields").alias("field"))
    return grid.join(last, ["document_id", "field"], "left")


def remaining(all_rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows without a result yet (JOI4)."""
    return all_rows.join(done.select(key).distinct(), key, "left_anti")


def selected(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of listed ids (JOI5)."""
    return rows.join(ids.select(key).distinct(), key, "left_semi")


def any_shared(a: DataFrame, b: DataFrame, key: str) -> bool:
    """Whether two tables share an id (JOI6)."""
    return not a.select(key).intersect(b.select(key)).isEmpty()


def segments(spans: DataFrame, seconds: int = 15) -> DataFrame:
    """Fixed segments of each (key, duration), the last one clipped (WIN8)."""
    n = F.ceil(F.col("duration") / seconds)
    rows = spans.where("duration > 0").select("*", F.explode(F.sequence(F.lit(0), n - 1)).alias("segment"))
    return rows.withColumn("l_start", (F.col("segment") * seconds).cast("double")).withColumn("l_end", F.least((F.col("segment") + 1) * seconds, F.col("duration")).cast("double"))


def _usable(rows: DataFrame) -> DataFrame:
    """vec_id and embedding of rows that have an id and a vector of finite numbers."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & finite).select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.stack(column.to_numpy(zero_copy_only=False)).astype(float) if len(column) else np.zeros((0, 1))


class Centres:
    """A store of vectors dealt to the nearest of sampled centres, each with the distance of its farthest vector.

    For a query q no vector of a centre c scores more than q.c + |q| * radius, so a centre below a query's bar needs no visit.
    ``CENTRES`` bounds what the driver and the tasks hold of them: a vector and a radius each.
    """

    def __init__(self, store: DataFrame, rows_a_task: int):
        with_checkpoints(store.sparkSession)
        n = min(CENTRES, -(-store.count() // rows_a_task))
        sample = store.orderBy(F.xxhash64("vec_id"), "vec_id", "embedding").limit(n).select("embedding").collect() if n else []
        self.rows_a_task = rows_a_task
        self.points = points = np.unique(np.array([r["embedding"] for r in sample], float), axis=0) if sample else np.zeros((0, 1))
        half = (points**2).sum(1) / 2

        def nearest(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            centre = np.argmax(x @ points.T - half, axis=1)
            return centre, np.linalg.norm(x - points[centre], axis=1)

        self.kept = self._numbered(self._mapped(store, nearest))
        self.radii = np.zeros(len(points))
        for r in self.kept.groupBy("centre").agg(F.max("value").alias("radius")).collect():  # a row for each centre
            self.radii[r["centre"]] = r["radius"]

    def _mapped(self, rows: DataFrame, of) -> DataFrame:
        """Rows with the centre and the value that ``of`` gives to their vectors; none if there are no centres."""
        some = len(self.points)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows if some else 0, 1024):
                    part = batch.slice(at, 1024)
                    centre, value = of(_matrix(part.column("embedding")))
                    yield pa.RecordBatch.from_arrays([*map(part.column, ("vec_id", "embedding")), pa.array(centre, pa.int32()), pa.array(value, pa.float64())], ["vec_id", "embedding", "centre", "value"])

        kind = rows.schema["embedding"].dataType.simpleString()
        return rows.select("vec_id", "embedding").mapInArrow(run, f"vec_id long, embedding {kind}, centre int, value double")

    @staticmethod
    def _numbered(rows: DataFrame) -> DataFrame:
        return rows.withColumn("number", F.monotonically_increasing_id()).checkpoint()

    def homes(self, queries: DataFrame) -> DataFrame:
        """Each query at the centre of the largest inner product."""
        points = self.points

        def best(q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            s = q @ points.T
            centre = np.argmax(s, axis=1)
            return centre, s[np.arange(len(q)), centre]

        return self._numbered(self._mapped(queries, best))

    def visits(self, queries: DataFrame) -> DataFrame:
        """Each query at all centres that may hold a score at or above its ``bar``, but the one it has ``seen`` (-1: none)."""
        points, radii, lengths = self.points, self.radii, np.linalg.norm(self.points, axis=1)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows if len(points) else 0, 512):
                    part = batch.slice(at, 512)
                    q = _matrix(part.column("embedding"))
                    size = np.linalg.norm(q, axis=1)[:, None]
                    # Scores are rounded to 6 places; the rest is for the bound's own rounding.
                    bound = q @ points.T + size * radii + 1e-6 + 1e-9 * size * (lengths + radii)
                    seen, bar = (part.column(c).to_numpy() for c in ("seen", "bar"))
                    row, centre = np.nonzero((bound >= bar[:, None]) & (np.arange(len(points)) != seen[:, None]))
                    ends = np.searchsorted(row, np.arange(len(q) + 1)).astype(np.int32)
                    listed = pa.ListArray.from_arrays(pa.array(ends), pa.array(centre, pa.int32()))
                    yield pa.RecordBatch.from_arrays([*map(part.column, ("vec_id", "embedding")), listed], ["vec_id", "embedding", "centres"])

        kind = queries.schema["embedding"].dataType.simpleString()
        # A row for each query is stored; the JVM makes one of it for each centre.
        listed = self._numbered(queries.select("vec_id", "embedding", "seen", "bar").mapInArrow(run, f"vec_id long, embedding {kind}, centres array<int>"))
        return listed.withColumn("centre", F.explode("centres")).drop("centres")

    def meet(self, visits: DataFrame, search, schema: str) -> DataFrame:
        """``search`` over each block of a centre's visitors with each part of its vectors, dealt by row numbers: no id or centre is one task's."""
        n = lambda df, name: df.groupBy("centre").agg(F.ceil(F.count("*") / self.rows_a_task).alias(name))
        plan = F.broadcast(n(self.kept, "parts").join(n(visits, "blocks"), "centre"))  # a row for each centre
        own = lambda c: F.pmod(F.xxhash64("number"), F.col(c)).cast("long")
        every = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
        met = self.kept.join(plan, "centre").select("centre", own("parts").alias("part"), every("blocks").alias("block"), "vec_id", "embedding", F.lit(False).alias("asks"))
        meets = visits.join(plan, "centre").select("centre", every("parts").alias("part"), own("blocks").alias("block"), "vec_id", "embedding", F.lit(True).alias("asks"))
        return met.union(meets).groupBy("centre", "part", "block").applyInArrow(search, schema)


def dealt_store(store: DataFrame, rows_a_task: int = 8192) -> Centres:
    """A store of vectors (vec_id, embedding) made ready once for several calls of ``top_k_similar``."""
    return Centres(_usable(store), rows_a_task)


def top_k_similar(queries: DataFrame, store: DataFrame | Centres, k: int, threshold: float | None = None, rows_a_task: int = 8192, same_ids: bool = True) -> DataFrame:
    """(query_id, vec_id, similarity, rank): each query's k nearest of the store by inner product (JOI9, FLT3).

    A query is first compared with the vectors of its nearest centre, then with those of all centres that may
    hold a score as high as the kth found there (``Centres``), so nothing is lost.  A task multiplies one block with
    one part of a centre, each of about ``rows_a_task`` rows, and keeps k a query.  Scores are rounded to 6 places; ties
    go to the smaller id; the threshold applies after the ranking.  A query's own row is no match, if both sides have the
    ``same_ids``.  Rows without an id, or with a vector that is null or holds null or non-finite numbers, take no part.
    """
    queries, centres = _usable(queries), store if isinstance(store, Centres) else dealt_store(store, rows_a_task)

    def search(table: pa.Table) -> pa.Table:
        asks, ids, vectors = table["asks"].to_numpy(), table["vec_id"].to_numpy(), _matrix(table["embedding"])
        points, own = vectors[~asks], ids[~asks]
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        asked, asked_ids, rows = vectors[asks], ids[asks], max(1, min(512, SCORES // max(len(own), 1)))
        for at in range(0, len(asked) if len(own) else 0, rows):
            q, q_ids = asked[at : at + rows], asked_ids[at : at + rows]
            s = np.round(q @ points.T, 6)
            if same_ids:
                s[q_ids[:, None] == own[None, :]] = -np.inf
            last = np.partition(s, -k, axis=1)[:, -k] if k < s.shape[1] else np.full(len(s), -np.inf)
            row, column = np.nonzero((s >= last[:, None]) & (s > -np.inf))
            order = np.lexsort((own[column], -s[row, column], row))
            row, column = row[order], column[order]
            first = np.arange(len(row)) - np.searchsorted(row, row) < k
            row, column = row[first], column[first]
            out.append((q_ids[row], own[column], s[row, column]))
        columns = [np.concatenate(x) for x in zip(*out, strict=True)]
        return pa.table(dict(zip(("query_id", "vec_id", "similarity"), columns, strict=True)))

    schema = "query_id long, vec_id long, similarity double"
    order = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "vec_id")
    best = lambda rows: rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    homes = centres.homes(queries)
    found = centres.meet(homes, search, schema)
    if len(centres.points) > 1:
        found = best(found).checkpoint()
        kth = found.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("similarity").alias("kth"))
        bar = F.greatest(F.coalesce("kth", F.lit(float("-inf"))), F.lit(float("-inf") if threshold is None else float(threshold)))
        rest = homes.join(kth, "vec_id", "left").select("vec_id", "embedding", F.col("centre").alias("seen"), bar.alias("bar"))
        found = found.drop("rank").union(centres.meet(centres.visits(rest), search, schema))
    ranked = best(found)
    return ranked.where(F.col("similarity") >= threshold) if threshold is not None else ranked


def alike_pairs(vectors: DataFrame, threshold: float, rows_a_task: int = 8192) -> DataFrame:
    """(item, earlier) of all vectors whose inner product, rounded to 6 places, is at or above a threshold; the larger vec_id is ``item``.

    Each vector meets those of all centres that may hold such a score (``Centres``), so no pair is left out.  The same
    rows take no part as in ``top_k_similar``.
    """
    vectors = _usable(vectors)
    centres = Centres(vectors, rows_a_task)

    def search(table: pa.Table) -> pa.Table:
        asks, ids, vectors = table["asks"].to_numpy(), table["vec_id"].to_numpy(), _matrix(table["embedding"])
        points, own, items, item_ids = vectors[~asks], ids[~asks], vectors[asks], ids[asks]
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for at in range(0, len(items) if len(own) else 0, 512):
            q = item_ids[at : at + 512]
            row, column = np.nonzero((np.round(items[at : at + 512] @ points.T, 6) >= threshold) & (q[:, None] > own[None, :]))
            found.append((q[row], own[column]))
        return pa.table({"item": np.concatenate([x[0] for x in found]), "earlier": np.concatenate([x[1] for x in found])})

    every = vectors.select("vec_id", "embedding", F.lit(-1).alias("seen"), F.lit(float(threshold)).alias("bar"))
    return centres.meet(centres.visits(every), search, "item long, earlier long")


def first_alike(items: DataFrame, store: Centres, threshold: float) -> DataFrame:
    """(item, like): of each vector (vec_id, embedding) that is as like as ``threshold`` to one of a store, the smallest such id there.

    A row for each item and part of a centre at most leaves a task. The same rows take no part as in ``top_k_similar``.
    """

    def search(table: pa.Table) -> pa.Table:
        asks, ids, vectors = table["asks"].to_numpy(), table["vec_id"].to_numpy(), _matrix(table["embedding"])
        order = np.argsort(ids[~asks], kind="stable")
        points, own, given, given_ids = vectors[~asks][order], ids[~asks][order], vectors[asks], ids[asks]
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for at in range(0, len(given) if len(own) else 0, 512):
            good = np.round(given[at : at + 512] @ points.T, 6) >= threshold
            some = good.any(1)
            found.append((given_ids[at : at + 512][some], own[good.argmax(1)[some]]))
        return pa.table({"item": np.concatenate([x[0] for x in found]), "like": np.concatenate([x[1] for x in found])})

    every = _usable(items).select("vec_id", "embedding", F.lit(-1).alias("seen"), F.lit(float(threshold)).alias("bar"))
    return store.meet(store.visits(every), search, "item long, like long").groupBy("item").agg(F.min("like").alias("like"))


def preferred_then_rest(ranked: DataFrame, k: int, preferred: Column) -> DataFrame:
    """Of each query's candidates, those preferred first and the rest after, k in all, in rank order (JOI10, WIN4)."""
    order = Window.partitionBy("query_id").orderBy(F.when(preferred, 0).otherwise(1), "rank")
    return ranked.withColumn("new_rank", F.row_number().over(order)).where(F.col("new_rank") <= k)


def duplicate_split(ranked: DataFrame, owner: DataFrame, threshold: float) -> DataFrame:
    """Matches at or above a threshold, of the same and of other users, after the ranking (JOI11, AGG21)."""
    a = owner.select(F.col("vec_id").alias("query_id"), F.col("user").alias("query_user"))
    b = owner.select("vec_id", "user")
    rows = a.join(ranked.join(b, "vec_id"), "query_id", "left")
    hit, same = F.col("similarity") >= threshold, F.col("user") == F.col("query_user")
    return rows.groupBy("query_id").agg(
        F.coalesce(F.bool_or(hit & same), F.lit(False)).alias("same_user"),
        F.coalesce(F.bool_or(hit & ~same), F.lit(False)).alias("other_user"),
        F.coalesce(F.max(F.when(hit & same, F.col("similarity"))), F.lit(0.0)).alias("same_max"),
        F.coalesce(F.max(F.when(hit & ~same, F.col("similarity"))), F.lit(0.0)).alias("other_max"),
        F.count_if(hit).alias("matches_found"),
    )


def numbered_letters(c: Column) -> Column:
    """A text's letters, each with how often it came before: what two texts have in common of these is what they share of letters.

    Null for texts of over 500 letters, whose bound would cost more than it saves.
    """
    letters = F.sort_array(F.regexp_extract_all(F.when(F.length(c) <= 500, c), F.lit("(?s)."), F.lit(0)))
    # In sorted order a letter's number is its place after the first of its kind.
    return F.transform(letters, lambda x, i: F.concat(x, (i - F.array_position(letters, x) + 1).cast("string")))


def best_token_match(fields: DataFrame, tokens: DataFrame, score=sequence_ratio, with_cost: bool = False) -> DataFrame:
    """For each (document_id, field, target) the best of the document's tokens and adjacent pairs (JOI12, WIN2).

    ``tokens``: document_id, pos, text.  A single token beats a pair of the same score, an earlier one a later.

    Bound, then verify: matching blocks hold no more letters than both texts share in any order, so twice these by both lengths bounds
    ``sequence_ratio``, and the JVM tells it for every pair.  Of each target the pair of the highest bound is scored first, then
    those whose bound reaches that score; all others can't win.  ``with_cost`` adds ``pairs`` and ``scored``, how many there
    were and how many were scored.  Another ``score`` has no bound here, and all its pairs are scored.
    """
    here = Window.partitionBy("document_id").orderBy("pos")
    with_next = tokens.withColumn("next", F.lead("text").over(here))
    singles = tokens.select("document_id", "text", F.col("pos").alias("pos"), F.lit(0).alias("pair"))
    pairs = with_next.where("next is not null").select("document_id", F.concat_ws(" ", "text", "next").alias("text"), "pos", F.lit(1).alias("pair"))
    keys = ["document_id", "field", "target"]
    of = lambda value: F.struct(F.col(value), (-F.col("pair")).alias("p"), (-F.col("pos")).alias("q"))
    if score is not sequence_ratio:
        scored = fields.join(singles.union(pairs), "document_id").withColumn("score", F.round(score(F.col("target"), F.col("text")), 6))
        best = scored.groupBy(*keys).agg(F.max_by(F.struct("text", "score"), of("score")).alias("b"), F.count("*").alias("pairs"))
        return best.select(*keys, F.col("b.text").alias("text"), F.col("b.score").alias("score"), *([F.col("pairs"), F.col("pairs").alias("scored")] if with_cost else []))
    with_checkpoints(fields.sparkSession)
    asked = fields.withColumn("a", numbered_letters(F.coalesce("target", F.lit(""))))
    bags = singles.union(pairs).withColumn("b", numbered_letters(F.coalesce("text", F.lit(""))))
    size = F.size("a") + F.size("b")
    bound = F.when((size > 0) & F.col("a").isNotNull() & F.col("b").isNotNull(), 2 * F.size(F.array_intersect("a", "b")) / size).otherwise(1.0)
    # One up in the sixth place: scores are compared as rounded.
    met = asked.join(bags, "document_id").select(*keys, "text", "pos", "pair", F.round(bound + 1e-6, 6).alias("bound")).checkpoint()
    first = met.groupBy(*keys).agg(F.max_by(F.struct("text", "pos", "pair"), of("bound")).alias("f"), F.count("*").alias("pairs"))
    least = first.select(*(F.col(k).alias(f"its_{k}") for k in keys), F.round(score(F.col("target"), F.col("f.text")), 6).alias("least"), "pairs").checkpoint()
    same = reduce(lambda x, k: x & F.col(k).eqNullSafe(F.col(f"its_{k}")), keys[1:], F.col(keys[0]) == F.col(f"its_{keys[0]}"))
    left = met.join(least, same & (F.col("bound") >= F.col("least"))).select(*keys, "text", "pos", "pair", "pairs")
    scored = left.withColumn("score", F.round(score(F.col("target"), F.col("text")), 6))
    best = scored.groupBy(*keys).agg(F.max_by(F.struct("text", "score"), of("score")).alias("b"), F.first("pairs").alias("pairs"), F.count("*").alias("scored"))
    return best.select(*keys, F.col("b.text").alias("text"), F.col("b.score").alias("score"), *(["pairs", "scored"] if with_cost else []))


def levenshtein_score(a: Column, b: Column) -> Column:
    """1 - distance / longer length: a symmetric score without Python."""
    longer = F.greatest(F.length(a), F.length(b))
    return F.when(longer == 0, F.lit(1.0)).otherwise(1 - F.levenshtein(a, b) / longer)


def _numbered(texts: Sequence[str], width: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(place of the text, mark) for each ``width`` (1 or 2) neighbouring letters of texts.

    A mark also holds how often the same came before, so two texts have as many marks in common as the least of their counts.
    """
    mark = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    at = np.repeat(np.arange(len(texts)), [len(x) for x in texts])
    if width == 2:
        inside = at[1:] == at[:-1]
        at, mark = at[1:][inside], (mark[:-1] << 21 | mark[1:])[inside]
    order = np.lexsort((mark, at))
    at, mark = at[order], mark[order]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (mark[1:] != mark[:-1])
    first = np.flatnonzero(new)
    return at, mark << 21 | np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))


class _Marks:
    """Which of ``n`` names have which marks: marks of many names as a table of ones, of others the names' places."""

    OFTEN = 32

    def __init__(self, at: np.ndarray, marks: np.ndarray, n: int, kind: type) -> None:
        self.marks, number, count = np.unique(marks, return_inverse=True, return_counts=True)
        often = count * self.OFTEN > n
        self.column = np.where(often, np.cumsum(often) - 1, -1)
        self.dense = np.zeros((int(often.sum()), n), kind)
        hit = often[number]
        self.dense[self.column[number[hit]], at[hit]] = 1
        self.names, self.ends = at[np.argsort(number, kind="stable")].astype(np.int32), np.append(0, np.cumsum(count))

    def _known(self, at: np.ndarray, marks: np.ndarray, *more: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of texts' marks those that names have, as their places."""
        place = np.searchsorted(self.marks, marks)
        hit = np.flatnonzero(self.marks[np.minimum(place, len(self.marks) - 1)] == marks) if len(self.marks) else np.zeros(0, np.int64)
        return at[hit], place[hit], *(x[hit] for x in more)

    def weighed(self, n_texts: int, at: np.ndarray, marks: np.ndarray, weights: np.ndarray, low: int, high: int) -> np.ndarray:
        """For each text, the sum of weights of its marks that each name from ``low`` to ``high`` has too; the table is multiplied for all texts at once."""
        at, place, weights = self._known(at, marks, weights)
        often = self.column[place] >= 0
        asks = np.zeros((n_texts, len(self.dense)), np.float32)
        asks[at[often], self.column[place[often]]] = weights[often]
        out = asks @ self.dense[:, low:high]
        for k, x, weight in zip(at[~often].tolist(), place[~often].tolist(), weights[~often].tolist(), strict=True):
            own = self.names[self.ends[x] : self.ends[x + 1]]
            out[k, own[(own >= low) & (own < high)] - low] += weight
        return out

    def counted(self, marks: np.ndarray, some: np.ndarray) -> np.ndarray:
        """How many of a text's marks some of the names have."""
        _, place = self._known(marks, marks)
        often, n = self.column[place][self.column[place] >= 0], self.dense.shape[1]
        out = self.dense[often].sum(0, np.int64)[some] if 4 * len(some) > n else self.dense[np.ix_(often, some)].sum(0, np.int64)
        posted = [self.names[self.ends[x] : self.ends[x + 1]] for x in place[self.column[place] < 0].tolist()]
        return out + np.bincount(np.concatenate(posted), minlength=n)[some] if posted else out


class _Asked:
    """A block of queries for a ``NameIndex``: places of their letters and words in the bits of 64-bit words, a space leads each word."""

    def __init__(self, index: NameIndex, queries: Sequence[str]) -> None:
        self.queries, self.split = queries, [sorted(set(x.split())) for x in queries]
        self.joined = [" ".join(x) for x in self.split]
        self.n_words, self.sizes = np.array([len(x) for x in self.split], np.int64), np.array([len(x) for x in self.joined], np.int64)
        self.plain = (self.sizes > 0) & (self.sizes < 64)
        known = [(q, w, index.words[w]) for q, x in enumerate(self.split) for w in x if w in index.words]
        self.word_of, self.word_number = np.array([q for q, _, _ in known], np.int64), np.array([k for _, _, k in known], np.int64)
        self.word_size = np.array([len(w) + 1 for _, w, _ in known], np.int64)
        # 0 is no letter and no word; only words that queries have are told apart.
        numbers = np.unique(self.word_number)
        self.numbers = np.zeros(len(index.words) + 1, np.int32)
        self.numbers[numbers] = np.arange(1, len(numbers) + 1)
        self.where, self.bits = np.zeros((len(queries), len(index.letters) + 1), np.uint64), np.zeros((len(queries), len(numbers) + 1), np.uint64)
        at, place, number = index.numbered_letters([x if ok else None for x, ok in zip(self.joined, self.plain.tolist(), strict=True)])
        np.bitwise_or.at(self.where.ravel(), at * self.where.shape[1] + number, np.uint64(1) << place.astype(np.uint64))
        self.where[:, 0] = 0
        for q in np.flatnonzero(self.plain).tolist():
            place = 0
            for w in self.split[q]:
                if w in index.words:
                    self.bits[q, self.numbers[index.words[w]]] = ((1 << len(w) + 1) - 1) << place
                place += len(w) + 1


class NameIndex:
    """An index of names by letters, words and pairs of letters, for the highest ``token_set`` scores at or above ``accept``.

    The words of a name, sorted, are one text of length a.  Let L be the length of two names' longest common subsequence, and s that of the words
    both have, with the spaces between: the score is 200 L / (a + b) or 200 s / (s + min(a, b)), which is 100 for a subset.  Words tell s.
    L is at most what both share of letters in any order, which leaves few names.  Where it leaves more, a text with a space at either side has a + 1
    letter pairs, which don't depend on the words' order.  If two names share c of them, a - L deletions break two pairs each and b - L insertions
    one, so c >= (a + 1) - 2 (a - L) - (b - L), hence L <= (c + a + b - 1) / 3.  A name below ``accept`` by both ways of scoring is no candidate;
    candidates are scored by falling bound until none can reach the best score.

    Marks that many names have are counted as a product of matrices, the others by their lists.  Candidates of a block of queries are scored at
    once: the words that both have are the same beginning of both texts, and what is left is compared in the bits of 64-bit words, a letter of all
    candidates a step.  Queries of more letters than that, and names of more than ``LONG``, are scored one by one.
    """

    LONG, WORDS, BLOCK, PAIRS, FEW = 256, 32, 128, 2048, 64

    def __init__(self, names: Sequence[str], row_ids: Sequence[int]) -> None:
        self.names, self.row_ids = names, np.array(row_ids, np.int64)
        split = [sorted(set(x.split())) for x in names]
        joined = [" ".join(x) for x in split]
        self.sizes = np.array([len(x) for x in joined], np.int64)
        self.n_words = np.array([len(x) for x in split], np.int64)
        self.words = {w: k for k, w in enumerate(dict.fromkeys(w for x in split for w in x), 1)}
        own = np.array([self.words[w] for x in split for w in x], np.int64)
        # Letters and words of names by length, as only names of like length can share as many letters as a high score needs.
        self.by_size = np.argsort(self.sizes, kind="stable")
        rank = np.empty_like(self.by_size)
        rank[self.by_size] = np.arange(len(names))
        at, marks = _numbered(joined)
        self.by_letter = _Marks(rank[at], marks, len(names), np.float32)
        self.by_word = _Marks(np.repeat(rank, self.n_words), own, len(names), np.float32)
        self.by_pair = _Marks(*_numbered([f" {x} " if x else "" for x in joined], 2), len(names), np.uint8)
        self.size_kinds, self.size_counts = np.unique(self.sizes, return_counts=True)
        self.needs: dict[tuple[int, float], tuple[np.ndarray, np.ndarray, int, int]] = {}
        # Letters of names, which of a name's words each belongs to, and these words; a space leads each word.
        self.plain = (self.n_words > 0) & (self.n_words <= self.WORDS) & (self.sizes < self.LONG)
        self.letters = np.unique(np.frombuffer("".join([" ", *joined]).encode("utf-32-le", "surrogatepass"), np.uint32))
        if len(self.letters) >= 1 << 16:  # more letters than the table tells apart
            self.plain[:] = False
        width = int(self.sizes[self.plain].max(initial=0)) + 1
        self.letter, self.word = np.zeros((len(split), width), np.uint16), np.zeros((len(split), width), np.uint8)
        at, place, number = self.numbered_letters([x if ok else None for x, ok in zip(joined, self.plain.tolist(), strict=True)])
        self.letter[at, place] = number
        self.word[at, place] = 1
        self.word *= self.letter == np.searchsorted(self.letters, 32) + 1
        self.word = np.cumsum(self.word, axis=1, dtype=np.uint8) - (self.letter > 0)
        self.own = np.zeros((len(split), self.WORDS), np.int32)
        at, place = np.repeat(np.arange(len(split)), self.n_words), np.arange(len(own)) - np.repeat(np.cumsum(self.n_words) - self.n_words, self.n_words)
        ok = self.plain[at]
        self.own[at[ok], place[ok]] = own[ok]

    def numbered_letters(self, joined: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place of the text, place in it, number) of texts' letters, a space before each text; 0 is a letter that no name has."""
        sizes = np.array([0 if x is None else len(x) + 1 for x in joined], np.int64)
        codes = np.frombuffer("".join(f" {x}" for x in joined if x is not None).encode("utf-32-le", "surrogatepass"), np.uint32)
        number = np.searchsorted(self.letters, codes)
        number = np.where(self.letters[np.minimum(number, len(self.letters) - 1)] == codes, number + 1, 0)
        return np.repeat(np.arange(len(sizes)), sizes), np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes), number

    def _needed(self, a: int, accept: float) -> tuple[np.ndarray, np.ndarray, int, int]:
        """How many letters each name, by length, must share with a query of ``a`` letters, or how many of shared words (a space more), to reach ``accept``.

        Then the first name of a length that can by letters, and the one after the last.
        """
        if (a, accept) not in self.needs:
            if len(self.needs) >= 2 * self.BLOCK:
                self.needs.clear()
            least, b = (accept - 1e-6) / 200, self.size_kinds
            short = np.minimum(a, b)
            letters = np.ceil(least * (a + b) - 1e-9)
            shared = np.ceil(least / (1 - least) * np.maximum(short, 1) - 1e-9)
            needs = [np.repeat(np.where(x <= short, x + more, np.inf).astype(np.float32), self.size_counts) for x, more in ((letters, 0), (shared, 1))]
            able = np.flatnonzero(needs[0] < np.inf)
            self.needs[a, accept] = *needs, *((int(able[0]), int(able[-1]) + 1) if len(able) else (0, 0))
        return self.needs[a, accept]

    def _scores(self, query: str, rows: np.ndarray) -> np.ndarray:
        """``token_set`` of the query with each of the names."""
        return self._pair_scores(_Asked(self, [query]), np.zeros(len(rows), np.int64), rows)

    def _pair_scores(self, asked: _Asked, asks: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """``token_set`` of queries, given by their places, with names."""
        at_once = asked.plain[asks] & self.plain[rows]
        out = np.zeros(len(rows))
        one_by_one = np.flatnonzero(~at_once)
        out[one_by_one] = [token_set(asked.queries[k], self.names[i]) for k, i in zip(asks[one_by_one].tolist(), rows[one_by_one].tolist(), strict=True)]
        # Names of like lengths together, as all take as many steps as the longest.
        at = np.flatnonzero(at_once)
        at = at[np.argsort(self.sizes[rows[at]], kind="stable")]
        for k in range(0, len(at), self.PAIRS):
            part = at[k : k + self.PAIRS]
            out[part] = self._plain_scores(asked, asks[part], rows[part])
        return out

    def _plain_scores(self, asked: _Asked, asks: np.ndarray, rows: np.ndarray) -> np.ndarray:
        a, b, most = asked.sizes[asks], self.sizes[rows], int(self.n_words[rows].max())
        both = asked.bits.take(asked.numbers[self.own[rows, :most]] + (asks * asked.bits.shape[1])[:, None])
        known = both > 0
        shared_bits = np.bitwise_or.reduce(both, axis=1)
        shared, n_shared = np.maximum(np.bitwise_count(shared_bits).astype(np.int64) - 1, 0), known.sum(1)
        left = ~shared_bits
        height = int(b.max()) + 1
        # Letters of shared words meet nothing.
        open_ = (~known).astype(np.uint64) @ (np.uint64(1) << np.arange(most, dtype=np.uint64))
        here = asked.where.take(np.ascontiguousarray(self.letter[rows, :height].T) + asks * asked.where.shape[1])
        here &= np.uint64(0) - (open_ >> np.ascontiguousarray(self.word[rows, :height].T) & np.uint64(1))
        here &= left
        row = np.full(len(rows), np.uint64((1 << 64) - 1))
        for k in range(height):
            hit = row & here[k]
            row = row + hit | row - hit
        full = (np.uint64(1) << (a + 1).astype(np.uint64)) - np.uint64(1)
        common = a + 1 - np.bitwise_count(row & full).astype(np.int64)
        common = np.where(n_shared > 0, shared + common, common - 1)
        score = np.maximum(200.0 * common / np.maximum(a + b, 1), np.where(n_shared > 0, 200.0 * shared / (shared + np.maximum(np.minimum(a, b), 1)), 0.0))
        return np.where((n_shared > 0) & ((n_shared == asked.n_words[asks]) | (n_shared == self.n_words[rows])), 100.0, score)

    def best(self, query: str, accept: float) -> tuple[list[tuple[int, float]], int]:
        """(row_id, score) of all names whose score may round to the best one, and how many were scored."""
        return self.bests([query], accept)[0]

    def bests(self, queries: Sequence[str], accept: float, known: Sequence[float] | None = None) -> list[tuple[list[tuple[int, float]], int]]:
        """``best`` of each query; ``known`` scores are those that a name is known to reach, here or elsewhere: less doesn't count."""
        least = np.maximum(accept, np.zeros(len(queries)) if known is None else np.array(known, float))
        # Alike queries together, as they need the same of names.
        order = sorted(range(len(queries)), key=lambda k: (int(least[k]), len(queries[k])))
        out: list = [None] * len(queries)
        for at in range(0, len(queries), self.BLOCK):
            part = order[at : at + self.BLOCK]
            for k, found in zip(part, self._bests([queries[k] for k in part], accept, least[part]), strict=True):
                out[k] = found
        return out

    def _bests(self, block: Sequence[str], accept: float, least: np.ndarray) -> list[tuple[list[tuple[int, float]], int]]:
        asked = _Asked(self, block)
        needed = {k: self._needed(int(asked.sizes[k]), max(accept, float(int(least[k])))) for k in np.flatnonzero(asked.sizes).tolist()}
        ranges = [x[2:] for x in needed.values() if x[3]]
        low, high = (min(x for x, _ in ranges), max(x for _, x in ranges)) if ranges else (0, 0)
        at, marks = _numbered(asked.joined)
        letters = self.by_letter.weighed(len(block), at, marks, np.ones(len(at), np.float32), low, high)
        shared = self.by_word.weighed(len(block), asked.word_of, asked.word_number, asked.word_size, 0, len(self.names))
        some = [np.zeros(0, np.int64)] * len(block)
        for k, (by_letters, by_words, first, end) in needed.items():
            hit = shared[k] >= by_words
            hit[first:end] |= letters[k, first - low : end - low] >= by_letters[first:end]
            some[k] = np.flatnonzero(hit)
        # What may round to the same score stays, so that the earlier row wins.
        least = least - 2e-6
        asks, rows = np.repeat(np.arange(len(block)), [len(x) for x in some]), np.concatenate(some)
        of_words = np.maximum(shared[asks, rows].astype(float) - 1, 0)
        # Outside of the range letters alone can't do.
        common = np.zeros(len(rows))
        inside = np.flatnonzero((rows >= low) & (rows < high))
        common[inside] = letters[asks[inside], rows[inside] - low]
        rows = self.by_size[rows]
        both, short = asked.sizes[asks] + self.sizes[rows], np.maximum(np.minimum(asked.sizes[asks], self.sizes[rows]), 1)
        by_words = 200 * of_words / (of_words + short)
        bound = np.maximum(200 * common / both, by_words)
        # The name of the highest bound by letters and words goes first: most can't reach its score.
        firsts = np.flatnonzero(np.diff(asks, prepend=-1))
        if len(firsts):
            highest = np.flatnonzero(bound == np.repeat(np.maximum.reduceat(bound, firsts), np.diff(np.append(firsts, len(asks)))))
            highest = highest[np.diff(asks[highest], prepend=-1) > 0]
            least[asks[highest]] = np.maximum(least[asks[highest]], self._pair_scores(asked, asks[highest], rows[highest]) - 2e-6)
        kept = bound >= least[asks]
        asks, rows, common, both, by_words, bound = (x[kept] for x in (asks, rows, common, both, by_words, bound))
        many = np.flatnonzero(np.bincount(asks, minlength=len(block)) * self.FEW > len(self.names))
        at, marks = _numbered([f" {asked.joined[k]} " for k in many.tolist()], 2)
        for i, k in enumerate(many.tolist()):
            own = slice(*np.searchsorted(asks, [k, k + 1]).tolist())
            pairs = self.by_pair.counted(marks[slice(*np.searchsorted(at, [i, i + 1]).tolist())], rows[own])
            bound[own] = np.maximum(200 * np.minimum(common[own], (pairs + both[own] - 1) // 3) / both[own], by_words[own])
        kept = np.flatnonzero(bound >= least[asks])
        kept = kept[np.lexsort((-bound[kept], asks[kept]))]
        asks, rows, bound = asks[kept], rows[kept], bound[kept]
        place = np.arange(len(asks)) - np.searchsorted(asks, asks)
        scores, n, size, end = np.full(len(asks), -1.0), np.zeros(len(block), np.int64), 4, 0
        while True:
            # By falling bound, so what can still win stands first.
            now = np.flatnonzero((place >= end) & (bound >= least[asks]))
            now = now[place[now] < end + size]
            if not len(now):
                break
            scores[now] = self._pair_scores(asked, asks[now], rows[now])
            np.maximum.at(least, asks[now], scores[now] - 2e-6)
            n += np.bincount(asks[now], minlength=len(block))
            end, size = end + size, min(4 * size, 1024)
        kept = np.flatnonzero(scores >= least[asks])
        ends = np.searchsorted(asks[kept], np.arange(len(block) + 1)).tolist()
        found = list(zip(self.row_ids[rows[kept]].tolist(), scores[kept].tolist(), strict=True))
        return [(found[x:y], k) for x, y, k in zip(ends, ends[1:], n.tolist(), strict=False)]


def catalog_match(queries: DataFrame, catalog: DataFrame, names: Sequence[str], accept: float = 75, names_a_task: int = 8192, with_cost: bool = False) -> DataFrame:
    """The catalog row whose best name is nearest to a query, if it is near enough (JOI13, FLT9).

    ``queries``: query_id, query.  ``catalog`` has a ``row_id``; of equal scores the earlier row wins.
    Distinct names are dealt to shards and distinct queries to blocks; a task indexes its shard (``NameIndex``) and scores
    only what may win there, so nothing is lost.  Where there are several shards, names that share a rare word with a query are scored
    before, and shards leave out what is below these scores.  ``accept`` is at least 67, below which letter pairs tell nothing.  ``with_cost``
    adds ``scored``, the names that were scored for a query, to rows of all queries, matched or not.
    """
    if accept < 200 / 3:
        raise ValueError("two names of such a score need not share a pair of letters")
    name = F.explode(F.array_distinct(F.filter(F.array(*(F.lower(F.trim(c)) for c in names)), lambda x: x != "")))
    entries = catalog.select("row_id", name.alias("text")).groupBy("text").agg(F.min("row_id").alias("row_id"))
    q = queries.select("query_id", F.lower(F.trim("query")).alias("query"))
    asked = q.where("query is not null").select(F.col("query").alias("text")).distinct()
    n_asked, cores = asked.count(), queries.sparkSession.sparkContext.defaultParallelism
    # A block has more queries than a shard names, as each block indexes the shard anew.
    shards, blocks = max(1, -(-entries.count() // names_a_task)), max(1, -(-n_asked // (4 * names_a_task)))
    # Few queries are dealt to all cores, if there are some for each.
    blocks = max(blocks, min(-(-4 * cores // shards), -(-n_asked // 128)))
    near = _by_rare_words(asked, entries, min(4096, max(cores, -(-n_asked // 1024)))) if shards > 1 else asked.select("text", F.lit(None).cast("double").alias("known"), F.lit(0).cast("long").alias("scored"))
    of = lambda n: F.pmod(F.xxhash64("text"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    kept = entries.select(of(shards).alias("shard"), every(blocks).alias("block"), "text", F.col("row_id").cast("long").alias("row_id"), F.lit(0.0).alias("known"), F.lit(False).alias("asks"))
    asking = near.select(every(shards).alias("shard"), of(blocks).alias("block"), "text", F.lit(None).cast("long").alias("row_id"), F.coalesce("known", F.lit(0.0)).alias("known"), F.lit(True).alias("asks"))

    def search(table: pa.Table) -> pa.Table:
        asks, texts, rows = table["asks"].to_numpy(), table["text"].to_pylist(), table["row_id"].to_pylist()
        own = np.flatnonzero(~asks).tolist()
        index = NameIndex([texts[i] for i in own], [rows[i] for i in own])
        out = []
        asked = [texts[i] for i in np.flatnonzero(asks).tolist()]
        for query, (found, n) in zip(asked, index.bests(asked, accept, table["known"].to_numpy()[asks]), strict=True):
            out += [(query, row, x, n if k == 0 else 0) for k, (row, x) in enumerate(found)] or ([(query, None, None, n)] if with_cost else [])
        kinds = pa.string(), pa.int64(), pa.float64(), pa.int64()
        return pa.table({c: pa.array([x[k] for x in out], kind) for k, (c, kind) in enumerate(zip(("text", "row_id", "score", "scored"), kinds, strict=True))})

    # By number, as the rows are few for what is done to them, and where there are few groups by a high one, so that few fall together.
    groups = shards * blocks
    met = kept.union(asking).repartition(min(4096, max(2 * groups, min(8 * groups, 256))), "shard", "block")
    found = met.groupBy("shard", "block").applyInArrow(search, "text string, row_id long, score double, scored long")
    if with_cost:
        found = found.union(near.select("text", F.lit(None).cast("long").alias("row_id"), F.lit(None).cast("double").alias("score"), "scored"))
    good = F.round("score", 6) >= accept
    scored = found.withColumns({"score": F.when(good, F.round("score", 6)), "row_id": F.when(good, F.col("row_id"))})
    first = F.max_by("row_id", F.struct("score", (-F.col("row_id")).alias("r")))
    best = scored.groupBy("text").agg(first.alias("row_id"), F.max("score").alias("score"), F.sum("scored").alias("scored"))
    matched = q.join(best, q["query"] == best["text"], "left" if with_cost else "inner").groupBy("query_id").agg(first.alias("row_id"), F.max("score").alias("score"), F.coalesce(F.sum("scored"), F.lit(0)).alias("scored"))
    return matched if with_cost else matched.where("row_id is not null").drop("scored")


def _by_rare_words(asked: DataFrame, entries: DataFrame, tasks: int) -> DataFrame:
    """Each text with the highest score of the names that its rare words point to, if any (``known``), and how many were ``scored``.

    A word of at most 8 names points to two of them.  The score is one that a name has: what is below it can't be the best.
    """
    with_checkpoints(asked.sparkSession)
    word = F.explode(F.array_distinct(F.filter(F.split("text", "\\s+"), lambda x: x != ""))).alias("word")
    pointed = entries.select("text", word).groupBy("word").agg(F.count("*").alias("n"), F.array_distinct(F.array(F.min("text"), F.max("text"))).alias("names"))
    rare = pointed.where("n <= 8").select("word", "names").checkpoint()
    met = asked.select("text", word).join(sized(rare), "word").select("text", F.explode("names").alias("name")).repartition(tasks, "text").distinct()
    scored = met.withColumn("score", token_set_ratio("text", "name")).groupBy("text").agg(F.max("score").alias("known"), F.count("*").alias("scored"))
    return asked.join(scored, "text", "left").select("text", "known", F.coalesce("scored", F.lit(0)).alias("scored")).checkpoint()


def first_contained(rows: DataFrame, text: str, categories: Sequence[str]) -> DataFrame:
    """The first category whose name a text contains, else the first of the list (JOI14)."""
    found = F.filter(F.array(*map(F.lit, categories)), lambda c: F.contains(F.lower(F.col(text)), F.lower(c)))
    return rows.withColumn("category", F.coalesce(F.try_element_at(found, F.lit(1)), F.lit(categories[0])))


def question_grid(items: DataFrame, questions: Sequence[str], limit: int = 5) -> DataFrame:
    """Every item with each of the first ``limit`` questions (JOI15, SRT3)."""
    return items.select("*", F.posexplode(F.slice(F.array(*map(F.lit, questions)), 1, limit)).alias("question_no", "question"))


def zipped(a: Column, b: Column) -> Column:
    """Pairs by position; what the second list lacks is empty (JOI16)."""
    return F.transform(a, lambda x, i: F.struct(x.alias("item"), F.coalesce(F.get(b, i), F.lit("")).alias("text")))


def routed(kind: Column, routes: dict[str, str], default: str) -> Column:
    """The value for a type, or the default (JOI17)."""
    pairs = [F.lit(x) for kv in routes.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), kind), F.lit(default)) if pairs else F.lit(default)


def paired_media(files: DataFrame, priorities: Sequence[str], partner: str) -> DataFrame:
    """A stem's file of the best-ranked extension, with its partner; without either, left out (JOI18, SRC13)."""
    ext = F.lower(F.regexp_extract("path", r"(\.[^./\\]+)$", 1))
    rows = files.select("path", F.regexp_replace("path", r"\.[^./\\]+$", "").alias("stem"), ext.alias("ext"))
    rank = F.array_position(F.array(*map(F.lit, priorities)), F.col("ext"))
    media = rows.where(F.col("ext").isin(*priorities)).groupBy("stem").agg(F.min_by("path", rank).alias("media"))
    return media.join(rows.where(F.col("ext") == partner).groupBy("stem").agg(F.min("path").alias("partner")), "stem")


def exact_duplicates(rows: DataFrame, key: str, text: str) -> DataFrame:
    """Groups of the same content: hash, first id and size, for groups of two and more (JOI19)."""
    return rows.groupBy(F.sha2(text, 256).alias("content_hash")).agg(F.min(key).alias("first_id"), F.count("*").alias("n")).where("n > 1")
