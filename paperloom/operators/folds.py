"""Order-dependent folds: chat history, greedy acceptance, bounded inquiry loops."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions import constants as K
from paperloom.functions import rules
from paperloom.functions.text import detect_language, squeeze, truncate_tail
from paperloom.operators import joins
from paperloom.operators.components import components
from paperloom.session import with_checkpoints


def append_turn(history: Column, question: Column, answer: Column, limit: int = K.HISTORY_CHARS) -> Column:
    """History after a turn; beyond the limit its end is kept after a mark (STA6 without a model)."""
    q, a, h = squeeze(question), squeeze(answer), squeeze(history)
    arabic = detect_language(F.when(q != "", q).when(a != "", a).otherwise(h)) == "ar"
    turn = F.when(arabic, F.concat(F.lit("س: "), q, F.lit(" ج: "), a)).otherwise(F.concat(F.lit("Q: "), q, F.lit(" A: "), a))
    merged = F.trim(F.when(h != "", F.concat(h, F.lit(" "), turn)).otherwise(turn))
    tail = max(250, int(limit * 0.6))
    long = truncate_tail(F.concat(F.lit("[...]"), F.right(merged, F.lit(tail))), limit)
    return F.when((q == "") & (a == ""), truncate_tail(h, limit)).when(F.length(merged) <= limit, merged).otherwise(long)


def chat_history(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """Each conversation's history after its last turn; turns: key, turn, question, answer (WIN9, STA6).

    A conversation's own turns are gathered, which its length bounds; conversations are independent.
    """
    ordered = turns.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("turn", "question", "answer"))).alias("turns"))
    return ordered.select(key, F.size("turns").alias("n_turns"), F.aggregate("turns", F.lit(""), lambda h, t: append_turn(h, t.question, t.answer)).alias("history"))


def greedy_accept(items: DataFrame, edges: DataFrame, ai_limit: float = 0.7, finish: int = 100_000, rounds: int = 3) -> DataFrame:
    """Which items are accepted when each must be no AI image and like no item accepted before it (STA1).

    ``items``: item, ai, in order of ``item``.  ``edges``: item, earlier, of pairs that are too alike.
    Rounds of joins: an item that waits for no earlier one is accepted, what is like it is a duplicate, and the
    edges of both go.  What is undecided after some ``rounds`` falls into components that decide by themselves: those of at
    most ``finish`` edges are folded in order, each in a group of its own, as a chain of edges would take as many rounds as it has items; while
    there is a larger one the rounds go on.
    """
    with_checkpoints(items.sparkSession)
    status = items.select("item", F.when(F.col("ai") >= ai_limit, "ai").alias("fixed"))
    fixed = status.where("fixed is not null").select("item")
    as_earlier = lambda df: df.select(F.col("item").alias("earlier"))
    # AI images are never accepted and never duplicates: they take no part.
    every = edges.where("earlier < item").select("item", "earlier").distinct()
    every = every.join(fixed, "item", "left_anti").join(as_earlier(fixed), "earlier", "left_anti").select("item", "earlier").checkpoint()
    left, duplicates = every, every.select("item").where("false")

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        like: dict[int, list[int]] = {}
        for i, e in zip(pdf["item"], pdf["earlier"], strict=True):
            like.setdefault(i, []).append(e)
        lost: set[int] = set()
        for i in sorted(like):
            if any(e not in lost for e in like[i]):
                lost.add(i)
        return pd.DataFrame({"item": sorted(lost)}, dtype="int64")

    while not left.isEmpty():
        for _ in range(rounds):
            free = left.select(F.col("earlier").alias("item")).distinct().join(left.select("item").distinct(), "item", "left_anti")
            hit = left.join(as_earlier(free), "earlier", "left_semi").select("item").distinct().checkpoint()
            left = left.join(hit, "item", "left_anti").join(as_earlier(hit), "earlier", "left_anti").select("item", "earlier").checkpoint()
            duplicates = duplicates.union(hit)
            if left.isEmpty():
                break
        else:
            roots = components(left.select(F.col("item").alias("a"), F.col("earlier").alias("b")))
            rooted = left.join(roots, left["item"] == roots["node"]).select("item", "earlier", "root").checkpoint()
            small = rooted.groupBy("root").agg(F.count("*").alias("n")).where(F.col("n") <= finish).select("root").checkpoint()
            duplicates = duplicates.union(rooted.join(small, "root", "left_semi").groupBy("root").applyInPandas(fold, "item long").checkpoint())
            left = rooted.join(small, "root", "left_anti").select("item", "earlier").checkpoint()
    duplicates = duplicates.checkpoint()
    hits = every.join(as_earlier(duplicates), "earlier", "left_anti").groupBy("item").agg(F.min("earlier").alias("like"))
    out = status.join(hits, "item", "left")
    return out.select("item", F.coalesce("fixed", F.when(F.col("like").isNotNull(), "duplicate").otherwise("accepted")).alias("decision"), "like")


def accept_vectors(vectors: DataFrame, threshold: float, ai_limit: float = 0.7, first: int = 8192) -> DataFrame:
    """``greedy_accept`` of vectors (vec_id, embedding, ai) that are too alike from a threshold on.

    Of equal vectors the first that is no AI image leads: the later ones are duplicates, of it if it is
    accepted, else of what it is like.  AI images are never accepted, so they take part in no pair.

    Vectors go in order of their ids through blocks, of which the first has about ``first`` and each further one as many as
    all before it.  A block's vectors are held against those accepted so far, which gives one row for each that is like one; only what is like none
    is compared with its own block.  So a cluster costs its accepted vectors times its size, not its square.
    """
    with_checkpoints(vectors.sparkSession)
    square = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    given = vectors.select("vec_id", "embedding", "ai", (~F.coalesce(F.col("ai") >= ai_limit, F.lit(False)) & F.col("embedding").isNotNull() & ~F.isnan(square) & (F.round(square, 6) >= threshold)).alias("alike"))
    leaders = given.where("alike").groupBy("embedding").agg(F.min("vec_id").alias("leader"))
    led = given.where("alike").join(leaders, "embedding").select("vec_id", "leader").where("vec_id <> leader").checkpoint()
    rest = given.join(led.select("vec_id"), "vec_id", "left_anti").drop("alike").checkpoint()
    decided = accepted = None
    for low, high in _blocks(rest, first):
        block = rest.where(F.coalesce((F.col("vec_id") > low) if low is not None else F.lit(True), F.lit(high is None)) & F.coalesce((F.col("vec_id") <= high) if high is not None else F.lit(True), F.lit(False)))
        own = F.coalesce(F.col("ai") < ai_limit, F.lit(True))
        like = block.select(F.col("vec_id").alias("item"), F.lit(None).cast("long").alias("like")).where("false") if accepted is None else joins.first_alike(block.where(own), joins.dealt_store(accepted), threshold).checkpoint()
        left = block.join(like, block["vec_id"] == like["item"], "left_anti")
        edges = joins.alike_pairs(left.where(own), threshold).checkpoint()
        told = greedy_accept(left.select(F.col("vec_id").alias("item"), "ai"), edges, ai_limit).union(like.select("item", F.lit("duplicate").alias("decision"), "like")).checkpoint()
        good = told.where("decision = 'accepted'").select(F.col("item").alias("of"))
        new = block.join(good, block["vec_id"] == good["of"]).select("vec_id", "embedding")
        decided, accepted = (told, new) if decided is None else (decided.union(told), accepted.union(new))
        accepted = accepted.checkpoint()
    by = decided.select(F.col("item").alias("leader"), F.when(F.col("decision") == "accepted", F.col("item")).otherwise(F.col("like")).alias("like"))
    return decided.union(led.join(by, "leader").select(F.col("vec_id").alias("item"), F.lit("duplicate").alias("decision"), "like"))


def _blocks(rows: DataFrame, first: int) -> list[tuple[int | None, int | None]]:
    """Ranges (above, up to) of ids: about ``first`` rows, then as many again as all before; ends are open."""
    n, at, parts = rows.count(), first, []
    while at < n:
        parts.append(at / n)
        at *= 2
    ends = sorted(set(rows.approxQuantile("vec_id", parts, 0.001))) if parts else []
    ends = [int(x) for x in ends]
    return list(zip([None, *ends], [*ends, None], strict=True))


def inquiry(cases: DataFrame, rounds: int = K.MAX_LOOPS) -> DataFrame:
    """Cases through at most ``rounds`` of deciding and asking (STA2): ``steps`` holds what the model would say each round.

    Result: case_id, the path taken, and the loops.
    """
    state = F.struct(F.array().cast("array<string>").alias("path"), F.lit("").alias("last"), F.lit(0).alias("loops"), F.lit(False).alias("done"))

    def turn(s: Column, step: Column) -> Column:
        node = rules.route(step, s.loops + 1, F.nullif(s.last, F.lit("")))
        moved = F.struct(F.concat(s.path, F.array(node)).alias("path"), node.alias("last"), (s.loops + 1).alias("loops"), (node == "report").alias("done"))
        return F.when(s.done, s).otherwise(moved)

    walked = cases.select("case_id", F.aggregate(F.slice("steps", 1, rounds), state, turn).alias("s"))
    path = F.when(F.col("s.done"), F.col("s.path")).otherwise(F.concat("s.path", F.array(F.lit("report"))))
    return walked.select("case_id", F.array_join(path, ">").alias("path"), F.col("s.loops").alias("loops"))
