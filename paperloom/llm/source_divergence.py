"""How far the sources of a language differ in their words: wide term vectors, exact in whole numbers.

Each term of a language becomes a vector: an array of the sources that use it, by the source's place among
the language's, with its count.  Higher-order functions turn a vector into what each pair of its
sources adds, and partial aggregates sum that before it is shuffled.

The smoothed share of a term in a group is ``p = 1 + floor(10^9 (count + 2) / (N + 2 V))``: V kept terms of the
language, N their occurrences in the group.  Two shares are ``f = floor((p - q)^2 / (p + q))`` apart.  A source that lacks a
term has the share ``p0`` of a count of nought, the same for all such terms, so a vector needs no
places for it.  With present shares p and q a pair's sum over all terms is

    V f(p0, q0)  +  sum over terms of the one of f(p, q0) - f(p0, q0)  +  the same of the other
                 +  sum over terms of both of f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)

where only the last line goes by pairs within a vector; the one before goes by distinct shares of a source.  So a
term costs the square of the sources that use it, not of all there are.

A term, its language or its source may hold any part of the rows: tasks count their own texts and pass on partial sums
by (language, source, term), and pairs are emitted by the entry, never a whole square at once.  The table of
sources is broadcast only if it has been counted as small.

Null text, lang and source are ''.  A text without terms still makes its group.  A repeated row counts each time.
A language of one source has no pairs; one without kept terms has pairs of value 0 and no terms.  Long
texts are read whole.  An empty table gives an empty result.  Further columns, of any name, are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paperloom.llm.common import BROADCAST_ROWS, lean, stored

MIN_DOCS, TOP, SCALE, ADDED = 10, 10, 1_000_000_000, 2
#: Terms that a task counts before it passes their partial sums on.
HELD = 200_000
#: What a term is made of, and the letters that are lower-cased.
TERM, UPPER = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"), re.compile("[A-Z]+")


def apart(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)) of two shares; squares stay below 2^63 as shares are at most 10^9 + 1."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def share(count: Column, total: Column, terms: Column) -> Column:
    """The smoothed share of a count, in decimals of 38 digits as 10^9 times a count may exceed a long."""
    wide = lambda c: c.cast("decimal(20,0)")
    return 1 + F.call_function("div", wide(count + ADDED) * F.lit(SCALE).cast("decimal(11,0)"), wide(total + ADDED * terms))


def terms_of(text: str) -> list[str]:
    """Terms with only A-Z lower-cased, which ``lower`` does alone where all is ASCII."""
    return TERM.findall(text.lower() if text.isascii() else UPPER.sub(lambda m: m[0].lower(), text))


def grouped(docs: DataFrame) -> DataFrame:
    """lang, source and text without nulls."""
    return docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents that hold the term.

    A task counts its texts into partial sums of at most about ``HELD`` terms at once; no text is shuffled.
    """
    fields = ["lang", "source", "term", "n", "docs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        held = 0
        for batch in batches:
            for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("text"), strict=True):
                n, of = counts.setdefault((lang, source), (Counter(), Counter()))
                before, terms = len(n), terms_of(text.as_py())
                n.update(terms)
                of.update(set(terms))
                held += len(n) - before
                if held > HELD:
                    yield from told(counts)
                    counts, held = {}, 0
        yield from told(counts)

    def told(counts: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, of) in counts.items():
            terms = list(n)
            columns = [pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()), pa.array(terms, pa.string())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n.values(), pa.int64()), pa.array([of[t] for t in terms], pa.int64())], fields)

    partial = grouped(docs).mapInArrow(lean(run), "lang string, source string, term string, n long, docs long")
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def with_places(docs: DataFrame) -> DataFrame:
    """(lang, source, place): a source's place among those of its language, in order."""
    every = grouped(docs).select("lang", "source").distinct()
    return every.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)


def _beside(rows: DataFrame, table: DataFrame, keys: list[str], small: bool, how: str = "inner") -> DataFrame:
    """An equi-join with a table that is broadcast if it was counted as small, else shuffled (hot keys are split by adaptive execution)."""
    return rows.join(F.broadcast(table) if small else table, keys, how)


def vectors(docs: DataFrame, places: DataFrame, small: bool, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term, n, vector) of the kept terms: n occurrences in all, vector of (place, n) by place."""
    placed = _beside(term_counts(docs), places, ["lang", "source"], small)
    entries = F.sort_array(F.collect_list(F.struct("place", "n")))
    return placed.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"), entries.alias("vector")).where(F.col("docs") >= min_docs).drop("docs")


def languages(wide: DataFrame, places: DataFrame) -> DataFrame:
    """(lang, terms, total, sources): V, N of the language, and its sources as (source, total, p0) by place."""
    whole = wide.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("n").alias("total"))
    entry = wide.select("lang", F.explode("vector").alias("e")).groupBy("lang", F.col("e.place").alias("place")).agg(F.sum("e.n").alias("in_source"))
    rows = places.join(entry, ["lang", "place"], "left").join(whole, "lang", "left")
    rows = rows.select("lang", "source", "place", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("terms", "total", "in_source")))
    # Without kept terms no share is asked for, and its divisor would be nought.
    p0 = F.when(F.col("terms") > 0, share(F.lit(0), F.col("in_source"), F.greatest(F.col("terms"), F.lit(1)))).otherwise(F.lit(1))
    each = F.sort_array(F.collect_list(F.struct("place", "source", F.col("in_source").alias("total"), p0.alias("p0"))))
    return rows.groupBy("lang").agg(F.first("terms").alias("terms"), F.first("total").alias("total"), each.alias("sources"))


def with_shares(wide: DataFrame, table: DataFrame, small: bool) -> DataFrame:
    """(lang, term, q, vector): q the share in the language, vector of (place, p, p0)."""
    known = _beside(wide, table.withColumnRenamed("total", "of"), ["lang"], small)
    p = lambda e: F.struct(e.place.alias("place"), share(e.n, F.get("sources", e.place).total, F.col("terms")).alias("p"), F.get("sources", e.place).p0.alias("p0"))
    return known.select("lang", "term", share(F.col("n"), F.col("of"), F.col("terms")).alias("q"), F.transform("vector", p).alias("vector"))


def pair_sums(shares: DataFrame, table: DataFrame, small: bool) -> DataFrame:
    """(lang, a, b, value) of every two places a < b of a language."""
    none = table.select("lang", "terms", "sources", F.posexplode("sources").alias("a", "x"))
    after = F.slice("sources", F.col("a") + 2, F.size("sources"))
    none = none.select("lang", "a", F.explode(F.transform(after, lambda y: F.struct(y.place.alias("b"), (F.col("terms") * apart(F.col("x.p0"), y.p0)).alias("add")))).alias("c"))
    entry = shares.select("lang", "vector", F.posexplode("vector").alias("i", "x"))
    own = entry.groupBy("lang", F.col("x").alias("x")).agg(F.count("*").alias("k"))
    one = lambda y: F.struct(y.place.alias("b"), (F.col("k") * (apart(F.col("x.p"), y.p0) - apart(F.col("x.p0"), y.p0))).alias("add"))
    others = F.filter("sources", lambda y: y.place != F.col("x.place"))
    alone = _beside(own, table.select("lang", "sources"), ["lang"], small).select("lang", F.col("x.place").alias("a"), F.explode(F.transform(others, one)).alias("c"))
    later = F.slice("vector", F.col("i") + 2, F.size("vector"))
    met = entry.select("lang", F.col("x.place").alias("a"), F.explode(F.transform(later, lambda y: F.struct(y.place.alias("b"), F.col("x.p").alias("p"), F.col("x.p0").alias("p0"), y.p.alias("q"), y.p0.alias("q0")))).alias("c"))
    p, p0, q, q0 = (F.col(f"c.{c}") for c in ("p", "p0", "q", "q0"))
    both = met.select("lang", "a", F.struct("c.b", (apart(p, q) - apart(p, q0) - apart(p0, q) + apart(p0, q0)).alias("add")).alias("c"))
    flat = lambda df: df.select("lang", F.least("a", "c.b").alias("a"), F.greatest("a", "c.b").alias("b"), "c.add")
    return flat(none).union(flat(alone)).union(flat(both)).groupBy("lang", "a", "b").agg(F.sum("add").alias("value"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source is from every other of its language, and its most telling terms.

    Part ``pair``: every other source, by distance.  Part ``term``: terms more frequent in the source than in its
    language, by what they add to the distance between the two, down to rank ``top``.
    """
    places = stored(with_places(docs), "places")
    small = places.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    wide = stored(vectors(docs, places, small, min_docs), "term-vectors")
    table = stored(languages(wide, places), "languages")
    shares = with_shares(wide, table, small)
    names = table.select("lang", "sources")
    summed = _beside(pair_sums(shares, table, small), names, ["lang"], small)
    name = lambda c: F.get("sources", F.col(c)).source
    ways = F.array(F.struct(name("a").alias("source"), name("b").alias("item")), F.struct(name("b").alias("source"), name("a").alias("item")))
    pairs = summed.select("lang", "value", F.explode(ways).alias("w")).select("lang", "w.source", F.lit("pair").alias("part"), "w.item", "value")
    more = shares.select("lang", "term", "q", F.explode("vector").alias("x")).where("x.p > q")
    more = more.select("lang", F.col("x.place").alias("place"), F.col("term").alias("item"), apart(F.col("x.p"), F.col("q")).alias("value"))
    by = lambda *c: F.row_number().over(Window.partitionBy("lang", *c).orderBy(F.desc("value"), "item"))
    telling = _beside(more.withColumn("rank", by("place")).where(F.col("rank") <= top), places, ["lang", "place"], small)
    return pairs.withColumn("rank", by("source")).union(telling.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))
