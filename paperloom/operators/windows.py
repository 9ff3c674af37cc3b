"""Window-like logic, ordering, limits, sampling and set operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def drop_repeats(rows: DataFrame, by: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """Without rows whose value is that of the row before (WIN1)."""
    w = Window.partitionBy(*by).orderBy(*order)
    marked = rows.withColumn("_first", F.row_number().over(w) == 1).withColumn("_before", F.lag(value).over(w))
    return marked.where(F.col("_first") | ~F.col(value).eqNullSafe(F.col("_before"))).drop("_first", "_before")


def adjacent_pairs(rows: DataFrame, by: Sequence[str], order: str, value: str) -> DataFrame:
    """Each row with the next one's value (WIN2)."""
    return rows.withColumn("next", F.lead(value).over(Window.partitionBy(*by).orderBy(order))).where("next is not null")


def ranked(rows: DataFrame, by: Sequence[str], score: str, key: str, k: int) -> DataFrame:
    """The k best of each group (WIN3)."""
    w = Window.partitionBy(*by).orderBy(F.desc(score), key)
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def ranked_first(rows: DataFrame, by: Sequence[str], order: Sequence[str], k: int) -> DataFrame:
    """The first k rows of each group."""
    w = Window.partitionBy(*by).orderBy(*order)
    return rows.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= k).drop("_k")


def last_of(history: str, kind: str) -> F.Column:
    """The last entry of a kind in an array of structs with a ``type`` (WIN5)."""
    return F.try_element_at(F.filter(F.col(history), lambda x: x.type == kind), F.lit(-1))


def last_entry(rows: DataFrame, by: Sequence[str], order: str, wanted: F.Column, value: str) -> DataFrame:
    """Each key's ``value`` on its last row that is ``wanted`` (WIN5), null if none is; no history is gathered."""
    return rows.groupBy(*by).agg(F.max_by(F.when(wanted, F.col(value)), F.when(wanted, F.col(order))).alias("last"))


def numbered(rows: DataFrame, by: Sequence[str], order: Sequence[str], pattern: str = "IMG-%03d", name: str = "label") -> DataFrame:
    """Names by place within a group (WIN6)."""
    return rows.withColumn(name, F.format_string(pattern, F.row_number().over(Window.partitionBy(*by).orderBy(*order))))


def first_of(rows: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key (WIN7, FLT10)."""
    w = Window.partitionBy(*by).orderBy(*order)
    return rows.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")


def first_sorted(rows: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first n rows in order; n must be positive (SRT2, SRT4)."""
    if n < 1:
        raise ValueError("the limit must be at least 1")
    return rows.orderBy(*order).limit(n)


def hash_sample(rows: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows by a seeded hash of their key: the same ones in every run (SRT5, SRT6)."""
    return rows.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))), key).limit(n)


def shuffled(rows: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """All rows in a seeded order (SRT6)."""
    return rows.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key)


def set_sizes(a: DataFrame, b: DataFrame) -> DataFrame:
    """Sizes of intersection, union and both differences of two one-column tables (SET1 to SET5)."""
    sides = a.distinct().select(F.col(a.columns[0]).alias("k"), F.lit(1).alias("a"), F.lit(0).alias("b")).union(b.distinct().select(F.col(b.columns[0]), F.lit(0), F.lit(1)))
    both = sides.groupBy("k").agg(F.max("a").alias("a"), F.max("b").alias("b"))
    return both.agg(F.count_if(F.expr("a = 1 and b = 1")).alias("shared"), F.count("*").alias("either"), F.count_if(F.expr("a = 1 and b = 0")).alias("only_a"), F.count_if(F.expr("a = 0 and b = 1")).alias("only_b"))
