"""Exact percentiles by distributed selection (AGG19): no group's values are ever gathered or sorted as a whole.

A sketch of each group, merged from partial ones, gives two values between which the wanted ranks must lie; a count tells how many values are
below and between. Of what lies between, the distinct values are counted in partial aggregates and the ranks read off their running sums, once
they are few enough for a window; until then the rows between are sketched again. A round takes all but a few thousandths of
the rows away, so two or three rounds do for any size.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.operators.joins import sized
from paperloom.session import with_checkpoints

#: The sketch's rank error is one in so many rows; distinct values of a bracket that a window sorts.
ACCURACY, FEW = 10_000, 1_000_000


def _same(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"_{k}").eqNullSafe(F.col(k)) for k in keys])


def percentiles(df: DataFrame, value: str, points: Sequence[float], by: Sequence[str] = (), accuracy: int = ACCURACY, few: int = FEW) -> DataFrame:
    """(by..., point, value) of each group: the value at rank point * (n - 1), between two values in proportion.

    Nulls don't count; a group without values has none.  NaN is above all numbers.  Null keys are a group.
    """
    with_checkpoints(df.sparkSession)
    if not by:
        return percentiles(df.select(F.lit(0).alias("all"), value), value, points, ["all"], accuracy, few).drop("all")
    rows = df.select(*by, F.col(value).cast("double").alias("x")).where("x is not null")
    kept = [f"_{k}" for k in by]
    n = rows.groupBy(*(F.col(k).alias(f"_{k}") for k in by)).agg(F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).where("n > 0")
    wanted = n.select(*kept, F.explode(F.array(*(F.lit(float(p)) for p in points))).alias("point"), "n", "lo", "hi")
    place = F.col("point") * (F.col("n") - 1)
    # Ranks from 0 of the two values, how far between them, and the bracket: its values, the rows below and in it.
    open_ = wanted.select(*kept, "point", F.floor(place).alias("r"), F.ceil(place).alias("s"), (place - F.floor(place)).alias("part"), "lo", "hi", F.lit(0).cast("long").alias("below"), F.col("n").alias("within"), F.lit(False).alias("stuck")).checkpoint()
    within = F.col("x").between(F.col("lo"), F.col("hi"))
    found = None
    while True:
        # A bracket of one value has its answer.
        done = open_.where("lo <=> hi").select(*kept, "point", F.col("lo").alias("value"))
        found = done if found is None else found.union(done)
        open_ = open_.where("not lo <=> hi")
        if open_.isEmpty():
            break
        # What a sketch can't part any more are few values that are there often.
        wide = open_.where((F.col("within") > few) & ~F.col("stuck"))
        if wide.isEmpty():
            found = found.union(_read_off(rows, open_, by, within))
            break
        narrow = open_.where((F.col("within") <= few) | F.col("stuck"))
        if not narrow.isEmpty():
            found = found.union(_read_off(rows, narrow, by, within).checkpoint())
        open_ = _narrowed(rows, wide, by, within, accuracy).checkpoint()
    return found.select(*(F.col(f"_{k}").alias(k) for k in by), "point", "value")


def _met(rows: DataFrame, brackets: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows beside each bracket of their group; brackets are broadcast if they were counted as few."""
    return rows.join(sized(brackets), _same(by))


def _narrowed(rows: DataFrame, brackets: DataFrame, by: Sequence[str], within: Column, accuracy: int) -> DataFrame:
    """Brackets around the same ranks with a few thousandths of the rows; where a sketch erred, what is left on the side of the ranks."""
    keys = [*(f"_{k}" for k in by), "point"]
    met = _met(rows, brackets, by).where(within)
    share = lambda rank, off: F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col(rank) - F.col("below") + off) / F.col("within")))
    # 2 in ``accuracy``: twice the sketch's error to either side.
    sketch = met.groupBy(*keys, "r", "s", "part", "lo", "hi", "below", "within").agg(F.percentile_approx("x", [i / 1000 for i in range(1001)], F.lit(accuracy)).alias("q"))
    margin = F.ceil(F.col("within") * 2.0 / accuracy) + 1
    first, last = F.floor(share("r", -margin) * 1000).cast("int"), F.ceil(share("s", margin) * 1000).cast("int")
    # The ends of the grid are the bracket's own.
    a = F.when(first <= 0, F.col("lo")).otherwise(F.get("q", first))
    b = F.when(last >= 1000, F.col("hi")).otherwise(F.get("q", last))
    cut = sketch.select(*keys, "r", "s", "part", "lo", "hi", "below", "within", a.alias("a"), b.alias("b")).checkpoint()
    met = _met(rows, cut, by).where(within)
    counted = met.groupBy(*keys, "r", "s", "part", "lo", "hi", "below", "within", "a", "b").agg(
        F.count_if(F.col("x") < F.col("a")).alias("under"), F.count_if(F.col("x").between(F.col("a"), F.col("b"))).alias("between"),
        F.min(F.when(F.col("x") >= F.col("a"), F.col("x"))).alias("least"), F.max(F.when(F.col("x") <= F.col("b"), F.col("x"))).alias("most"),
    )
    from_, to = F.col("below") + F.col("under"), F.col("below") + F.col("under") + F.col("between")
    good = (F.col("r") >= from_) & (F.col("s") < to)
    keep = lambda new, old: F.when(good, F.col(new) if isinstance(new, str) else new).otherwise(F.col(old))
    return counted.select(*keys, "r", "s", "part", keep("least", "lo").alias("lo"), keep("most", "hi").alias("hi"), keep(from_, "below").alias("below"), keep("between", "within").alias("within"), (keep("between", "within") > 0.9 * F.col("within")).alias("stuck"))


def _read_off(rows: DataFrame, brackets: DataFrame, by: Sequence[str], within: Column) -> DataFrame:
    """The values at the ranks of brackets that are small enough to count value by value."""
    keys = [*(f"_{k}" for k in by), "point"]
    counts = _met(rows, brackets, by).where(within).groupBy(*keys, "r", "s", "part", "below", "x").agg(F.count("*").alias("c"))
    upto = F.col("below") + F.sum("c").over(Window.partitionBy(*keys).orderBy("x"))
    at = lambda rank: F.min(F.when(F.col("upto") > F.col(rank), F.col("x")))
    ends = counts.withColumn("upto", upto).groupBy(*keys, "part").agg(at("r").alias("v"), at("s").alias("w"))
    return ends.select(*keys, F.when(F.col("part") == 0, F.col("v")).otherwise(F.col("v") + (F.col("w") - F.col("v")) * F.col("part")).alias("value"))
