"""Aggregates: accuracies, error rates, confusion counts, summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions import constants as K
from paperloom.functions.arrow_udfs import list_distance, text_distance
from paperloom.functions.rules import risk_level
from paperloom.functions.text import words
from paperloom.operators import selection


def ratio(a: Column, b: Column, places: int = 6) -> Column:
    """a / b, 0 where b is 0 or null."""
    return F.round(F.coalesce(F.try_divide(a, b), F.lit(0.0)), places)


def accuracies(compared: DataFrame, key: str) -> DataFrame:
    """Accuracy by document, by path and over all, of compared fields (AGG1): one pass of grouping sets."""
    sets = compared.groupingSets([[F.col(key)], [F.col("path")], []], F.col(key), F.col("path"))
    out = sets.agg(F.grouping_id().alias("g"), F.count_if("correct").alias("correct"), F.count("*").alias("total"))
    grain = F.when(F.col("g") == 3, "overall").when(F.col("g") == 1, "document").otherwise("path")
    return out.select(grain.alias("grain"), key, "path", "correct", "total", ratio(F.col("correct"), F.col("total"), 4).alias("accuracy"))


def mismatches(compared: DataFrame, key: str) -> DataFrame:
    """Each document's wrong fields in order of their paths (AGG2)."""
    wrong = compared.where(~F.col("correct"))
    return wrong.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("path", "pred_value", "gold_value"))).alias("wrong"))


def confusion(rows: DataFrame, by: Sequence[str], kind: Column) -> DataFrame:
    """tp, fp, fn and tn with precision, recall and F1 (AGG3, AGG4); ``kind`` names each row's cell."""
    n = lambda k: F.count_if(kind == k).alias(k)
    out = rows.groupBy(*by).agg(n("tp"), n("fp"), n("fn"), n("tn"))
    p, r = ratio(F.col("tp"), F.col("tp") + F.col("fp")), ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    out = out.withColumn("precision", p).withColumn("recall", r)
    return out.withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def banded(score: Column, gold: Column) -> Column:
    """The cell of a similarity: from .85 on right, from .5 on wrong, else missed; blank truth is tn (AGG3)."""
    return F.when(F.coalesce(F.trim(gold), F.lit("")) == "", "tn").when(score >= K.BAND_CORRECT, "tp").when(score >= K.BAND_WRONG, "fp").otherwise("fn")


def exact_cell(pred: Column, gold: Column) -> Column:
    """The cell of an exact comparison; what is read where the truth is blank isn't counted against it (AGG4, FLT5)."""
    blank = lambda c: F.coalesce(c, F.lit("")) == ""
    return F.when(blank(gold), "tn").when(pred.eqNullSafe(gold), "tp").when(~blank(pred), "fp").otherwise("fn")


def word_distance(a: Column, b: Column) -> Column:
    """Edit distance over words (AGG6)."""
    return list_distance(words(a), words(b))


def error_rates(rows: DataFrame, by: Sequence[str], pred: str = "pred", gold: str = "gold") -> DataFrame:
    """Micro character and word error rates, and exact matches; groups without characters are left out (AGG5, AGG7)."""
    return rated(error_counts(rows, by, pred, gold))


def error_counts(rows: DataFrame, by: Sequence[str], pred: str = "pred", gold: str = "gold") -> DataFrame:
    """Edits, sizes and exact matches of each group: sums, which sum up to those of coarser groups (``added``)."""
    p, g = F.coalesce(F.col(pred), F.lit("")), F.coalesce(F.col(gold), F.lit(""))
    each = rows.select(*by, text_distance(p, g).alias("ce"), F.length(g).alias("cn"), word_distance(p, g).alias("we"), F.size(words(g)).alias("wn"), (p == g).cast("int").alias("same"))
    return each.groupBy(*by).agg(F.count("*").alias("samples"), F.sum("ce").alias("char_edits"), F.sum("cn").alias("chars"), F.sum("we").alias("word_edits"), F.sum("wn").alias("words"), F.sum("same").alias("exact"))


COUNTS = ("samples", "char_edits", "chars", "word_edits", "words", "exact")


def added(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Counts of groups summed up by fewer columns."""
    return counts.groupBy(*by).agg(*(F.sum(c).alias(c) for c in COUNTS))


def rated(counts: DataFrame) -> DataFrame:
    """Counts with their rates; groups without characters are left out."""
    out = counts.where("chars > 0")
    return out.withColumn("cer", ratio(F.col("char_edits"), F.col("chars"))).withColumn("wer", ratio(F.col("word_edits"), F.col("words"))).withColumn("exact_match", ratio(F.col("exact"), F.col("samples")))


def number_accuracy(ref: Column, pred: Column) -> Column:
    """Shared numbers over the reference's list, 0 without any (AGG9)."""
    return F.size(F.array_intersect(ref, pred)) / F.greatest(F.size(ref), F.lit(1))


def number_accuracy_sets(ref: Column, pred: Column) -> Column:
    """Shared numbers over the reference's distinct ones, 1 without any (AGG9)."""
    return F.when(F.size(ref) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(ref, pred)) / F.greatest(F.size(F.array_distinct(ref)), F.lit(1)))


def token_f1(pred: Column, gold: Column) -> Column:
    """F1 of the distinct shared words over the lists' lengths; 0 if either is empty (AGG10)."""
    p, g = words(pred), words(gold)
    shared = F.size(F.array_intersect(p, g))
    return F.when((F.size(p) == 0) | (F.size(g) == 0) | (shared == 0), F.lit(0.0)).otherwise(2 * (shared / F.size(p)) * (shared / F.size(g)) / (shared / F.size(p) + shared / F.size(g)))


def answer_scores(rows: DataFrame, category: str) -> DataFrame:
    """Exact match and mean token F1, by category and over all (AGG11)."""
    each = rows.select(category, (F.col("pred") == F.col("gold")).cast("int").alias("em"), token_f1(F.col("pred"), F.col("gold")).alias("f1"))
    out = each.groupingSets([[F.col(category)], []], F.col(category)).agg(F.grouping(category).cast("int").alias("overall"), F.count("*").alias("n"), F.round(F.avg("em"), 6).alias("exact_match"), F.round(F.avg("f1"), 6).alias("f1"))
    return out


def fraud_summary(rows: DataFrame) -> DataFrame:
    """Counts of decisions and the pass rate (AGG13): columns passed, ai, same, other, error."""
    n = lambda c, a: F.count_if(c).alias(a)
    out = rows.agg(F.count("*").alias("total"), n("passed", "passed"), n("ai", "ai_generated"), n("same", "duplicates_same_user"), n("other", "duplicates_other_user"), F.count_if(F.col("same") | F.col("other")).alias("duplicates"), n("error", "errors"))
    return out.withColumn("pass_rate", F.format_string("%.1f%%", 100 * F.coalesce(F.try_divide(F.col("passed"), F.col("total")), F.lit(0.0))))


def reverse_summary(rows: DataFrame) -> DataFrame:
    """Unique images are those without matches, errors included (AGG14)."""
    return rows.agg(F.count("*").alias("total"), F.count_if(F.coalesce("matches_found", F.lit(0)) == 0).alias("unique"), F.count_if(F.col("matches_found") > 0).alias("duplicates"), F.count_if("error").alias("errors"))


def case_risk(rows: DataFrame, key: str) -> DataFrame:
    """A case's highest risk and its level (AGG15)."""
    return rows.groupBy(key).agg(F.max("risk_score").alias("overall_risk_score"), F.count("*").alias("images")).withColumn("overall_risk_level", risk_level(F.col("overall_risk_score")))


def mean_confidence(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Mean confidence, 0 without answers (AGG17)."""
    return rows.groupBy(*by).agg(F.round(F.coalesce(F.avg("confidence"), F.lit(0.0)), 3).alias("mean_confidence"))


def best_per_class(rows: DataFrame, by: Sequence[str], conf: str = "conf", order: str = "pos", floor: float = 0.25) -> DataFrame:
    """Each class's most confident detection, the earlier one of equals (AGG18, FLT4)."""
    rest = [c for c in rows.columns if c not in by]
    best = rows.where(F.col(conf) >= floor).groupBy(*by).agg(F.max_by(F.struct(*rest), F.struct(conf, (-F.col(order)).alias("o"))).alias("b"))
    return best.select(*by, *(F.col(f"b.{c}").alias(c) for c in rest))


def length_percentiles(rows: DataFrame, c: str, points: Sequence[float] = (0.9, 0.95, 0.99)) -> DataFrame:
    """Interpolated percentiles and the largest (AGG19)."""
    found = selection.percentiles(rows, c, points)
    row = found.agg(*(F.round(F.max(F.when(F.col("point") == p, F.col("value"))), 6).alias(f"p{round(100 * p)}") for p in points))
    return row.crossJoin(F.broadcast(rows.agg(F.max(c).alias("largest"))))  # a row by a row


def keep_last(rows: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key (AGG20, WIN7)."""
    w = Window.partitionBy(*by).orderBy(*(F.desc(c) for c in order))
    return rows.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")


def store_stats(rows: DataFrame, user: str, key: str) -> DataFrame:
    """Vectors and distinct users of a store (AGG24, SRC17)."""
    return rows.agg(F.count("*").alias("embeddings"), F.count_distinct(user).alias("users"), F.count_distinct(key).alias("images"), F.lit(True).alias("available"))
