"""Pictures by their statistics: kind, planned enhancement and tier as Column expressions; what an enhancement does to pixels is a provider's."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions import constants as K
from paperloom.functions import rules

# --- fixed values: what is done to a picture of a kind, in order, if a statistic is below a limit (no statistic: always) ---
RECIPES = [
    ("clean_document", "light_sharpen", "sharpness", 250),
    ("medical_photo", "clahe", "std", 35),
    ("medical_photo", "gentle_sharpen", "sharpness", 150),
    ("dark_scene", "clahe", None, None),
    ("dark_scene", "sharpen", None, None),
    ("underexposed_phone", "shadow_correction", None, None),
    ("underexposed_phone", "gamma_1.3", "mean", 100),
    ("underexposed_phone", "white_balance", "spread", 150),
    ("underexposed_phone", "clahe", None, None),
    ("underexposed_phone", "bilateral_denoise", None, None),
    ("underexposed_phone", "morph_closing", "std", 40),
    ("underexposed_phone", "unsharp_mask", None, None),
    ("general", "gamma_1.2", "mean", 80),
    ("general", "clahe", "std", 40),
    ("general", "unsharp_mask", "sharpness", 200),
]


def planned(kind: Column, statistics: dict[str, Column]) -> Column:
    """The names of the steps that a picture of a kind gets (IMG4), ``none`` where it needs nothing.

    Limits are held against the picture as it came: what a step before has made of it only its provider knows.
    """
    wanted = [F.when((kind == of) & (F.lit(True) if name is None else statistics[name] < limit), step) for of, step, name, limit in RECIPES]
    steps = F.filter(F.array(*wanted), lambda s: s.isNotNull())
    return F.when(F.size(steps) == 0, F.array(F.lit("none"))).otherwise(steps)


def half_difference(pixels: Column, width: int) -> Column:
    """How much the upper and lower, or the left and right half differ in mean brightness, whichever is more.

    ``pixels`` are rows of a grey picture one after the other.  A picture without two halves differs by 0.
    """
    mean = lambda xs: F.aggregate(xs, F.lit(0.0), lambda a, x: a + x) / F.nullif(F.size(xs), F.lit(0))
    rows, half = F.floor(F.size(pixels) / width), width // 2
    top, rest = F.slice(pixels, 1, (F.floor(rows / 2) * width).cast("int")), F.size(pixels) - F.floor(rows / 2) * width
    bottom = F.slice(pixels, (F.floor(rows / 2) * width + 1).cast("int"), rest.cast("int"))
    left, right = F.filter(pixels, lambda _, i: i % width < half), F.filter(pixels, lambda _, i: i % width >= half)
    return F.greatest(F.coalesce(F.abs(mean(top) - mean(bottom)), F.lit(0.0)), F.coalesce(F.abs(mean(left) - mean(right)), F.lit(0.0)))


def assessed(pictures: DataFrame, longest: str = "longest") -> DataFrame:
    """``pictures`` (mean, std, spread, sharpness, texture, halves, and the longer side) with image_type, steps and tier (IMG2, IMG4, IMG6, IMG7).

    Pictures whose longer side is short are left as they are, with a warning.
    """
    small = F.col(longest) < K.MIN_SIDE
    kind = rules.image_type(F.col("mean"), F.col("std"), F.col("sharpness"), F.col("texture"), F.col("halves"))
    steps = planned(kind, {c: F.col(c) for c in ("mean", "std", "spread", "sharpness")})
    return pictures.withColumns({
        "image_type": F.when(small, "low_resolution").otherwise(kind),
        "steps": F.when(small, F.array().cast("array<string>")).otherwise(steps),
        "tier": rules.quality_tier(F.col("sharpness"), F.col(longest)),
    })


def page_summary(pages: DataFrame, key: str) -> DataFrame:
    """A document's tier from its pages' (IMG7): a warning if any page has one, with the pages' numbers and mean sharpness."""
    warned = F.sort_array(F.collect_list(F.when(F.col("tier") == "WARNING", F.col("page"))))
    out = pages.groupBy(key).agg(F.count("*").alias("pages"), F.count_if(F.col("tier") == "PASS").alias("pass_pages"), warned.alias("warning_pages"), F.round(F.avg("sharpness"), 6).alias("sharpness"))
    return out.withColumn("tier", F.when(F.size("warning_pages") > 0, "WARNING").otherwise("PASS"))


def crops(boxes: DataFrame, padding: int = 15) -> DataFrame:
    """Boxes x0, y0, x1, y1 of a detector, widened within the image's width and height (IMG13)."""
    fit = lambda c, most: F.greatest(F.lit(0), F.least(c, F.col(most)))
    return boxes.select("*", fit(F.col("x0") - padding, "width").alias("left"), fit(F.col("y0") - padding, "height").alias("top"), fit(F.col("x1") + padding, "width").alias("right"), fit(F.col("y1") + padding, "height").alias("bottom"))


def fitted(width: Column, height: Column, longest: int = 1024) -> Column:
    """Width and height with the longer side at most ``longest`` (the size part of IMG12)."""
    scale = F.least(F.lit(1.0), longest / F.greatest(width, height))
    return F.struct(F.greatest(F.lit(1), F.floor(width * scale)).cast("int").alias("width"), F.greatest(F.lit(1), F.floor(height * scale)).cast("int").alias("height"))
