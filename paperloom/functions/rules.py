"""Decision rules as Column expressions: risk, quality, routing, images and boxes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from paperloom.functions import constants as K


def clamp(c: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def risk_level(score: Column) -> Column:
    return F.when(score >= K.RISK_HIGH, "high").when(score >= K.RISK_MEDIUM, "medium").otherwise("low")


def risk_profile(ai: Column, same_user: Column, other_user: Column, quality: Column) -> Column:
    """Score, level and signals of one image (AGG16)."""
    duplicate = F.when(other_user, F.lit(K.RISK_OTHER_USER)).when(same_user, F.lit(K.RISK_SAME_USER)).otherwise(F.lit(0.0))
    score = F.round(clamp(K.RISK_AI * ai + duplicate + K.RISK_QUALITY * (1 - quality)), 3)
    signals = F.array(
        F.when(ai > K.SIGNAL_AI, "ai_generated"), F.when(other_user, "duplicate_other_user"),
        F.when(same_user, "duplicate_same_user"), F.when(quality < K.SIGNAL_QUALITY, "low_quality"),
    )
    return F.struct(score.alias("risk_score"), risk_level(score).alias("risk_level"), F.filter(signals, lambda s: s.isNotNull()).alias("risk_signals"))


def route(step: Column, loops: Column, last_tool: Column) -> Column:
    """The next node: report after three loops, when asked, when a tool would repeat, or when unknown (STA3)."""
    return F.when(loops >= K.MAX_LOOPS, "report").when(step == "report", "report").when(step.eqNullSafe(last_tool), "report").when(step.isin("vqa", "search"), step).otherwise("report")


def decision(reply: Column, loops: Column) -> Column:
    """A parsed decision: an unknown step is a report; the loop counts on (STA5)."""
    step = F.try_variant_get(F.try_parse_json(reply), "$.next_step", "string")
    return F.struct(F.when(step.isin("vqa", "search", "report"), step).otherwise("report").alias("next_step"), (loops + 1).alias("loop_count"))


def image_type(mean: Column, std: Column, sharpness: Column, texture: Column, half_difference: Column) -> Column:
    """What kind of picture an image is, by its statistics (IMG2)."""
    even = half_difference <= 30
    return (
        F.when((mean > 180) & (sharpness > 200) & (std > 40) & even, "clean_document")
        .when((texture > 200) & (std > 50) & (mean > 100) & (mean < 200), "medical_photo")
        .when((mean < 100) & (std > 50) & (texture > 150), "dark_scene")
        .when((mean < 120) & (std < 35) & ~even, "underexposed_phone")
        .otherwise("general")
    )


def safeguard(before: Column, after: Column, clipped_before: Column, clipped_after: Column) -> Column:
    """Whether an enhancement is undone: over 30% of sharpness lost, or clipping doubled and over 1000 (IMG5)."""
    return (after < before * 0.7) | ((clipped_after > 2 * clipped_before) & (clipped_after > 1000))


def quality_tier(sharpness: Column, side: Column) -> Column:
    """PASS from a sharpness of 300; small images are a WARNING without more ado (IMG6, FLT11)."""
    return F.when(side < K.MIN_SIDE, "WARNING").when(sharpness >= K.SHARP_ENOUGH, "PASS").otherwise("WARNING")


def lighting(mean: Column, std: Column) -> Column:
    return F.when((mean < 50) | (mean > 220), F.lit(0.6)).otherwise(F.lit(1.0)) * F.when(std < 30, F.lit(0.7)).otherwise(F.lit(1.0))


def quality_score(sharpness: Column, light: Column, fixed: bool = False) -> Column:
    """0.6 (1 - blur) + 0.4 light (IMG8).  As in use, blur rises with sharpness; ``fixed`` turns that round."""
    blur = sharpness / (sharpness + K.SHARP_ENOUGH)
    return F.round(clamp(0.6 * (blur if fixed else 1 - blur) + 0.4 * light), 3)


def polygon_box(poly: Column, width: Column, height: Column) -> Column:
    """A polygon's box: centre, width and height in parts of the page (SCL22)."""
    xs, ys = F.transform(poly, lambda p: F.get(p, 0)), F.transform(poly, lambda p: F.get(p, 1))
    x0, x1, y0, y1 = F.array_min(xs), F.array_max(xs), F.array_min(ys), F.array_max(ys)
    return F.struct(((x0 + x1) / 2 / width).alias("xc"), ((y0 + y1) / 2 / height).alias("yc"), ((x1 - x0) / width).alias("w"), ((y1 - y0) / height).alias("h"))


def clamped_box(xc: Column, yc: Column, w: Column, h: Column) -> Column:
    """A box within the page (SCL22): its edges are moved in, its centre follows."""
    x0, x1, y0, y1 = clamp(xc - w / 2), clamp(xc + w / 2), clamp(yc - h / 2), clamp(yc + h / 2)
    return F.struct(((x0 + x1) / 2).alias("xc"), ((y0 + y1) / 2).alias("yc"), (x1 - x0).alias("w"), (y1 - y0).alias("h"))


def padded_crop(x0: Column, y0: Column, x1: Column, y1: Column, width: Column, height: Column, pad: int = 15) -> Column:
    """A crop in pixels with a margin, within the image."""
    zero = F.lit(0)
    return F.struct(F.greatest(zero, x0 - pad).alias("x0"), F.greatest(zero, y0 - pad).alias("y0"), F.least(width, x1 + pad).alias("x1"), F.least(height, y1 + pad).alias("y1"))


def split_name(document_id: Column, after: int = K.SPLIT_AFTER) -> Column:
    """val for ids whose number is over 32, else train (SCL23)."""
    number = F.regexp_extract(document_id, "^[^_]*_(.*)$", 1).try_cast("long")
    return F.when(number > after, "val").otherwise("train")


def yolo_line(class_id: Column, box: Column) -> Column:
    return F.format_string("%d %.6f %.6f %.6f %.6f", class_id, box.xc, box.yc, box.w, box.h)
