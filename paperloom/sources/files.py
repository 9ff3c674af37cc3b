"""Utilities on the driver: finding folders and files, archives, policies of calls."""

from __future__ import annotations

import time
import zipfile
from collections.abc import Callable, Iterable, Iterator, Sequence
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.functions import constants as K


def find_scan_folder(root: str, layouts: Sequence[str], pattern: str = "BC_*", name: str = "Birth Certificate") -> Path | None:
    """The folder of a kind of scan: fixed layouts first, then files of a pattern, then a folder's name (SRC6)."""
    base = Path(root)
    for layout in layouts:
        if (base / layout).is_dir():
            return base / layout
    hit = next(iter(sorted(base.rglob(pattern))), None)
    if hit:
        return hit.parent if hit.is_file() else hit
    return next((p for p in sorted(base.rglob(name)) if p.is_dir()), None)


def pick(paths: Iterable[str], *cues: str) -> str | None:
    """The first path, in order, that has all cues, in any case (SRC10)."""
    return next((p for p in sorted(paths) if all(c.lower() in p.lower() for c in cues)), None)


def unzip(archive: str, folder: str) -> list[str]:
    """Extracts an archive; members that would leave the folder are refused (SRC24)."""
    target = Path(folder).resolve()
    with zipfile.ZipFile(archive) as z:
        for member in z.namelist():
            if not (target / member).resolve().is_relative_to(target):
                raise ValueError(f"{member} leaves {folder}")
        z.extractall(target)
        return sorted(z.namelist())


def zip_folder(folder: str, archive: str) -> str:
    """An archive of a folder's files (SNK11)."""
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(Path(folder).rglob("*")):
            if p.is_file():
                z.write(p, p.relative_to(folder))
    return archive


def resolved(rows: DataFrame, path: str, listing: DataFrame) -> DataFrame:
    """Rows with the listed file of their path's base name, null if there is none (SCL27)."""
    from paperloom.functions.text import base_name

    files = listing.select(base_name(F.col("path")).alias("_base"), F.col("path").alias("resolved")).groupBy("_base").agg(F.min("resolved").alias("resolved"))
    return rows.withColumn("_base", base_name(F.col(path))).join(files, "_base", "left").drop("_base")


def throttled(items: Iterable, call: Callable, gap: float = 3.0, attempts: int = 4, wait: Callable[[Exception], float] | None = None, sleep: Callable[[float], None] = time.sleep) -> Iterator:
    """Answers to items, at least ``gap`` seconds apart; a failed call is made again after ``wait`` (STA9)."""
    last = None
    for item in items:
        for attempt in range(attempts):
            now = time.monotonic()
            if last is not None and now - last < gap:
                sleep(gap - (now - last))
            last = time.monotonic()
            try:
                yield call(item)
                break
            except Exception as error:
                if attempt == attempts - 1:
                    raise
                sleep(wait(error) if wait else 30.0)


def poll(status: Callable[[], str], done: Sequence[str] = ("COMPLETED", "FAILED", "CANCELLED", "TIMED_OUT"), every: float = 2.0, limit: int = 300, sleep: Callable[[float], None] = time.sleep) -> str:
    """A job's final status, asked for again and again (STA10)."""
    for _ in range(limit):
        found = status()
        if found in done:
            return found
        sleep(every)
    raise TimeoutError("the job didn't end")


def score_split(rows: DataFrame, score: str, accept: float) -> tuple[DataFrame, DataFrame]:
    """Rows at or above a score, and the rest (FLT2)."""
    good = F.coalesce(F.col(score) >= accept, F.lit(False))
    return rows.where(good), rows.where(~good)


def present_fields(rows: DataFrame, payload: str) -> DataFrame:
    """Rows with an array of the field classes that their record holds (SCL24)."""
    v = F.try_parse_json(payload)
    names = F.array(*(F.when(F.coalesce(F.try_variant_get(v, path, "string"), F.lit("")) != "", F.lit(name)) for name, *_, path in K.SEED_BOXES))
    return rows.withColumn("present", F.filter(names, lambda x: x.isNotNull()))


def run_counts(rows: DataFrame) -> DataFrame:
    """How many of a batch's calls were saved and failed (AGG23)."""
    return rows.agg(F.count_if("saved").alias("saved"), F.count_if(~F.col("saved")).alias("failed"))
