"""Model providers: what a model does is an interface, with deterministic stand-ins that need no model.

A provider is called once for each ``ROWS`` rows of an Arrow batch at most; its object is built once for each worker process, which gives its
free memory back after a task, as workers are kept for later ones.
"""

from __future__ import annotations

import ctypes
import gc
import hashlib
import json
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions import constants as K

#: Rows that a provider gets at once.
ROWS = 1000
Batch = Callable[[pd.DataFrame], pd.Series]
_registry: dict[str, tuple[Callable[[], Batch], str]] = {}
_built: dict[str, Batch] = {}


def register(name: str, returns: str):
    """Names a factory of batch functions (UDF9)."""

    def wrap(factory: Callable[[], Batch]):
        _registry[name] = (factory, returns)
        return factory

    return wrap


def released() -> None:
    """Gives free memory of this process back to the machine."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not with this C library
        pass


def call(df: DataFrame, name: str, inputs: list[str], output: str, retry_if: Callable[[pd.Series], pd.Series] | None = None) -> DataFrame:
    """``df`` with a provider's answers as a column; a batch's answers that ``retry_if`` marks are asked for once more (UDF1 to UDF8, FLT12)."""
    factory, returns = _registry[name]

    @F.pandas_udf(returns)
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        if name not in _built:
            _built[name] = factory()
        try:
            for batch in batches:
                for at in range(0, len(batch), ROWS):
                    part = batch.iloc[at : at + ROWS].reset_index(drop=True)
                    answer = _built[name](part)
                    if retry_if is not None and (again := retry_if(answer)).any():
                        answer = answer.where(~again, _built[name](part))
                    yield answer
        finally:
            released()

    return df.withColumn(output, run(F.struct(*(F.col(c) for c in inputs))))


def _digest(x: object) -> int:
    return int.from_bytes(hashlib.sha256(str(x).encode()).digest()[:8], "little")


@register("embed", "array<float>")
def stub_embedder(dim: int = 64) -> Batch:
    """Unit vectors by hashed words: alike texts are near (UDF8)."""

    def one(text: str | None) -> np.ndarray:
        v = np.zeros(dim, np.float32)
        for w in (text or "").lower().split():
            h = _digest(w)
            v[h % dim] += 1 if h >> 32 & 1 else -1
        n = np.linalg.norm(v)
        return v / n if n else v

    return lambda b: b.iloc[:, 0].map(one)


@register("ai_probability", "double")
def stub_detector() -> Batch:
    """A probability by a hash of the image's name (IMG11)."""
    return lambda b: b.iloc[:, 0].map(lambda x: _digest(x) % 101 / 100)


@register("chat", "string")
def stub_chat() -> Batch:
    """The prompt's last line, or nothing for an empty prompt (UDF7)."""
    return lambda b: b.iloc[:, 0].map(lambda x: (x or "").strip().rsplit("\n", 1)[-1])


@register("rewrite", "string")
def stub_rewriter(short: int = 20) -> Batch:
    """A history and a question in, JSON out: a short question depends on the history and gets its last word; nothing without a question (UDF7)."""

    def one(history: str | None, question: str | None) -> str | None:
        if not question:
            return None
        depends = len(question.split()) < short
        rewrite = f"{question} {history.split()[-1]}" if depends and history and history.split() else question
        return "Here it is: " + json.dumps({"depends": depends, "rewrite": rewrite}, ensure_ascii=False)

    return lambda b: pd.Series([one(h, q) for h, q in zip(b.iloc[:, 0], b.iloc[:, 1], strict=True)], dtype=object)


@register("vqa", "string")
def stub_vqa() -> Batch:
    """Yes, no or unclear, by a hash of the image's name and the prompt (UDF4)."""
    return lambda b: pd.Series([("نعم", "لا", "غير واضح")[_digest(f"{x}|{p}") % 3] for x, p in zip(b.iloc[:, 0], b.iloc[:, 1], strict=True)])


@register("embed_image", "array<float>")
def stub_image_embedder(dim: int = 512) -> Batch:
    """Unit vectors of a fixed width by the image's bytes, pixels or name (IMG9)."""

    def one(x: object) -> np.ndarray:
        v = np.random.default_rng(_digest(x)).normal(size=dim).astype(np.float32)
        return v / np.linalg.norm(v)

    return lambda b: b.iloc[:, 0].map(one)


@register("detect", "array<struct<class:string,conf:double,x0:double,y0:double,x1:double,y1:double>>")
def stub_boxes() -> Batch:
    """Two boxes of an image, by a hash of its name (IMG13)."""

    def one(x: object) -> list[dict]:
        h = _digest(x)
        return [{"class": f"c{h >> 8 * k & 3}", "conf": (h >> 8 * k & 255) / 255, "x0": float(h >> k & 31), "y0": float(h >> 2 * k & 31), "x1": 40.0 + (h >> 3 * k & 31), "y1": 40.0 + (h >> 5 & 31)} for k in (0, 1)]

    return lambda b: b.iloc[:, 0].map(one)


@register("remote", "map<string,string>")
def stub_remote() -> Batch:
    """A remote batch function: a payload in, a map out (UDF10)."""
    return lambda b: b.iloc[:, 0].map(lambda x: {"sha256": hashlib.sha256(str(x).encode()).hexdigest(), "size": str(len(str(x)))})


@register("read_page", "string")
def stub_reader() -> Batch:
    """A fenced JSON record that names the document (UDF1, UDF5)."""
    return lambda b: b.iloc[:, 0].map(lambda x: f'```json\n{{"document_id": "{x}", "page_count": 1,}}\n```')


@register("read_form", "string")
def stub_form_reader() -> Batch:
    """A case form's reply by its number and address, as models reply: whole, fenced, with fields of the wrong kind, cut off, or empty (UDF1)."""

    def one(document_id: str, url: str | None) -> str:
        number = int(document_id.rsplit("_", 1)[-1])
        record = dict.fromkeys(K.CASE_FIELDS) | dict.fromkeys(K.LIST_FIELDS, ()) | {"document_id": document_id, "source_files": [url], "page_count": 1, "review_required": False, "case_office": url}
        match number % 6:
            case 1:
                return f"Here it is:\n```json\n{json.dumps(record, ensure_ascii=False)[:-1]},}}\n```"
            case 2:
                return json.dumps(record | {"page_count": 0, "family_members": [dict.fromkeys(K.MEMBER_FIELDS, "x"), {"name": "x", "age": 5}], "uncertain_fields": ["phone"]})
            case 3:
                return json.dumps(record)[:40]
            case 4:
                return ""
            case 5:
                return json.dumps(record | {"phone": 123, "document_id": "", "more": 1, "review_required": "yes"})
        return json.dumps(record, ensure_ascii=False)

    return lambda b: pd.Series([one(d, u) for d, u in zip(b.iloc[:, 0], b.iloc[:, 1], strict=True)])


@register("transcribe", "string")
def stub_transcriber() -> Batch:
    """What is to be said, as a transcript (UDF6)."""
    return lambda b: b.iloc[:, 0].map(lambda x: " ".join((x or "").split()))


def merged_passes(first: Column, regions: Column) -> Column:
    """A page's record with what its regions' records add, in order: the first value that isn't null or empty stays (UDF3).

    Both are maps of texts.
    """
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    solid = lambda m: F.map_filter(m, lambda _, v: F.coalesce(v, F.lit("")) != "")
    add = lambda acc, m: F.map_concat(acc, F.map_filter(solid(m), lambda k, _: ~F.array_contains(F.map_keys(acc), k)))
    return F.aggregate(regions, F.coalesce(solid(first), empty), add)


@register("text_similarity", "double")
def stub_similarity() -> Batch:
    """A pair's similarity by shared hashed words: the place of a model's metric, averaged by the caller (AGG12)."""

    def one(a: str | None, b: str | None) -> float:
        x, y = set((a or "").lower().split()), set((b or "").lower().split())
        return 2 * len(x & y) / (len(x) + len(y)) if x or y else 1.0

    return lambda batch: pd.Series([one(a, b) for a, b in zip(batch.iloc[:, 0], batch.iloc[:, 1], strict=True)])
