"""What built-in functions can't express, as Arrow-batched functions."""

from __future__ import annotations

import difflib
import json
import unicodedata
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.StringType())
def nfkc(s: pd.Series) -> pd.Series:
    """Compatibility composition (the middle step of TXT3)."""
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


@F.pandas_udf(T.DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff and Obershelp's ratio of matching blocks (UDF12); not symmetric."""
    return pd.Series([difflib.SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(a, b, strict=True)], dtype=float)


def common_length(a: str, b: str) -> int:
    """The length of the longest common subsequence, a column of the table at a time in the bits of whole numbers (Hyyrö)."""
    where: dict[str, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for y in b:
        here = row & where.get(y, 0)
        row = (row + here | row - here) & full
    return len(a) - row.bit_count()


def _indel(a: str, b: str) -> float:
    """100 * (1 - insertions and deletions / both lengths), by the longest common subsequence."""
    return 200.0 * common_length(a, b) / (len(a) + len(b)) if a or b else 100.0


def token_set(a: str, b: str) -> float:
    """Similarity of two texts as sets of words: what they share against what either has besides (UDF13)."""
    s, t = set(a.split()), set(b.split())
    if not s or not t:
        return 0.0
    shared = " ".join(sorted(s & t))
    if shared and (s <= t or t <= s):
        return 100.0
    one, two = (" ".join(x for x in (shared, " ".join(sorted(rest))) if x) for rest in (s - t, t - s))
    return max([_indel(one, two), *([_indel(shared, one), _indel(shared, two)] if shared else [])])


@F.pandas_udf(T.DoubleType())
def token_set_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([token_set(x or "", y or "") for x, y in zip(a, b, strict=True)], dtype=float)


def edits(a: Sequence[str], b: Sequence[str]) -> int:
    """Edit distance of two sequences, a column of the table at a time in the bits of whole numbers (Myers, Hyyrö)."""
    begin, end = 0, 0  # what both begin and end with alike changes nothing
    while begin < min(len(a), len(b)) and a[begin] == b[begin]:
        begin += 1
    while end < min(len(a), len(b)) - begin and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[begin : len(a) - end], b[begin : len(b) - end]
    a, b = sorted((a, b), key=len)
    rest = iter(b)
    if all(x in rest for x in a):  # a part of the other, in order: what the other has besides must be put in
        return len(b) - len(a)
    where: dict[str, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    full, last, score = (1 << len(a)) - 1, 1 << len(a) - 1, len(a)
    up, down = full, 0
    for x in b:
        here = where.get(x, 0)
        same = (((here & up) + up) ^ up | here | down) & full
        more, less = down | full & ~(same | up), same & up
        score += bool(more & last) - bool(less & last)
        more, less = (more << 1 | 1) & full, less << 1 & full
        up, down = less | full & ~(same | more), more & same
    return score


def _distances(a: pa.Array, b: pa.Array, read) -> pa.Array:
    """A row at a time becomes Python objects: a batch of whole texts, or of their words, would be many times its size."""
    found = []
    for x, y in zip(a, b, strict=True):
        found.append(None if not (x.is_valid and y.is_valid) else 0 if x.equals(y) else edits(read(x), read(y)))
    return pa.array(found, pa.int32())


@F.arrow_udf(T.IntegerType())
def list_distance(a: pa.Array, b: pa.Array) -> pa.Array:
    return _distances(a, b, lambda x: x.values.to_numpy(zero_copy_only=False).tolist())


@F.arrow_udf(T.IntegerType())
def text_distance(a: pa.Array, b: pa.Array) -> pa.Array:
    """Edit distance over characters, for texts of any length."""
    return _distances(a, b, lambda x: x.as_py())


class Literal(str):
    """A number as it is written."""


def _whole(text: str) -> Literal:
    return Literal(str(int(text)) if len(text) < 4000 else text)


def _float(text: str) -> Literal:
    value = float(text)
    return Literal(repr(value) if np.isfinite(value) else text)


def _no_number(text: str) -> None:
    raise ValueError(text)


def leaves_of(payload: str | None) -> Iterator[tuple[str, str | None, str]]:
    """(path, text, kind) of a JSON text's scalars and empty lists, in order; nothing if it doesn't parse."""
    try:
        root = json.loads(payload or "", parse_int=_whole, parse_float=_float, parse_constant=_no_number)
    except (ValueError, RecursionError):
        return
    open_ = [("", root)]
    while open_:
        path, x = open_.pop()
        if isinstance(x, dict):
            open_ += [(f"{path}.{k}" if path else k, v) for k, v in reversed(x.items())]
        elif isinstance(x, list) and x:
            open_ += [(f"{path}[{k}]", x[k]) for k in range(len(x) - 1, -1, -1)]
        elif isinstance(x, list):
            yield path, "[]", "list"
        elif x is None:
            yield path, None, "null"
        elif isinstance(x, bool):
            yield path, str(x).lower(), "boolean"
        else:
            yield path, str(x), "number" if isinstance(x, Literal) else "string"


def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """k, path, raw and vtype of every leaf of batches of (k, payload)."""

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column("k").take(pa.array(rows, pa.int64())), *(pa.array(c, pa.string()) for c in found)], ["k", "path", "raw", "vtype"])

    for batch in batches:
        rows: list[int] = []
        found: tuple[list, list, list] = ([], [], [])
        for i, payload in enumerate(batch.column("payload").to_pylist()):
            for leaf in leaves_of(payload):
                rows.append(i)
                for column, x in zip(found, leaf, strict=True):
                    column.append(x)
                if len(rows) >= 20_000:
                    yield made()
                    rows, found = [], ([], [], [])
        yield made()


def balanced(text: str | None) -> str | None:
    """The text if it is JSON as a whole, else its first balanced object; None if there is none (JSN2)."""
    if text is None:
        return None
    try:
        json.loads(text)
        return text.strip()
    except ValueError:
        pass
    start = text.find("{")
    if start < 0:
        return None
    try:
        _, end = json.JSONDecoder(strict=False).raw_decode(text, start)
        return text[start:end]
    except ValueError:
        return None


@F.pandas_udf(T.StringType())
def first_object(s: pd.Series) -> pd.Series:
    return s.map(balanced)


@F.pandas_udf(T.ArrayType(T.StringType()))
def harvest_texts(s: pd.Series) -> pd.Series:
    """The texts in a recogniser's nested reply, in order: rec_texts lists, or [box, (text, confidence)] pairs (JSN17)."""

    def walk(x) -> Iterator[str]:
        if isinstance(x, dict):
            if isinstance(x.get("rec_texts"), list):
                yield from (str(t) for t in x["rec_texts"])
            else:
                for v in x.values():
                    yield from walk(v)
        elif isinstance(x, list):
            if len(x) == 2 and isinstance(x[1], list) and len(x[1]) == 2 and isinstance(x[1][0], str):
                yield x[1][0]
            else:
                for v in x:
                    yield from walk(v)

    def parse(text: str | None) -> list[str]:
        try:
            return list(walk(json.loads(text or "null")))
        except ValueError:
            return []

    return s.map(parse)


@F.pandas_udf(T.ArrayType(T.FloatType()))
def unpack_floats(s: pd.Series) -> pd.Series:
    """Little-endian 32-bit floats from bytes (SCL21)."""
    return s.map(lambda b: None if b is None else np.frombuffer(b[: len(b) // 4 * 4], "<f4"))


@F.pandas_udf(T.BinaryType())
def pack_floats(s: pd.Series) -> pd.Series:
    return s.map(lambda v: None if v is None else np.asarray(v, "<f4").tobytes())


def variance_of_laplacian(grey: np.ndarray) -> float:
    """Sharpness: the variance of the 4-neighbour Laplacian, edges mirrored (IMG1)."""
    g = np.pad(np.asarray(grey, float), 1, mode="reflect")
    return float((g[:-2, 1:-1] + g[2:, 1:-1] + g[1:-1, :-2] + g[1:-1, 2:] - 4 * g[1:-1, 1:-1]).var())


STATS = T.StructType([*(T.StructField(x, T.DoubleType()) for x in ("mean", "std", "p2", "p98")), T.StructField("clipped", T.LongType()), T.StructField("sharpness", T.DoubleType())])


@F.pandas_udf(STATS)
def image_stats(pixels: pd.Series, width: pd.Series) -> pd.DataFrame:
    """Statistics of grey images given as rows of pixels, 0 to 255 (AGG22, IMG1)."""
    out = []
    for p, w in zip(pixels, width, strict=True):
        g = np.asarray(p, float)
        g = g[: len(g) // w * w].reshape(-1, w)
        out.append((g.mean(), g.std(), *np.percentile(g, (2, 98)), int(((g <= 0) | (g >= 255)).sum()), variance_of_laplacian(g)))
    return pd.DataFrame(out, columns=["mean", "std", "p2", "p98", "clipped", "sharpness"])


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def enhanced(pixels: pd.Series, gamma: pd.Series) -> pd.Series:
    """Percentile stretch to 0..255, then a gamma curve (the portable parts of IMG3)."""

    def one(p, g):
        x = np.asarray(p, float)
        low, high = np.percentile(x, (2, 98))
        x = np.clip((x - low) / max(high - low, 1e-9), 0, 1)
        return 255 * x ** (1 / g)

    return pd.Series([one(p, g) for p, g in zip(pixels, gamma, strict=True)])
