"""Byte-pair encoding and decoding with contiguous rank arrays.

A word is held as its part boundaries and, beside them, the rank of each adjacent pair of parts.  The
smallest rank is found by a scan, its inner boundary is deleted and the two neighbouring ranks are
looked up again.  That is quadratic in the word, so words over ``SHORT`` bytes use a heap over linked
boundaries instead; both merge the leftmost pair of the lowest rank first.

Nulls and empty texts have no ids and decode to the empty text.  Special tokens' strings in a text
become their ids, as the library does by default.  Rows are independent: ties, repeated rows and
further columns change nothing, and an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from paperloom.llm.common import lean
from paperloom.llm.tokens import BYTE_PATTERN, MEMO_ENTRIES, Memo, SpaceLed, byte_letters

SHORT = 128
NONE = 1 << 60


class RankBpe:
    """A byte-level vocabulary: ``encode(text) -> numpy ids`` and ``decode(ids) -> text``."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        to_byte = {c: b for b, c in byte_letters().items()}
        vocab = spec["model"]["vocab"]
        as_bytes = {token: bytes(map(to_byte.__getitem__, token)) for token in vocab if all(c in to_byte for c in token)}
        self.ids = {as_bytes[token]: i for token, i in vocab.items() if token in as_bytes}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        #: What a merge makes, by its two parts: the same bytes can be made by one merge only.
        self.ranks = {(as_bytes[a], as_bytes[b]): k for k, (a, b) in enumerate(pairs)}
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.firsts = {token[0] for token in self.special if token}
        self.bytes_of = {i: b for b, i in self.ids.items()} | {i: s.encode() for s, i in self.special.items()}
        self.split = regex.compile(BYTE_PATTERN).findall
        self.words = Memo(self._word, MEMO_ENTRIES // 10)
        self.whole = self._piece if any(x.isspace() for token in self.special for x in token) else SpaceLed(self._word, self._piece)

    def merge_short(self, word: bytes) -> list[int]:
        """The ids of a word by scans over its rank array."""
        rank, bounds = self.ranks.get, list(range(len(word) + 1))
        ranks = [rank((word[i : i + 1], word[i + 1 : i + 2]), NONE) for i in range(len(word) - 1)]
        while ranks and (low := min(ranks)) < NONE:
            i = ranks.index(low)
            del bounds[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = rank((word[bounds[i] : bounds[i + 1]], word[bounds[i + 1] : bounds[i + 2]]), NONE)
            if i:
                ranks[i - 1] = rank((word[bounds[i - 1] : bounds[i]], word[bounds[i] : bounds[i + 1]]), NONE)
        return [self.ids[word[a:b]] for a, b in zip(bounds, bounds[1:], strict=False)]

    def merge_long(self, word: bytes) -> list[int]:
        """The same ids for a long word in n log n: pairs wait in a heap by rank and place."""
        n = len(word)
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        heap: list[tuple[int, int, int, int]] = []

        def push(i: int) -> None:
            j = end[i]
            if j < n and (r := self.ranks.get((word[i:j], word[j : end[j]]))) is not None:
                heapq.heappush(heap, (r, i, j, end[j]))

        for i in range(n - 1):
            push(i)
        while heap:
            _, i, j, k = heapq.heappop(heap)
            if not (alive[i] and j < n and alive[j] and end[i] == j and end[j] == k):
                continue  # one of its parts has been merged since
            alive[j], end[i] = False, k
            if k < n:
                before[k] = i
            push(i)
            if before[i] >= 0:
                push(before[i])
        out, i = [], 0
        while i < n:
            out.append(self.ids[word[i : end[i]]])
            i = end[i]
        return out

    def _word(self, word: str) -> bytes:
        raw = word.encode()
        if raw in self.ids and len(raw) == 1:
            return self.ids[raw].to_bytes(4, "little")
        return np.array((self.merge_short if len(raw) <= SHORT else self.merge_long)(raw), dtype="<u4").tobytes()

    def _piece(self, text: str) -> bytes:
        if self.cut is None or not any(x in text for x in self.firsts):
            return b"".join(map(self.words.__getitem__, self.split(text)))
        out = []
        for k, part in enumerate(self.cut.split(text)):
            out.append(self.special[part].to_bytes(4, "little") if k % 2 else b"".join(map(self.words.__getitem__, self.split(part))))
        return b"".join(out)

    def encode(self, text: str | None) -> np.ndarray:
        return np.frombuffer(self.whole(text) if text else b"", dtype="<u4")

    def decode(self, ids: Iterable[int]) -> str:
        """Unknown ids are left out; bytes that aren't UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes_of.get, (i for i in ids if i in self.bytes_of))).decode("utf-8", "replace")


_vocabularies: dict[str, RankBpe] = {}


def vocabulary(path: str) -> RankBpe:
    if path not in _vocabularies:
        _vocabularies[path] = RankBpe(path)
    return _vocabularies[path]


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids array<int>) of every whole text."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in batches:
            ids = [bpe.encode(x).astype(np.int32) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(lean(run), f"doc_id {kind}, ids array<int>")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of ids that ``encode_documents`` has given; null ids decode to the empty text."""
    kind = dict(encoded.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in batches:
            texts = [bpe.decode(x or []) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(lean(run), f"doc_id {kind}, text string")


def digest(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encode, then decode the ids, in one pass over the texts."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in batches:
            counts, ids_sha, text_sha = [], [], []
            for text in batch.column("text").to_pylist():
                ids = bpe.encode(text).tolist()
                counts.append(len(ids))
                ids_sha.append(hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
                text_sha.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(lean(run), f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
