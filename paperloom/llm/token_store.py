"""Token ids in binary shards that can be read one document at a time.

A shard is a run of independent zstandard frames, a skippable frame with the documents' index, and a
trailing seek table in the published seekable format: compressed size, size and checksum (the low 32
bits of XXH64) of each frame.  Any zstandard reader can decompress a shard whole; ``ShardReader``
decompresses only the frames that a document's ids lie in, and verifies their checksums.

Documents lie in ascending ``doc_id`` order over all shards (a null id first; rows of one id by text), about
``SHARD_CHARS`` characters of text a shard; rows of one id whose texts begin alike are in one shard.
A null text counts as empty: such a document has its end id alone.  Repeated rows are all written, very long
texts take several frames, and further columns of any name are not read.  An empty table makes no
shard, and reading it gives no rows.
"""

from __future__ import annotations

import io
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paperloom.llm.common import lean, scratch
from paperloom.llm.tokens import encoder

#: Fixed values of the seekable format and of skippable frames.
SEEK_SKIPPABLE, SEEK_FOOTER, INDEX_SKIPPABLE = 0x184D2A5E, 0x8F92EAB1, 0x184D2A50
#: A frame ends with the first document that takes it to so many bytes; longer documents are cut there.
FRAME_BYTES = 1 << 17
SHARD_CHARS = 1 << 25


class ShardWriter:
    """Writes ids of documents, one after the other, to a binary stream."""

    def __init__(self, out, width: int, level: int = 3):
        self.out, self.width, self.packer = out, width, zstandard.ZstdCompressor(level=level, write_content_size=True)
        self.buffer, self.frames = bytearray(), []
        self.doc_ids, self.nulls, self.counts = array("q"), bytearray(), array("Q")

    def _frame(self, data: bytes) -> None:
        packed = self.packer.compress(data)
        self.out.write(packed)
        self.frames.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.doc_ids.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        self.counts.append(len(ids) // self.width)
        self.buffer += ids
        while len(self.buffer) >= 2 * FRAME_BYTES:
            self._frame(bytes(self.buffer[:FRAME_BYTES]))
            del self.buffer[:FRAME_BYTES]
        if len(self.buffer) >= FRAME_BYTES:
            self._frame(bytes(self.buffer))
            self.buffer.clear()

    def close(self) -> None:
        if self.buffer:
            self._frame(bytes(self.buffer))
        index = struct.pack("<BQ", self.width, len(self.counts)) + np.array(self.doc_ids, "<i8").tobytes() + bytes(self.nulls) + np.array(self.counts, "<u8").tobytes()
        index = zstandard.ZstdCompressor(level=3, write_content_size=True, write_checksum=True).compress(index)
        self.out.write(struct.pack("<II", INDEX_SKIPPABLE, len(index)) + index)
        table = b"".join(struct.pack("<III", *x) for x in self.frames) + struct.pack("<IBI", len(self.frames), 0x80, SEEK_FOOTER)
        self.out.write(struct.pack("<II", SEEK_SKIPPABLE, len(table)) + table)


class ShardReader:
    """Random access to a shard: ``ids`` and which are ``nulls`` (or both as ``doc_ids``), ``counts``, ``read(k)``."""

    def __init__(self, file):
        self.file, self.unpacker = file, zstandard.ZstdDecompressor()
        file.seek(0, io.SEEK_END)
        end = file.tell()
        file.seek(end - 9)
        n, flags, magic = struct.unpack("<IBI", file.read(9))
        if magic != SEEK_FOOTER or not flags & 0x80:
            raise ValueError("no seek table with checksums at the end of this file")
        top = end - 9 - 12 * n - 8
        file.seek(top)
        if struct.unpack("<II", file.read(8)) != (SEEK_SKIPPABLE, 12 * n + 9):
            raise ValueError("the seek table is damaged")
        entries = np.frombuffer(file.read(12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.sums = entries[:, 2]
        self.packed_at = np.concatenate([[0], np.cumsum(entries[:, 0])])
        self.at = np.concatenate([[0], np.cumsum(entries[:, 1])])
        file.seek(int(self.packed_at[-1]))
        magic, size = struct.unpack("<II", file.read(8))
        if magic != INDEX_SKIPPABLE:
            raise ValueError("the documents' index is missing")
        index = self.unpacker.decompress(file.read(size))
        self.width, docs = struct.unpack_from("<BQ", index)
        self.ids = np.frombuffer(index, "<i8", docs, 9)
        self.nulls = np.frombuffer(index, "u1", docs, 9 + 8 * docs).astype(bool)
        self.counts = np.frombuffer(index, "<u8", docs, 9 + 9 * docs).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])
        self.cached = (-1, b"")
        self.frames_read = 0

    @property
    def doc_ids(self) -> list[int | None]:
        return [None if null else int(i) for i, null in zip(self.ids, self.nulls, strict=True)]

    def frame(self, k: int) -> bytes:
        if self.cached[0] != k:
            self.file.seek(int(self.packed_at[k]))
            data = self.unpacker.decompress(self.file.read(int(self.packed_at[k + 1] - self.packed_at[k])))
            if xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.sums[k]:
                raise ValueError(f"frame {k} doesn't match its checksum")
            self.cached, self.frames_read = (k, data), self.frames_read + 1
        return self.cached[1]

    def read(self, k: int) -> np.ndarray:
        """The ids of the k-th document."""
        a, b = (int(x) * self.width for x in self.starts[k : k + 2])
        parts, f = [], int(np.searchsorted(self.at, a, "right")) - 1
        while a < b:
            stop = min(b, int(self.at[f + 1]))
            parts.append(self.frame(f)[a - int(self.at[f]) : stop - int(self.at[f])])
            a, f = stop, f + 1
        return np.frombuffer(b"".join(parts), f"<u{self.width}")


def write_shards(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = None) -> DataFrame:
    """Writes ``docs`` under ``path`` (a folder all executors share); the manifest: shard, file, docs, tokens.

    A task writes its shard under a name of its own and renames it when whole, so that a retried or
    speculative task leaves no damaged file.  The manifest is a table under ``path`` too.
    """
    spark = docs.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, writer = encoder(tokenizer), None
        tail = b"" if end_id is None else end_id.to_bytes(enc.width, "little")
        shard = TaskContext.get().partitionId()
        fs, folder = pa.fs.FileSystem.from_uri(path)
        part, final = f"{folder}/.{uuid.uuid4().hex}", f"{folder}/shard-{shard:07d}.ids.zst"
        for batch in batches:
            if writer is None and batch.num_rows:
                fs.create_dir(folder, recursive=True)
                out = fs.open_output_stream(part)
                writer = ShardWriter(out, enc.width)
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                writer.add(doc_id, enc.ids(text) + tail)
        if writer is not None:
            writer.close()
            out.close()
            fs.move(part, final)
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([f"shard-{shard:07d}.ids.zst"]), pa.array([len(writer.counts)], pa.int64()), pa.array([sum(writer.counts)], pa.int64())], ["shard", "file", "docs", "tokens"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(2 * spark.sparkContext.defaultParallelism, -(-chars // SHARD_CHARS))
    # A text's beginning only tells which shard a row of a repeated id goes to; all of it is written.
    ordered = rows.repartitionByRange(parts, "doc_id", F.left("text", F.lit(32))).sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(lean(run), "shard long, file string, docs long, tokens long").write.parquet(f"{path}/manifest")
    return spark.read.schema("shard long, file string, docs long, tokens long").parquet(f"{path}/manifest")


def read_shards(spark: SparkSession, path: str, manifest: DataFrame) -> DataFrame:
    """Every document of the shards: doc_id, start, n_tokens, ids_crc32, shard, frames.

    ``start`` counts the ids of all documents before it; the sum over shards is over one row for each.
    ``frames`` is how many frames the document's ids lie in.
    """
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = manifest.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = pa.fs.FileSystem.from_uri(path)
        for batch in batches:
            for row in batch.to_pylist():
                with fs.open_input_file(f"{folder}/{row['file']}") as file:
                    shard = ShardReader(file)
                    for at in range(0, len(shard.ids), 10_000):
                        k = range(at, min(at + 10_000, len(shard.ids)))
                        sums = [zlib.crc32(shard.read(i).astype("<u4")) for i in k]
                        first = np.searchsorted(shard.at, shard.starts[k.start : k.stop] * shard.width, "right")
                        last = np.searchsorted(shard.at, shard.starts[k.start + 1 : k.stop + 1] * shard.width, "left")
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(shard.ids[k.start : k.stop], pa.int64(), mask=shard.nulls[k.start : k.stop]), pa.array(row["base"] + shard.starts[k.start : k.stop]), pa.array(shard.counts[k.start : k.stop]), pa.array(sums, pa.int64()), pa.array([row["shard"]] * len(k), pa.int64()), pa.array(last - first + 1, pa.int64())],
                            ["doc_id", "start", "n_tokens", "ids_crc32", "shard", "frames"],
                        )

    spread = shards.repartition(max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), "shard")
    return spread.select("shard", "file", "base").mapInArrow(lean(run), "doc_id long, start long, n_tokens long, ids_crc32 long, shard long, frames long")


def read_documents(path: str, file: str, wanted: set[int]) -> dict[int, list[np.ndarray]]:
    """The ids of some documents of one shard; frames of other documents stay unread."""
    fs, folder = pa.fs.FileSystem.from_uri(path)
    with fs.open_input_file(f"{folder}/{file}") as f:
        shard, out = ShardReader(f), {}
        for k in np.flatnonzero(np.isin(shard.ids, list(wanted)) & ~shard.nulls).tolist():
            out.setdefault(int(shard.ids[k]), []).append(shard.read(k))
    return out


def store_and_read(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Writes ``docs`` to the shared folder and reads every shard back."""
    spark = docs.sparkSession
    path = scratch(spark, "token-store")
    return read_shards(spark, path, write_shards(docs, path, tokenizer, end_id))
