"""What the training-data operators share: durable scratch folders, size-checked broadcasts and training samples."""

from __future__ import annotations

import ctypes
import gc
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of at most so many narrow rows may be broadcast; beyond it the same join shuffles.
BROADCAST_ROWS = 100_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors and the driver share, as the cluster names it.

    Where ``spark.checkpoint.dir`` is unset, a session in local mode (tests) gets a temporary folder; on a
    cluster that is an error, as each executor would write to a disk of its own.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        context = spark.sparkContext._jsc.sc().getCheckpointDir()
        if context.isDefined():
            found = context.get().rsplit("/", 1)[0]
        elif re.match(r"local(\[|$)", spark.sparkContext.master):
            found = "file://" + tempfile.mkdtemp(prefix="paperloom-")
        else:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors and the driver share")
        spark.conf.set("spark.checkpoint.dir", found)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(found)
    return re.sub("^file:/(?!/)", "file:///", found.rstrip("/"))


def scratch(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends in files that outlive executors.

    The files are deleted when the driver's JVM ends; ``dropped`` deletes them earlier.
    """
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    df.write.parquet(path)
    _folder(spark, path)[0].deleteOnExit(_folder(spark, path)[1])
    return spark.read.schema(df.schema).parquet(path)


def dropped(spark: SparkSession, *tables: DataFrame) -> None:
    """Deletes the files of stored tables that nothing will read again."""
    for table_ in tables:
        for file in table_.inputFiles()[:1]:
            fs, path = _folder(spark, file.rsplit("/", 1)[0])
            fs.delete(path, True)


def _folder(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], rows: int = 500):
    """``run`` over slices of at most ``rows`` rows, so that few texts are Python objects at once; its worker gives its memory back at the end."""

    @wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batch.slice(at, rows) for batch in batches for at in range(0, max(1, batch.num_rows), rows))
        finally:
            released()

    return wrapped


def released() -> None:
    """Gives free memory of this process back to the machine, as workers are kept for later tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not with this C library
        pass


def small_side(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has been counted and is at most ``limit`` rows, else as it is."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder; one of fewer splits than cores is dealt to all cores, as texts cost more than their shuffle."""
    rows, cores = spark.read.parquet(f"{sf_dir}/{name}.parquet"), spark.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows._jdf.rdd().getNumPartitions() < cores else rows


def training_rows(docs: DataFrame, labels: DataFrame, label: str, limit: int, keep: str = "true") -> DataFrame:
    """(text, label, row) of at most ``limit`` labelled documents, taken in the order of a hash of their ids; stored.

    Labels are rows of ``labels`` (doc_id, label) that ``keep`` picks; null ids and labels are none.  Of
    repeated rows of one id, text and label one counts; ``row`` tells the documents apart.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).select(F.col("doc_id").cast("long").alias("id"), F.col(label).cast("int").alias("label"))
    order = (F.xxhash64("id"), "id", "label")
    known = known.where(keep).distinct().orderBy(*order).limit(limit)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.join(F.broadcast(known), F.col("doc_id") == F.col("id")).select("id", "label", F.coalesce(F.md5("text"), F.lit("")).alias("key"), "text")
    sample = rows.select("id", "label", "key").distinct().orderBy(*order, "key").limit(limit)
    sample = sample.select(F.col("id").alias("of"), F.col("label").alias("is"), F.col("key").alias("with"))
    same = (F.col("id") == F.col("of")) & (F.col("label") == F.col("is")) & (F.col("key") == F.col("with"))
    picked = rows.join(F.broadcast(sample), same, "left_semi").dropDuplicates(["id", "label", "key"])
    return stored(picked.select("text", "label", F.concat_ws(":", F.col("id").cast("string"), "key").alias("row")), "training-rows")
