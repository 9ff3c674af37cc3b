"""Sinks: records, labels, reports, resumable and keyed tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.sources.part_log import BatchTable


def write_records(records: DataFrame, path: str, by: str | None = None) -> None:
    """JSON records, by a column's values if one is named (SNK1)."""
    writer = records.write.mode("overwrite").option("ignoreNullFields", "false")
    (writer.partitionBy(by) if by else writer).json(path)


def append_missing(rows: DataFrame, path: str, key: str) -> int:
    """Appends the rows whose key the table lacks, and says how many (SNK2, SNK5, STA8)."""
    spark, where = rows.sparkSession, rows.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
    there = where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)
    new = rows.join(spark.read.parquet(path).select(key), key, "left_anti") if there else rows
    new = new.dropDuplicates([key]).persist()
    n = new.count()
    if n:
        new.write.mode("append").parquet(path)
    new.unpersist()
    return n


def write_summary(summary: DataFrame, path: str) -> None:
    """One JSON document (SNK3)."""
    summary.coalesce(1).write.mode("overwrite").json(path)


def write_splits(rows: DataFrame, path: str, split: str = "split") -> None:
    """CSV by split (SNK4)."""
    rows.write.mode("overwrite").partitionBy(split).option("header", True).csv(path)


def write_lines(rows: DataFrame, line: Column, path: str, by: str | None = None) -> None:
    """Text lines such as labels (SNK7)."""
    out = rows.select(*([by] if by else []), line.alias("value"))
    writer = out.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).text(path)


def write_tsv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)


def upserted(store: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """A store with changed rows in place of those of the same key (SNK8)."""
    return store.join(changes.select(key).distinct(), key, "left_anti").unionByName(changes, allowMissingColumns=True)


def deleted(store: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return store.join(keys.select(key).distinct(), key, "left_anti")


def report(module: str, summary: DataFrame, results: DataFrame) -> DataFrame:
    """A module's report (SNK10) as rows (module, part, content): one of the summary, and one of each result, as JSON."""
    row = lambda df, part: df.select(F.lit(module).alias("module"), F.lit(part).alias("part"), F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("content"))
    return row(summary, "summary").union(row(results, "result"))


def write_report(module: str, summary: DataFrame, results: DataFrame, path: str) -> None:
    """The report as JSON lines, its one summary and its results in folders of their own; nothing is gathered."""
    for part, rows in (("summary", summary.coalesce(1)), ("results", results)):
        rows.select(F.lit(module).alias("module"), *rows.columns).write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/{part}")


def autosave(batches: Iterable[Callable[[], DataFrame]], table: BatchTable, run: str) -> int:
    """Adds each of a run's batches as it is done, and says how many: a run that is started again goes on after its last one (SNK6, STA8).

    A batch is given as a function, which isn't called for batches that are in the table.
    """
    added, last = 0, table.log.entry().done.get(run, -1)
    for number, batch in enumerate(batches):
        if number > last:
            added += table.add(run, number, batch())
    return added


def percent(part: Column, whole: Column, floor: bool = False) -> Column:
    """A share as it is printed: one decimal, or the whole percent below (SNK12)."""
    share = F.coalesce(F.try_divide(100 * part, whole), F.lit(0.0))
    return F.format_string("%d%%", F.floor(share)) if floor else F.format_string("%.1f%%", share.cast("double"))


def write_files(rows: DataFrame, path: str) -> None:
    """A file of each (name, content), as other programs leave them in a folder; each task writes its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, folder = fs.FileSystem.from_uri(path)
        for batch in batches:
            for name, content in zip(batch.column("name").to_pylist(), batch.column("content").to_pylist(), strict=True):
                system.create_dir(f"{folder}/{name}".rsplit("/", 1)[0], recursive=True)
                with system.open_output_stream(f"{folder}/{name}") as stream:
                    stream.write((content or "").encode())
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    rows.select("name", "content").mapInArrow(run, "n long").write.format("noop").mode("overwrite").save()
