"""Token counts kept as delta-maintained rollups by source, language and tokenizer version.

A change is an insert, a delete or a revision of a document's count.  Changes become signed
deltas, are added up by (source, lang, version) and are committed as one small table of a batch;
totals are the sum over committed batches and never need the documents again.

A commit is idempotent: a batch is written under a name of its own and counts from the moment its one-row entry is
in the ledger; a batch id that is in the ledger already is left as it is, so a retried or
repeated commit changes nothing.  If two writers commit one id at once, the first entry counts.
``compact`` folds committed batches into one (one compaction at a time) and keeps their ids, as rows of a
table, so that they stay committed; folds count from the moment that the compaction's own entry is in the ledger, and
then the folded batches' files go, so that what is listed grows with what came since.
No step gathers batches or their ids on the driver.

A null source, lang or version is a group of its own.  A null text counts as empty: one document of
no tokens.  A null count in a change counts as 0.  Repeated rows are changes each, very long texts are
counted whole, and further columns of any name are not read.  An empty batch commits no deltas but its id.
Totals of groups that have come down to no documents and no tokens are left out; an empty table has none.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paperloom.llm.common import lean, small_side
from paperloom.llm.tokens import encoder

KEYS = ("source", "lang", "version")
DELTAS = "source string, lang string, version string, docs long, tokens long"
ENTRIES = "batch string, part string, n long"
FOLDS = "batch string, part string"
COUNTS = "doc_id long, source string, lang string, h binary, version string, tokens long"
#: A text with more than this share of all rows is hot: there are at most 1 / HOT_SHARE of them.
HOT_SHARE = 1 / 1000


def counted(docs: DataFrame, tokenizer: str, version: str) -> DataFrame:
    """(doc_id, source, lang, h, version, tokens) of every whole text; h: its SHA-256, null for a null text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            n = [len(enc.ids(x)) // enc.width for x in batch.column("text").to_pylist()]
            kept = [batch.column(c) for c in ("doc_id", "source", "lang", "h")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array([version] * len(n), pa.string()), pa.array(n, pa.int64())], ["doc_id", "source", "lang", "h", "version", "tokens"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *(F.col(c).cast("string").alias(c) for c in ("source", "lang", "text")))
    return rows.withColumn("h", F.unhex(F.sha2("text", 256))).mapInArrow(lean(run), COUNTS)


def inserts(counts: DataFrame) -> DataFrame:
    """Deltas of new documents."""
    return counts.select(*KEYS, F.lit(1).cast("long").alias("docs"), F.coalesce("tokens", F.lit(0)).cast("long").alias("tokens"))


def deletes(counts: DataFrame) -> DataFrame:
    """Deltas that take documents back, by the counts they were inserted with."""
    return counts.select(*KEYS, F.lit(-1).cast("long").alias("docs"), (-F.coalesce("tokens", F.lit(0))).cast("long").alias("tokens"))


def revisions(old: DataFrame, new: DataFrame) -> DataFrame:
    """Deltas of documents counted anew: the old count goes, the new one comes."""
    return deletes(old).unionByName(inserts(new))


class Ledger:
    """Rollups under ``path``, a folder that all executors share: ``deltas/`` and ``folds/`` by part, ``entries/`` by batch."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _read(self, folder: str, schema: str, pattern: str = "") -> DataFrame:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}")
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{folder}{pattern}")

    def entries(self) -> DataFrame:
        """One row for each committed batch: the first entry of its id."""
        first = Window.partitionBy("batch").orderBy("n", "part")
        return self._read("entries", ENTRIES, "/*/").withColumn("k", F.row_number().over(first)).where("k = 1").drop("k")

    def folded(self) -> DataFrame:
        """(batch) ids that a compaction in the ledger has taken up."""
        by = self.entries().select(F.col("part").alias("into"))
        folds = self._read("folds", FOLDS)
        return folds.join(by, folds["part"] == by["into"], "left_semi").select("batch").distinct()

    def _enter(self, batch: str, part: str) -> None:
        n = self.entries().agg(F.coalesce(F.max("n"), F.lit(0))).first()[0] + 1
        row = self.spark.createDataFrame([(batch, part, n)], ENTRIES)
        row.coalesce(1).write.parquet(f"{self.path}/{self._entry(batch, part)}")

    def commit(self, batch: str, deltas: DataFrame) -> bool:
        """Adds a batch of deltas; False, and nothing done, if its id is committed already."""
        known = self.entries().select("batch").union(self.folded())
        if known.where(F.col("batch") == batch).head(1):
            return False
        part = uuid.uuid4().hex
        sums = deltas.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        sums.where("docs <> 0 or tokens <> 0").write.parquet(f"{self.path}/deltas/part={part}")
        self._enter(batch, part)
        return True

    def live(self) -> DataFrame:
        """Entries of batches that no compaction has taken up."""
        return self.entries().join(self.folded(), "batch", "left_anti")

    def _sums(self, live: DataFrame) -> DataFrame:
        deltas = self._read("deltas", DELTAS + ", part string")
        parts = small_side(live.select(F.col("part").alias("of")))
        rows = deltas.join(parts, deltas["part"] == parts["of"], "left_semi")
        return rows.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))

    def totals(self) -> DataFrame:
        """source, lang, version, docs, tokens over all committed batches."""
        return self._sums(self.live()).where("docs <> 0 or tokens <> 0")

    def compact(self) -> None:
        """Folds all committed batches into one; their ids stay committed, and their files go once the fold's entry is in.

        Run it while nobody reads totals that were asked for before: these still name the files.
        """
        part = uuid.uuid4().hex
        # The folds are written first: what is summed up is what they list, whatever is committed meanwhile.
        live = self.live().select("batch", F.lit(True).alias("now")).union(self.folded().select("batch", F.lit(False).alias("now")))
        live.write.parquet(f"{self.path}/folds/part={part}")
        folds = self.spark.read.schema("batch string, now boolean").parquet(f"{self.path}/folds/part={part}")
        taken = folds.where("now").select("batch")
        if len(taken.head(2)) < 2:
            self._delete(f"folds/part={part}")
            return
        self._sums(self.entries().join(taken, "batch", "left_semi")).write.parquet(f"{self.path}/deltas/part={part}")
        self._enter(f"compact:{part}", part)
        gone = self._read("entries", ENTRIES, "/*/").join(folds.select("batch"), "batch", "left_semi").select("batch", "part").distinct()
        for r in gone.toLocalIterator():  # a task's rows at a time
            # A fold's own list is in the new one.
            for old in (f"deltas/part={r['part']}", f"folds/part={r['part']}", self._entry(r["batch"], r["part"])):
                self._delete(old)

    @staticmethod
    def _entry(batch: str, part: str) -> str:
        return f"entries/{hashlib.sha256(batch.encode()).hexdigest()[:32]}-{part}"

    def _delete(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def copies_marked(counts: DataFrame, first: DataFrame, hot: DataFrame) -> DataFrame:
    """``counts`` with ``copy``: whether the row's text is on a row of a smaller doc_id.

    ``first``: (of, least, n), a row for each text; ``hot``: those of them that hold a large share of all rows,
    few by arithmetic and so broadcast, whose copies are marked without a shuffle.  All others are joined by hash.
    """
    hot = hot.select(F.col("of").alias("hot_of"), F.col("least").alias("hot_least"))
    marked = counts.join(F.broadcast(hot), counts["h"] == hot["hot_of"], "left")
    after = lambda least: F.coalesce(F.col("doc_id") > least, F.lit(False)).alias("copy")
    columns = counts.columns
    known = marked.where("hot_of is not null or h is null").select(*columns, after(F.col("hot_least")))
    rest = marked.where("hot_of is null and h is not null").select(*columns)
    cold = first.where("n > 1").select("of", "least")
    return known.union(rest.join(cold, rest["h"] == cold["of"], "left").select(*columns, after(F.col("least"))))


def maintained_totals(docs: DataFrame, path: str, old: tuple[str, str], new: tuple[str, str], moved: str = "lang <> 'en'") -> DataFrame:
    """A life of the rollups: every document is inserted under the ``old`` (tokenizer, version); later copies of a text (rows
    of a larger doc_id than its smallest) are deleted; the other documents that ``moved`` picks are counted anew under the
    ``new`` version.  A row without a doc_id is no copy.

    Each batch is committed twice, as after a lost answer; the second time does nothing.
    """
    spark = docs.sparkSession
    ledger = Ledger(spark, path)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *(F.col(c).cast("string").alias(c) for c in ("source", "lang", "text")))

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{path}/counts/{name}")
        return spark.read.schema(df.schema).parquet(f"{path}/counts/{name}")

    counts = kept(counted(rows, *old), "old")
    first = kept(counts.where("h is not null").groupBy(F.col("h").alias("of")).agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "first")
    hot = first.where(F.col("n") > F.lit(HOT_SHARE * max(1000, counts.count())))
    before = kept(copies_marked(counts, first, hot), "marked")
    again = copies_marked(counted(rows.where(moved), *new), first, hot).where("not copy")
    left = before.where(moved).where("not copy")
    for batch, deltas in (("load", inserts(before)), ("copies", deletes(before.where("copy"))), ("recount", revisions(left, again))):
        ledger.commit(batch, deltas)
        ledger.commit(batch, deltas)
    return ledger.totals()
