"""A store of rows by key that changes in place: appended deltas, merged when read (SNK8, SRC15 to SRC17).

Every change is one appended part of rows or of tombstones, and one entry of the log (``part_log``).  A snapshot is what one
entry names.  Of each key the row of the highest sequence number counts, unless it is a tombstone.  The base, a part without
tombstones in which each key is there once, is not shuffled: the few keys of the deltas are taken out of it by an anti join,
broadcast if they were counted as few.  Filters on a snapshot reach the base's scan.

``compact`` folds base and deltas into a new base.  What was appended meanwhile stays as deltas after it.  Parts that no recent
entry names are deleted by ``vacuum``, so a reader of one of the last ``keep`` entries always finds its files.

A null key is an error.  Of rows with one key within one change the greatest (of all columns in order) counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom.operators.joins import sized
from paperloom.sources.part_log import Entry, Part, PartLog

SEQUENCE, DELETED = "_sequence", "_deleted"


class KeyedStore:
    def __init__(self, spark: SparkSession, path: str, key: str, schema: T.StructType | str) -> None:
        """A store at ``path``, there already or empty."""
        self.spark, self.key, self.log = spark, key, PartLog(spark, path)
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self._stored = T.StructType([*(T.StructField(f.name, f.dataType) for f in self.schema), T.StructField(DELETED, T.BooleanType())])

    def _write(self, rows: DataFrame) -> str:
        key = F.when(F.col(self.key).isNull(), F.raise_error(F.lit(f"a row of the store has no {self.key}"))).otherwise(F.col(self.key))
        return self.log.write(rows.withColumn(self.key, key))

    def _append(self, rows: DataFrame) -> int:
        name = self._write(rows)
        return self.log.enter(lambda last: Entry(0, (*last.parts, Part(name, last.version + 1)), last.done)).version

    def upsert(self, rows: DataFrame) -> int:
        """Rows put in, in place of those of the same keys; the number of the entry."""
        return self._append(rows.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema), F.lit(False).alias(DELETED)))

    def delete(self, keys: DataFrame) -> int:
        """Keys taken out, those that aren't there without effect; the number of the entry."""
        value = lambda f: (F.col(f.name) if f.name == self.key else F.lit(None)).cast(f.dataType).alias(f.name)
        return self._append(keys.select(*map(value, self.schema), F.lit(True).alias(DELETED)))

    def snapshot(self, version: int | None = None) -> DataFrame:
        """The rows as of an entry, by default the last; changes after it, and compaction, don't show."""
        parts, columns = self.log.entry(version).parts, [f.name for f in self.schema]
        base, deltas = [p for p in parts if p.base], [p for p in parts if not p.base]
        if not deltas:
            return self.log.read(base, self._stored).select(*columns)
        number = F.create_map(*(F.lit(x) for p in deltas for x in (p.name, p.sequence)))
        rows = self.log.read(deltas, self._stored).withColumn(SEQUENCE, number[F.regexp_extract("_metadata.file_path", "/data/([0-9a-f]{32})/", 1)])
        row = F.struct(*columns, DELETED)
        last = rows.groupBy(F.col(self.key).alias("_key")).agg(F.max_by(row, F.struct(SEQUENCE, DELETED, *columns)).alias("r"))
        changed = last.where(f"not r.{DELETED}").select(*(F.col(f"r.`{c}`").alias(c) for c in columns))
        if not base:
            return changed
        keys = sized(rows.select(F.col(self.key).alias("_key")).distinct())
        kept = self.log.read(base, self._stored).select(*columns)
        return kept.join(keys, kept[self.key] == keys["_key"], "left_anti").union(changed)

    def of_user(self, column: str, user: object, version: int | None = None) -> DataFrame:
        """A user's rows of a snapshot (SRC15)."""
        return self.snapshot(version).where(F.col(column) == user)

    def compact(self) -> bool:
        """Folds what the last entry names into a new base; False if there was nothing to fold, or another compaction was faster."""
        seen = self.log.entry()
        folded = seen.parts
        if not folded or (len(folded) == 1 and folded[0].base):
            return False
        name, names = self._write(self.snapshot(seen.version).withColumn(DELETED, F.lit(False))), {p.name for p in folded}

        def change(last: Entry) -> Entry | None:
            if not names <= {p.name for p in last.parts}:
                return None
            later = tuple(p for p in last.parts if p.name not in names)
            return Entry(0, (Part(name, max(p.sequence for p in folded), base=True), *later), last.done)

        if self.log.enter(change) is None:
            self.log.discard(name)
            return False
        return True

    def vacuum(self, keep: int = 1) -> int:
        return self.log.vacuum(keep)
