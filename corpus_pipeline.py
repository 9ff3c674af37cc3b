"""From raw documents to packed sequences: toxicity, quality rules, near-duplicates, packing.

Each stage works on what its predecessor kept, written as Parquet and read again; all but the last
return the columns of ``documents``.  Rows are judged where they stand, so nulls in any column, repeated
rows and repeated ids are ordinary rows, further columns travel along whatever their names, very long
texts are read whole, and empty tables stay empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm import line_rules, packing, simhash, similar, toxicity
from paperloom.llm.common import small_side, stored, table
from paperloom.llm.queries import vocabulary


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal regression grades as toxic go; it learns from the labels of documents that are here."""
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def apply_line_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines above their host's limits are removed; documents that fail the base rules or are depleted go."""
    return line_rules.cleaned(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group stays: that of the smallest doc_id, a null id after all others.

    Texts are alike that share 0.8 of their five-word shingles.  SimHash anchors find pairs, their shingles decide (``similar``), so a
    document goes only if links of that similarity join it to the one that stays.

    Where the smallest id is on several rows of the group, the one of the smallest row key stays, so
    repeated and null ids keep no second row.
    """
    surplus = stored(similar.surplus(docs.select("doc_id", "text")), "surplus-rows")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("gone_id")) & (simhash.row_key() == F.col("gone_key"))
    # What goes is less than what stays: texts are shuffled only where even that is too much to broadcast.
    once = docs.join(small_side(surplus.select("gone_id", "gone_key")), same, "left_anti")
    repeated = surplus.where("not all_go")
    return once.union(docs.join(small_side(repeated), same, "left_semi").dropDuplicates(["doc_id", "text"])) if repeated.head(1) else once


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens, mixed over sources in proportion to what is left of them."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"), end_id=0)


STAGES = [("toxicity", drop_toxic), ("quality rules", apply_line_rules), ("near-duplicates", drop_near_duplicates), ("packing", pack_sequences)]
#: The first and the last stage can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
