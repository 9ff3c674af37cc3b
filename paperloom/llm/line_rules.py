"""Quality rules on lines: cross-document line frequency by host, and the base rules, as SQL expressions.

A line is normalised (lower case, trimmed) and hashed.  For each host
(``source``) the distinct documents that hold it are counted: by doc_id, rows without one by their text.  A
line is boilerplate on a host when more than ``max(min_docs, share * documents of the host)`` distinct
documents hold it.  With ``by_text`` copies of one text count once, for corpora whose copies go later: there a large group of
copies must not make boilerplate of its own lines, or none of it would stay.  Such lines are removed; a document that keeps under ``keep_share`` of its words, or
under ``min_words`` words, is depleted and rejected.  Only hashes and counts are shuffled, aggregated
before and after; texts never are.

A boilerplate line is in over ``share`` of its host's documents, so a host has at most (mean lines of
a document) / ``share`` of them: one array for each host, joined by a broadcast if there are few
hosts.

A null or empty text has no words and fails the base rules.  A null source is a host of its own.
Repeated rows of one id count once and get a row each.  Very long texts are read whole.  An empty
table gives an empty result.  Further columns of the input, of any name, are not read (``cleaned`` keeps them).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import small_side, stored

MIN_DOCS = 20
SHARE = 0.05
KEEP_SHARE = 0.5
MIN_WORDS = 50
BROADCAST_HASHES = 2_000_000
#: What separates words, and what counts as a symbol.
GAP = "[\\x20\\x09-\\x0D]+"
GAP_LETTERS = " \t\n\u000b\f\r"
SYMBOLS = "#*$%&|<>"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def has_word(line: Column) -> Column:
    return F.rlike(line, F.lit("[^\\x20\\x09-\\x0D]"))


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def line_hash(line: Column) -> Column:
    """Hash of a normalised line; null if the line has no word."""
    norm = F.btrim(F.lower(line), F.lit(GAP_LETTERS))
    return F.when(norm != "", F.xxhash64(norm))


def base_metrics(docs: DataFrame) -> DataFrame:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words beside doc_id, source and text.

    Words of repeated windows: the hashes of all 3-word windows are sorted with their places, those
    equal to a neighbour are the repeated ones, and their places, in order, cover up to three words.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split("text", "\n"), has_word)
    first = docs.select(F.col("doc_id"), F.col("source"), text.alias("text"))
    with_words = first.withColumn("w", words_of(F.col("text")))
    windows = F.transform(F.slice("w", 1, F.greatest(F.size("w") - 2, F.lit(0))), lambda w, i: F.struct(F.xxhash64(w, F.get("w", i + 1), F.get("w", i + 2)).alias("h"), i.alias("i")))
    hashed = with_words.select("*", F.sort_array(windows).alias("s"))
    hashed = hashed.select(
        "doc_id", "source", "text",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        (F.size(F.split("text", f"[{SYMBOLS}]", -1)) - 1).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        "s",
    )
    again = F.sort_array(F.filter(F.transform("s", lambda x, k: F.when((x.h == F.get("s", k - 1).h) | (x.h == F.get("s", k + 1).h), x.i)), lambda x: x.isNotNull()))
    placed = hashed.select("doc_id", "source", "text", "n_words", "word_chars", "n_symbols", "n_dup_lines", again.alias("p"))
    covered = F.aggregate(F.transform("p", lambda x, k: F.least(F.lit(3), F.coalesce(F.get("p", k + 1) - x, F.lit(3)))), F.lit(0), lambda a, x: a + x)
    return placed.select("doc_id", "source", "text", "n_words", "word_chars", "n_symbols", "n_dup_lines", covered.cast("long").alias("n_repeat_words"))


def boilerplate(docs: DataFrame, min_docs: int = MIN_DOCS, share: float = SHARE, by_text: bool = False) -> DataFrame:
    """(host, hashes): for each host the hashes of its lines above the limits.

    Counting goes by (host, line, document) first, so a line or host of a third of all rows is spread over
    many tasks before its count is summed.
    """
    own_text = F.xxhash64(F.coalesce("text", F.lit("")))
    document = own_text if by_text else F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", F.lit("id"))).otherwise(own_text)
    rows = docs.select(F.col("source").alias("host"), F.col("text"), document.alias("d"))
    named = rows.select("host", "d", F.explode(F.array_distinct(F.transform(lines_of(F.col("text")), line_hash))).alias("line"))
    seen = named.where("line is not null").groupBy("host", "line", "d").agg(F.lit(1).alias("n"))
    counts = seen.groupBy("host", "line").agg(F.sum("n").alias("n"))
    documents = rows.select("host", "d").groupBy("host", "d").agg(F.lit(1).alias("n"))
    hosts = documents.groupBy("host").agg(F.sum("n").alias("of")).withColumnRenamed("host", "in_host")
    over = counts.where(F.col("n") > min_docs).join(hosts, F.col("host").eqNullSafe(F.col("in_host")))
    over = over.where(F.col("n") > F.col("of") * share)
    return over.groupBy("host").agg(F.collect_set("line").alias("hashes"))


def with_verdict(docs: DataFrame, min_docs: int = MIN_DOCS, share: float = SHARE, keep_share: float = KEEP_SHARE, min_words: int = MIN_WORDS, by_text: bool = False) -> DataFrame:
    """doc_id, the base metrics, n_removed_words, base_failed, kept, and text without boilerplate lines."""
    found = stored(boilerplate(docs, min_docs, share, by_text), "boilerplate")
    if (found.agg(F.sum(F.size("hashes"))).first()[0] or 0) <= BROADCAST_HASHES:  # 8 bytes each
        found = small_side(found, 20_000)
    rows = base_metrics(docs)
    joined = rows.join(found, F.col("source").eqNullSafe(F.col("host")), "left")
    flagged = lambda line: F.coalesce(F.array_contains("hashes", line_hash(line)), F.lit(False))
    removed = F.when(F.col("hashes").isNotNull(), F.filter(F.split("text", "\n"), flagged))
    taken = joined.withColumn("removed", removed)
    lost = F.coalesce(F.aggregate("removed", F.lit(0), lambda a, x: a + F.size(words_of(x))), F.lit(0)).cast("long")
    text = F.when(F.size("removed") > 0, F.array_join(F.filter(F.split("text", "\n"), lambda x: ~flagged(x)), "\n")).otherwise(F.col("text"))
    judged = taken.select("doc_id", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", lost.alias("n_removed_words"), text.alias("text"))
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    left = F.col("n_words") - F.col("n_removed_words")
    depleted = (F.col("n_removed_words") > 0) & ((left < min_words) | (left < keep_share * F.col("n_words")))
    return judged.withColumn("base_failed", base).withColumn("kept", ~base & ~depleted)


def verdicts(docs: DataFrame) -> DataFrame:
    """The verdict of every document, without its text."""
    return with_verdict(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_removed_words", "base_failed", "kept")


def cleaned(docs: DataFrame) -> DataFrame:
    """The kept documents with all their columns, boilerplate lines removed from ``text``; lines are counted by texts, as copies go later.

    ``n_chars``, if there, is the length of the text that is left.  Rows are judged where they stand, so
    repeated ids need no join back.
    """
    rest = [c for c in docs.columns if c.lower() not in ("doc_id", "source", "text")]
    # The other columns travel in one struct beside the id, so that their names can't clash.
    beside = F.struct(*(F.col(f"`{c}`") for c in rest)) if rest else F.lit(0)
    judged = with_verdict(docs.select(F.struct("doc_id", beside.alias("rest")).alias("doc_id"), "source", "text"), by_text=True)
    # A filter pushed below the row number would repeat each array expression for each of its uses.
    kept = judged.withColumn("row", F.monotonically_increasing_id()).where((F.col("row") >= 0) & F.col("kept"))
    out = {"doc_id": F.col("doc_id.doc_id"), "source": F.col("source"), "text": F.col("text")}
    columns = []
    for c in docs.columns:
        if c.lower() == "n_chars":
            columns.append(F.length("text").cast(docs.schema[c].dataType).alias(c))
        else:
            columns.append((out[c.lower()] if c.lower() in out else F.col(f"doc_id.rest.`{c}`")).alias(c))
    return kept.select(*columns)
