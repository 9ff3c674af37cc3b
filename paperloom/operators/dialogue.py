"""Conversations that are answered from passages, a turn at a time (STA7).

What a turn asks for depends on the history, and the history on the answers before it.  So a state table (conversation,
history) goes through rounds by turn number: each round takes the turns of that number, rewrites their questions with the folded
history, retrieves from an index that was embedded and dealt to its centres once, answers, and folds.  All conversations go
through a round together, so there are as many rounds as the longest conversation has turns, whatever their number.

Each round is a table in the folder of the run.  A run that is started again on the same folder goes on after the last complete round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paperloom.functions import constants as K
from paperloom.functions import jsonx, text
from paperloom.operators import folds, joins, providers
from paperloom.session import scratch, with_checkpoints

#: What a provider is told to do with a question's passages, by language.
TASK = {"en": "Answer in one or two sentences, only from the passages.", "ar": "أجب في جملة أو جملتين من السياق فقط."}


class Index:
    """Passages (vec_id long, faq_id, lang, question, answer, tags), embedded once and dealt to centres once for all rounds."""

    def __init__(self, passages: DataFrame, embedder: str = "embed") -> None:
        with_checkpoints(passages.sparkSession)
        told = passages.withColumn("passage", text.passage(F.col("question"), F.col("answer"), F.col("faq_id"), F.col("tags")))
        embedded = providers.call(told, embedder, ["passage"], "embedding").checkpoint()
        self.embedder, self.centres = embedder, joins.dealt_store(embedded)
        self.passages = joins.sized(embedded.select("vec_id", "faq_id", "lang", "question", "answer"))

    def hits(self, asked: DataFrame, k: int = 5) -> DataFrame:
        """``asked`` (row long, query, lang, ...) with ``hits``: of its 2 k nearest passages those of its own language first, k in all (JOI10)."""
        vectors = providers.call(asked.select(F.col("row").alias("vec_id"), F.concat(F.lit("query: "), "query").alias("q")), self.embedder, ["q"], "embedding")
        near = joins.top_k_similar(vectors, self.centres, 2 * k, same_ids=False).join(self.passages, "vec_id")
        hit = F.struct("rank", "lang", "faq_id", "question", "answer")
        found = near.groupBy(F.col("query_id").alias("of")).agg(F.array_sort(F.collect_list(hit)).alias("found"))
        joined = asked.join(found, asked["row"] == found["of"], "left")
        own = lambda same: F.filter("found", lambda h: (h.lang == F.col("lang")) if same else (h.lang != F.col("lang")))
        return joined.withColumn("hits", F.slice(F.concat(own(True), own(False)), 1, k)).drop("of", "found")


def truthy(payload: Column, field: str) -> Column:
    """Whether a field of a JSON object counts as true: not false, nought, null or empty."""
    raw = F.to_json(F.try_variant_get(F.try_parse_json(payload), f"$.{field}", "variant"))
    return F.coalesce(~raw.isin("false", "null", '""', "[]", "{}", "0", "-0", "0.0"), F.lit(False))


def standalone(rows: DataFrame, rewriter: str = "rewrite") -> DataFrame:
    """``rows`` (question, history) with ``query``: the question as it stands without its history (SCL12).

    The provider replies with JSON of ``depends`` and ``rewrite``; it is asked only where there is a question and a history.
    """
    given = (F.col("question") != "") & (F.col("history") != "")
    asked = rows.withColumns({c: F.when(given, F.col(c.removeprefix("asked_"))) for c in ("asked_history", "asked_question")})
    said = providers.call(asked, rewriter, ["asked_history", "asked_question"], "said").withColumn("said", jsonx.greedy_object(F.col("said")))
    query = text.guarded_rewrite(F.col("question"), jsonx.at(F.col("said"), "rewrite"), truthy(F.col("said"), "depends"))
    return said.withColumn("query", query).drop("asked_history", "asked_question", "said")


def context(hits: Column) -> Column:
    """The passages of a prompt, repeated ones once, within their limit."""
    label = lambda h, en, ar: F.when(h.lang == "ar", ar).otherwise(en)
    block = lambda h: F.concat(label(h, "Q: ", "س: "), h.question, label(h, "\nA: ", "\nج: "), h.answer, label(h, "\nSource: ", "\nالمصدر: "), h.answer)
    distinct = F.array_distinct(F.transform(hits, lambda h: F.struct(h.lang.alias("lang"), h.question.alias("question"), h.answer.alias("answer"), h.faq_id.alias("faq_id"))))
    return text.truncate_head(F.array_join(F.transform(distinct, block), "\n\n---\n\n"), K.CONTEXT_CHARS)


def answered(rows: DataFrame, index: Index, k: int = 5, rewriter: str = "rewrite", chat: str = "chat") -> DataFrame:
    """One turn of many conversations: ``rows`` (row, question, history, ...) with query, ids, answer, and the history after it.

    An answer keeps only Arabic letters, digits and marks, as the application has it, whatever the language; what is left
    empty becomes the notice that nothing was found.
    """
    clean = rows.withColumns({c: text.squeeze(F.col(c)) for c in ("question", "history")})
    clean = clean.withColumn("lang", text.detect_language(F.when(F.col("question") != "", F.col("question")).otherwise(F.col("history"))))
    found = index.hits(standalone(clean, rewriter), k)
    some = F.coalesce(F.size("hits") > 0, F.lit(False))
    by_language = F.when(text.detect_language(F.col("query")) == "ar", TASK["ar"]).otherwise(TASK["en"])
    prompt = text.prompt(by_language, F.col("query"), context(F.col("hits")))
    said = providers.call(found.withColumn("prompt", F.when(some, prompt)), chat, ["prompt"], "said")
    nothing = F.when(F.col("lang") == "ar", K.INSUFFICIENT_AR).otherwise(K.INSUFFICIENT_EN)
    answer = F.when(some, F.coalesce(F.nullif(text.keep_only(F.trim("said")), F.lit("")), nothing)).otherwise(nothing)
    told = said.withColumn("answer", answer)
    named = F.when(some, text.with_entity(F.col("answer"), F.transform("hits", lambda h: h.question))).otherwise(F.col("answer"))
    told = told.withColumn("history", folds.append_turn(F.col("history"), F.col("question"), named))
    return told.withColumn("ids", F.coalesce(F.transform("hits", lambda h: h.faq_id), F.array().cast("array<string>"))).drop("hits", "prompt", "said", "lang")


def _complete(spark: SparkSession, path: str) -> bool:
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


def converse(turns: DataFrame, passages: DataFrame, k: int = 5, folder: str | None = None, rewriter: str = "rewrite", chat: str = "chat", embedder: str = "embed") -> DataFrame:
    """(conv_id, turn, question, query, ids, answer, history) of every turn of (conv_id, turn, question).

    Turns go by ``turn``, then question.  Rows without a conv_id are one conversation.  A conversation's own turns
    wait for each other; all else is dealt by conversation.  ``folder`` keeps the rounds, for a run to go on with.
    """
    spark = turns.sparkSession
    folder = folder or scratch(spark, "conversations")
    order = Window.partitionBy("conv_id").orderBy("turn", "question")
    numbered = turns.select("conv_id", "turn", F.coalesce("question", F.lit("")).alias("question"), F.row_number().over(order).alias("k")).withColumn("row", F.monotonically_increasing_id())
    if not _complete(spark, f"{folder}/turns"):
        # Turns of one number lie together, large numbers of them in several files.
        numbered.hint("rebalance", "k").write.partitionBy("k").mode("overwrite").parquet(f"{folder}/turns")
    stored = spark.read.schema(numbered.schema).parquet(f"{folder}/turns")
    last = stored.agg(F.max("k")).first()[0] or 0
    index, rounds = None, []
    for n in range(1, last + 1):
        path = f"{folder}/rounds/n={n}"
        if not _complete(spark, path):
            index = index or Index(passages, embedder)
            rows = stored.where(F.col("k") == n).drop("k")
            if n > 1:
                state = spark.read.parquet(rounds[-1]).select(F.col("conv_id").alias("of"), F.col("history"))
                rows = rows.join(state, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")
            else:
                rows = rows.withColumn("history", F.lit(""))
            done = answered(rows, index, k, rewriter, chat)
            done.select("conv_id", "turn", "question", "query", "ids", "answer", "history").write.mode("overwrite").parquet(path)
        rounds.append(path)
    if not rounds:
        return stored.select("conv_id", "turn", "question", F.col("question").alias("query"), F.array().cast("array<string>").alias("ids"), F.col("question").alias("answer"), F.col("question").alias("history"))
    return spark.read.parquet(*rounds)
