"""The applications' flows as compositions of operators, with stand-in providers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.functions import constants as K
from paperloom.functions import jsonx, rules, schemas, text
from paperloom.operators import dialogue, folds, joins, providers
from paperloom.session import table


def extraction_pipeline(spark: SparkSession, d: str) -> DataFrame:
    """Pages to validated records: read, repair, fill in, validate, flag; what can't be parsed becomes an empty record."""
    pages = table(spark, d, "pages").select(F.concat(F.lit("page_"), "page_id").alias("document_id"), "url", F.array("url").alias("files"))
    read = providers.call(pages, "read_form", ["document_id", "url"], "reply", retry_if=lambda replies: replies == "")
    parsed = read.withColumn("payload", jsonx.lenient_object(jsonx.strip_fences(F.col("reply"))))
    payload = F.when(F.col("payload") == "{}", jsonx.fallback_record(F.col("document_id"), F.col("files"), F.lit("the reply was not valid JSON"))).otherwise(F.col("payload"))
    filled = parsed.withColumn("payload", jsonx.completed(payload, F.col("document_id"), F.col("files")))
    judged = filled.withColumn("errors", schemas.compiled(schemas.case_schema())(F.col("payload")))
    judged = jsonx.with_defaults(judged, "payload", "document_id", "files")
    flags = jsonx.review_flags(F.col("errors"), F.col("review_required"), F.col("review_notes"), F.col("uncertain_fields"))
    out = judged.withColumn("flags", flags)
    return out.select("document_id", "record_id", "record_pages", F.array_join("errors", "; ").alias("errors"), F.col("flags.review_required").alias("review"), F.array_join("flags.uncertain_fields", ",").alias("uncertain"), F.size("flags.review_notes").alias("notes"))


def case_pipeline(spark: SparkSession, d: str) -> DataFrame:
    """Cases through intake, evidence, risk, routing and a report's decision."""
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("case_id"), "text", F.lower("source").alias("user"))
    intake = docs.select("case_id", "user", text.consolidated(F.col("text"), F.lit(None).cast("string"), F.lit(None).cast("array<string>")).alias("case"))
    v = table(spark, d, "embeddings")
    near = joins.duplicate_split(joins.top_k_similar(v, v, 10), v.select("vec_id", F.col("label").alias("user")), 0.4)
    images = providers.call(near.withColumn("case_id", F.col("query_id")), "ai_probability", ["query_id"], "ai")
    risk = rules.risk_profile(F.col("ai"), F.col("same_user"), F.col("other_user"), (F.col("query_id") % 89) / 88)
    worst = images.select("case_id", risk.alias("r")).groupBy("case_id").agg(F.max("r.risk_score").alias("risk"), F.count("*").alias("images"))
    joined = intake.join(worst, "case_id", "left").withColumns({"risk": F.coalesce("risk", F.lit(0.0)), "images": F.coalesce("images", F.lit(0))})
    wish = F.when(F.col("risk") >= K.RISK_MEDIUM, "vqa").otherwise("report")
    walked = joined.join(folds.inquiry(joined.select("case_id", F.array(wish, F.lit("search"), F.lit("report")).alias("steps"))), "case_id")
    decision = F.when(F.col("risk") >= K.RISK_HIGH, "reject").when(F.col("risk") >= K.RISK_MEDIUM, "review").otherwise("approve")
    return walked.select("case_id", F.length("case.extracted_text").alias("chars"), "images", "risk", rules.risk_level(F.col("risk")).alias("level"), "path", decision.alias("decision"))


#: Every third item and conversation is written in Arabic letters, as the tables have none.
LATIN, ARABIC = "aeioutnshr", "ايوكمتنسهر"


def _lettered(c: Column, number: Column) -> Column:
    return F.when(number % 3 == 0, F.translate(c, LATIN, ARABIC)).otherwise(c)


def rag_pipeline(spark: SparkSession, d: str) -> DataFrame:
    """All conversations answered from the benchmark's passages, turn after turn: rewrite with the history, retrieve, answer, fold (``dialogue``)."""
    said = text.squeeze(_lettered(F.col("text"), F.col("item_id")))
    asked = F.regexp_extract(said, r"^[^.]*\.?", 0)
    passages = table(spark, d, "benchmark").select(F.col("item_id").alias("vec_id"), F.col("item_id").cast("string").alias("faq_id"), text.detect_language(said).alias("lang"), asked.alias("question"), said.alias("answer"), F.array().cast("array<string>").alias("tags"))
    turns = table(spark, d, "conversations").where("role = 'user'").select("conv_id", "turn", _lettered(F.col("text"), F.col("conv_id")).alias("question"))
    return dialogue.converse(turns, passages).select("conv_id", "turn", "query", F.array_join("ids", ",").alias("ids"), "answer", "history")
