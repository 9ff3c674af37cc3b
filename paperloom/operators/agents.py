"""Questions about images, bounded tool loops, evidence and two-phase readings, as plans around providers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions import jsonx, text
from paperloom.operators import providers
from paperloom.operators.joins import sized
from paperloom.sources.writers import append_missing

#: Fixed value: the most model calls of a search.
TOOL_CALLS = 6
#: What is asked of an image and its text, and the words that make an answer certain.
CONSISTENCY = ("النص المذكور:\n", "\n\nهل الصورة تتفق مع هذا النص؟\nأجب بنعم أو لا أو غير واضح مع توضيح مختصر.")
CONTRADICTS, AGREES = "تناقض", "يتفق"
#: Fixed value: what a web search adds to a query that doesn't name it.
LOCALE = "مصر"


def vqa_prompt(question: Column, ocr: Column, context: Column) -> Column:
    """Context, recognised text and question, without the parts that are blank (SCL15)."""
    return text.prompt(context, ocr, question)


def consistency_question(ocr: Column) -> Column:
    """Whether the picture agrees with its text (UDF4)."""
    return F.concat(F.lit(CONSISTENCY[0]), F.coalesce(ocr, F.lit("")), F.lit(CONSISTENCY[1]))


def answer_questions(images: DataFrame, category: str, questions: Sequence[str], provider: str = "vqa") -> DataFrame:
    """(case_id, image_id, image_path, question, answer, confidence, question_type) of each image and question (UDF4).

    ``images``: case_id, pos, image_path, ocr.  Each image is asked all questions and whether it agrees with its
    text; an answer that fails is empty, with confidence 0.
    """
    asked = F.array(*(F.struct(F.lit(q).alias("question"), F.lit("question").alias("question_type")) for q in questions), F.struct(consistency_question(F.col("ocr")).alias("question"), F.lit("image_text_consistency").alias("question_type")))
    rows = images.select("case_id", "image_path", "ocr", F.format_string("IMG-%03d", F.col("pos") + 1).alias("image_id"), F.explode(asked).alias("q")).select("*", "q.*").drop("q")
    context = F.when(F.col("question_type") == "question", F.lit(f"Category: {category}")).otherwise(F.col("question"))
    answered = providers.call(rows.withColumn("prompt", vqa_prompt(F.col("question"), F.col("ocr"), context)), provider, ["image_path", "prompt"], "answer")
    said = F.coalesce("answer", F.lit(""))
    return answered.select("case_id", "image_id", "image_path", "question", said.alias("answer"), text.answer_confidence(said).alias("confidence"), "question_type")


def overall_confidence(answers: DataFrame) -> DataFrame:
    """A case's mean confidence over its questions, without those of consistency; 0 without any."""
    own = F.when(F.col("question_type") == "question", F.col("confidence"))
    return answers.groupBy("case_id").agg(F.countDistinct("image_id").alias("images"), F.round(F.coalesce(F.avg(own), F.lit(0.0)), 3).alias("overall_confidence"))


def answer_batch(images: DataFrame, description: str, questions: Sequence[str], provider: str = "vqa") -> DataFrame:
    """The same questions of a batch of images (UDF4): the text goes along with questions of contradiction or agreement, and plain answers are certain."""
    rows = images.select("case_id", "image_path", "ocr", F.posexplode(F.array(*map(F.lit, questions))).alias("question_no", "question"))
    compares = F.contains("question", F.lit(CONTRADICTS)) | F.contains("question", F.lit(AGREES))
    context = F.when(compares, F.concat(F.lit(f"{description}\n\nOCR:\n"), F.coalesce("ocr", F.lit("")))).otherwise(F.lit(description))
    answered = providers.call(rows.withColumn("prompt", vqa_prompt(F.col("question"), F.col("ocr"), context)), provider, ["image_path", "prompt"], "answer")
    said = F.coalesce("answer", F.lit(""))
    return answered.select("case_id", "image_path", "question_no", "question", said.alias("answer"), text.override_confidence(said, text.answer_confidence(said)).alias("confidence"))


def web_query(c: Column) -> Column:
    """A query with the place it is about, unless it names it (SRC19)."""
    return F.when(F.contains(c, F.lit(LOCALE)), c).otherwise(F.concat(c, F.lit(f" في {LOCALE}")))


def terms_within(queries: DataFrame, terms: DataFrame) -> DataFrame:
    """(query_id, term) of all terms that a query contains, in any case, wherever they begin.

    A term's first letters, as many as the shortest term has, are looked up among the query's runs of so many letters, so the join is by
    equality; what meets there is then verified. Blank terms are in nothing.
    """
    known = terms.select("term", F.lower("term").alias("low")).where("low <> ''").distinct()
    shortest = known.agg(F.min(F.length("low"))).first()[0]
    if not shortest:
        return queries.select("query_id").crossJoin(known.select("term")).limit(0)
    asked = queries.select("query_id", F.lower("query").alias("text")).where("text is not null")
    runs = F.array_distinct(F.regexp_extract_all("text", F.lit(f"(?s)(?=(.{{{shortest}}}))"), F.lit(1)))
    meets = asked.select("query_id", F.explode(runs).alias("run")).join(sized(known.withColumn("first", F.left("low", F.lit(shortest)))), F.col("run") == F.col("first"))
    met = meets.select(F.col("query_id").alias("of"), "term", "low")
    return asked.join(met, asked["query_id"] == met["of"]).where(F.contains("text", "low")).select("query_id", "term")


def web_results(queries: DataFrame, store: DataFrame, top: int = 3) -> DataFrame:
    """(query_id, context) of a search over a table of (term, rank, title, url, content), the stand-in for the web (SRC19)."""
    ranked = store.where(F.col("rank") <= top).withColumnRenamed("term", "of_term")
    hits = terms_within(queries, store.select("term")).join(sized(ranked), F.col("term") == F.col("of_term"))
    line = F.concat(F.lit("المصدر "), F.col("rank"), F.lit(": "), F.coalesce("title", F.lit("")), F.lit(" | الرابط: "), F.coalesce("url", F.lit("")), F.lit("\nالملخص: "), F.coalesce("content", F.lit("")), F.lit("\n\n"))
    said = hits.groupBy("query_id").agg(F.array_join(F.transform(F.slice(F.array_sort(F.collect_list(F.struct("rank", line.alias("line")))), 1, top), lambda x: x.line), "").alias("context"))
    return queries.select("query_id").join(said, "query_id", "left").select("query_id", F.coalesce("context", F.lit("لم يتم العثور على نتائج للبحث.")).alias("context"))


def tool_loop(cases: DataFrame, calls: int = TOOL_CALLS) -> DataFrame:
    """(case_id, model_calls, used, last) of a model that may ask for a tool each time, ``calls`` times at most (STA4).

    ``replies``: what the model says each time, as (tool, content); it goes on as long as it asks for a tool.
    """
    start = F.struct(F.lit(0).alias("n"), F.array().cast("array<string>").alias("used"), F.lit("").alias("last"), F.lit(False).alias("done"))

    def step(s: Column, r: Column) -> Column:
        asks = F.coalesce(r.tool, F.lit("")) != ""
        stop = ~asks | (s.n + 1 >= calls)
        moved = F.struct((s.n + 1).alias("n"), F.when(stop, s.used).otherwise(F.concat(s.used, F.array(r.tool))).alias("used"), F.coalesce(r.content, F.lit("")).alias("last"), stop.alias("done"))
        return F.when(s.done, s).otherwise(moved)

    walked = cases.select("case_id", F.aggregate(F.slice("replies", 1, calls), start, step).alias("s"))
    return walked.select("case_id", F.col("s.n").alias("model_calls"), F.col("s.used").alias("used"), F.col("s.last").alias("last"))


def search_result(reply: Column) -> Column:
    """The three lists of a search's last reply, or what it said as raw_fallback (STA4)."""
    return jsonx.repaired_search(reply)


def with_evidence(evidence: Column, name: str, value: Column) -> Column:
    """Evidence, a map of JSON texts, with one part put in and its siblings kept (STA11)."""
    kept = F.map_filter(F.coalesce(evidence, F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))), lambda k, _: k != name)
    return F.map_concat(kept, F.create_map(F.lit(name), value))


def read_in_phases(images: DataFrame, texts: str, records: str, reader: str = "transcribe", extractor: str = "read_page") -> DataFrame:
    """Recognised texts first, stored under ``texts``; then records from them, stored under ``records`` (UDF2).

    One provider is in memory at a time, and a run goes on where it broke off: what is stored isn't read again.
    ``images``: document_id, image.
    """
    spark = images.sparkSession
    for rows, provider, given, output, path in ((lambda: images, reader, "image", "text", texts), (lambda: spark.read.parquet(texts), extractor, "document_id", "reply", records)):
        left = rows()
        if spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()).exists(spark._jvm.org.apache.hadoop.fs.Path(path)):
            left = left.join(spark.read.parquet(path).select("document_id"), "document_id", "left_anti")
        append_missing(providers.call(left, provider, [given], output).select("document_id", output), path, "document_id")
    return spark.read.parquet(records).select("document_id", jsonx.lenient_object(jsonx.strip_fences(F.col("reply"))).alias("record"))


def rewritten(asked: DataFrame, provider: str = "chat") -> DataFrame:
    """``asked`` (question, history, ...) with a stand-alone form of each question, if its rewrite passes the guard (STA7, SCL12)."""
    depends = F.coalesce("history", F.lit("")) != ""
    said = providers.call(asked.withColumn("rewrite_prompt", text.prompt(F.col("history"), F.col("question"))), provider, ["rewrite_prompt"], "rewrite")
    return said.withColumn("question_alone", text.guarded_rewrite(F.col("question"), F.col("rewrite"), depends)).drop("rewrite_prompt", "rewrite")


def measured(rows: DataFrame, listing: DataFrame, keep_errors: bool) -> DataFrame:
    """Rows with whether their file is listed (FLT6): those without are left out, or kept with an error, as the two checks do."""
    files = listing.select("path").distinct().withColumn("there", F.lit(True))
    found = rows.join(files, rows["image_path"] == files["path"], "left").drop("path").withColumn("error", F.when(F.col("there").isNull(), "File not found")).drop("there")
    return found if keep_errors else found.where("error is null").drop("error")


def read_pairs(rows: DataFrame, pred: str = "pred") -> DataFrame:
    """Rows whose prediction isn't blank: others don't count in means (FLT7)."""
    return rows.where(F.trim(F.coalesce(pred, F.lit(""))) != "")
