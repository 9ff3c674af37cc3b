"""The registered queries: each operator over the tables, and the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paperloom.functions import arrow_udfs as A
from paperloom.functions import constants as K
from paperloom.functions import jsonx, rules, schemas, text
from paperloom.operators import agents, folds, images, joins, metrics, providers, selection, sweep, windows
from paperloom.session import scratch, spread, table
from paperloom.sources import readers, vector_pages, writers
from paperloom.sources.keyed_store import KeyedStore
from paperloom.sources.part_log import BatchTable
from paperloom.streaming import streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with its SQL if it has any."""

    def wrap(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return wrap


def listed(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def any_in(column: str, words) -> str:
    return "(" + " OR ".join(f"contains({column}, '{w}')" for w in words) + ")"


def digest_sql(value: str, modulus: int) -> str:
    """What the stand-in providers compute: the first 8 bytes of SHA-256, the lowest first, as a number, modulo a small one."""
    terms = " + ".join(f"('0x' || substr(sha256({value}), {2 * i + 1}, 2))::BIGINT * {pow(256, i, modulus)}" for i in range(8))
    return f"(({terms}) % {modulus})"


# English twins of the word lists, for tables without Arabic.
URGENT, REQUEST, THANKS = ["and", "was"], ["the", "of"], ["is", "to"]
PLACES = ["the", "and", "der", "que", "les", "ción"]
STOPS = ["the", "and", "for", "that", "with"]
TWIN_DIALECT = [("the", "THE"), ("and", "&"), ("THE ", "the_"), ("ing", "in")]


def _records(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """A predicted and a reviewed record for each labelled document, apart in fixed places."""
    rows = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id")
    pred = rows.select("doc_id", F.to_json(F.struct(
        F.when(F.col("doc_id") % 7 == 0, F.lit("xx")).otherwise(F.col("lang")).alias("lang"),
        F.struct(F.col("source").alias("name"), F.when(F.col("doc_id") % 5 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars")).alias("size")).alias("from"),
        F.array("quality", F.when(F.col("doc_id") % 11 == 0, F.lit(9)).otherwise(F.col("toxic"))).alias("marks"),
    )).alias("payload"))
    gold = rows.select("doc_id", F.to_json(F.struct("lang", F.struct(F.col("source").alias("name"), F.col("n_chars").alias("size")).alias("from"), F.array("quality", "toxic").alias("marks"))).alias("payload"))
    return pred, gold


def _compared(spark: SparkSession, d: str) -> DataFrame:
    pred, gold = _records(spark, d)
    return joins.compared_fields(jsonx.flatten(pred, "doc_id", "payload"), jsonx.flatten(gold, "doc_id", "payload"), "doc_id")


COMPARED = """
    WITH b AS (SELECT doc_id, lang, source, n_chars, quality, toxic FROM documents JOIN labels USING (doc_id)),
    c AS (
        SELECT doc_id, 'lang' AS path, CASE WHEN doc_id % 7 = 0 THEN 'xx' ELSE lang END AS p, lang AS g FROM b
        UNION ALL SELECT doc_id, 'from.name', source, source FROM b
        UNION ALL SELECT doc_id, 'from.size', (n_chars + CASE WHEN doc_id % 5 = 0 THEN 1 ELSE 0 END)::VARCHAR, n_chars::VARCHAR FROM b
        UNION ALL SELECT doc_id, 'marks[0]', quality::VARCHAR, quality::VARCHAR FROM b
        UNION ALL SELECT doc_id, 'marks[1]', CASE WHEN doc_id % 11 = 0 THEN '9' ELSE toxic::VARCHAR END, toxic::VARCHAR FROM b
    )
"""


@query(COMPARED + """
    SELECT CASE grouping(doc_id, path) WHEN 3 THEN 'overall' WHEN 1 THEN 'document' ELSE 'path' END AS grain, doc_id, path,
           count(*) FILTER (p IS NOT DISTINCT FROM g) AS correct, count(*) AS total,
           round(count(*) FILTER (p IS NOT DISTINCT FROM g) / count(*), 4) AS accuracy
    FROM c GROUP BY GROUPING SETS ((doc_id), (path), ())""")
def benchmark_fields(spark, d):
    return metrics.accuracies(_compared(spark, d), "doc_id")


@query(COMPARED + """
    SELECT doc_id, string_agg(path || '=' || p || '/' || g, ';' ORDER BY path) AS wrong FROM c WHERE p IS DISTINCT FROM g GROUP BY doc_id""")
def benchmark_mismatches(spark, d):
    wrong = metrics.mismatches(_compared(spark, d), "doc_id")
    return wrong.select("doc_id", F.array_join(F.transform("wrong", lambda x: F.concat(x.path, F.lit("="), x.pred_value, F.lit("/"), x.gold_value)), ";").alias("wrong"))


@query(r"SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS clean FROM documents")
def normalize_ws(spark, d):
    return table(spark, d, "documents").select("doc_id", text.squeeze(F.col("text")).alias("clean"))


@query(r"SELECT doc_id, regexp_replace(regexp_replace(lower(trim(text)), '\s+', ' ', 'g'), '[^\p{L}\p{N}_\s]', '', 'g') AS clean FROM documents")
def normalize_ocr(spark, d):
    return table(spark, d, "documents").select("doc_id", text.normalize_ocr(F.col("text")).alias("clean"))


LITERALS = ["مُحَمَّد  إبراهيم ٢٠٢٤", " القاهرة، ", "سؤال: على المستشفى!", "سؤال قائمة إلى", "  Napa - 500 Mg. ", "محتاج علاج دلوقتي ٥٠٠ جنيه القاهرة", "شكراً لكم", "plain text"]
LITERAL_SQL = "(SELECT unnest(range(1, " + str(len(LITERALS) + 1) + ")) AS id, unnest(" + listed(LITERALS) + ") AS t) l"
#: The literals, and the texts of all documents after them.
SAID_SQL = f"(SELECT id, t FROM {LITERAL_SQL} UNION ALL SELECT doc_id + 1000, text FROM documents) s"


def _literals(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, t) for i, t in enumerate(LITERALS, 1)], "id long, t string")


def _said(spark: SparkSession, d: str) -> DataFrame:
    return _literals(spark).union(table(spark, d, "documents").select(F.col("doc_id") + 1000, "text"))


MARKS_SQL = "[\\x{0617}-\\x{061A}\\x{064B}-\\x{0652}\\x{0670}\\x{0640}]"


@query(rf"""
    SELECT id, lower(trim(regexp_replace(translate(regexp_replace(translate(t, '٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹', '01234567890123456789'), '{MARKS_SQL}', '', 'g'), 'أإآىة', 'ااايه'), '\s+', ' ', 'g'))) AS eval_text,
           lower(trim(trim(regexp_replace(translate(regexp_replace(translate(t, '٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹', '01234567890123456789'), '{MARKS_SQL}', '', 'g'), 'أإآىة', 'ااايه'), '\s+', ' ', 'g')), ' .,:;،')) AS bare_text,
           lower(regexp_replace(translate(regexp_replace(trim(t), '{MARKS_SQL}', '', 'g'), 'إأآىؤئ', 'اااي' || 'ءء'), '[^\p{{L}}\p{{N}}_\s]', '', 'g')) AS vqa_text
    FROM {SAID_SQL}""")
def normalize_eval_letters(spark, d):
    t = F.col("t")
    return _said(spark, d).select("id", text.normalize_eval(t).alias("eval_text"), text.normalize_eval(t, edges=True).alias("bare_text"), text.normalize_vqa(t).alias("vqa_text"))


@query(f"SELECT id, trim(translate(t, 'أإآىةؤئ', 'ااايهوي')) AS asr_text FROM {SAID_SQL}")
def asr_normalize(spark, d):
    return _said(spark, d).select("id", text.normalize_asr(F.col("t")).alias("asr_text"))


@query(r"SELECT page_id, trim(regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), '\s+', ' ', 'g')) AS caption FROM pages")
def caption_clean(spark, d):
    return table(spark, d, "pages").select("page_id", text.clean_caption(F.col("html")).alias("caption"))


@query("SELECT page_id, coalesce(nullif(left(trim(regexp_replace(url, '[^A-Za-z0-9_.-]+', '_', 'g'), '_'), 80), ''), 'model') AS slug FROM pages")
def slugify(spark, d):
    return table(spark, d, "pages").select("page_id", text.slug(F.col("url")).alias("slug"))


@query(r"SELECT doc_id, regexp_replace(text, '[^a-z0-9\s.,;:!?()\-/]', '', 'g') AS kept FROM documents")
def strip_nonblock(spark, d):
    return table(spark, d, "documents").select("doc_id", text.keep_only(F.col("text"), r"[^a-z0-9\s.,;:!?()\-/]").alias("kept"))


@query("SELECT conv_id, turn, trim(replace(replace(replace(replace(text, 'the', 'THE'), 'and', '&'), 'THE ', 'the_'), 'ing', 'in')) AS standard FROM conversations")
def dialect_replace(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", text.replace_words(F.col("text"), TWIN_DIALECT).alias("standard"))


@query(f"SELECT 'literal' AS origin, id, CASE WHEN regexp_matches(t, '[\\x{{0600}}-\\x{{06FF}}]') THEN 'ar' ELSE 'en' END AS detected FROM {LITERAL_SQL} UNION ALL SELECT 'documents', doc_id, CASE WHEN regexp_matches(text, '[\\x{{0600}}-\\x{{06FF}}]') THEN 'ar' ELSE 'en' END FROM documents")
def lang_detect(spark, d):
    lit = _literals(spark).select(F.lit("literal").alias("origin"), "id", text.detect_language(F.col("t")).alias("detected"))
    return lit.union(table(spark, d, "documents").select(F.lit("documents"), "doc_id", text.detect_language(F.col("text"))))


@query(f"SELECT conv_id, turn, CASE WHEN {any_in('text', URGENT)} THEN 'urgent' WHEN {any_in('text', REQUEST)} THEN 'request' WHEN {any_in('text', THANKS)} THEN 'grateful' ELSE 'neutral' END AS sentiment FROM conversations")
def sentiment_rules(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", text.sentiment(F.col("text"), URGENT, REQUEST, THANKS).alias("sentiment"))


@query(rf"""
    SELECT doc_id, (SELECT string_agg(w, ',' ORDER BY i) FROM (
        SELECT w, min(i) AS i FROM (SELECT trim(u.w, '.,!?') AS w, u.i FROM (SELECT unnest(ws) AS w, unnest(range(len(ws))) AS i) u WHERE length(u.w) > 2 AND u.w NOT IN ('the','and','for','that','with'))
        GROUP BY w ORDER BY i LIMIT 5)) AS keywords
    FROM (SELECT doc_id, list_filter(string_split_regex(text, '\s+'), lambda x: x <> '') AS ws FROM documents)""")
def keywords_top5(spark, d):
    found = table(spark, d, "documents").select("doc_id", text.keywords(F.col("text"), 5, STOPS).alias("k"))
    return found.select("doc_id", F.when(F.size("k") > 0, F.array_join("k", ",")).alias("keywords"))


@query(r"SELECT doc_id, array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(text, '\d+'), lambda x: TRY_CAST(x AS DECIMAL(38,0))))), ',') AS numbers FROM documents")
def numbers_extract(spark, d):
    return table(spark, d, "documents").select("doc_id", F.array_join(F.transform(text.numbers(F.col("text")), lambda x: x.cast("string")), ",").alias("numbers"))


@query(f"SELECT doc_id, array_to_string(list_filter({listed(PLACES)}, lambda w: contains(text, w)), ',') AS places FROM documents")
def gazetteer_locations(spark, d):
    return table(spark, d, "documents").select("doc_id", F.array_join(text.found_in(F.col("text"), PLACES), ",").alias("places"))


@query(r"""SELECT doc_id, CASE WHEN length(text) > 4000 THEN left(text, 4000) || chr(10) || '[...]' ELSE text END AS head,
    CASE WHEN length(s) > 900 THEN '[...]' || right(s, 900) ELSE s END AS tail FROM (SELECT *, trim(regexp_replace(text, '\s+', ' ', 'g')) AS s FROM documents)""")
def truncate_head_tail(spark, d):
    return table(spark, d, "documents").select("doc_id", text.truncate_head(F.col("text")).alias("head"), text.truncate_tail(F.col("text")).alias("tail"))


@query("""
    WITH q AS (SELECT conv_id, arg_min(text, (length(text), turn)) AS entity FROM conversations WHERE role = 'user' AND text <> '' GROUP BY conv_id),
    a AS (SELECT conv_id, turn, text FROM conversations WHERE role = 'assistant')
    SELECT a.conv_id, turn, CASE WHEN entity IS NOT NULL AND NOT contains(text, entity) THEN '(' || entity || ') ' || text ELSE text END AS answer FROM a LEFT JOIN q USING (conv_id)""")
def entity_prefix(spark, d):
    c = table(spark, d, "conversations")
    # Only the shortest question matters, so no conversation's questions are gathered.
    shortest = F.min_by(F.array("text"), F.struct(F.length("text"), "turn"))
    q = c.where("role = 'user' and text <> ''").groupBy("conv_id").agg(shortest.alias("questions"))
    a = c.where("role = 'assistant'").select("conv_id", "turn", "text").join(q, "conv_id", "left")
    return a.select("conv_id", "turn", text.with_entity(F.col("text"), F.coalesce("questions", F.array().cast("array<string>"))).alias("answer"))


@query(r"""
    WITH n AS (SELECT conv_id, turn, text, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS nxt FROM conversations)
    SELECT conv_id, turn, CASE WHEN turn % 3 = 0 OR trim(regexp_replace(coalesce(nxt, ''), '\s+', ' ', 'g')) = '' OR length(trim(regexp_replace(nxt, '\s+', ' ', 'g'))) > greatest(40, floor(2.2 * length(text))::INT) THEN text
           ELSE trim(regexp_replace(nxt, '\s+', ' ', 'g')) END AS question FROM n""")
def rewrite_guard(spark, d):
    n = table(spark, d, "conversations").withColumn("nxt", F.lead("text").over(Window.partitionBy("conv_id").orderBy("turn")))
    return n.select("conv_id", "turn", text.guarded_rewrite(F.col("text"), F.col("nxt"), F.col("turn") % 3 != 0).alias("question"))


@query(r"""
    WITH c AS (SELECT conv_id, turn, trim(text) AS s, text, len(list_filter(string_split_regex(trim(text), '\s+'), lambda w: w <> '')) AS n, CASE WHEN contains(trim(text), 'the') OR contains(trim(text), 'que') THEN 0.4 ELSE 0.9 END AS b FROM conversations),
    e AS (SELECT *, CASE WHEN s = '' THEN 0.0 WHEN n <= 3 THEN round(least(b + 0.05, 0.95), 2) ELSE round(b, 2) END AS f FROM c)
    SELECT conv_id, turn, f::DOUBLE AS confidence, (CASE WHEN contains(text, 'is') OR contains(text, 'no') THEN 0.95 ELSE f END)::DOUBLE AS final FROM e""")
def vqa_confidence(spark, d):
    c = text.answer_confidence(F.col("text"), ["the", "que"])
    return table(spark, d, "conversations").select("conv_id", "turn", c.alias("confidence"), text.override_confidence(F.col("text"), c, ["is", "no"]).alias("final"))


@query("""
    SELECT doc_id, concat_ws(chr(10) || chr(10), nullif(lang, ''), nullif(CASE WHEN doc_id % 3 = 0 THEN '' ELSE source END, ''), 'Answer briefly.') AS prompt,
           'passage: Q: ' || source || chr(10) || 'A: ' || text || chr(10) || 'FAQ ID: ' || doc_id || chr(10) || 'Tags: ' || lang || ', ' || source AS passage, 'FAQ ' || doc_id || ' — ' || lang AS citation,
           concat_ws(chr(10) || chr(10), CASE WHEN trim(source) <> '' THEN '[TEXT]' || chr(10) || trim(source) END, CASE WHEN doc_id % 2 = 0 THEN '[VOICE]' || chr(10) || lang END, CASE WHEN doc_id % 5 > 0 THEN '[OCR]' || chr(10) || lang END) AS intake,
           CASE WHEN doc_id % 5 > 0 THEN 2 ELSE 0 END AS image_count
    FROM documents""")
def prompt_assemble(spark, d):
    id_ = F.col("doc_id").cast("string")
    tags = F.array("lang", "source")
    case = text.consolidated(F.col("source"), F.when(F.col("doc_id") % 2 == 0, F.col("lang")), F.when(F.col("doc_id") % 5 > 0, F.array(F.col("lang"), F.lit(" "))))
    return table(spark, d, "documents").select(
        "doc_id",
        text.prompt(F.col("lang"), F.when(F.col("doc_id") % 3 == 0, F.lit("")).otherwise(F.col("source")), F.lit("Answer briefly.")).alias("prompt"),
        text.passage(F.col("source"), F.col("text"), id_, tags).alias("passage"), text.citation(id_, tags).alias("citation"),
        case.extracted_text.alias("intake"), case.image_count.alias("image_count"),
    )


@query("""
    SELECT event_id, (props->>'$.k')::BIGINT AS k, event_id % 4 <> 3 AS parsed_first FROM events""")
def json_repair(spark, d):
    wrapped = F.concat(F.lit("Here: ```json\n"), F.regexp_replace("props", "}", ",}"), F.lit("\n``` done"))
    broken = F.when(F.col("event_id") % 4 == 3, F.replace(wrapped, F.lit(","), F.lit("\r,\n"))).otherwise(wrapped)
    e = table(spark, d, "events").select("event_id", broken.alias("reply"))
    k = jsonx.at(jsonx.retried_object(F.col("reply")), "k", "long")
    return e.select("event_id", k.alias("k"), (jsonx.lenient_object(F.replace("reply", F.lit("\r"), F.lit("!"))) != "{}").alias("parsed_first"))


@query("""
    SELECT event_id, 'b.k' AS path, props->>'$.k' AS value, 'number' AS vtype FROM events
    UNION ALL SELECT event_id, 'a', '[]', 'list' FROM events
    UNION ALL SELECT event_id, 'b.y[0]', event_type, 'string' FROM events
    UNION ALL SELECT event_id, 'b.y[1].z', NULL, 'null' FROM events
    UNION ALL SELECT event_id, 't', CASE WHEN user_id % 2 = 0 THEN 'true' ELSE 'false' END, 'boolean' FROM events""")
def json_flatten(spark, d):
    payload = F.concat(F.lit('{"a":[],"x":{},"t":'), (F.col("user_id") % 2 == 0).cast("string"), F.lit(',"b":{"k":'), F.get_json_object("props", "$.k"), F.lit(',"y":["'), F.col("event_type"), F.lit('",{"z":null}]}}'))
    return jsonx.flatten(table(spark, d, "events").select("event_id", payload.alias("payload")), "event_id", "payload")


@query("""
    SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'doc_' || doc_id ELSE source END AS record_id, CASE WHEN doc_id % 3 = 0 THEN 2 ELSE (doc_id % 9)::INT END AS record_pages,
           toxic IS NULL OR toxic = 1 AS review_required, CASE WHEN toxic IS NULL THEN 'lang,schema_validation' ELSE 'lang' END AS uncertain_fields
    FROM (SELECT d.doc_id, source, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE d.doc_id % 3 = 0 OR d.doc_id % 9 > 0)""")
def defaults_and_flags(spark, d):
    rows = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left").where("doc_id % 3 = 0 or doc_id % 9 > 0")
    payload = F.to_json(F.struct(F.when(F.col("doc_id") % 4 == 0, "").otherwise(F.col("source")).alias("document_id"), F.when(F.col("doc_id") % 3 == 0, F.lit(0)).otherwise(F.col("doc_id") % 9).alias("page_count"), (F.col("toxic") == 1).alias("review_required")))
    rows = rows.select("doc_id", "toxic", payload.alias("payload"), F.concat(F.lit("doc_"), "doc_id").alias("name"), F.array(F.lit("a.png"), F.lit("b.png")).alias("files"))
    full = jsonx.with_defaults(rows, "payload", "name", "files")
    errors = F.when(F.col("toxic").isNull(), F.array(F.lit("toxic: missing"))).otherwise(F.array().cast("array<string>"))
    flags = jsonx.review_flags(errors, F.col("review_required"), F.col("review_notes"), F.array(F.lit("lang")))
    return full.select("doc_id", "record_id", "record_pages", flags.review_required.alias("review_required"), F.array_join(flags.uncertain_fields, ",").alias("uncertain_fields"))


@query("""
    WITH e AS (
        SELECT doc_id, list_sort(list_filter([
            CASE WHEN doc_id % 5 = 0 THEN '<root>: ''lang'' is a required property' END,
            CASE WHEN doc_id % 6 = 0 THEN 'pages: is less than the minimum of 1' END,
            CASE WHEN doc_id % 7 = 0 THEN 'pages: is not of type ''integer''' END,
            CASE WHEN doc_id % 10 = 0 THEN '<root>: ''extra'' was unexpected' END], lambda x: x IS NOT NULL)) AS errors FROM documents)
    SELECT doc_id, array_to_string(errors, '; ') AS errors, CASE WHEN len(errors) = 0 THEN 'OK' ELSE 'INVALID' END AS status FROM e""")
def schema_validate(spark, d):
    id_ = F.col("doc_id")
    lang = F.when(id_ % 5 != 0, F.concat(F.lit('"lang":"'), "lang", F.lit('",'))).otherwise("")
    pages = F.when((id_ % 7 == 0) & (id_ % 6 == 0), F.lit('"pages":0.5')).when(id_ % 7 == 0, F.lit('"pages":"one"')).when(id_ % 6 == 0, F.lit('"pages":0')).otherwise(F.lit('"pages":3'))
    rows = table(spark, d, "documents").select("doc_id", F.concat(F.lit("{"), lang, F.when(id_ % 10 == 0, F.lit('"extra":1,')).otherwise(""), pages, F.lit("}")).alias("payload"))
    errors = jsonx.violations(F.col("payload"), {"lang": {"type": "string", "required": True}, "pages": {"type": "integer", "required": True, "minimum": 1}})
    return rows.select("doc_id", F.array_join(errors, "; ").alias("errors"), F.when(F.size(errors) == 0, "OK").otherwise("INVALID").alias("status"))


def _schema_rules(schema: dict, at: str = "$") -> list[str]:
    """A row of SQL for each node of a schema: where it is, the types it may have, the fields it must and may have, its least length and least value."""
    kinds = [schema["type"]] if isinstance(schema["type"], str) else schema["type"]
    fields = schema.get("properties", {})
    rows = [f"('{at}', {listed(kinds)}, {listed(schema.get('required', []))}::VARCHAR[], {listed(fields) if fields else 'NULL'}::VARCHAR[], {schema.get('minLength', 0)}, {schema.get('minimum', 'NULL')})"]
    for name, sub in fields.items():
        rows += _schema_rules(sub, f"{at}.{name}")
    return rows + (_schema_rules(schema["items"], f"{at}[]") if "items" in schema else [])


def schema_sql(schema: dict, records: str) -> str:
    """``errors`` of each doc_id of ``records`` (doc_id, payload) by a schema, over the tree that DuckDB makes of a JSON text."""
    return rf"""
    WITH p AS ({records}),
    r(place, kinds, needed, known, least_length, least) AS (VALUES {", ".join(_schema_rules(schema))}),
    n AS (
        SELECT doc_id, regexp_replace(fullkey, '\[\d+\]', '[]', 'g') AS place, CASE WHEN fullkey = '$' THEN '<root>' ELSE replace(replace(fullkey[3:], '[', '.'), ']', '') END AS path, value,
               CASE WHEN type = 'VARCHAR' THEN 'string' WHEN type IN ('BOOLEAN', 'NULL', 'OBJECT', 'ARRAY') THEN lower(type) WHEN type = 'DOUBLE' AND value::DOUBLE <> floor(value::DOUBLE) THEN 'number' ELSE 'integer' END AS kind
        FROM p, json_tree(p.payload::JSON)
    ),
    m AS (
        SELECT n.*, r.*, CASE WHEN kind = 'object' THEN json_keys(value) ELSE [] END AS has,
               CASE WHEN kind = 'string' THEN '''' || (value->>'$') || '''' WHEN kind = 'null' THEN 'None' WHEN kind = 'boolean' THEN upper(left(value::VARCHAR, 1)) || substr(value::VARCHAR, 2) ELSE value::VARCHAR END AS said
        FROM n JOIN r ON n.place = r.place
    ),
    e AS (
        SELECT doc_id, path || ': ' || said || ' is not of type ' || array_to_string(list_transform(kinds, lambda k: '''' || k || ''''), ', ') AS error FROM m WHERE NOT list_contains(kinds, kind)
        UNION ALL SELECT doc_id, path || ': ' || said || ' should be non-empty' FROM m WHERE kind = 'string' AND length(value->>'$') < least_length
        UNION ALL SELECT doc_id, path || ': ' || said || ' is less than the minimum of ' || least FROM m WHERE kind IN ('integer', 'number') AND value::DOUBLE < least
        UNION ALL SELECT doc_id, path || ': ''' || f || ''' is a required property' FROM (SELECT *, unnest(list_filter(needed, lambda x: NOT list_contains(has, x))) AS f FROM m WHERE kind = 'object')
        UNION ALL SELECT doc_id, path || ': Additional properties are not allowed (' || array_to_string(list_transform(more, lambda x: '''' || x || ''''), ', ') || CASE WHEN len(more) = 1 THEN ' was' ELSE ' were' END || ' unexpected)'
            FROM (SELECT *, list_sort(list_filter(has, lambda x: NOT list_contains(known, x))) AS more FROM m WHERE kind = 'object') WHERE len(more) > 0
    ),
    errors AS (SELECT doc_id, array_to_string(list_sort(coalesce(list(error) FILTER (error IS NOT NULL), [])), '; ') AS errors FROM p LEFT JOIN e USING (doc_id) GROUP BY doc_id)"""


def _nulls(fields) -> str:
    return ",".join(f'"{f}":null' for f in fields)


#: A birth certificate's record in SQL that both engines read: rules of each depth are broken by number.
CERTIFICATE_SQL = (
    "'{\"document_id\":\"' || CASE WHEN doc_id % 11 = 0 THEN '' ELSE 'doc_' || doc_id END || '\",\"source_files\":[' || CASE WHEN doc_id % 4 = 0 THEN '3' ELSE '\"a.png\"' END"
    " || '],\"page_count\":' || CASE WHEN doc_id % 6 = 0 THEN '0' WHEN doc_id % 7 = 0 THEN '1.5' WHEN doc_id % 13 = 0 THEN '\"two\"' ELSE '2' END"
    f" || ',\"birth_certificate\":{{{_nulls(K.CERTIFICATE_FIELDS)}' || CASE WHEN doc_id % 9 = 0 THEN ',\"stamp\":1,\"seal\":true' ELSE '' END"
    " || '},\"ids\":{\"child_national_id\":null,\"father_national_id\":null,\"mother_national_id\":' || CASE WHEN doc_id % 5 = 0 THEN '5' ELSE 'null' END"
    " || ',\"other_ids\":[{\"label_ar\":\"' || source || '\",\"value\":' || CASE WHEN doc_id % 3 = 0 THEN '{\"deep\":[1]}' ELSE '\"v\"' END || '},{\"label_ar\":null' || CASE WHEN doc_id % 8 = 0 THEN '' ELSE ',\"value\":null' END"
    f" || '}}]}},\"personal_and_other\":{{\"child\":{{{_nulls(K.CHILD_FIELDS)}}},\"father\":{{{_nulls(K.PARENT_FIELDS)}}},\"mother\":' || CASE WHEN doc_id % 10 = 0 THEN '[]' ELSE '{{{_nulls(K.PARENT_FIELDS)}}}' END"
    " || ',\"misc_notes\":null},\"uncertain_fields\":[],\"review_required\":' || CASE WHEN doc_id % 12 = 0 THEN 'null' ELSE 'false' END || ',\"review_notes\":[' || CASE WHEN doc_id % 14 = 0 THEN 'false' ELSE '\"' || lang || '\"' END || ']}'"
)


@query(schema_sql(schemas.certificate_schema(), f"SELECT doc_id, {CERTIFICATE_SQL} AS payload FROM documents") + " SELECT doc_id, errors, CASE WHEN errors = '' THEN 'OK' ELSE 'INVALID' END AS status FROM errors")
def nested_errors(spark, d):
    rows = table(spark, d, "documents").select("doc_id", F.expr(CERTIFICATE_SQL).alias("payload"))
    told = rows.select("doc_id", schemas.compiled(schemas.certificate_schema())(F.col("payload")).alias("e"))
    return told.select("doc_id", F.array_join("e", "; ").alias("errors"), F.when(F.size("e") == 0, "OK").otherwise("INVALID").alias("status"))


@query("SELECT DISTINCT user_id, sha256(user_id::VARCHAR) AS user_hash FROM events")
def sha_ids(spark, d):
    return table(spark, d, "events").select("user_id").distinct().select("user_id", text.sha256(F.col("user_id").cast("string")).alias("user_hash"))


@query("SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_anti_join(spark, d):
    return joins.remaining(table(spark, d, "documents"), table(spark, d, "labels"), "doc_id").select("doc_id", "lang")


@query("SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def id_semi_join(spark, d):
    return joins.selected(table(spark, d, "documents"), table(spark, d, "labels").where("toxic = 1"), "doc_id").select("doc_id", "lang")


def _spans(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    e = table(spark, d, "events")
    start = F.unix_micros("ts") / 1e6
    cues = e.where("event_type <> 'click'").select(F.col("event_id").alias("r_id"), F.col("user_id").alias("r_user"), start.alias("r_start"), (start + F.col("value") * 60).alias("r_end"))
    parts = e.where("event_type = 'click'").select(F.col("event_id").alias("l_id"), F.col("user_id").alias("l_user"), start.alias("l_start"), (start + 3600).alias("l_end"))
    return parts, cues


SPANS = """
    WITH e AS (SELECT event_id AS id, user_id AS u, event_type, epoch_us(ts) / 1e6 AS s, value FROM events),
    l AS (SELECT id, u, s, s + 3600 AS t FROM e WHERE event_type = 'click'), r AS (SELECT id, u, s, s + value * 60 AS t FROM e WHERE event_type <> 'click')
"""


@query(SPANS + "SELECT l.id AS l_id, r.id AS r_id FROM l JOIN r ON l.u = r.u AND r.t > l.s AND r.s < l.t")
def interval_overlap(spark, d):
    return sweep.overlap(*_spans(spark, d), on=["user"]).select("l_id", "r_id")


@query(SPANS + "SELECT l.id AS l_id, r.id AS r_id FROM l JOIN r ON l.u = r.u AND r.t >= l.s AND r.s <= l.t")
def interval_overlap_closed(spark, d):
    return sweep.overlap(*_spans(spark, d), on=["user"], closed=True).select("l_id", "r_id")


@query("""
    WITH u AS (SELECT user_id, max(value) AS duration FROM events GROUP BY user_id HAVING max(value) > 0)
    SELECT user_id, s::BIGINT AS segment, (s * 15)::DOUBLE AS l_start, least((s + 1) * 15, duration)::DOUBLE AS l_end FROM (SELECT user_id, duration, unnest(range(ceil(duration / 15)::BIGINT)) AS s FROM u)""")
def fixed_segments(spark, d):
    spans = table(spark, d, "events").groupBy("user_id").agg(F.max("value").alias("duration"))
    return joins.segments(spans).select("user_id", F.col("segment").cast("long").alias("segment"), "l_start", "l_end")


@query("""
    SELECT event_id, user_id, event_type FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS b, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events)
    WHERE k = 1 OR event_type IS DISTINCT FROM b""")
def consecutive_dedup(spark, d):
    return windows.drop_repeats(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], "event_type").select("event_id", "user_id", "event_type")


def _nearest(spark: SparkSession, d: str, k: int, threshold: float | None = None) -> tuple[DataFrame, DataFrame]:
    v = table(spark, d, "embeddings")
    return v, joins.top_k_similar(v, v, k, threshold)


NEAREST = """
    WITH s AS (SELECT a.vec_id AS query_id, b.vec_id, a.label AS qu, b.label AS u, round(list_inner_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS similarity FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
    t AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, vec_id) AS rank FROM s)
"""


@query(NEAREST + "SELECT query_id, vec_id, similarity, rank::INT AS rank FROM t WHERE rank <= 5")
def topk_similarity(spark, d):
    return _nearest(spark, d, 5)[1]


@query(NEAREST + """, w AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY CASE WHEN u = qu THEN 0 ELSE 1 END, rank) AS new_rank FROM t WHERE rank <= 10)
    SELECT query_id, vec_id, rank::INT AS rank, new_rank::INT AS new_rank FROM w WHERE new_rank <= 5""")
def lang_backfill_rerank(spark, d):
    v, near = _nearest(spark, d, 10)
    lang = v.select("vec_id", F.col("label").alias("u"))
    both = near.join(lang, "vec_id").join(lang.select(F.col("vec_id").alias("query_id"), F.col("u").alias("qu")), "query_id")
    return joins.preferred_then_rest(both, 5, F.col("u") == F.col("qu")).select("query_id", "vec_id", "rank", "new_rank")


def _duplicates(spark: SparkSession, d: str) -> DataFrame:
    v, near = _nearest(spark, d, 10)
    return joins.duplicate_split(near, v.select("vec_id", F.col("label").alias("user")), 0.4)


DUPLICATES = NEAREST + """, g AS (
    SELECT v.vec_id AS query_id, coalesce(bool_or(u = qu), false) AS same_user, coalesce(bool_or(u <> qu), false) AS other_user, coalesce(max(similarity) FILTER (u = qu), 0.0) AS same_max, coalesce(max(similarity) FILTER (u <> qu), 0.0) AS other_max, count(query_id) AS matches_found
    FROM embeddings v LEFT JOIN (SELECT * FROM t WHERE rank <= 10 AND similarity >= 0.4) t ON v.vec_id = t.query_id GROUP BY v.vec_id)
"""


@query(DUPLICATES + "SELECT * FROM g")
def dup_same_other_user(spark, d):
    return _duplicates(spark, d)


@query(DUPLICATES + "SELECT count(*) AS total, count(*) FILTER (matches_found = 0) AS \"unique\", count(*) FILTER (matches_found > 0) AS duplicates, count(*) FILTER (query_id % 50 = 49) AS errors FROM g")
def reverse_summary(spark, d):
    return metrics.reverse_summary(_duplicates(spark, d).withColumn("error", F.col("query_id") % 50 == 49))


@query("SELECT sha256(text) AS content_hash, min(doc_id) AS first_id, count(*) AS n FROM documents GROUP BY text HAVING count(*) > 1")
def exact_dup_hash(spark, d):
    return joins.exact_duplicates(table(spark, d, "documents"), "doc_id", "text")


#: Letters that take several bytes, and signs that no token holds: in SQL an edit distance goes by bytes.
WIDE, NARROW = "ÄÇÈÉÊÑÖÜßäçèéêíñóöüáúàâîôû", "!#$%&()*+-/:;<=>?@[]^_{|}~"


def _fields_and_tokens(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    b = table(spark, d, "benchmark").select(F.col("item_id").alias("document_id"), "text")
    tokens = b.select("document_id", F.posexplode(F.split("text", " ")).alias("pos", "text"))
    said = F.concat_ws(" ", F.get(F.split("text", " "), 3), F.get(F.split("text", " "), 4))
    # Every other target is misread.
    return b.select("document_id", F.lit("third").alias("field"), F.when(F.col("document_id") % 2 == 1, F.translate(said, "eo", "a")).otherwise(said).alias("target")), tokens


TOKENS = rf"""WITH RECURSIVE b AS (SELECT item_id AS document_id, string_split(text, ' ') AS w FROM benchmark),
    f AS (SELECT document_id, 'third' AS field, CASE WHEN document_id % 2 = 1 THEN translate(concat_ws(' ', w[4], w[5]), 'eo', 'a') ELSE concat_ws(' ', w[4], w[5]) END AS target FROM b),
    k AS (SELECT document_id, unnest(w) AS text, unnest(range(len(w))) AS pos FROM b),
    c AS (SELECT document_id, text, pos, 0 AS pair FROM k UNION ALL SELECT document_id, text || ' ' || nxt, pos, 1 FROM (SELECT *, lead(text) OVER (PARTITION BY document_id ORDER BY pos) AS nxt FROM k) WHERE nxt IS NOT NULL),
    s AS (SELECT document_id, field, target, text, round(CASE WHEN greatest(length(target), length(text)) = 0 THEN 1 ELSE 1 - levenshtein(translate(target, '{WIDE}', '{NARROW}'), translate(text, '{WIDE}', '{NARROW}')) / greatest(length(target), length(text)) END, 6) AS score, pair, pos FROM f JOIN c USING (document_id))
"""


@query(TOKENS + "SELECT document_id, field, target, text, score FROM (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY score DESC, pair, pos) AS k FROM s) WHERE k = 1")
def fuzzy_best_match(spark, d):
    return joins.best_token_match(*_fields_and_tokens(spark, d), score=joins.levenshtein_score)


@query(TOKENS + """,
    d AS (SELECT DISTINCT target, text FROM s),
    pieces(target, text, a, b, k) AS (
        SELECT target, text, target, text, 0 FROM d
        UNION ALL
        SELECT target, text, CASE side WHEN 0 THEN a[1:m.i - 1] ELSE a[m.i + m.k:] END, CASE side WHEN 0 THEN b[1:m.j - 1] ELSE b[m.j + m.k:] END, CASE side WHEN 0 THEN m.k ELSE 0 END
        FROM (
            SELECT target, text, a, b, list_sort(flatten(list_transform(range(1, length(a) + 1), lambda i: list_transform(range(1, length(b) + 1), lambda j:
                {'less': -coalesce(list_max(list_filter(range(1, least(length(a) - i, length(b) - j) + 2), lambda z: a[i:i + z - 1] = b[j:j + z - 1])), 0), 'i': i, 'j': j,
                 'k': coalesce(list_max(list_filter(range(1, least(length(a) - i, length(b) - j) + 2), lambda z: a[i:i + z - 1] = b[j:j + z - 1])), 0)}))))[1] AS m
            FROM pieces WHERE a <> '' AND b <> ''
        ), (SELECT unnest([0, 1]) AS side) WHERE m.k > 0
    ),
    ratio AS (SELECT target, text, round(CASE WHEN target = '' AND text = '' THEN 1 ELSE 2 * sum(k) / (length(target) + length(text)) END, 6) AS score FROM pieces GROUP BY target, text)
    SELECT document_id, field, target, text, score FROM (SELECT s.document_id, s.field, target, text, ratio.score, row_number() OVER (PARTITION BY document_id ORDER BY ratio.score DESC, pair, pos) AS k FROM s JOIN ratio USING (target, text)) WHERE k = 1""")
def fuzzy_best_match_sequence(spark, d):
    return joins.best_token_match(*_fields_and_tokens(spark, d))


def nearest_sql(catalog: str, queries: str, accept: int = 75) -> str:
    """The best row of ``catalog`` (row_id, text) for each of ``queries`` (query_id, text) by shared words and common subsequences; texts of up to 120 letters.

    A common subsequence's length is counted in the bits of a whole number, a letter of the other text at a time.
    """
    words = "list_sort(list_distinct(list_filter(string_split_regex(lower(trim(text)), '\\s+'), lambda x: x <> '')))"
    return rf"""
    WITH c AS (SELECT min(row_id) AS row_id, w FROM (SELECT row_id, {words} AS w FROM ({catalog})) WHERE len(w) > 0 GROUP BY w),
    q AS (SELECT DISTINCT {words} AS w FROM ({queries})),
    p AS (SELECT q.w AS qw, c.row_id, list_filter(q.w, lambda x: list_contains(c.w, x)) AS shared, list_filter(q.w, lambda x: NOT list_contains(c.w, x)) AS mine, list_filter(c.w, lambda x: NOT list_contains(q.w, x)) AS its FROM q, c WHERE len(q.w) > 0),
    t AS (SELECT *, array_to_string(list_concat(shared, mine), ' ') AS a, array_to_string(list_concat(shared, its), ' ') AS b, length(array_to_string(shared, ' ')) AS s FROM p),
    m AS (SELECT *, list_transform(string_split(b, ''), lambda y: list_sum(list_transform(range(length(a)), lambda i: CASE WHEN a[i + 1] = y THEN 1::HUGEINT << i::HUGEINT ELSE 0 END))::HUGEINT) AS masks, (1::HUGEINT << length(a)::HUGEINT) - 1 AS every FROM t),
    l AS (SELECT *, length(a) - bit_count(list_reduce(masks, lambda row, m: ((row + (row & m)) | (row - (row & m))) & every, every)) AS common FROM m),
    r AS (
        SELECT qw, row_id, round(CASE WHEN s > 0 AND (len(mine) = 0 OR len(its) = 0) THEN 100
            ELSE greatest(200::DOUBLE * common / (length(a) + length(b)), CASE WHEN s > 0 THEN greatest(200::DOUBLE * s / (s + length(a)), 200::DOUBLE * s / (s + length(b))) ELSE 0 END) END, 6) AS score FROM l
    ),
    best AS (SELECT qw, arg_min(row_id, (-score, row_id)) AS row_id, max(score) AS score FROM r WHERE score >= {accept} GROUP BY qw)
    SELECT query_id, row_id, score FROM (SELECT query_id, {words} AS w FROM ({queries})) JOIN best ON w = qw"""


#: A name as someone may write it: with an ending, its letters changed, its first letter lost, or as it is.
MISSPELT = "CASE {1} % 4 WHEN 0 THEN {0} || 's' WHEN 1 THEN replace(replace({0}, 'e', 'a'), 'o', 'u') WHEN 2 THEN substr({0}, 2) ELSE {0} END"
PARTS, PAGES = "SELECT p_partkey AS row_id, unnest([p_name, p_type]) AS text FROM part", "SELECT page_id AS row_id, regexp_replace(url, '[^A-Za-z0-9]+', ' ', 'g') AS text FROM pages"


@query(nearest_sql(PARTS, f"SELECT p_partkey AS query_id, {MISSPELT.format('p_name', 'p_partkey')} AS text FROM part"))
def catalog_nearest(spark, d):
    catalog = table(spark, d, "part").select(F.col("p_partkey").alias("row_id"), "p_name", "p_type")
    queries = catalog.select(F.col("row_id").alias("query_id"), F.expr(MISSPELT.format("p_name", "row_id")).alias("query"))
    return joins.catalog_match(queries, catalog, ["p_name", "p_type"])


@query(nearest_sql(PAGES, f"SELECT row_id AS query_id, {MISSPELT.format('text', 'row_id')} AS text FROM ({PAGES})"))
def catalog_urls(spark, d):
    """Every page's address, misspelt, against all addresses: a catalogue whose names are nearly all different."""
    catalog = table(spark, d, "pages").select(F.col("page_id").alias("row_id"), F.regexp_replace("url", "[^A-Za-z0-9]+", " ").alias("name"))
    queries = catalog.select(F.col("row_id").alias("query_id"), F.expr(MISSPELT.format("name", "row_id")).alias("query"))
    return joins.catalog_match(queries, catalog, ["name"])


@query("SELECT doc_id, CASE WHEN contains(lower(source), 'src1') THEN 'src1' WHEN contains(lower(source), 'src2') THEN 'src2' WHEN contains(lower(source), '5') THEN '5' ELSE 'src1' END AS category FROM documents")
def category_contains(spark, d):
    return joins.first_contained(table(spark, d, "documents").select("doc_id", "source"), "source", ["src1", "src2", "5"]).select("doc_id", "category")


@query("""SELECT item_id, q::INT AS question_no, ['What?', 'Where?', 'When?'][q + 1] AS question, ['a', 'b', 'c'][q + 1] AS item, CASE WHEN q < 2 THEN ['x', 'y'][q + 1] ELSE '' END AS ocr
    FROM (SELECT item_id, unnest(range(3)) AS q FROM benchmark)""")
def question_grid(spark, d):
    grid = joins.question_grid(table(spark, d, "benchmark").select("item_id"), ["What?", "Where?", "When?", "Who?"], 3)
    pairs = joins.zipped(F.array(*map(F.lit, "abc")), F.array(*map(F.lit, "xy")))
    z = F.get(pairs, F.col("question_no"))
    return grid.select("item_id", "question_no", "question", z["item"].alias("item"), z["text"].alias("ocr"))


@query("SELECT doc_id, CASE lang WHEN 'de' THEN 'model-d' WHEN 'fr' THEN 'model-f' ELSE 'model-0' END AS model FROM documents")
def type_routing(spark, d):
    return table(spark, d, "documents").select("doc_id", joins.routed(F.col("lang"), {"de": "model-d", "fr": "model-f"}, "model-0").alias("model"))


CELLS = """
    SELECT lang, tp, fp, fn, tn, p AS precision, r AS recall, coalesce(round(2 * p * r / nullif(p + r, 0), 6), 0) AS f1 FROM (
        SELECT *, coalesce(round(tp / nullif(tp + fp, 0), 6), 0) AS p, coalesce(round(tp / nullif(tp + fn, 0), 6), 0) AS r FROM (
            SELECT lang, count(*) FILTER (c = 'tp') AS tp, count(*) FILTER (c = 'fp') AS fp, count(*) FILTER (c = 'fn') AS fn, count(*) FILTER (c = 'tn') AS tn FROM c GROUP BY lang))
"""


@query(f"""WITH b AS (SELECT item_id, string_split(text, ' ')[1:4] AS w, CASE WHEN item_id % 5 = 0 THEN 'ar' ELSE 'en' END AS lang FROM benchmark),
    t AS (SELECT item_id, lang, CASE WHEN item_id % 7 = 0 THEN '' ELSE array_to_string(w, ' ') END AS gold, CASE item_id % 4 WHEN 0 THEN array_to_string(w, ' ') WHEN 1 THEN translate(array_to_string(w, ' '), 'e', '') WHEN 2 THEN w[1] ELSE 'zzzz' END AS pred FROM b),
    s AS (SELECT lang, gold, 1 - levenshtein(translate(gold, '{WIDE}', '{NARROW}'), translate(pred, '{WIDE}', '{NARROW}')) / greatest(length(gold), length(pred)) AS score FROM t),
    c AS (SELECT lang, CASE WHEN gold = '' THEN 'tn' WHEN score >= 0.85 THEN 'tp' WHEN score >= 0.5 THEN 'fp' ELSE 'fn' END AS c FROM s)""" + CELLS)
def confusion_bands(spark, d):
    """Readings of the first words of each item in bands of how alike they are to what is there."""
    id_ = F.col("item_id")
    said = F.array_join(F.slice(F.split("text", " "), 1, 4), " ")
    pred = F.when(id_ % 4 == 0, said).when(id_ % 4 == 1, F.translate(said, "e", "")).when(id_ % 4 == 2, F.get(F.split("text", " "), 0)).otherwise("zzzz")
    rows = table(spark, d, "benchmark").select(F.when(id_ % 5 == 0, "ar").otherwise("en").alias("lang"), F.when(id_ % 7 == 0, "").otherwise(said).alias("gold"), pred.alias("pred"))
    return metrics.confusion(rows, ["lang"], metrics.banded(joins.levenshtein_score(F.col("gold"), F.col("pred")), F.col("gold")))


@query("WITH c AS (SELECT lang, CASE WHEN doc_id % 4 = 0 THEN 'tn' WHEN doc_id % 5 = 0 THEN 'fp' WHEN doc_id % 7 = 0 THEN 'fn' ELSE 'tp' END AS c FROM documents)" + CELLS)
def confusion_exact(spark, d):
    id_ = F.col("doc_id")
    pred = F.when(id_ % 5 == 0, "other").when(id_ % 7 == 0, "").otherwise(F.col("source"))
    return metrics.confusion(table(spark, d, "documents"), ["lang"], metrics.exact_cell(pred, F.when(id_ % 4 == 0, F.lit(None)).otherwise(F.col("source"))))


#: Words that a reading drops or says twice.
DROPPED = ["the", "and", "der", "die", "de", "la", "que", "les", "of", "un"]


def _readings(spark: SparkSession, d: str) -> DataFrame:
    """Whole texts of all languages, and a reading of each that drops some words, says them twice, misreads a letter, or is right.

    Where one is a part of the other, their edit distance is the difference of their lengths; where a letter is read as a sign that no text
    has, each of these is one edit.  So SQL can tell both.
    """
    w = text.words(F.col("text"))
    gold, known = F.array_join(w, " "), lambda x: x.isin(*DROPPED)
    dropped = F.array_join(F.filter(w, lambda x: ~known(x)), " ")
    doubled = F.array_join(F.transform(w, lambda x: F.when(known(x), F.concat(x, F.lit(" "), x)).otherwise(x)), " ")
    kind = F.col("doc_id") % 4
    pred = F.when(kind == 0, dropped).when(kind == 1, doubled).when(kind == 2, F.translate(gold, "e", MISREAD)).otherwise(gold)
    return spread(table(spark, d, "documents")).select("lang", pred.alias("pred"), gold.alias("gold"))


#: A sign that stands in no text.
MISREAD = "¤"
READINGS = rf"""
    WITH w AS (SELECT doc_id, lang, list_filter(string_split_regex(text, '\s+'), lambda x: x <> '') AS w FROM documents),
    p AS (SELECT lang, doc_id, w, CASE doc_id % 4 WHEN 0 THEN list_filter(w, lambda x: NOT list_contains({listed(DROPPED)}, x)) WHEN 1 THEN flatten(list_transform(w, lambda x: CASE WHEN list_contains({listed(DROPPED)}, x) THEN [x, x] ELSE [x] END))
        WHEN 2 THEN list_transform(w, lambda x: replace(x, 'e', '{MISREAD}')) ELSE w END AS v FROM w),
    r AS (SELECT lang, v = w AS same, length(array_to_string(w, ' ')) AS cn, len(w) AS wn,
        CASE WHEN doc_id % 4 = 2 THEN length(regexp_replace(array_to_string(w, ' '), '[^e]', '', 'g')) ELSE abs(length(array_to_string(v, ' ')) - length(array_to_string(w, ' '))) END AS ce,
        CASE WHEN doc_id % 4 = 2 THEN len(list_filter(w, lambda x: contains(x, 'e'))) ELSE abs(len(v) - len(w)) END AS we FROM p)
"""


@query(READINGS + "SELECT lang, count(*) AS samples, sum(ce)::BIGINT AS char_edits, sum(cn)::BIGINT AS chars, count(*) FILTER (same) AS exact, round(sum(ce) / sum(cn), 6) AS cer, round(count(*) FILTER (same) / count(*), 6) AS exact_match FROM r GROUP BY lang HAVING sum(cn) > 0")
def cer_micro(spark, d):
    return metrics.error_rates(_readings(spark, d), ["lang"]).drop("wer", "word_edits", "words")


@query(READINGS + "SELECT lang, count(*) AS samples, sum(we)::BIGINT AS word_edits, sum(wn)::BIGINT AS words, round(sum(we) / sum(wn), 6) AS wer FROM r GROUP BY lang HAVING sum(cn) > 0")
def wer_micro(spark, d):
    return metrics.error_rates(_readings(spark, d), ["lang"]).select("lang", "samples", "word_edits", "words", "wer")


@query("""
    WITH n AS (SELECT lang, list_transform(regexp_extract_all(text, '[0-9]+'), lambda x: TRY_CAST(x AS DECIMAL(38,0))) AS ref, list_transform(regexp_extract_all(replace(text, '7', '1'), '[0-9]+'), lambda x: TRY_CAST(x AS DECIMAL(38,0))) AS pred FROM documents),
    m AS (SELECT lang, len(list_intersect(list_distinct(list_filter(ref, lambda x: x IS NOT NULL)), list_distinct(list_filter(pred, lambda x: x IS NOT NULL)))) AS s, len(list_distinct(list_filter(ref, lambda x: x IS NOT NULL))) AS r FROM n)
    SELECT lang, round(avg(s / greatest(r, 1)), 6) AS number_accuracy, round(avg(CASE WHEN r = 0 THEN 1 ELSE s / r END), 6) AS number_accuracy_sets FROM m GROUP BY lang""")
def macro_means(spark, d):
    ref, pred = text.numbers(F.col("text")), text.numbers(F.replace("text", F.lit("7"), F.lit("1")))
    rows = table(spark, d, "documents").select("lang", ref.alias("ref"), pred.alias("pred"))
    return rows.groupBy("lang").agg(F.round(F.avg(metrics.number_accuracy(F.col("ref"), F.col("pred"))), 6).alias("number_accuracy"), F.round(F.avg(metrics.number_accuracy_sets(F.col("ref"), F.col("pred"))), 6).alias("number_accuracy_sets"))


@query(r"""
    WITH n AS (SELECT role, text AS gold, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS pred FROM conversations),
    w AS (SELECT role, pred = gold AS em, list_filter(string_split_regex(pred, '\s+'), lambda x: x <> '') AS p, list_filter(string_split_regex(gold, '\s+'), lambda x: x <> '') AS g FROM n WHERE pred IS NOT NULL),
    s AS (SELECT role, em, CASE WHEN len(p) = 0 OR len(g) = 0 OR len(list_intersect(list_distinct(p), list_distinct(g))) = 0 THEN 0 ELSE 2 * (len(list_intersect(list_distinct(p), list_distinct(g))) / len(p)) * (len(list_intersect(list_distinct(p), list_distinct(g))) / len(g)) / (len(list_intersect(list_distinct(p), list_distinct(g))) / len(p) + len(list_intersect(list_distinct(p), list_distinct(g))) / len(g)) END AS f FROM w)
    SELECT role, grouping(role)::INT AS overall, count(*) AS n, round(avg(em::INT), 6) AS exact_match, round(avg(f), 6) AS f1 FROM s GROUP BY GROUPING SETS ((role), ())""")
def token_f1_by_category(spark, d):
    rows = table(spark, d, "conversations").withColumn("pred", F.lead("text").over(Window.partitionBy("conv_id").orderBy("turn"))).where("pred is not null")
    return metrics.answer_scores(rows.select("role", "pred", F.col("text").alias("gold")), "role")


@query("""
    WITH e AS (SELECT event_id, (event_id % 101) / 100 >= 0.7 AS ai, event_id % 13 = 0 AS same, event_id % 17 = 0 AS other, event_type = 'error' AS error FROM events),
    s AS (SELECT count(*) AS total, count(*) FILTER (NOT ai AND NOT same AND NOT other AND NOT error) AS passed, count(*) FILTER (ai) AS ai_generated, count(*) FILTER (same) AS duplicates_same_user, count(*) FILTER (other) AS duplicates_other_user, count(*) FILTER (same OR other) AS duplicates, count(*) FILTER (error) AS errors FROM e)
    SELECT *, printf('%.1f%%', 100 * (passed / total)) AS pass_rate FROM s""")
def fraud_summary(spark, d):
    id_ = F.col("event_id")
    rows = table(spark, d, "events").select(((id_ % 101) / 100 >= 0.7).alias("ai"), (id_ % 13 == 0).alias("same"), (id_ % 17 == 0).alias("other"), (F.col("event_type") == "error").alias("error"))
    return metrics.fraud_summary(rows.withColumn("passed", ~F.col("ai") & ~F.col("same") & ~F.col("other") & ~F.col("error")))


def _profiles(spark: SparkSession, d: str) -> DataFrame:
    id_ = F.col("event_id")
    risk = rules.risk_profile((id_ % 101) / 100, id_ % 13 == 0, id_ % 17 == 0, (id_ % 89) / 88)
    return table(spark, d, "events").select("event_id", "user_id", risk.alias("r")).select("event_id", "user_id", "r.risk_score", "r.risk_level", F.array_join("r.risk_signals", ",").alias("signals"))


PROFILES = """
    WITH e AS (SELECT event_id, user_id, (event_id % 101) / 100 AS ai, event_id % 13 = 0 AS same, event_id % 17 = 0 AS other, (event_id % 89) / 88 AS q FROM events),
    r AS (SELECT event_id, user_id, round(greatest(0, least(1, 0.5::DOUBLE * ai + CASE WHEN other THEN 0.3::DOUBLE WHEN same THEN 0.2::DOUBLE ELSE 0.0::DOUBLE END + 0.2::DOUBLE * (1 - q))), 3) AS risk_score,
        array_to_string(list_filter([CASE WHEN ai > 0.7 THEN 'ai_generated' END, CASE WHEN other THEN 'duplicate_other_user' END, CASE WHEN same THEN 'duplicate_same_user' END, CASE WHEN q < 0.5 THEN 'low_quality' END], lambda x: x IS NOT NULL), ',') AS signals FROM e)
"""


@query(PROFILES + "SELECT event_id, user_id, risk_score, CASE WHEN risk_score >= 0.75 THEN 'high' WHEN risk_score >= 0.4 THEN 'medium' ELSE 'low' END AS risk_level, signals FROM r")
def risk_profile(spark, d):
    return _profiles(spark, d)


@query(PROFILES + "SELECT user_id, max(risk_score) AS overall_risk_score, count(*) AS images, CASE WHEN max(risk_score) >= 0.75 THEN 'high' WHEN max(risk_score) >= 0.4 THEN 'medium' ELSE 'low' END AS overall_risk_level FROM r GROUP BY user_id")
def case_risk(spark, d):
    return metrics.case_risk(_profiles(spark, d), "user_id")


@query("""
    WITH s AS (SELECT event_id, (event_id % 256)::DOUBLE AS mean, (event_id % 70)::DOUBLE AS std, (event_id % 701)::DOUBLE AS v, (event_id % 300)::DOUBLE AS tex, (event_id % 45)::DOUBLE AS half, event_id % 900 AS side FROM events)
    SELECT event_id,
        CASE WHEN mean > 180 AND v > 200 AND std > 40 AND half <= 30 THEN 'clean_document' WHEN tex > 200 AND std > 50 AND mean > 100 AND mean < 200 THEN 'medical_photo' WHEN mean < 100 AND std > 50 AND tex > 150 THEN 'dark_scene' WHEN mean < 120 AND std < 35 AND half > 30 THEN 'underexposed_phone' ELSE 'general' END AS kind,
        CASE WHEN side < 400 THEN 'WARNING' WHEN v >= 300 THEN 'PASS' ELSE 'WARNING' END AS tier,
        round(greatest(0, least(1, 0.6::DOUBLE * (1 - v / (v + 300)) + 0.4::DOUBLE * (CASE WHEN mean < 50 OR mean > 220 THEN 0.6::DOUBLE ELSE 1 END * CASE WHEN std < 30 THEN 0.7::DOUBLE ELSE 1 END))), 3) AS quality,
        tex < v * 0.7 OR (side > 2 * half AND side > 1000) AS undone
    FROM s""")
def quality_tier(spark, d):
    m = lambda k: (F.col("event_id") % k).cast("double")
    mean, std, v, tex, half, side = m(256), m(70), m(701), m(300), m(45), F.col("event_id") % 900
    return table(spark, d, "events").select("event_id", rules.image_type(mean, std, v, tex, half).alias("kind"), rules.quality_tier(v, side).alias("tier"), rules.quality_score(v, rules.lighting(mean, std)).alias("quality"), rules.safeguard(v, tex, half, side).alias("undone"))


@query("""
    WITH s AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'vqa' WHEN 1 THEN 'search' WHEN 2 THEN 'report' WHEN 3 THEN 'dance' END AS step, (event_id % 4)::INT AS loops, CASE event_id % 3 WHEN 0 THEN 'vqa' WHEN 1 THEN 'search' END AS last FROM events)
    SELECT event_id, CASE WHEN step IN ('vqa', 'search') THEN step ELSE 'report' END AS decided, loops + 1 AS loop_count,
        CASE WHEN loops >= 3 THEN 'report' WHEN step IS NOT DISTINCT FROM last THEN 'report' WHEN step IN ('vqa', 'search') THEN step ELSE 'report' END AS node FROM s""")
def router_decisions(spark, d):
    id_ = F.col("event_id")
    step = F.when(id_ % 5 == 0, "vqa").when(id_ % 5 == 1, "search").when(id_ % 5 == 2, "report").when(id_ % 5 == 3, "dance")
    reply = F.to_json(F.struct(step.alias("next_step")))
    loops, last = (id_ % 4).cast("int"), F.when(id_ % 3 == 0, "vqa").when(id_ % 3 == 1, "search")
    made = rules.decision(reply, loops)
    return table(spark, d, "events").select("event_id", made.next_step.alias("decided"), made.loop_count.alias("loop_count"), rules.route(step, loops, last).alias("node"))


@query("""
    WITH s AS (SELECT user_id AS case_id, list(CASE event_type WHEN 'click' THEN 'vqa' WHEN 'view' THEN 'search' ELSE 'report' END ORDER BY ts, event_id)[:3] AS t FROM events GROUP BY user_id),
    p AS (SELECT case_id, t, CASE WHEN t[1] = 'report' THEN 1 WHEN t[2] = 'report' OR t[2] = t[1] THEN 2 ELSE 3 END AS n FROM s)
    SELECT case_id, CASE WHEN n = 1 THEN 'report' WHEN n = 2 THEN t[1] || '>report' ELSE t[1] || '>' || t[2] || '>report' END AS path, n::INT AS loops FROM p""")
def inquiry_paths(spark, d):
    step = F.when(F.col("event_type") == "click", "vqa").when(F.col("event_type") == "view", "search").otherwise("report")
    steps = F.transform(F.array_sort(F.collect_list(F.struct("ts", "event_id", step.alias("s")))), lambda x: x.s)
    # Only a user's first steps are walked, so no whole history is gathered.
    first = windows.ranked_first(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], K.MAX_LOOPS)
    return folds.inquiry(first.groupBy(F.col("user_id").alias("case_id")).agg(steps.alias("steps")))


@query("SELECT round(quantile_cont(n_chars, 0.9), 6) AS p90, round(quantile_cont(n_chars, 0.95), 6) AS p95, round(quantile_cont(n_chars, 0.99), 6) AS p99, max(n_chars) AS largest FROM documents")
def percentiles_lengths(spark, d):
    return metrics.length_percentiles(table(spark, d, "documents"), "n_chars")


@query("""
    SELECT event_type, p::DOUBLE AS point, round(CASE p WHEN 0.5 THEN quantile_cont(value, 0.5) WHEN 0.9 THEN quantile_cont(value, 0.9) ELSE quantile_cont(value, 0.999) END, 6) AS value
    FROM events, (SELECT unnest([0.5, 0.9, 0.999]) AS p) WHERE value IS NOT NULL GROUP BY event_type, p""")
def percentiles_by_type(spark, d):
    return selection.percentiles(table(spark, d, "events"), "value", [0.5, 0.9, 0.999], ["event_type"]).withColumn("value", F.round("value", 6))


@query("SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1")
def keep_last_dedup(spark, d):
    return metrics.keep_last(table(spark, d, "events"), ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id")


@query("SELECT label, vec_id AS pos, round(abs(embedding[1])::DOUBLE, 6) AS conf FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY abs(embedding[1]) DESC, vec_id) AS k FROM embeddings WHERE abs(embedding[1]) >= 0.25) WHERE k = 1")
def best_box_per_class(spark, d):
    rows = table(spark, d, "embeddings").select("label", F.col("vec_id").alias("pos"), F.abs(F.get("embedding", 0)).alias("conf"))
    return metrics.best_per_class(rows, ["label"]).select("label", "pos", F.round(F.col("conf").cast("double"), 6).alias("conf"))


BOXES_SQL = "(VALUES " + ", ".join(f"({i}, '{c}', {x}::DOUBLE, {y}::DOUBLE, {w}::DOUBLE, {h}::DOUBLE, {len(p)})" for i, (c, x, y, w, h, p) in enumerate(K.SEED_BOXES)) + ") b(class_id, class, x, y, w, h, n)"


@query(f"""
    SELECT doc_id, CASE WHEN doc_id > 32 THEN 'val' ELSE 'train' END AS split, class,
        round(least(1, greatest(0, x - w / 2)) / 2 + least(1, greatest(0, x + w / 2)) / 2, 6) AS xc, round(least(1, greatest(0, x + w / 2)) - least(1, greatest(0, x - w / 2)), 6) AS bw
    FROM documents, {BOXES_SQL} WHERE (class = 'child_name' OR (class = 'issue_date' AND doc_id % 100 = 0))""")
def seed_boxes_split(spark, d):
    boxes = spark.createDataFrame([(i, *b) for i, b in enumerate(K.SEED_BOXES)], "class_id int, class string, x double, y double, w double, h double, path string")
    docs = table(spark, d, "documents").select("doc_id", F.concat(F.lit('{"birth_certificate":{"issue_date":"'), F.when(F.col("doc_id") % 100 == 0, F.lit("x")).otherwise(""), F.lit('"},"personal_and_other":{"child":{"name":"n"}}}')).alias("record"))
    rows = docs.crossJoin(F.broadcast(boxes))
    present = F.coalesce(*(F.when(F.col("path") == p, F.try_variant_get(F.try_parse_json("record"), p, "string")) for _, _, _, _, _, p in K.SEED_BOXES), F.lit(""))
    box = rules.clamped_box(F.col("x"), F.col("y"), F.col("w"), F.col("h"))
    return rows.where(present != "").select("doc_id", rules.split_name(F.concat(F.lit("BC_"), "doc_id")).alias("split"), "class", F.round(box.xc, 6).alias("xc"), F.round(box.w, 6).alias("bw"))


@query(READINGS + ", u AS (SELECT lang AS split, * FROM r UNION ALL SELECT 'all', * FROM r) SELECT split, count(*) AS samples, round(count(*) FILTER (same) / count(*), 6) AS exact_match, round(sum(ce) / sum(cn), 6) AS cer FROM u GROUP BY split HAVING sum(cn) > 0")
def splits_union_metrics(spark, d):
    # Each reading is compared once: groups of both kinds are sums of those by language.
    counts = metrics.error_counts(_readings(spark, d), ["lang"])
    both = counts.withColumn("splits", F.explode(F.array("lang", F.lit("all"))))
    return metrics.rated(metrics.added(both, ["splits"])).select(F.col("splits").alias("split"), "samples", "exact_match", "cer")


@query("SELECT count(*) AS embeddings, count(DISTINCT label) AS users, count(DISTINCT vec_id) AS images, true AS available FROM embeddings")
def store_stats(spark, d):
    return metrics.store_stats(table(spark, d, "embeddings"), "label", "vec_id")


@query("SELECT vec_id::VARCHAR AS embedding_id, 'u' || label AS user_id_hash, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE)), 4) AS total FROM embeddings WHERE label = 3 UNION ALL SELECT vec_id::VARCHAR, 'u' || label, NULL FROM embeddings")
def paged_vectors(spark, d):
    """Vectors saved as a service's pages: one user's with their vectors, and all without."""
    url = scratch(spark, "vector-pages")
    e = table(spark, d, "embeddings").select(F.col("vec_id").cast("string").alias("embedding_id"), F.concat(F.lit("u"), "label").alias("user_id_hash"), "embedding")
    vector_pages.save_pages(e, url, rows_a_page=300)
    total = F.round(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double")), 4)
    one = vector_pages.read_pages(spark, url, user="u3").select("embedding_id", "user_id_hash", total.alias("total"))
    return one.union(vector_pages.read_pages(spark, url, columns=["embedding_id", "user_id_hash"]).withColumn("total", F.lit(None).cast("double")))


@query("SELECT vec_id, label FROM embeddings WHERE label = 3")
def user_pushdown(spark, d):
    store = table(spark, d, "embeddings").withColumnRenamed("label", "user")
    return readers.of_user(store, 3).select("vec_id", F.col("user").alias("label"))


@query(r"""
    WITH RECURSIVE n AS (SELECT *, coalesce(lead(text) OVER (PARTITION BY conv_id ORDER BY turn), '') AS answer FROM conversations),
    t AS MATERIALIZED (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k, count(*) OVER (PARTITION BY conv_id) AS n_turns, trim(regexp_replace(text, '\s+', ' ', 'g')) AS q, trim(regexp_replace(answer, '\s+', ' ', 'g')) AS a FROM n WHERE role = 'user'),
    f(conv_id, k, h) AS (
        SELECT DISTINCT conv_id, 0::BIGINT, '' FROM t
        UNION ALL
        SELECT conv_id, k, CASE WHEN q = '' AND a = '' THEN CASE WHEN length(h) > 900 THEN '[...]' || right(h, 900) ELSE h END
                                WHEN length(m) <= 900 THEN m ELSE trim(regexp_replace('[...]' || right(m, 540), '\s+', ' ', 'g')) END
        FROM (SELECT t.conv_id, t.k, q, a, h, trim(CASE WHEN h <> '' THEN h || ' ' ELSE '' END || CASE WHEN regexp_matches(CASE WHEN q <> '' THEN q ELSE a END, '[\x{0600}-\x{06FF}]') THEN 'س: ' || q || ' ج: ' || a ELSE 'Q: ' || q || ' A: ' || a END) AS m
              FROM f JOIN t ON t.conv_id = f.conv_id AND t.k = f.k + 1)
    )
    SELECT f.conv_id, n_turns::INT AS n_turns, h AS history FROM f JOIN t ON t.conv_id = f.conv_id AND t.k = f.k WHERE f.k = n_turns""".replace("\\\\", "\\"))
def chat_history_fold(spark, d):
    return folds.chat_history(_turns(spark, d))


def _turns(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations").withColumn("answer", F.lead("text").over(Window.partitionBy("conv_id").orderBy("turn")))
    return c.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("question"), F.coalesce("answer", F.lit("")).alias("answer"))


@query("""
    WITH RECURSIVE v AS MATERIALIZED (SELECT vec_id, embedding::DOUBLE[] AS e, (vec_id % 101) / 100 >= 0.7 AS ai, row_number() OVER (ORDER BY vec_id) AS k FROM embeddings),
    near AS MATERIALIZED (SELECT a.k, list(b.vec_id) AS near FROM v a JOIN v b ON b.vec_id < a.vec_id AND round(list_inner_product(a.e, b.e), 6) >= 0.4 GROUP BY a.k),
    w AS MATERIALIZED (SELECT v.k, vec_id, ai, coalesce(near, []) AS near FROM v LEFT JOIN near ON near.k = v.k),
    f(k, item, ai, hit, taken) AS (
        SELECT 0::BIGINT, NULL::BIGINT, false, NULL::BIGINT, []::BIGINT[]
        UNION ALL
        SELECT w.k, w.vec_id, w.ai, list_min(list_intersect(w.near, f.taken)), CASE WHEN w.ai OR len(list_intersect(w.near, f.taken)) > 0 THEN f.taken ELSE list_append(f.taken, w.vec_id) END
        FROM f JOIN w ON w.k = f.k + 1
    )
    SELECT item, CASE WHEN ai THEN 'ai' WHEN hit IS NOT NULL THEN 'duplicate' ELSE 'accepted' END AS decision, CASE WHEN NOT ai THEN hit END AS "like" FROM f WHERE k > 0""")
def greedy_accept_index(spark, d):
    v = table(spark, d, "embeddings")
    return folds.accept_vectors(v.select("vec_id", "embedding", ((F.col("vec_id") % 101) / 100).alias("ai")), 0.4)


@query(DUPLICATES + """,
    i AS (SELECT query_id AS case_id, least(1, greatest(0, 0.5::DOUBLE * """ + digest_sql("query_id::VARCHAR", 101) + """ / 100 + CASE WHEN other_user THEN 0.3::DOUBLE WHEN same_user THEN 0.2::DOUBLE ELSE 0.0::DOUBLE END + 0.2::DOUBLE * (1 - (query_id % 89) / 88))) AS score FROM g),
    r AS (SELECT doc_id AS case_id, CASE WHEN trim(text) <> '' THEN '[TEXT]' || chr(10) || trim(text) ELSE '' END AS said, CASE WHEN score IS NULL THEN 0 ELSE 1 END AS images, round(coalesce(score, 0.0), 3) AS risk FROM documents LEFT JOIN i ON i.case_id = doc_id)
    SELECT case_id, length(said)::INT AS chars, images, risk, CASE WHEN risk >= 0.75 THEN 'high' WHEN risk >= 0.4 THEN 'medium' ELSE 'low' END AS level,
           CASE WHEN risk >= 0.4 THEN 'vqa>search>report' ELSE 'report' END AS path, CASE WHEN risk >= 0.75 THEN 'reject' WHEN risk >= 0.4 THEN 'review' ELSE 'approve' END AS decision FROM r""")
def case_pipeline(spark, d):
    from paperloom.plans.pipelines import case_pipeline as run

    return run(spark, d)


def _embedded(rows: str, column: str) -> str:
    """A subquery: ``rows`` with ``u``, what the stand-in embedder makes of a column."""
    return rf"""(SELECT * EXCLUDE (hs, v), CASE WHEN list_sum(list_transform(v, lambda z: z * z)) = 0 THEN v::FLOAT[]
            ELSE list_transform(v, lambda z: z::FLOAT / sqrt(list_sum(list_transform(v, lambda y: y * y))::DOUBLE)::FLOAT) END AS u
        FROM (SELECT *, list_transform(range(64), lambda j: coalesce(list_sum(list_transform(hs, lambda z: CASE WHEN z.d = j THEN z.s ELSE 0 END)), 0)) AS v
            FROM (SELECT *, list_transform(list_transform(list_filter(string_split_regex(lower({column}), '\s+'), lambda z: z <> ''), lambda z: sha256(z)),
                    lambda z: {{'d': ('0x' || substr(z, 1, 2))::INT & 63, 's': CASE WHEN ('0x' || substr(z, 9, 2))::INT & 1 = 1 THEN 1 ELSE -1 END}}) AS hs FROM {rows})))"""


AR = r"'[\x{0600}-\x{06FF}]'"
LETTERED = "CASE WHEN {1} % 3 = 0 THEN translate({0}, 'aeioutnshr', 'ايوكمتنسهر') ELSE {0} END"


@query(rf"""
    WITH RECURSIVE b AS (SELECT item_id, trim(regexp_replace({LETTERED.format("text", "item_id")}, '\s+', ' ', 'g')) AS said FROM benchmark),
    faq AS (SELECT item_id AS id, said, regexp_extract(said, '^[^.]*\.?') AS asked, CASE WHEN regexp_matches(said, {AR}) THEN 'ar' ELSE 'en' END AS lang FROM b),
    pe AS (SELECT * FROM {_embedded("(SELECT *, 'passage: Q: ' || asked || chr(10) || 'A: ' || said || chr(10) || 'FAQ ID: ' || id || chr(10) || 'Tags: ' AS t FROM faq)", "t")}),
    store AS MATERIALIZED (SELECT list({{'id': id, 'lang': lang, 'asked': asked, 'said': said, 'u': u::DOUBLE[]}}) AS l FROM pe),
    t AS MATERIALIZED (
        SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn, x) AS k, trim(regexp_replace(x, '\s+', ' ', 'g')) AS q
        FROM (SELECT conv_id, turn, {LETTERED.format("text", "conv_id")} AS x FROM conversations WHERE role = 'user')
    ),
    f(conv_id, k, turn, query, ids, answer, h) AS (
        SELECT DISTINCT conv_id, 0::BIGINT, NULL::BIGINT, '', '', '', '' FROM t
        UNION ALL
        SELECT conv_id, k, turn, query, ids, answer, CASE WHEN length(m) <= 900 THEN m ELSE trim(regexp_replace('[...]' || right(m, 540), '\s+', ' ', 'g')) END
        FROM (SELECT *, trim(CASE WHEN h <> '' THEN h || ' ' ELSE '' END || CASE WHEN regexp_matches(q, {AR}) THEN 'س: ' || q || ' ج: ' || a ELSE 'Q: ' || q || ' A: ' || a END) AS m
        FROM (SELECT *, trim(regexp_replace(CASE WHEN entity IS NOT NULL AND NOT contains(answer, entity) THEN '(' || entity || ') ' || answer ELSE answer END, '\s+', ' ', 'g')) AS a
        FROM (SELECT *, array_to_string(list_transform(hits, lambda x: x.id), ',') AS ids,
            list_sort(list_filter(list_transform(hits, lambda x, i: {{'n': length(x.asked), 'i': i, 'q': x.asked}}), lambda x: x.q <> ''))[1].q AS entity,
            coalesce(nullif(regexp_replace(CASE WHEN length(ctx) > 4000 THEN '[...]' WHEN hits[-1].lang = 'ar' THEN 'المصدر: ' || hits[-1].said ELSE 'Source: ' || hits[-1].said END,
                '[^\x{{0600}}-\x{{06FF}}0-9\s.،؛:!؟()\-/]', '', 'g'), ''), CASE WHEN lang = 'ar' THEN '{K.INSUFFICIENT_AR}' ELSE '{K.INSUFFICIENT_EN}' END) AS answer
        FROM (SELECT *, array_to_string(list_transform(hits, lambda x: CASE WHEN x.lang = 'ar' THEN 'س: ' || x.asked || chr(10) || 'ج: ' || x.said || chr(10) || 'المصدر: ' || x.said
                ELSE 'Q: ' || x.asked || chr(10) || 'A: ' || x.said || chr(10) || 'Source: ' || x.said END), chr(10) || chr(10) || '---' || chr(10) || chr(10)) AS ctx
        FROM (SELECT *, list_concat(list_filter(top, lambda x: x.lang = lang), list_filter(top, lambda x: x.lang <> lang))[1:5] AS hits
        FROM (SELECT *, list_sort(list_transform(l, lambda x: {{'s': -round(list_inner_product(u::DOUBLE[], x.u), 6), 'id': x.id, 'lang': x.lang, 'asked': x.asked, 'said': x.said}}))[1:10] AS top
        FROM {_embedded(f"""(SELECT *, 'query: ' || query AS e FROM (SELECT *, CASE WHEN regexp_matches(CASE WHEN q <> '' THEN q ELSE h END, {AR}) THEN 'ar' ELSE 'en' END AS lang,
                CASE WHEN q = '' OR h = '' OR len(string_split(q, ' ')) >= 20 OR length(w) > greatest(40, floor(2.2::DOUBLE * length(q))::INT) THEN q ELSE w END AS query
                FROM (SELECT t.*, f.h, t.q || ' ' || regexp_extract(f.h, '[^ ]+$') AS w, store.l FROM f JOIN t ON t.conv_id = f.conv_id AND t.k = f.k + 1 CROSS JOIN store)))""", "e")}
        ))))))
    )
    SELECT conv_id, turn, query, ids, answer, h AS history FROM f WHERE k > 0""")
def rag_pipeline(spark, d):
    from paperloom.plans.pipelines import rag_pipeline as run

    return run(spark, d)


def _missing_sql(path: str, fields) -> str:
    return "; ".join(sorted(f"{path}: ''{f}'' is a required property" for f in fields))


@query(f"""
    SELECT 'page_' || page_id AS document_id, 'page_' || page_id AS record_id, 1 AS record_pages, e AS errors, e <> '' OR page_id % 6 IN (3, 4) AS review,
           CASE page_id % 6 WHEN 2 THEN 'phone,schema_validation' WHEN 5 THEN 'schema_validation' WHEN 3 THEN 'model_output' WHEN 4 THEN 'model_output' ELSE '' END AS uncertain,
           CASE page_id % 6 WHEN 2 THEN {len(K.MEMBER_FIELDS) - 1} WHEN 5 THEN 2 WHEN 3 THEN 1 WHEN 4 THEN 1 ELSE 0 END AS notes
    FROM (SELECT page_id, CASE page_id % 6 WHEN 2 THEN 'family_members.1.age: 5 is not of type ''string'', ''null''; {_missing_sql("family_members.1", [f for f in K.MEMBER_FIELDS if f not in ("name", "age")])}'
        WHEN 5 THEN '<root>: Additional properties are not allowed (''more'' was unexpected); phone: 123 is not of type ''string'', ''null''' ELSE '' END AS e FROM pages)""")
def extraction_pipeline(spark, d):
    from paperloom.plans.pipelines import extraction_pipeline as run

    return run(spark, d)


@query("SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 20")
def top_n_after_sort(spark, d):
    return windows.first_sorted(table(spark, d, "documents").select("doc_id", "n_chars"), [F.desc("n_chars"), "doc_id"], 20)


@query("SELECT doc_id FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 20")
def hash_sample(spark, d):
    return windows.hash_sample(table(spark, d, "documents").select("doc_id"), "doc_id", 20)


@query("""SELECT (SELECT count(*) FROM (SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels)) AS shared, (SELECT count(*) FROM (SELECT doc_id FROM documents UNION SELECT doc_id FROM labels)) AS either,
    (SELECT count(*) FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels)) AS only_a, (SELECT count(*) FROM (SELECT doc_id FROM labels EXCEPT SELECT doc_id FROM documents)) AS only_b""")
def intersect_union_except(spark, d):
    return windows.set_sizes(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels").select("doc_id"))


@query("SELECT user_id, event_id, printf('IMG-%03d', row_number() OVER (PARTITION BY user_id ORDER BY event_id)) AS label FROM events")
def numbered_images(spark, d):
    return windows.numbered(table(spark, d, "events"), ["user_id"], ["event_id"]).select("user_id", "event_id", "label")


@query("SELECT event_id, event_type, nxt AS next FROM (SELECT *, lead(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS nxt FROM events) WHERE nxt IS NOT NULL")
def adjacent_pairs(spark, d):
    return windows.adjacent_pairs(table(spark, d, "events"), ["user_id"], "event_id", "event_type").select("event_id", "event_type", "next")


@query("""SELECT event_id, printf('%02d%02d%02d', (user_id * 37 // 3600)::INT, (user_id * 37 % 3600 // 60)::INT, (user_id * 37 % 60)::INT) AS clock, user_id * 37 * 1000 + 250 AS ms,
    CASE WHEN event_id % 4 = 0 THEN least(user_id + 1, 90)::DOUBLE ELSE 30.0 END AS wait, CASE WHEN user_id = 0 THEN 0 ELSE round((user_id - event_id % 7) / user_id * 100, 6) END AS gain FROM events""")
def clock_and_waits(spark, d):
    s = F.col("user_id") * 37
    stamp = F.format_string("%02d:%02d:%02d,250", F.floor(s / 3600), F.floor(F.pmod(s, F.lit(3600)) / 60), F.pmod(s, F.lit(60)))
    said = F.when(F.col("event_id") % 4 == 0, F.concat(F.lit("limit: try again in "), "user_id", F.lit("s"))).otherwise("busy")
    return table(spark, d, "events").select("event_id", text.clock(s).alias("clock"), text.milliseconds(stamp).alias("ms"), text.retry_after(said).alias("wait"), F.round(text.improvement(F.col("user_id"), F.col("event_id") % 7), 6).cast("double").alias("gain"))


@query("""
    WITH e AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS w, event_type, value FROM events)
    SELECT (epoch(w))::BIGINT AS start_s, event_type, count(*) AS n, round(sum(value), 4) AS total FROM e GROUP BY w, event_type""")
def window_counts(spark, d):
    out = streams.windowed(table(spark, d, "events"))
    return out.select(F.unix_timestamp("start").alias("start_s"), "event_type", "n", F.round("total", 4).alias("total"))


@query("""
    WITH g AS (SELECT user_id, ts, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) < 1800000000 THEN 0 ELSE 1 END AS new FROM events),
    s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
    SELECT user_id, epoch_us(min(ts)) AS start_us, epoch_us(max(ts)) + 1800000000 AS end_us, count(*) AS n FROM s GROUP BY user_id, k""")
def session_counts(spark, d):
    out = streams.sessions(table(spark, d, "events"))
    return out.select("user_id", F.unix_micros("start").alias("start_us"), F.unix_micros("end").alias("end_us"), "n")


@query("""
    WITH c AS (SELECT page_id, string_split(url, '/') AS p FROM pages)
    SELECT page_id, p[len(p)] AS base, regexp_replace(p[len(p)], '(.)\\.[^.]*$', '\\1') AS stem FROM c""")
def path_parts(spark, d):
    return table(spark, d, "pages").select("page_id", text.base_name(F.col("url")).alias("base"), text.stem(F.col("url")).alias("stem"))


@query("SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'front' WHEN 1 THEN 'back' END AS side, CASE doc_id % 3 WHEN 0 THEN 'front' WHEN 1 THEN 'back' END AS canonical FROM documents")
def page_sides(spark, d):
    id_ = F.col("doc_id")
    said = F.when(id_ % 4 == 0, F.concat(F.lit(K.FRONT_CUES[1]), "lang", F.lit(K.BACK_CUES[0]))).when(id_ % 4 == 1, F.lit(K.BACK_CUES[2])).otherwise(F.col("lang"))
    named = F.when(id_ % 3 == 0, "The FRONT page").when(id_ % 3 == 1, "ظهر").otherwise("?")
    return table(spark, d, "documents").select("doc_id", text.page_side(said).alias("side"), text.canonical_side(named).alias("canonical"))


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN lang END AS type, CASE WHEN doc_id % 2 = 0 THEN source || '=x' END AS value FROM documents")
def typed_pairs(spark, d):
    p = F.concat("lang", F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit(" = "), "source", F.lit("=x"))).otherwise(""))
    return table(spark, d, "documents").select("doc_id", jsonx.typed_pair(p).alias("p")).select("doc_id", "p.type", "p.value")


@query("SELECT doc_id, doc_id % 2 = 0 AS fit, base64(encode(lang || source)) AS bare FROM documents")
def base64_payloads(spark, d):
    b = F.base64(F.concat("lang", "source").cast("binary"))
    given = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("data:image/png;base64,"), b)).otherwise(F.concat(F.lit("!"), b))
    return table(spark, d, "documents").select("doc_id", text.is_base64(given).alias("fit"), F.ltrim(text.strip_data_uri(given), F.lit("!")).alias("bare"))


@query("""
    SELECT doc_id || '::' || l AS id, doc_id::VARCHAR AS faq_id, l AS lang, CASE WHEN l = 'en' THEN lang ELSE '' END AS question, CASE WHEN l = 'en' THEN 'an answer' ELSE 'جواب' END AS answer
    FROM documents, (SELECT unnest(['ar', 'en']) AS l) WHERE l = 'en' OR doc_id % 2 = 0""")
def faq_rows(spark, d):
    f = F.struct(F.col("doc_id").cast("string").alias("id"), F.lit("").alias("question_ar"), F.when(F.col("doc_id") % 2 == 0, "  جواب ").otherwise("").alias("answer_ar"), F.concat(F.lit(" "), "lang").alias("question_en"), F.lit("an \n answer").alias("answer_en"), F.array("source").alias("tags"))
    raw = table(spark, d, "documents").select(F.concat(F.lit("/faq/"), "doc_id", F.lit(".json")).alias("path"), F.to_json(F.struct(F.array(f).alias("faqs"))).alias("value"))
    return readers.faq_rows(raw).select("id", "faq_id", "lang", "question", "answer")


@query("SELECT doc_id::VARCHAR AS document_id, 'a.png' AS first_image, CASE WHEN doc_id % 3 = 0 THEN 'default' ELSE lang END AS document_type FROM documents")
def manifest_rows(spark, d):
    doc = F.struct(F.col("doc_id").cast("string").alias("document_id"), F.array(F.lit("a.png")).alias("images"), F.when(F.col("doc_id") % 3 == 0, " ").otherwise(F.concat(F.lit(" "), "lang")).alias("document_type"))
    as_list, as_object = F.to_json(F.array(doc)), F.to_json(F.struct(F.array(doc).alias("pipeline_manifest")))
    raw = table(spark, d, "documents").select(F.when(F.col("doc_id") % 2 == 0, as_list).otherwise(as_object).alias("value"))
    return readers.manifest_rows(raw).select("document_id", F.get("images", 0).alias("first_image"), "document_type")


@query("""SELECT 'v' || conv_id AS path, turn AS pos, turn * 2000 AS start_ms, turn * 2000 + 1500 AS end_ms, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS text FROM conversations WHERE trim(text) <> ''""")
def caption_cues(spark, d):
    at = lambda ms: F.format_string("%02d:%02d.%03d", F.floor(ms / 60000), F.floor(F.pmod(ms, F.lit(60000)) / 1000), F.pmod(ms, F.lit(1000)))
    start = F.col("turn") * 2000
    cue = F.concat(at(start), F.lit(" --> "), at(start + 1500), F.lit("\n<i>"), F.regexp_replace("text", r"\s+", " "), F.lit("</i>"))
    file = F.concat(F.lit("WEBVTT\n\n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", cue.alias("c")))), lambda x: x.c), "\n\n"))
    raw = table(spark, d, "conversations").groupBy("conv_id").agg(file.alias("value")).select(F.concat(F.lit("v"), "conv_id").alias("path"), "value")
    return readers.caption_cues(raw).select("path", F.floor(F.col("start_ms") / 2000).alias("pos"), "start_ms", "end_ms", "text")


@query("SELECT 'lang' AS module, count(*) AS total, printf('%.1f%%', 100 * count(*) FILTER (lang = 'en') / count(*)) AS share, printf('%d%%', floor(100 * count(*) FILTER (lang = 'en') / count(*))::INT) AS whole FROM documents")
def printed_report(spark, d):
    r = table(spark, d, "documents").agg(F.count("*").alias("total"), F.count_if(F.col("lang") == "en").alias("en"))
    return r.select(F.lit("lang").alias("module"), "total", writers.percent(F.col("en"), F.col("total")).alias("share"), writers.percent(F.col("en"), F.col("total"), floor=True).alias("whole"))


@query("SELECT vec_id, label FROM embeddings WHERE vec_id % 10 > 1 UNION ALL SELECT vec_id, -1 FROM embeddings WHERE vec_id % 10 = 1")
def upsert_delete(spark, d):
    store = table(spark, d, "embeddings").select("vec_id", "label")
    changed = store.where("vec_id % 10 = 1").select("vec_id", F.lit(-1).alias("label"))
    return writers.deleted(writers.upserted(store, changed, "vec_id"), store.where("vec_id % 10 = 0"), "vec_id")


@query("SELECT doc_id, 'معي ' || CASE doc_id % 3 WHEN 0 THEN 'five' WHEN 1 THEN 'two thousand' ELSE 'خمسةx' END || ' جنيه' AS said FROM documents")
def number_words(spark, d):
    n = F.when(F.col("doc_id") % 3 == 0, "خمسة").when(F.col("doc_id") % 3 == 1, "ألفين").otherwise("خمسةx")
    return table(spark, d, "documents").select("doc_id", text.number_words(F.concat(F.lit("معي "), n, F.lit(" جنيه"))).alias("said"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN '[1]' WHEN event_id % 3 = 1 THEN props END AS object FROM events")
def first_object(spark, d):
    said = F.when(F.col("event_id") % 3 == 0, F.lit("[1]")).when(F.col("event_id") % 3 == 1, F.concat(F.lit("so: "), "props", F.lit(" } {"))).otherwise(F.lit("none {"))
    return table(spark, d, "events").select("event_id", A.first_object(said).alias("object"))


@query("""SELECT event_id, CASE WHEN event_id % 2 = 0 THEN '[{"item":"' || event_type || '"}]' ELSE '[]' END AS pricing, '[]' AS definitions, CASE WHEN event_id % 2 = 1 THEN event_type END AS raw_fallback FROM events""")
def search_repair(spark, d):
    reply = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit('```json {"pricing":[{"item":"'), "event_type", F.lit('"},],}```'))).otherwise(F.col("event_type"))
    return table(spark, d, "events").select("event_id", jsonx.repaired_search(reply).alias("r")).select("event_id", "r.pricing", "r.definitions", "r.raw_fallback")


@query("SELECT doc_id, source AS serial, CASE WHEN doc_id % 2 = 0 THEN lang END AS child, CASE WHEN doc_id % 3 = 0 THEN 1 ELSE 0 END AS others, doc_id % 5 = 0 AS review FROM documents")
def certificate_defaults(spark, d):
    id_ = F.col("doc_id")
    payload = F.concat(F.lit('{"birth_certificate":{"serial_number":"'), "source", F.lit('"}'), F.when(id_ % 2 == 0, F.concat(F.lit(',"personal_and_other":{"child":{"name":"'), "lang", F.lit('"}}'))).otherwise(""), F.when(id_ % 3 == 0, F.lit(',"ids":{"other_ids":[{"label_ar":"l","value":"v"},7]}')).otherwise(""), F.when(id_ % 5 == 0, F.lit(',"review_required":true')).otherwise(""), F.lit("}"))
    r = table(spark, d, "documents").select("doc_id", jsonx.certificate_defaults(payload).alias("r"))
    return r.select("doc_id", F.col("r.birth_certificate.serial_number").alias("serial"), F.col("r.personal_and_other.child.name").alias("child"), F.size(F.filter("r.ids.other_ids", lambda x: x.value.isNotNull())).alias("others"), F.col("r.review_required").alias("review"))


@query("SELECT doc_id, 'doc ' || doc_id AS record_id, 1 AS pages, 'model_output' AS uncertain, true AS review FROM documents")
def fallback_records(spark, d):
    p = jsonx.fallback_record(F.concat(F.lit("doc "), "doc_id"), F.array("source"), F.lit("bad"))
    r = table(spark, d, "documents").select("doc_id", p.alias("p"))
    return r.select("doc_id", jsonx.at(F.col("p"), "document_id").alias("record_id"), jsonx.at(F.col("p"), "page_count", "int").alias("pages"), jsonx.at(F.col("p"), "uncertain_fields[0]").alias("uncertain"), jsonx.at(F.col("p"), "review_required", "boolean").alias("review"))


@query("SELECT doc_id, lang || ',' || source AS texts FROM documents")
def harvested_texts(spark, d):
    j = F.concat(F.lit('[[[[0,0],[1,1]],["'), "lang", F.lit('",0.9]],{"rec_texts":["'), "source", F.lit('"]}]'))
    return table(spark, d, "documents").select("doc_id", F.array_join(A.harvest_texts(j), ",").alias("texts"))


@query("SELECT doc_id, lang AS lang, 'core' AS source FROM documents")
def metadata_maps(spark, d):
    obj = F.to_json(F.struct("lang", "source"))
    given = F.when(F.col("doc_id") % 2 == 0, obj).otherwise(F.to_json(F.array(obj)).substr(F.lit(2), F.length(F.to_json(F.array(obj))) - 2))
    m = jsonx.metadata(given, F.create_map(F.lit("source"), F.lit("core")))
    return table(spark, d, "documents").select("doc_id", m.alias("m")).select("doc_id", F.col("m")["lang"].alias("lang"), F.col("m")["source"].alias("source"))


@query("SELECT vec_id::VARCHAR AS id, label::VARCHAR AS user, round(embedding[1]::DOUBLE, 6) AS first FROM embeddings WHERE vec_id % 4 > 0")
def stored_vectors(spark, d):
    packed = table(spark, d, "embeddings").select("vec_id", "label", F.when(F.col("vec_id") % 4 > 0, F.base64(A.pack_floats("embedding"))).alias("b"))
    e = F.array(F.struct(F.col("vec_id").cast("string").alias("requestId"), F.col("label").cast("string").alias("userIdHash"), F.col("b").alias("embedding")))
    raw = packed.select(F.when(F.col("vec_id") % 2 == 0, F.to_json(e)).otherwise(F.to_json(F.struct(e.alias("data")))).alias("value"))
    return readers.embedding_rows(raw).select(F.col("requestId").alias("id"), F.col("userIdHash").alias("user"), F.round(F.get(A.unpack_floats("embedding"), 0).cast("double"), 6).alias("first"))


@query("SELECT c AS category, i::INT AS pos, q AS question FROM (VALUES ('a', 0, 'x?'), ('a', 1, 'y?'), ('b', 0, 'z?')) v(c, i, q)")
def question_templates(spark, d):
    return readers.templates(spark, {"a": ["x?", "y?"], "b": ["z?"]})


@query("SELECT doc_id, base64(encode(lang)) AS voice, 1 AS images, 1 AS skipped FROM documents")
def job_payloads(spark, d):
    none = F.lit(None).cast("string")
    jobs = table(spark, d, "documents").select("doc_id", none.alias("audio_base64"), F.concat(F.lit("data:audio/wav;base64,"), F.base64(F.col("lang").cast("binary"))).alias("voice_base64"), F.lit(None).cast("array<string>").alias("images_base64"), F.array(F.concat("source", F.lit(".png")), F.lit("!?")).alias("images"))
    return readers.job_inputs(jobs).select("doc_id", "voice", F.size("image_inputs").alias("images"), "skipped")


@query("SELECT CASE WHEN doc_id % 2 = 0 THEN doc_id::VARCHAR ELSE 'image_1' END AS id, CASE WHEN doc_id % 3 = 0 THEN lang ELSE 'unknown' END AS user_id, source AS image_path FROM documents")
def image_batches(spark, d):
    i = F.struct(F.when(F.col("doc_id") % 2 == 0, F.col("doc_id").cast("string")).alias("id"), F.when(F.col("doc_id") % 3 == 0, F.col("lang")).alias("user_id"), F.col("source").alias("image_path"))
    return readers.batch_images(table(spark, d, "documents").select(F.array(i).alias("images")))


@query("""
    WITH r AS (SELECT doc_id AS document_id, 'lang' AS field, lang AS value FROM documents UNION ALL SELECT doc_id, 'source', CASE WHEN doc_id % 2 = 0 THEN source ELSE lang END FROM documents)
    SELECT document_id, field, value FROM r UNION ALL SELECT doc_id, 'absent', NULL FROM documents""")
def field_reads(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("document_id"), "lang", "source")
    read = lambda f, c, pos: docs.select("document_id", F.lit(f).alias("field"), F.col(c).alias("value"), F.lit(pos).alias("pos"))
    reads = read("lang", "lang", 0).union(read("source", "lang", 0)).union(read("source", "source", 1).where("document_id % 2 = 0"))
    return joins.field_reads(reads, docs, spark.createDataFrame([("lang",), ("source",), ("absent",)], "field string"))


@query("SELECT '/m/' || doc_id AS stem, '/m/' || doc_id || '.wav' AS media, '/m/' || doc_id || '.txt' AS partner FROM documents WHERE doc_id % 2 = 0")
def paired_media(spark, d):
    ext = F.explode(F.array(F.lit(".mp3"), F.lit(".wav"), F.when(F.col("doc_id") % 2 == 0, ".txt").otherwise(".jpg"))).alias("e")
    files = table(spark, d, "documents").select("doc_id", ext).select(F.concat(F.lit("/m/"), "doc_id", "e").alias("path"))
    return joins.paired_media(files, [".wav", ".mp3"], ".txt")


@query("SELECT user_id, round(avg((event_id % 101) / 100), 3) AS mean_confidence FROM events GROUP BY user_id")
def mean_confidences(spark, d):
    return metrics.mean_confidence(table(spark, d, "events").select("user_id", ((F.col("event_id") % 101) / 100).alias("confidence")), ["user_id"])


@query("SELECT user_id, arg_max(event_id, event_id) FILTER (event_type = 'click') AS last_click FROM events GROUP BY user_id")
def last_inquiry(spark, d):
    return windows.last_entry(table(spark, d, "events"), ["user_id"], "event_id", F.col("event_type") == "click", "event_id").withColumnRenamed("last", "last_click")


@query("SELECT count(*) FILTER (event_type <> 'error') AS saved, count(*) FILTER (event_type = 'error') AS failed FROM events")
def run_counts(spark, d):
    from paperloom.sources.files import run_counts as counts

    return counts(table(spark, d, "events").select((F.col("event_type") != "error").alias("saved")))


@query("SELECT event_id, 'accepted' AS part FROM events WHERE event_id % 100 >= 60 UNION ALL SELECT event_id, 'low' FROM events WHERE event_id % 100 < 60")
def score_split(spark, d):
    from paperloom.sources.files import score_split as split

    good, low = split(table(spark, d, "events").select("event_id", ((F.col("event_id") % 100) / 100).alias("score")), "score", 0.6)
    return good.select("event_id", F.lit("accepted").alias("part")).union(low.select("event_id", F.lit("low")))


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'child_national_id,health_office' ELSE 'health_office' END AS present FROM documents")
def present_fields(spark, d):
    from paperloom.sources.files import present_fields as present

    p = F.concat(F.lit('{"ids":{"child_national_id":"'), F.when(F.col("doc_id") % 2 == 0, "5").otherwise(""), F.lit('"},"birth_certificate":{"health_office":"x"}}'))
    return present(table(spark, d, "documents").select("doc_id", p.alias("p")), "p").select("doc_id", F.array_join("present", ",").alias("present"))


@query("SELECT page_id, CASE WHEN page_id % 2 = 0 THEN '/img/' || page_id || '.png' END AS resolved FROM pages")
def resolved_paths(spark, d):
    from paperloom.sources.files import resolved

    p = table(spark, d, "pages")
    listing = p.where("page_id % 2 = 0").select(F.concat(F.lit("/img/"), "page_id", F.lit(".png")).alias("path"))
    return resolved(p.select("page_id", F.concat(F.lit("C:\\data\\"), "page_id", F.lit(".png")).alias("p")), "p", listing).select("page_id", "resolved")


@query("SELECT doc_id, lang AS a, source AS b FROM documents")
def merged_regions(spark, d):
    m = providers.merged_passes(F.create_map(F.lit("a"), F.col("lang"), F.lit("b"), F.lit("")), F.array(F.create_map(F.lit("a"), F.lit("other"), F.lit("b"), F.col("source"))))
    return table(spark, d, "documents").select("doc_id", m.alias("m")).select("doc_id", F.col("m")["a"].alias("a"), F.col("m")["b"].alias("b"))


@query("""
    WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
    p AS (SELECT vec_id, e, unnest(range(64)) AS i FROM e),
    l AS (SELECT vec_id, e[8 * (CASE i // 8 WHEN 0 THEN 1 ELSE i // 8 - 1 END) + i % 8 + 1] + e[8 * (CASE i // 8 WHEN 7 THEN 6 ELSE i // 8 + 1 END) + i % 8 + 1]
          + e[8 * (i // 8) + (CASE i % 8 WHEN 0 THEN 1 ELSE i % 8 - 1 END) + 1] + e[8 * (i // 8) + (CASE i % 8 WHEN 7 THEN 6 ELSE i % 8 + 1 END) + 1] - 4 * e[i + 1] AS v, e[i + 1] AS x FROM p)
    SELECT vec_id, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS std, round(quantile_cont(x, 0.02), 6) AS p2, round(quantile_cont(x, 0.98), 6) AS p98, count(*) FILTER (x <= 0 OR x >= 255) AS clipped, round(var_pop(v), 6) AS sharpness
    FROM l GROUP BY vec_id""")
def image_statistics(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("p"))
    s = e.select("vec_id", A.image_stats("p", F.lit(8)).alias("s"))
    return s.select("vec_id", *(F.round(f"s.{c}", 6).alias(c) for c in ("mean", "std", "p2", "p98", "sharpness")), "s.clipped")


@query(r"""
    WITH n AS (SELECT role, text AS g, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS p FROM conversations),
    w AS (SELECT role, list_distinct(list_filter(string_split_regex(lower(p), '\s+'), lambda x: x <> '')) AS x, list_distinct(list_filter(string_split_regex(lower(g), '\s+'), lambda x: x <> '')) AS y FROM n WHERE p IS NOT NULL)
    SELECT role, round(avg(CASE WHEN len(x) + len(y) = 0 THEN 1 ELSE 2 * len(list_intersect(x, y)) / (len(x) + len(y)) END), 6) AS similarity FROM w GROUP BY role""")
def mean_similarity(spark, d):
    n = table(spark, d, "conversations").withColumn("p", F.lead("text").over(Window.partitionBy("conv_id").orderBy("turn"))).where("p is not null")
    return providers.call(n, "text_similarity", ["p", "text"], "s").groupBy("role").agg(F.round(F.avg("s"), 6).alias("similarity"))


# --- agents, images, sinks -----------------------------------------------------------------------

CASES = ["What is it?", "Where is it?"]


def _vqa_sql(columns: str, prompt: str) -> str:
    said = "CASE " + digest_sql("image_path || '|' || prompt", 3) + " WHEN 0 THEN 'نعم' WHEN 1 THEN 'لا' ELSE 'غير واضح' END"
    return f"a AS (SELECT {columns}, {said} AS answer FROM (SELECT *, {prompt} AS prompt FROM q))"


@query("""
    WITH q AS (SELECT doc_id AS case_id, source AS image_path, lang AS ocr, unnest(['What is it?', 'Where is it?', 'c']) AS question FROM documents),
    """ + _vqa_sql("case_id, question", "CASE WHEN question = 'c' THEN c || chr(10) || chr(10) || ocr || chr(10) || chr(10) || c ELSE 'Category: aid' || chr(10) || chr(10) || ocr || chr(10) || chr(10) || question END").replace("FROM q)", "FROM (SELECT *, 'النص المذكور:' || chr(10) || ocr || chr(10) || chr(10) || 'هل الصورة تتفق مع هذا النص؟' || chr(10) || 'أجب بنعم أو لا أو غير واضح مع توضيح مختصر.' AS c FROM q))") + """
    SELECT case_id, 1::BIGINT AS images, round(avg(CASE answer WHEN 'غير واضح' THEN 0.45 ELSE 0.95 END) FILTER (question <> 'c'), 3) AS overall_confidence, string_agg(answer, ',') FILTER (question = 'c') AS agrees FROM a GROUP BY case_id""")
def vqa_cases(spark, d):
    images = table(spark, d, "documents").select(F.col("doc_id").alias("case_id"), F.lit(0).alias("pos"), F.col("source").alias("image_path"), F.col("lang").alias("ocr"))
    answers = agents.answer_questions(images, "aid", CASES)
    agrees = answers.where("question_type = 'image_text_consistency'").select("case_id", F.col("answer").alias("agrees"))
    return agents.overall_confidence(answers).join(agrees, "case_id")


@query("""
    WITH q AS (SELECT doc_id AS case_id, source AS image_path, lang AS ocr, unnest(['What?', 'هل يتفق؟']) AS question, unnest([0, 1]) AS question_no FROM documents),
    """ + _vqa_sql("case_id, question_no", "'a case' || CASE WHEN question_no = 1 THEN chr(10) || chr(10) || 'OCR:' || chr(10) || ocr ELSE '' END || chr(10) || chr(10) || ocr || chr(10) || chr(10) || question") + """
    SELECT case_id, question_no, answer, 0.95::DOUBLE AS confidence FROM a""")
def vqa_batch(spark, d):
    images = table(spark, d, "documents").select(F.col("doc_id").alias("case_id"), F.col("source").alias("image_path"), F.col("lang").alias("ocr"))
    return agents.answer_batch(images, "a case", ["What?", "هل يتفق؟"]).select("case_id", "question_no", "answer", "confidence")


@query("""
    WITH t AS (SELECT user_id AS case_id, list(event_type ORDER BY ts, event_id)[:6] AS t FROM events GROUP BY user_id),
    n AS (SELECT case_id, t, CASE WHEN coalesce(list_position(t, 'error'), 0) > 0 THEN list_position(t, 'error') ELSE len(t) END AS n FROM t)
    SELECT case_id, n::INT AS model_calls, array_to_string(CASE WHEN n = 6 OR t[n] = 'error' THEN t[:n - 1] ELSE t END, ',') AS used, t[n] AS last FROM n""")
def tool_loop(spark, d):
    tool = F.when(F.col("event_type") != "error", F.col("event_type"))
    # Six calls are all that a loop reads, so no more of a case's replies are kept.
    first = windows.ranked_first(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], agents.TOOL_CALLS)
    replies = first.groupBy(F.col("user_id").alias("case_id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("ts", "event_id", tool.alias("tool"), F.col("event_type").alias("content")))), lambda x: F.struct(x.tool.alias("tool"), x.content.alias("content"))).alias("replies"))
    return agents.tool_loop(replies).withColumn("used", F.array_join("used", ","))


@query("SELECT doc_id, source AS search, lang AS cold FROM documents")
def evidence_merge(spark, d):
    e = agents.with_evidence(F.create_map(F.lit("search"), F.col("source"), F.lit("cold"), F.lit("old")), "cold", F.col("lang"))
    return table(spark, d, "documents").select("doc_id", e.alias("e")).select("doc_id", F.col("e")["search"].alias("search"), F.col("e")["cold"].alias("cold"))


@query("""
    WITH e AS (SELECT event_id, event_id % 3 > 0 AS there FROM events)
    SELECT 'skipped' AS how, count(*) FILTER (there) AS total, 0::BIGINT AS errors FROM e UNION ALL SELECT 'kept', count(*), count(*) FILTER (NOT there) FROM e""")
def missing_files(spark, d):
    e = table(spark, d, "events").select("event_id", F.concat(F.lit("/img/"), "event_id").alias("image_path"))
    listing = e.where("event_id % 3 > 0").select(F.col("image_path").alias("path"))
    skipped = agents.measured(e, listing, keep_errors=False).agg(F.count("*").alias("total")).select(F.lit("skipped").alias("how"), "total", F.lit(0).cast("long").alias("errors"))
    return skipped.union(agents.measured(e, listing, keep_errors=True).agg(F.count("*").alias("total"), F.count_if(F.col("error").isNotNull()).alias("errors")).select(F.lit("kept").alias("how"), "total", "errors"))


@query("SELECT lang, count(*) AS n, round(avg(CASE WHEN doc_id % 5 = 1 THEN 0 ELSE 1 END), 6) AS exact FROM documents WHERE doc_id % 5 > 0 GROUP BY lang")
def blank_predictions(spark, d):
    pred = F.when(F.col("doc_id") % 5 == 0, F.lit("  ")).when(F.col("doc_id") % 5 == 1, F.lit("?")).otherwise(F.col("source"))
    rows = agents.read_pairs(table(spark, d, "documents").select("lang", "source", pred.alias("pred")))
    return rows.groupBy("lang").agg(F.count("*").alias("n"), F.round(F.avg((F.col("pred") == F.col("source")).cast("int")), 6).alias("exact"))


@query("""
    WITH q AS (SELECT doc_id AS query_id, source || ' price' AS query FROM documents), s AS (SELECT t AS term, r::INT AS rank, t || r AS title FROM (SELECT unnest(['1', '2', '15']) AS t), (SELECT unnest([1, 2, 3, 4]) AS r)),
    h AS (SELECT query_id, term, rank, title, row_number() OVER (PARTITION BY query_id ORDER BY rank, 'المصدر ' || rank || ': ' || title) AS k FROM q JOIN s ON contains(query, term) WHERE rank <= 3)
    SELECT q.query_id, coalesce((SELECT string_agg('المصدر ' || rank || ': ' || title || ' | الرابط: u' || chr(10) || 'الملخص: c' || chr(10) || chr(10), '' ORDER BY k) FROM h WHERE h.query_id = q.query_id AND k <= 3), 'لم يتم العثور على نتائج للبحث.') AS context FROM q""")
def web_search(spark, d):
    store = spark.createDataFrame([(t, r, f"{t}{r}", "u", "c") for t in ("1", "2", "15") for r in range(1, 5)], "term string, rank int, title string, url string, content string")
    return agents.web_results(table(spark, d, "documents").select(F.col("doc_id").alias("query_id"), F.concat("source", F.lit(" price")).alias("query")), store)


@query("SELECT 'doc_' || doc_id AS document_id, '{\"document_id\": \"doc_' || doc_id || '\", \"page_count\": 1}' AS record FROM documents")
def read_in_phases(spark, d):
    folder = scratch(spark, "phases")
    images = table(spark, d, "documents").select(F.concat(F.lit("doc_"), "doc_id").alias("document_id"), F.col("source").alias("image"))
    return agents.read_in_phases(images, f"{folder}/texts", f"{folder}/records")


@query("""
    SELECT 'lang' AS module, 'summary' AS part, '{"total":' || count(*) || '}' AS content FROM documents
    UNION ALL SELECT 'lang', 'result', '{"doc_id":' || doc_id || ',"lang":"' || lang || '"}' FROM documents""")
def module_report(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang")
    return writers.report("lang", docs.agg(F.count("*").alias("total")), docs)


@query("""
    SELECT item_id::VARCHAR AS document_id, 'image' AS kind, length(text)::BIGINT AS size FROM benchmark WHERE item_id % 3 = 0 AND regexp_matches(text, '^[\\x{00}-\\x{7F}]*$')
    UNION ALL SELECT item_id::VARCHAR, 'record', item_id FROM benchmark WHERE item_id % 3 > 0 UNION ALL SELECT 'summary', 'records', count(*) FROM benchmark WHERE item_id % 3 > 0""")
def folder_sources(spark, d):
    """A folder of pictures and records as another program leaves it: listed, read, built once, summed up."""
    folder = scratch(spark, "folder")
    b = table(spark, d, "benchmark").where(r"item_id % 3 > 0 or text rlike '^\\p{ASCII}*$'")
    is_image = F.col("item_id") % 3 == 0
    name = F.when(is_image, F.concat(F.lit("images/"), "item_id", F.lit(".PNG"))).otherwise(F.concat(F.lit("records/"), "item_id", F.lit(".json")))
    writers.write_files(b.select(name.alias("name"), F.when(is_image, F.col("text")).otherwise(F.to_json(F.struct("item_id"))).alias("content")), folder)
    pictures = readers.list_images(spark, f"{folder}/images").select(text.stem(F.col("path")).alias("document_id"), F.lit("image").alias("kind"), F.col("length").alias("size"))
    build = lambda: readers.read_records(spark, f"{folder}/records")
    for _ in range(2):  # the second time it is there
        records = readers.load_or_build(spark, f"{folder}/index", build)
    records = records.select("document_id", F.lit("record").alias("kind"), jsonx.at(F.col("payload"), "item_id", "long").alias("size"))
    writers.write_summary(records.agg(F.count("*").alias("n")), f"{folder}/summary")
    summary = readers.json_or_empty(spark, f"{folder}/summary", "n long").select(F.lit("summary").alias("document_id"), F.lit("records").alias("kind"), F.col("n").alias("size"))
    return pictures.union(records).union(summary)


@query("SELECT event_id, event_type FROM events")
def autosaved(spark, d):
    saved = BatchTable(spark, scratch(spark, "autosave"), "event_id long, event_type string")
    rows = table(spark, d, "events").select("event_id", "event_type")
    batches = [lambda k=k: rows.where(F.pmod(F.col("event_id"), F.lit(4)) == k) for k in range(4)]
    writers.autosave(batches[:3], saved, "events")
    writers.autosave(batches, saved, "events")  # as after a restart: what is there isn't written again
    saved.fold()
    return saved.rows()


@query("""
    SELECT vec_id, CASE WHEN vec_id % 20 = 0 THEN -2 WHEN vec_id % 10 = 1 THEN -1 ELSE label END AS label, embedding[1]::DOUBLE AS x FROM embeddings
    WHERE (vec_id % 10 > 0 OR vec_id % 20 = 0) AND vec_id % 7 <> 0""")
def mutable_store(spark, d):
    """Vectors put in, changed, taken out, put in again, with compaction between."""
    v = table(spark, d, "embeddings").select("vec_id", "label", F.get("embedding", 0).cast("double").alias("x"))
    store = KeyedStore(spark, scratch(spark, "vector-store"), "vec_id", v.schema)
    store.upsert(v)
    store.compact()
    store.upsert(v.where("vec_id % 10 = 1").withColumn("label", F.lit(-1)))
    store.delete(v.where("vec_id % 10 = 0").select("vec_id"))
    before = store.log.entry().version
    store.upsert(v.where("vec_id % 20 = 0").withColumn("label", F.lit(-2)))
    store.compact()
    store.delete(v.where("vec_id % 7 = 0").select("vec_id"))
    assert store.snapshot(before).where("vec_id % 10 = 0").isEmpty()
    store.vacuum()
    return store.snapshot()


@query("SELECT doc_id, lang, source FROM documents")
def written_records(spark, d):
    path = scratch(spark, "records")
    writers.write_records(table(spark, d, "documents").select("doc_id", "lang", "source"), path, by="lang")
    return spark.read.schema("doc_id long, source string, lang string").json(path)


@query("SELECT doc_id::VARCHAR AS doc_id, lang AS split, source FROM documents")
def written_splits(spark, d):
    path = scratch(spark, "splits")
    writers.write_splits(table(spark, d, "documents").select("doc_id", F.col("lang").alias("split"), "source"), path)
    return readers.read_labels(spark, path)


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'a.JPG' ELSE 'b.Tiff' END AS path FROM documents WHERE doc_id % 3 > 0")
def image_paths(spark, d):
    path = F.when(F.col("doc_id") % 3 == 0, "c.txt").when(F.col("doc_id") % 2 == 0, "a.JPG").otherwise("b.Tiff")
    return table(spark, d, "documents").select("doc_id", path.alias("path")).where(readers.is_image(F.col("path")))


@query("SELECT doc_id || CASE WHEN doc_id % 2 = 0 THEN '.jpg' ELSE '.png' END AS file, lang AS label FROM documents WHERE doc_id % 3 > 0")
def labelled_files(spark, d):
    rows = table(spark, d, "documents").select("source", F.concat("doc_id", F.when(F.col("doc_id") % 2 == 0, ".jpg").otherwise("")).alias("IMAGE"), F.when(F.col("doc_id") % 3 == 0, " NaN").otherwise(F.concat(F.lit(" "), "lang")).alias("MEDICINE_NAME"))
    return readers.label_pairs(rows)


@query("SELECT doc_id, lang FROM documents WHERE doc_id = 7")
def one_by_key(spark, d):
    return readers.by_key(table(spark, d, "documents").select("doc_id", "lang"), "doc_id", 7)


@query("SELECT doc_id, lang FROM documents WHERE doc_id IN (3, 5, 8) ORDER BY doc_id LIMIT 2")
def listed_ids(spark, d):
    return readers.by_id_list(table(spark, d, "documents").select("doc_id", "lang"), "doc_id", "3, 5,,8", 2)


@query("SELECT CASE WHEN doc_id % 5 = 0 THEN 'INVALID' ELSE 'OK' END AS status, count(*) AS n FROM documents GROUP BY 1")
def validity_counts(spark, d):
    payload = F.when(F.col("doc_id") % 5 == 0, F.lit("[]")).otherwise(F.to_json(F.struct("lang")))
    rows = table(spark, d, "documents").select(jsonx.violations(payload, {"lang": {"type": "string", "required": True}}).alias("errors"))
    return jsonx.validity_report(rows, "errors")


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN props END AS object FROM events")
def greedy_objects(spark, d):
    said = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("so "), "props", F.lit(" it is"))).otherwise(F.concat("props", F.lit(" and {}")))
    return table(spark, d, "events").select("event_id", jsonx.greedy_object(said).alias("object"))


@query("SELECT event_id, props AS bare FROM events")
def bare_replies(spark, d):
    said = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit(" ```JSON\n"), "props", F.lit("\n``` "))).otherwise(F.col("props"))
    return table(spark, d, "events").select("event_id", jsonx.strip_fences(said).alias("bare"))


@query("SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS k FROM events) WHERE k = 1")
def first_rows(spark, d):
    return windows.first_of(table(spark, d, "events"), ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id")


@query("SELECT 'a_' || doc_id AS document_id, 'a' AS document_type FROM documents UNION ALL SELECT 'b_' || item_id, 'b' FROM benchmark")
def typed_documents(spark, d):
    a = table(spark, d, "documents").select(F.concat(F.lit("/x/"), "doc_id", F.lit(".png")).alias("path"))
    b = table(spark, d, "benchmark").select(F.concat(F.lit("/y/"), "item_id", F.lit(".jpg")).alias("path"))
    return readers.typed_documents({"a": a, "b": b}).select("document_id", "document_type")


@query("SELECT (SELECT count(*) FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)) > 0 AS labelled, false AS nothing")
def shared_ids(spark, d):
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    return spark.createDataFrame([(joins.any_shared(docs, labels, "doc_id"), joins.any_shared(docs.where("false"), labels, "doc_id"))], "labelled boolean, nothing boolean")


@query("SELECT vec_id, " + digest_sql("vec_id::VARCHAR", 101) + " / 100 AS ai FROM embeddings")
def ai_probabilities(spark, d):
    return providers.call(table(spark, d, "embeddings").select("vec_id"), "ai_probability", ["vec_id"], "ai")


@query("SELECT event_id, sha256(event_type) AS sha256, length(event_type)::VARCHAR AS size FROM events")
def remote_calls(spark, d):
    r = providers.call(table(spark, d, "events").select("event_id", "event_type"), "remote", ["event_type"], "r")
    return r.select("event_id", F.col("r")["sha256"].alias("sha256"), F.col("r")["size"].alias("size"))


@query("""
    WITH b AS (SELECT event_id, event_id % 90 AS x, event_id % 70 AS y, 100 AS w, 80 AS h FROM events)
    SELECT event_id, greatest(0, x - 15)::BIGINT AS "left", greatest(0, y - 15)::BIGINT AS top, least(w, x + 45)::BIGINT AS "right", least(h, y + 45)::BIGINT AS bottom FROM b""")
def padded_crops(spark, d):
    x, y = F.col("event_id") % 90, F.col("event_id") % 70
    boxes = table(spark, d, "events").select("event_id", x.alias("x0"), y.alias("y0"), (x + 30).alias("x1"), (y + 30).alias("y1"), F.lit(100).cast("long").alias("width"), F.lit(80).cast("long").alias("height"))
    return images.crops(boxes).select("event_id", "left", "top", "right", "bottom")


@query("""
    WITH s AS (SELECT event_id, 100 + event_id % 3000 AS w, 50 + event_id % 1700 AS h FROM events), f AS (SELECT *, least(1.0::DOUBLE, 1024 / greatest(w, h)) AS k FROM s)
    SELECT event_id, greatest(1, floor(w * k))::INT AS width, greatest(1, floor(h * k))::INT AS height FROM f""")
def fitted_sizes(spark, d):
    w, h = 100 + F.col("event_id") % 3000, 50 + F.col("event_id") % 1700
    return table(spark, d, "events").select("event_id", images.fitted(w, h).alias("s")).select("event_id", "s.width", "s.height")


def _recipes_sql() -> str:
    return ", ".join(f"CASE WHEN image_type = '{kind}'{f' AND {name} < {limit}' if name else ''} THEN '{step}' END" for kind, step, name, limit in images.RECIPES)


@query(rf"""
    WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: round((x::DOUBLE * (1 + vec_id % 3) + 1) * (60 + vec_id % 80))) AS p FROM embeddings),
    s AS (
        SELECT vec_id, (vec_id * 37) % 900 AS longest, list_avg(p) AS mean, list_stddev_pop(p) AS std, list_max(p) - list_min(p) AS spread, list_var_pop(p) AS texture, (vec_id * 13 % 701)::DOUBLE AS sharpness,
               greatest(abs(list_avg(p[1:32]) - list_avg(p[33:64])), abs(list_avg(list_filter(p, lambda x, i: (i - 1) % 8 < 4)) - list_avg(list_filter(p, lambda x, i: (i - 1) % 8 >= 4)))) AS halves FROM e
    ),
    k AS (SELECT *, CASE WHEN mean > 180 AND sharpness > 200 AND std > 40 AND halves <= 30 THEN 'clean_document' WHEN texture > 200 AND std > 50 AND mean > 100 AND mean < 200 THEN 'medical_photo'
        WHEN mean < 100 AND std > 50 AND texture > 150 THEN 'dark_scene' WHEN mean < 120 AND std < 35 AND halves > 30 THEN 'underexposed_phone' ELSE 'general' END AS image_type FROM s),
    t AS (SELECT *, list_filter([{_recipes_sql()}], lambda x: x IS NOT NULL) AS steps FROM k)
    SELECT vec_id, CASE WHEN longest < 400 THEN 'low_resolution' ELSE image_type END AS image_type, CASE WHEN longest < 400 THEN '' WHEN len(steps) = 0 THEN 'none' ELSE array_to_string(steps, '>') END AS steps,
           CASE WHEN longest >= 400 AND sharpness >= 300 THEN 'PASS' ELSE 'WARNING' END AS tier FROM t""")
def image_assessment(spark, d):
    """A picture of 8 x 8 pixels out of each vector; its size and sharpness are those of the picture that it would be the thumbnail of."""
    shade = F.transform("embedding", lambda x: F.round((x.cast("double") * (1 + F.col("vec_id") % 3) + 1) * (60 + F.col("vec_id") % 80)))
    rows = table(spark, d, "embeddings").select("vec_id", shade.alias("p"))
    n = F.size("p")
    mean = F.aggregate("p", F.lit(0.0), lambda a, x: a + x) / n
    var = F.aggregate("p", F.lit(0.0), lambda a, x: a + (x - F.col("mean")) * (x - F.col("mean"))) / n
    told = rows.withColumn("mean", mean).withColumn("texture", var).withColumns({"std": F.sqrt("texture"), "spread": F.array_max("p") - F.array_min("p"), "halves": images.half_difference(F.col("p"), 8)})
    told = told.withColumns({"longest": F.col("vec_id") * 37 % 900, "sharpness": (F.col("vec_id") * 13 % 701).cast("double")})
    return images.assessed(told).select("vec_id", "image_type", F.array_join("steps", ">").alias("steps"), "tier")


def _dialect_sql(column: str) -> str:
    for a, b in K.DIALECT:
        column = f"replace({column}, '{a}', '{b}')"
    return f"trim({column})"


@query(rf"""
    WITH c AS (SELECT id, trim(regexp_replace(t, '\s+', ' ', 'g')) AS cleaned FROM {SAID_SQL}), n AS (SELECT id, cleaned, {_dialect_sql("cleaned")} AS normal FROM c),
    w AS (SELECT *, list_filter(string_split(normal, ' '), lambda x: x <> '') AS ws FROM n)
    SELECT id, cleaned AS cleaned_text, normal AS normalized_text,
        CASE WHEN {any_in("normal", K.URGENT)} THEN 'urgent' WHEN {any_in("normal", [*K.FINANCIAL, *K.MEDICAL, *K.FOOD])} THEN 'request' WHEN {any_in("normal", K.THANKS)} THEN 'grateful' ELSE 'neutral' END AS sentiment,
        coalesce((SELECT string_agg(k, ',' ORDER BY i) FROM (SELECT trim(u.x, '.,!?') AS k, min(u.i) AS i FROM (SELECT unnest(ws) AS x, unnest(range(len(ws))) AS i) u WHERE length(u.x) > 2 AND NOT list_contains({listed(K.STOP_WORDS)}, u.x) GROUP BY k ORDER BY i LIMIT 5)), '') AS keywords,
        array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(translate(normal, '{K.ARABIC_DIGITS}{K.PERSIAN_DIGITS}', '{K.ASCII_DIGITS}{K.ASCII_DIGITS}'), '[0-9]+'), lambda x: TRY_CAST(x AS DECIMAL(38,0))))), ',') AS numbers,
        array_to_string(list_filter({listed(K.LOCATIONS)}, lambda x: contains(normal, x)), ',') AS locations
    FROM w""")
def text_insights(spark, d):
    told = _said(spark, d).select("id", text.insights(F.col("t")).alias("i")).select("id", "i.*")
    as_text = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(c)
    return told.select("id", "cleaned_text", "normalized_text", "sentiment", *map(as_text, ("keywords", "numbers", "locations")))


@query("""
    SELECT CASE WHEN event_id % 40 > 32 THEN 'val' ELSE 'train' END AS split, printf('%d %.6f %.6f %.6f %.6f', event_id % 19, (event_id % 100) / 100.0::DOUBLE, (event_id % 90) / 90.0::DOUBLE, (event_id % 7) / 8.0::DOUBLE, 0.25::DOUBLE) AS line FROM events""")
def label_lines(spark, d):
    """Lines of labels, by split, written and read again."""
    path, id_ = scratch(spark, "labels"), F.col("event_id")
    box = F.struct(((id_ % 100) / 100).alias("xc"), ((id_ % 90) / 90).alias("yc"), ((id_ % 7) / 8).alias("w"), F.lit(0.25).alias("h"))
    rows = table(spark, d, "events").select("event_id", rules.split_name(F.concat(F.lit("BC_"), (id_ % 40).cast("string"))).alias("split"), box.alias("box"))
    writers.write_lines(rows, rules.yolo_line(id_ % 19, F.col("box")), path, by="split")
    return spark.read.text(path).select("split", F.col("value").alias("line"))


@query(ORACLE["chat_history_fold"])
def streamed_history(spark, d):
    """The same histories from a stream whose turns come in three files out of order."""
    folder, third = scratch(spark, "turns"), F.pmod(F.col("turn") + F.col("conv_id"), F.lit(3))
    seconds = 1_700_000_000 + 60 * F.col("turn") + F.pmod(F.col("conv_id"), F.lit(50))
    turns = _turns(spark, d).withColumn("ts", F.timestamp_seconds(seconds))
    end = spark.createDataFrame([(-1, 0, "", "")], "conv_id long, turn long, question string, answer string").withColumn("ts", F.timestamp_seconds(F.lit(1_800_000_000)))
    for k in range(3):
        turns.where(third == k).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    end.coalesce(1).write.mode("append").parquet(f"{folder}/in")
    before = spark.conf.get(streams.ROCKSDB[0])
    spark.conf.set(*streams.ROCKSDB)
    try:
        stream = spark.readStream.schema(turns.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
        streams.run_to_files(streams.ordered_history(stream, late="1 day"), f"{folder}/out", f"{folder}/check")
    finally:
        spark.conf.set(streams.ROCKSDB[0], before)
    told = spark.read.parquet(f"{folder}/out").where("conv_id >= 0")
    last = told.groupBy("conv_id").agg(F.max_by(F.struct("n_turns", "history"), "n_turns").alias("b"))
    return last.select("conv_id", F.col("b.n_turns").cast("int").alias("n_turns"), "b.history")
