"""Text normalisers and scalar rules as Column expressions: no Python on the executors."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from paperloom.functions import constants as K

WHITE = r"(?U)\s+"
PUNCTUATION = r"[^\p{L}\p{N}_\s]"


def _or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def squeeze(c: Column) -> Column:
    """White space to single spaces, trimmed; null is empty (TXT1, TXT13)."""
    return F.trim(F.regexp_replace(_or_empty(c), WHITE, " "))


def ascii_digits(c: Column, persian: bool = True) -> Column:
    out = F.translate(c, K.ARABIC_DIGITS, K.ASCII_DIGITS)
    return F.translate(out, K.PERSIAN_DIGITS, K.ASCII_DIGITS) if persian else out


def normalize_value(c: Column) -> Column:
    """A record's text value: digits to ASCII, squeezed, empty is null (TXT2)."""
    return F.nullif(squeeze(ascii_digits(c)), F.lit(""))


def normalize_eval(c: Column, edges: bool = False) -> Column:
    """For comparing readings: digits, marks and letter variants folded, lower case (TXT3; TXT4 with ``edges``).

    Compatibility forms (NFKC) need ``arrow_udfs.nfkc`` before it.
    """
    out = F.regexp_replace(ascii_digits(_or_empty(c)), K.TASHKEEL, "")
    out = squeeze(F.translate(out, "أإآىة", "ااايه"))
    return F.lower(F.btrim(out, F.lit(" .,:;،")) if edges else out)


def normalize_vqa(c: Column) -> Column:
    """For comparing answers (TXT5): hamza carriers become hamza, punctuation goes, white space stays."""
    out = F.translate(F.regexp_replace(F.trim(_or_empty(c)), K.TASHKEEL, ""), "إأآىؤئ", "اااي" + "ءء")
    return F.lower(F.regexp_replace(out, PUNCTUATION, ""))


def normalize_asr(c: Column) -> Column:
    """For comparing transcripts (TXT6)."""
    return F.trim(F.translate(_or_empty(c), "أإآىةؤئ", "ااايهوي"))


def normalize_ocr(c: Column) -> Column:
    """For comparing recognised words (TXT7): squeezed first, so dropped punctuation can leave two spaces."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(_or_empty(c))), WHITE, " "), PUNCTUATION, "")


def replace_words(c: Column, pairs: Sequence[tuple[str, str]] = K.DIALECT) -> Column:
    """Ordered substring replacements, trimmed (TXT8)."""
    return F.trim(reduce(lambda x, p: F.replace(x, F.lit(p[0]), F.lit(p[1])), pairs, _or_empty(c)))


def number_words(c: Column, pairs: Sequence[tuple[str, str]] = K.NUMBER_WORDS) -> Column:
    """Ordered whole-word replacements (TXT9)."""
    return reduce(lambda x, p: F.regexp_replace(x, rf"(?U)\b{p[0]}\b", p[1]), pairs, _or_empty(c))


def clean_caption(c: Column) -> Column:
    """Tags out, white space squeezed (TXT10)."""
    return squeeze(F.regexp_replace(_or_empty(c), "<[^>]+>", ""))


def keep_only(c: Column, others: str = K.NOT_ARABIC) -> Column:
    """Drops the characters of a negated class (TXT11)."""
    return F.regexp_replace(_or_empty(c), others, "")


def slug(c: Column, default: str = "model", size: int = 80) -> Column:
    """A name for files (TXT12)."""
    out = F.left(F.btrim(F.regexp_replace(_or_empty(c), "[^A-Za-z0-9_.-]+", "_"), F.lit("_")), F.lit(size))
    return F.coalesce(F.nullif(out, F.lit("")), F.lit(default))


def base_name(c: Column) -> Column:
    """The last part of a path of either kind of slash (TXT14)."""
    return F.element_at(F.split(F.replace(c, F.lit("\\"), F.lit("/")), "/"), -1)


def stem(c: Column) -> Column:
    return F.regexp_replace(base_name(c), r"(?<=.)\.[^.]*$", "")


def detect_language(c: Column) -> Column:
    """Arabic if there is an Arabic letter, else English (SCL1)."""
    return F.when(F.rlike(_or_empty(c), F.lit(K.ARABIC_LETTER)), "ar").otherwise("en")


def has_any(c: Column, words: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(c, F.lit(w)) for w in words])


def first_rule(c: Column, rules: Sequence[tuple[str, Sequence[str]]], default: str | None) -> Column:
    """The name of the first rule one of whose words is in the text."""
    out = None
    for name, words in rules:
        out = (F if out is None else out).when(has_any(_or_empty(c), words), name)
    return out.otherwise(default)


def sentiment(c: Column, urgent: Sequence[str] = K.URGENT, request: Sequence[str] = (*K.FINANCIAL, *K.MEDICAL, *K.FOOD), thanks: Sequence[str] = K.THANKS) -> Column:
    """urgent, request, grateful or neutral (SCL2)."""
    return first_rule(c, [("urgent", urgent), ("request", request), ("grateful", thanks)], "neutral")


def words(c: Column) -> Column:
    return F.filter(F.split(_or_empty(c), WHITE), lambda w: w != "")


def keywords(c: Column, n: int = 5, stop: Sequence[str] = K.STOP_WORDS) -> Column:
    """The first ``n`` distinct words of over two characters (SCL3)."""
    kept = F.filter(words(c), lambda w: (F.length(w) > 2) & ~w.isin(*stop))
    return F.slice(F.array_distinct(F.transform(kept, lambda w: F.btrim(w, F.lit(".,!?")))), 1, n)


def numbers(c: Column) -> Column:
    """Distinct numbers written in digits of either script, in order of size (SCL4)."""
    found = F.regexp_extract_all(_or_empty(c), F.lit(r"(?U)(\d+)"), F.lit(1))
    return F.array_sort(F.array_distinct(F.filter(F.transform(found, lambda x: ascii_digits(x).try_cast("decimal(38,0)")), lambda x: x.isNotNull())))


def found_in(c: Column, names: Sequence[str] = K.LOCATIONS) -> Column:
    """The names that are in the text, in the list's order (SCL5)."""
    return F.filter(F.array(*map(F.lit, names)), lambda x: F.contains(_or_empty(c), x))


def insights(c: Column) -> Column:
    """Everything that is read off a request's text (SCL6)."""
    cleaned = squeeze(c)
    normal = replace_words(cleaned)
    return F.struct(cleaned.alias("cleaned_text"), normal.alias("normalized_text"), sentiment(normal).alias("sentiment"), keywords(normal).alias("keywords"), numbers(normal).alias("numbers"), found_in(normal).alias("locations"))


def citation(faq_id: Column, tags: Column) -> Column:
    """FAQ id — first tag (SCL7)."""
    return F.concat(F.lit("FAQ "), F.coalesce(faq_id, F.lit("?")), F.when(F.try_element_at(tags, F.lit(1)) != "", F.concat(F.lit(" — "), F.element_at(tags, 1))).otherwise(""))


def passage(question: Column, answer: Column, faq_id: Column, tags: Column) -> Column:
    """The text that is embedded for a question and its answer (SCL8)."""
    return F.concat(F.lit("passage: Q: "), _or_empty(question), F.lit("\nA: "), _or_empty(answer), F.lit("\nFAQ ID: "), F.coalesce(faq_id, F.lit("?")), F.lit("\nTags: "), F.coalesce(F.array_join(tags, ", "), F.lit("")))


def truncate_head(c: Column, n: int = K.CONTEXT_CHARS) -> Column:
    """The beginning, and a mark if there was more (SCL9)."""
    return F.when(F.length(c) > n, F.concat(F.left(c, F.lit(n)), F.lit("\n[...]"))).otherwise(c)


def truncate_tail(c: Column, n: int = K.HISTORY_CHARS) -> Column:
    """The end, squeezed, after a mark if there was more (SCL10): up to n + 5 characters."""
    s = squeeze(c)
    return F.when(F.length(s) > n, F.concat(F.lit("[...]"), F.right(s, F.lit(n)))).otherwise(s)


def with_entity(answer: Column, questions: Column) -> Column:
    """The answer, led by the shortest question if that isn't in it (SCL11)."""
    kept = F.filter(F.transform(questions, lambda q, i: F.struct(F.length(q).alias("n"), i.alias("i"), q.alias("q"))), lambda s: s.q != "")
    entity = F.try_element_at(F.array_sort(kept), F.lit(1)).q
    return F.when(entity.isNotNull() & ~F.contains(answer, entity), F.concat(F.lit("("), entity, F.lit(") "), answer)).otherwise(answer)


def guarded_rewrite(question: Column, rewrite: Column, depends: Column) -> Column:
    """A rewritten question, unless it isn't wanted, empty or too long (SCL12)."""
    limit = F.greatest(F.lit(40), (F.length(question) * 2.2).cast("int"))
    r = squeeze(rewrite)
    return F.when(~F.coalesce(depends, F.lit(False)) | (r == "") | (F.length(r) > limit), question).otherwise(r)


def answer_confidence(c: Column, low: Sequence[str] = K.LOW_CONFIDENCE) -> Column:
    """Confidence by wording and length (SCL13)."""
    s = F.trim(_or_empty(c))
    base = F.when(has_any(s, low), F.lit(0.4)).otherwise(F.lit(0.9))
    return F.when(s == "", F.lit(0.0)).otherwise(F.round(F.when(F.size(words(s)) <= 3, F.least(base + 0.05, F.lit(0.95))).otherwise(base), 2))


def override_confidence(c: Column, confidence: Column, sure: Sequence[str] = K.OVERRIDE_WORDS) -> Column:
    """0.95 if a sure word is in the answer, even within a word (SCL14)."""
    return F.when(has_any(_or_empty(c), sure), F.lit(0.95)).otherwise(confidence)


def prompt(*parts: Column) -> Column:
    """Parts that aren't empty, a blank line between them (SCL15)."""
    return F.concat_ws("\n\n", *(F.nullif(p, F.lit("")) for p in parts))


def consolidated(text: Column, transcript: Column, ocr: Column) -> Column:
    """A case's text from what was typed, said and read, each under its head (SCL16)."""
    section = lambda head, c: F.when(F.trim(_or_empty(c)) != "", F.concat(F.lit(f"[{head}]\n"), F.trim(c)))
    read = F.array_join(F.filter(F.coalesce(ocr, F.array().cast("array<string>")), lambda x: F.trim(x) != ""), "\n")
    return F.struct(
        F.concat_ws("\n\n", section("TEXT", text), section("VOICE", transcript), section("OCR", read)).alias("extracted_text"),
        (F.trim(_or_empty(transcript)) != "").alias("has_voice"),
        (F.size(F.coalesce(ocr, F.array())) > 0).alias("has_images"),
        F.size(F.coalesce(ocr, F.array())).alias("image_count"),
        (read != "").alias("ocr_executed"),
    )


def page_side(c: Column) -> Column:
    """front or back by what a page says; null if neither (SCL17)."""
    return first_rule(c, [("front", K.FRONT_CUES), ("back", K.BACK_CUES)], None)


def canonical_side(c: Column) -> Column:
    """front or back by how a reader names the side (SCL18)."""
    low = F.lower(c)
    return F.when(F.contains(low, F.lit("front")) | has_any(c, ["أمام", "وجه"]), "front").when(F.contains(low, F.lit("back")) | has_any(c, ["ظهر", "خلف"]), "back")


def clock(seconds: Column) -> Column:
    """Seconds as HHMMSS (SCL19)."""
    s = F.floor(seconds)
    return F.format_string("%02d%02d%02d", F.floor(s / 3600), F.floor(F.pmod(s, F.lit(3600)) / 60), F.pmod(s, F.lit(60)))


def milliseconds(c: Column) -> Column:
    """H:M:S, M:S or S with a fraction after a point or comma, as milliseconds (SCL19)."""
    parts = F.reverse(F.split(F.replace(F.trim(c), F.lit(","), F.lit(".")), ":"))
    at = lambda k: F.coalesce(F.try_element_at(parts, F.lit(k)).try_cast("double"), F.lit(0.0))
    return F.round((at(1) + 60 * at(2) + 3600 * at(3)) * 1000).cast("long")


def sha256(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


def retry_after(message: Column) -> Column:
    """Seconds to wait that a rate limit's message names, and one, at most 90; else 30 (JSN16)."""
    found = F.regexp_extract(_or_empty(message), r"(?i)try again in ([0-9.]+)s", 1).try_cast("double")
    return F.when(found.isNotNull(), F.least(found + 1, F.lit(90.0))).otherwise(F.lit(30.0))


def improvement(before: Column, after: Column, lower_is_better: bool = True) -> Column:
    """Relative improvement in percent, 0 from a base of 0 (SCL25)."""
    gain = (before - after) if lower_is_better else (after - before)
    return F.when(before == 0, F.lit(0.0)).otherwise(gain / before * 100)


def strip_data_uri(c: Column) -> Column:
    """Base64 without what may lead it (SRC22)."""
    return F.regexp_replace(c, r"^data:[^,]*;base64,", "")


def is_base64(c: Column) -> Column:
    """Whether a text decodes as base64 (FLT8)."""
    return F.coalesce(c != "", F.lit(False)) & F.try_to_binary(strip_data_uri(c), F.lit("base64")).isNotNull()
