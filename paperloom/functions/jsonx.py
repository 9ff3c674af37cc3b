"""Parsing, repairing, flattening and validating JSON that models have written."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom.functions import constants as K
from paperloom.functions.arrow_udfs import leaves
from paperloom.functions.text import normalize_value

OBJECT = r"(?s)(\{.*\})"


def strip_fences(c: Column) -> Column:
    """Without a code fence around the whole text (JSN1)."""
    return F.trim(F.regexp_replace(F.trim(c), r"(?is)^```(?:json)?\s*|\s*```$", ""))


def is_json(c: Column) -> Column:
    """Whether a text is one JSON value and nothing else.

    ``try_parse_json`` leaves what follows the first value unread; within brackets and within braces, what follows
    can't be right for both.
    """
    listed = F.try_parse_json(F.concat(F.lit("["), c, F.lit("]")))
    named = F.try_parse_json(F.concat(F.lit('{"x":'), c, F.lit("}")))
    one = F.try_variant_get(listed, "$[0]", "variant").isNotNull() & F.try_variant_get(listed, "$[1]", "variant").isNull()
    return F.coalesce(listed.isNotNull() & named.isNotNull() & one, F.lit(False))


def greedy_object(c: Column) -> Column:
    """From the first opening to the last closing brace, if that parses (JSN3)."""
    found = F.regexp_extract(c, OBJECT, 1)
    return F.when((found != "") & is_json(found), found)


def without_trailing_commas(c: Column) -> Column:
    return F.regexp_replace(c, r",\s*([}\]])", "$1")


def lenient_object(c: Column, form_feeds: bool = True) -> Column:
    """Fences anywhere out, braces, trailing commas out; {} if that doesn't parse (JSN4; JSN5 keeps form feeds)."""
    bare = F.regexp_replace(F.coalesce(c, F.lit("")), "(?i)```(?:json)?", "")
    bare = F.replace(bare, F.lit("\f"), F.lit("")) if form_feeds else bare
    found = without_trailing_commas(F.regexp_extract(bare, OBJECT, 1))
    return F.when((found != "") & is_json(found), found).otherwise("{}")


def retried_object(c: Column) -> Column:
    """The same, and once more with line ends as spaces (JSN6)."""
    first = lenient_object(c)
    flat = lenient_object(F.replace(F.replace(c, F.lit("\n"), F.lit(" ")), F.lit("\r"), F.lit("")))
    return F.when(first != "{}", first).otherwise(flat)


def repaired_search(c: Column, keys: Sequence[str] = ("definitions", "medical_analysis", "pricing")) -> Column:
    """A search reply with its three lists; what has none of them comes as raw_fallback (JSN7)."""
    parsed = F.try_parse_json(retried_object(c))
    part = lambda k: F.try_variant_get(parsed, f"$.{k}", "variant")
    known = F.coalesce(*(part(k) for k in keys)).isNotNull()
    return F.struct(*(F.coalesce(F.to_json(part(k)), F.lit("[]")).alias(k) for k in keys), F.when(~known, c).alias("raw_fallback"))


def kind(text: Column) -> Column:
    """object, array, string, number, boolean or null of a JSON text; null if it isn't any."""
    t = F.ltrim(text)
    return F.when(~is_json(text), None).when(t.startswith("{"), "object").when(t.startswith("["), "array").when(t.startswith('"'), "string").when(F.rlike(t, F.lit("^(true|false)")), "boolean").when(t.startswith("null"), "null").otherwise("number")


def flatten(df: DataFrame, key: str, payload: str) -> DataFrame:
    """(key, path, value, vtype) of every scalar and empty list of a JSON text (JSN8).

    Paths are a.b and a[0]; an empty object leaves nothing; text values are normalised.  A payload that
    doesn't parse leaves no rows.  One narrow Arrow stage, whatever the depth and number of records; of a
    name that an object has twice the last value counts.
    """
    kind = df.schema[key].dataType
    schema = T.StructType([T.StructField("k", kind), *(T.StructField(c, T.StringType()) for c in ("path", "raw", "vtype"))])
    flat = df.select(F.col(key).alias("k"), F.col(payload).cast("string").alias("payload")).mapInArrow(leaves, schema)
    value = F.when(F.col("vtype") == "string", normalize_value(F.col("raw"))).otherwise(F.col("raw"))
    return flat.select(F.col("k").alias(key), "path", value.alias("value"), F.when(value.isNull(), "null").otherwise(F.col("vtype")).alias("vtype"))


def at(payload: Column, path: str, kind: str = "string") -> Column:
    """The value at a dotted path, null if there is none (JSN9)."""
    return F.try_variant_get(F.try_parse_json(payload), f"$.{path}", kind)


def _truthy_list(v: Column) -> Column:
    return F.when((F.size(v) > 0), v).otherwise(F.array().cast("array<string>"))


def with_defaults(df: DataFrame, payload: str, document_id: str, files: str, lists: Sequence[str] = K.LIST_FIELDS) -> DataFrame:
    """Columns of a case record, with what is missing, empty or zero filled in (JSN10)."""
    v = F.try_parse_json(payload)
    get = lambda k, t: F.try_variant_get(v, f"$.{k}", t)
    return df.select(
        "*",
        F.coalesce(F.nullif(get("document_id", "string"), F.lit("")), F.col(document_id)).alias("record_id"),
        F.when(F.size(get("source_files", "array<string>")) > 0, get("source_files", "array<string>")).otherwise(F.col(files)).alias("record_files"),
        F.coalesce(F.nullif(get("page_count", "int"), F.lit(0)), F.size(files)).alias("record_pages"),
        *(_truthy_list(get(k, "array<string>")).alias(k) for k in lists),
        F.coalesce(get("review_required", "boolean"), F.lit(False)).alias("review_required"),
    )


def completed(payload: Column, document_id: Column, files: Column, lists: Sequence[str] = K.LIST_FIELDS) -> Column:
    """A case record's JSON with what is missing, empty or zero filled in (JSN10); null if it isn't an object.

    What a record has besides stays as it is, for a schema to judge.
    """
    given = F.try_variant_get(F.try_parse_json(payload), "$", "map<string,variant>")
    kept = lambda name, empty: F.when(F.coalesce(F.to_json(given[name]).isin(*empty), F.lit(True)), None).otherwise(given[name])
    as_value = lambda c: F.parse_json(F.to_json(c))
    nothing = ["null", '""', "[]", "{}", "0", "0.0", "false"]
    filled = {
        "document_id": F.coalesce(kept("document_id", nothing), F.to_variant_object(F.struct(document_id.alias("x")))),
        "source_files": F.coalesce(kept("source_files", nothing), as_value(files)),
        "page_count": F.coalesce(kept("page_count", nothing), F.parse_json(F.size(files).cast("string"))),
        **{name: F.coalesce(kept(name, nothing), F.parse_json(F.lit("[]"))) for name in lists},
        "review_required": F.parse_json(F.when(kept("review_required", nothing).isNull(), "false").otherwise("true")),
    }
    filled["document_id"] = F.coalesce(kept("document_id", nothing), F.try_variant_get(filled["document_id"], "$.x", "variant"))
    names = F.array(*map(F.lit, filled))
    rest = F.map_filter(given, lambda k, _: ~F.array_contains(names, k))
    return F.when(given.isNotNull(), F.to_json(F.map_concat(rest, F.map_from_arrays(names, F.array(*filled.values())))))


def certificate_defaults(payload: Column) -> Column:
    """A certificate record of the fixed shape: absent scalars are null, other ids keep their two keys (JSN11)."""
    v = F.try_parse_json(payload)
    text = lambda p: F.try_variant_get(v, p, "string")
    other = F.coalesce(F.try_variant_get(v, "$.ids.other_ids", "array<struct<label_ar string, value string>>"), F.array().cast("array<struct<label_ar string, value string>>"))
    person = lambda who, fields: F.struct(*(text(f"$.personal_and_other.{who}.{f}").alias(f) for f in fields)).alias(who)
    return F.struct(
        F.struct(*(text(f"$.birth_certificate.{f}").alias(f) for f in K.CERTIFICATE_FIELDS)).alias("birth_certificate"),
        F.struct(*(text(f"$.ids.{f}_national_id").alias(f"{f}_national_id") for f in ("child", "father", "mother")), F.filter(other, lambda x: x.isNotNull()).alias("other_ids")).alias("ids"),
        F.struct(person("child", K.CHILD_FIELDS), person("father", K.PARENT_FIELDS), person("mother", K.PARENT_FIELDS), text("$.personal_and_other.misc_notes").alias("misc_notes")).alias("personal_and_other"),
        F.coalesce(F.try_variant_get(v, "$.review_required", "boolean"), F.lit(False)).alias("review_required"),
    )


def fallback_record(document_id: Column, files: Column, note: Column, fields: Sequence[str] = K.CASE_FIELDS) -> Column:
    """The empty record of a reply that couldn't be parsed, as JSON with its nulls (JSN12)."""
    fixed = {"document_id": document_id, "source_files": files, "page_count": F.size(files), "uncertain_fields": F.array(F.lit("model_output")), "review_required": F.lit(True), "review_notes": F.array(note)}
    parts = [fixed.get(f, F.array().cast("array<string>") if f in K.LIST_FIELDS else F.lit(None).cast("string")).alias(f) for f in fields]
    return F.to_json(F.struct(*parts), {"ignoreNullFields": "false"})


def violations(payload: Column, rules: Mapping[str, Mapping[str, object]], closed: bool = True) -> Column:
    """Sorted "path: message" of each rule that a JSON object breaks (JSN13).

    ``rules`` names for each field its ``type``, and whether it is ``required``, may be null
    (``nullable``), and its ``minimum`` or ``min_length``.  A closed object has no other fields.
    """
    v = F.try_parse_json(payload)
    found = []
    for field, rule in rules.items():
        raw = F.try_variant_get(v, f"$.{field}", "variant")
        schema = F.schema_of_variant(raw)
        is_null = F.coalesce(F.is_variant_null(raw), F.lit(False))
        if rule.get("required"):
            found.append(F.when(raw.isNull(), f"<root>: '{field}' is a required property"))
        good = {"string": schema == "STRING", "integer": schema == "BIGINT", "boolean": schema == "BOOLEAN", "array": schema.startswith("ARRAY"), "object": schema.startswith("OBJECT")}[str(rule["type"])]
        if rule.get("nullable"):
            good = good | is_null
        found.append(F.when(raw.isNotNull() & ~good, f"{field}: is not of type '{rule['type']}'"))
        if "minimum" in rule:
            found.append(F.when(F.try_variant_get(raw, "$", "double") < F.lit(rule["minimum"]), f"{field}: is less than the minimum of {rule['minimum']}"))
        if "min_length" in rule:
            found.append(F.when((schema == "STRING") & (F.length(F.try_variant_get(raw, "$", "string")) < F.lit(rule["min_length"])), f"{field}: is too short"))
    every = F.filter(F.array(*found), lambda x: x.isNotNull())
    if closed:
        extra = F.array_except(F.json_object_keys(payload), F.array(*map(F.lit, rules)))
        every = F.concat(every, F.transform(F.coalesce(extra, F.array().cast("array<string>")), lambda k: F.concat(F.lit("<root>: '"), k, F.lit("' was unexpected"))))
    return F.when(F.coalesce(kind(payload) == "object", F.lit(False)), F.array_sort(every)).otherwise(F.array(F.lit("<root>: is not of type 'object'")))


def review_flags(errors: Column, required: Column, notes: Column, uncertain: Column) -> Column:
    """What validation adds to a record: review, notes, and schema_validation as an uncertain field (JSN14)."""
    bad = F.size(errors) > 0
    return F.struct(
        (bad | F.coalesce(required, F.lit(False))).alias("review_required"),
        F.when(bad, F.concat(notes, errors)).otherwise(notes).alias("review_notes"),
        F.when(bad, F.array_sort(F.array_union(uncertain, F.array(F.lit("schema_validation"))))).otherwise(uncertain).alias("uncertain_fields"),
    )


def validity_report(df: DataFrame, errors: str) -> DataFrame:
    """How many records are valid and how many aren't (JSN15)."""
    return df.groupBy(F.when(F.size(errors) == 0, "OK").otherwise("INVALID").alias("status")).agg(F.count("*").alias("n"))


def typed_pair(c: Column) -> Column:
    """TYPE=VALUE as a struct; nulls if there is no sign or no value (JSN18)."""
    parts = F.split(c, "=", 2)
    ok = (F.size(parts) == 2) & (F.trim(F.get(parts, 0)) != "") & (F.trim(F.get(parts, 1)) != "")
    return F.struct(F.when(ok, F.trim(F.get(parts, 0))).alias("type"), F.when(ok, F.trim(F.get(parts, 1))).alias("value"))


def metadata(c: Column, core: Column | None = None) -> Column:
    """Metadata given as an object or as a string of one, as a map; core fields win (JSN19)."""
    unwrapped = F.coalesce(F.try_variant_get(F.try_parse_json(c), "$", "map<string,string>"), F.from_json(F.try_variant_get(F.try_parse_json(c), "$", "string"), "map<string,string>"), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))
    if core is None:
        return unwrapped
    kept = F.map_filter(unwrapped, lambda k, _: ~F.array_contains(F.map_keys(core), k))
    return F.map_concat(kept, core)
