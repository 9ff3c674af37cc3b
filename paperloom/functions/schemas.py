"""A compiler of JSON Schema: a schema's tree becomes one Column expression over a variant (JSN13).

``compiled(schema)`` gives a function from a column of JSON texts to the sorted "path: message" of every rule a record breaks; a
path is ``family_members.2.age``, and ``<root>`` for the record itself.  The tree is walked once, by the driver; each node's value is
bound once, by a higher-order function, so a record is parsed once and a list's items are checked in place, at any depth.

Keywords: type (one or several), enum, const, minimum, maximum, exclusiveMinimum, exclusiveMaximum, minLength, maxLength,
pattern, minItems, maxItems, items, required, properties, additionalProperties (false, or a schema), anyOf, allOf, and $ref into
$defs that doesn't lead to itself.  Notes such as title and description say nothing; any other keyword is an error at compile time,
as leaving it out would pass records that it forbids.

In messages texts, numbers, booleans and null are written as Python writes them, lists and objects as JSON.  What isn't JSON breaks one rule:
it isn't.  A record whose objects name a field twice isn't taken for JSON.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from paperloom.functions import constants as K
from paperloom.functions import jsonx

#: Keywords that describe and don't restrict.
NOTES = ["$schema", "$id", "$comment", "$defs", "title", "description", "default", "examples", "deprecated", "readOnly", "writeOnly", "format"]
RULES = [
    "type", "enum", "const", "minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "minLength", "maxLength", "pattern", "minItems", "maxItems", "items",
    "required", "properties", "additionalProperties", "anyOf", "allOf", "$ref",
]


#: Types that a variant's own type tells.
PLAIN = {"string": "STRING", "boolean": "BOOLEAN", "null": "VOID"}


def _names(schema: Mapping) -> list[str]:
    return [schema["type"]] if isinstance(schema["type"], str) else list(schema["type"])


def _type_message(names: Sequence[str]) -> str:
    return " is not of type " + ", ".join(map(repr, names))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is evaluated once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), 0)


def kind(v: Column) -> Column:
    """array, object, string, integer, number, boolean or null of a variant; a number without a fraction is an integer."""
    number = F.try_variant_get(v, "$", "double")
    scalar = F.schema_of_variant(v)
    return (
        F.when(F.is_variant_null(v), "null")
        .when(F.try_variant_get(v, "$", "array<variant>").isNotNull(), "array")
        .when(F.try_variant_get(v, "$", "map<string,variant>").isNotNull(), "object")
        .when(scalar == "STRING", "string")
        .when(scalar == "BOOLEAN", "boolean")
        .otherwise(F.when(number == F.floor(number), "integer").otherwise("number"))
    )


def shown(value: Column) -> Column:
    """A value in a message."""

    def one(s: Column) -> Column:
        text = F.try_variant_get(s.v, "$", "string")
        escaped = text
        for letter, mark in (("\\", "\\\\"), ("\n", "\\n"), ("\t", "\\t"), ("\r", "\\r")):
            escaped = F.replace(escaped, F.lit(letter), F.lit(mark))
        double = F.concat(F.lit('"'), escaped, F.lit('"'))
        single = F.concat(F.lit("'"), F.replace(escaped, F.lit("'"), F.lit("\\'")), F.lit("'"))
        quoted = F.when(F.contains(text, F.lit("'")) & ~F.contains(text, F.lit('"')), double).otherwise(single)
        number = F.when(F.rlike(text, F.lit("^-?[0-9]+$")), text).otherwise(F.try_variant_get(s.v, "$", "double").cast("string"))
        return F.when(s.k == "string", quoted).when(s.k == "null", "None").when(s.k == "boolean", F.initcap(text)).when(s.k.isin("integer", "number"), number).otherwise(F.to_json(s.v))

    return bound(F.struct(value.alias("v"), kind(value).alias("k")), one)


def _is_kind(k: Column, name: str) -> Column:
    return k.isin("integer", "number") if name == "number" else k == name


def _equals(v: Column, k: Column, value: object) -> Column:
    """Whether a variant is a scalar value."""
    if value is None:
        return k == "null"
    if isinstance(value, bool):
        return (k == "boolean") & (F.try_variant_get(v, "$", "boolean") == F.lit(value))
    if isinstance(value, (int, float)):
        return k.isin("integer", "number") & (F.try_variant_get(v, "$", "double") == F.lit(float(value)))
    if isinstance(value, str):
        return (k == "string") & (F.try_variant_get(v, "$", "string") == F.lit(value))
    raise ValueError(f"enum and const hold texts, numbers, booleans and null, not {value!r}")


#: What is broken: where, by which value if a message shows it, and how.  Values are written out once, at the end.
BROKEN = "array<struct<path: string, value: variant, text: string>>"


def _nothing() -> Column:
    return F.array().cast(BROKEN)


def _under(prefix: Column | str, part: Column | str) -> Column | str:
    """A path below another; known paths are put together by the driver."""
    if isinstance(prefix, str) and isinstance(part, str):
        return f"{prefix}.{part}" if prefix else part
    if isinstance(prefix, str):
        return F.concat(F.lit(f"{prefix}."), part) if prefix else part
    return F.concat(prefix, F.lit("."), F.lit(part) if isinstance(part, str) else part)


def _told(prefix: Column | str, text: Column | str, value: Column | None = None) -> Column:
    path = F.lit(prefix or "<root>") if isinstance(prefix, str) else prefix
    shown_value = F.lit(None).cast("variant") if value is None else value
    return F.struct(path.alias("path"), shown_value.alias("value"), (F.lit(text) if isinstance(text, str) else text).alias("text"))


class _Compiler:
    def __init__(self, root: Mapping) -> None:
        self.root = root

    def _resolved(self, schema: Mapping, seen: Sequence[str]) -> tuple[Mapping, Sequence[str]]:
        while "$ref" in schema:
            ref = str(schema["$ref"])
            if ref in seen or not ref.startswith("#/"):
                raise ValueError(f"{ref} leads to itself or out of the schema")
            seen, at = [*seen, ref], self.root
            for part in ref[2:].split("/"):
                at = at[part]
            schema = {**at, **{k: v for k, v in schema.items() if k != "$ref"}}
        return schema, seen

    def errors(self, v: Column, prefix: Column | str, schema: Mapping | bool, seen: Sequence[str] = ()) -> Column:
        """What a variant breaks; ``prefix`` is the path to it, empty for the root."""
        if schema is True:
            return _nothing()
        if schema is False:
            return F.array(_told(prefix, " is not allowed here", v))
        schema, seen = self._resolved(schema, seen)
        if unknown := set(schema) - set(NOTES) - set(RULES):
            raise ValueError(f"keywords that aren't compiled: {sorted(unknown)}")
        if set(schema) - set(NOTES) == {"type"} and set(names := _names(schema)) <= set(PLAIN):
            # Most fields: told by the value's own type.
            return F.when(F.schema_of_variant(v).isin(*(PLAIN[n] for n in names)), _nothing()).otherwise(F.array(_told(prefix, _type_message(names), v)))

        def node(s: Column) -> Column:
            own = [F.when(broken, F.array(_told(prefix, text, s.v if show else None))).otherwise(_nothing()) for broken, text, show in self._rules(s.v, s.k, schema)]
            parts = [*own, *self._below(s.v, s.k, prefix, schema, seen)]
            return F.concat(*parts) if parts else _nothing()

        return bound(F.struct(v.alias("v"), kind(v).alias("k")), node)

    def _rules(self, v: Column, k: Column, schema: Mapping) -> list[tuple[Column, Column | str, bool]]:
        """The node's own rules: when each is broken, what is said then, and whether the value is shown before it."""
        out: list[tuple[Column, Column | str, bool]] = []
        number, text = F.try_variant_get(v, "$", "double"), F.try_variant_get(v, "$", "string")
        items, fields = F.try_variant_get(v, "$", "array<variant>"), F.try_variant_get(v, "$", "map<string,variant>")
        is_number, is_object = k.isin("integer", "number"), k == "object"
        any_of = lambda tests: reduce(lambda a, b: a | b, tests, F.lit(False))
        if "type" in schema:
            names = _names(schema)
            out.append((~any_of(_is_kind(k, name) for name in names), _type_message(names), True))
        if "enum" in schema:
            out.append((~any_of(_equals(v, k, x) for x in schema["enum"]), f" is not one of {list(schema['enum'])!r}", True))
        if "const" in schema:
            out.append((~_equals(v, k, schema["const"]), f"{schema['const']!r} was expected", False))
        for word, broken, what in (
            ("minimum", lambda x: number < x, "less than the minimum of"),
            ("maximum", lambda x: number > x, "greater than the maximum of"),
            ("exclusiveMinimum", lambda x: number <= x, "less than or equal to the minimum of"),
            ("exclusiveMaximum", lambda x: number >= x, "greater than or equal to the maximum of"),
        ):
            if word in schema:
                out.append((is_number & broken(F.lit(float(schema[word]))), f" is {what} {schema[word]!r}", True))
        for least, most, size, is_sized in (("minLength", "maxLength", F.length(text), k == "string"), ("minItems", "maxItems", F.size(items), k == "array")):
            if least in schema:
                out.append((is_sized & (size < F.lit(schema[least])), " should be non-empty" if schema[least] == 1 else " is too short", True))
            if most in schema:
                out.append((is_sized & (size > F.lit(schema[most])), " is expected to be empty" if schema[most] == 0 else " is too long", True))
        if "pattern" in schema:
            out.append(((k == "string") & ~F.rlike(text, F.lit(schema["pattern"])), f" does not match {schema['pattern']!r}", True))
        for name in schema.get("required", ()):
            out.append((is_object & self._field(v, name).isNull(), f"{name!r} is a required property", False))
        if schema.get("additionalProperties") is False:
            known = F.array(*map(F.lit, schema.get("properties", {}))).cast("array<string>")
            extra = F.array_sort(F.array_except(F.map_keys(fields), known))
            names = F.array_join(F.transform(extra, lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", ")
            were = F.when(F.size(extra) == 1, " was").otherwise(" were")
            out.append((is_object & (F.size(extra) > 0), F.concat(F.lit("Additional properties are not allowed ("), names, were, F.lit(" unexpected)")), False))
        return out

    @staticmethod
    def _field(v: Column, name: str) -> Column:
        """A field of an object, null if it lacks it; a path can't hold a name with both kinds of quotes."""
        if "'" in name and '"' in name:
            return F.try_element_at(F.try_variant_get(v, "$", "map<string,variant>"), F.lit(name))
        mark = '"' if "'" in name else "'"
        return F.try_variant_get(v, f"$[{mark}{name}{mark}]", "variant")

    def _if_there(self, k: Column, path: Column | str, schema: Mapping | bool, seen: Sequence[str]) -> Callable[[Column], Column]:
        """The errors of an object's field, none if the object lacks it."""
        return lambda x: F.when(x.isNotNull() & (k == "object"), self.errors(x, path, schema, seen)).otherwise(_nothing())

    def _below(self, v: Column, k: Column, prefix: Column | str, schema: Mapping, seen: Sequence[str]) -> list[Column]:
        """What the node's fields, items and branches break."""
        out = [bound(self._field(v, name), self._if_there(k, _under(prefix, name), sub, seen)) for name, sub in schema.get("properties", {}).items()]
        more = schema.get("additionalProperties")
        if isinstance(more, Mapping):
            known = list(schema.get("properties", {}))
            entries = F.map_entries(F.map_filter(F.try_variant_get(v, "$", "map<string,variant>"), lambda name, _: ~name.isin(*known) if known else F.lit(True)))
            each = F.flatten(F.transform(entries, lambda e: self.errors(e.value, _under(prefix, e.key), more, seen)))
            out.append(F.when(k == "object", each).otherwise(_nothing()))
        if isinstance(schema.get("items"), (Mapping, bool)):
            each = F.flatten(F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda x, i: self.errors(x, _under(prefix, i.cast("string")), schema["items"], seen)))
            out.append(F.when(k == "array", each).otherwise(_nothing()))
        out += [self.errors(v, prefix, sub, seen) for sub in schema.get("allOf", ())]
        if "anyOf" in schema:
            fits = reduce(lambda a, b: a | b, [F.size(self.errors(v, prefix, sub, seen)) == 0 for sub in schema["anyOf"]])
            out.append(F.when(fits, _nothing()).otherwise(F.array(_told(prefix, " is not valid under any of the given schemas", v))))
        return out


def compiled(schema: Mapping) -> Callable[[Column], Column]:
    """A function from JSON texts to the sorted errors of ``schema``; an empty array is a valid record, a null text breaks it."""
    compiler = _Compiler(schema)

    def errors(payload: Column) -> Column:
        text = payload.cast("string")
        parsed = F.when(jsonx.is_json(text), F.try_parse_json(text))
        broken = bound(parsed, lambda v: F.when(v.isNotNull(), compiler.errors(v, "", schema)))
        told = F.transform(broken, lambda e: F.concat(e.path, F.lit(": "), F.when(e.value.isNull(), "").otherwise(shown(e.value)), e.text))
        return F.coalesce(F.array_sort(told), F.array(F.lit("<root>: is not JSON")))

    return errors


def _texts(names: Sequence[str]) -> dict:
    """A closed object of fields that are all required, each a text or null."""
    return _closed({name: {"type": ["string", "null"]} for name in names})


def _closed(properties: Mapping) -> dict:
    return {"type": "object", "additionalProperties": False, "required": list(properties), "properties": dict(properties)}


def _record(lists: Mapping, middle: Mapping) -> dict:
    """A closed record with what every kind of record has: its document, files, pages, and what a reader should look at again."""
    name = {"type": "string", "minLength": 1}
    head = {"document_id": name, "source_files": {"type": "array", "items": name}, "page_count": {"type": "integer", "minimum": 1}}
    tail = {"uncertain_fields": {"type": "array", "items": {"type": "string"}}, "review_required": {"type": "boolean"}, "review_notes": {"type": "array", "items": {"type": "string"}}}
    return _closed({**head, **middle, **lists, **tail})


def case_schema() -> dict:
    """The schema of a case study's record."""
    objects = lambda names: {"type": "array", "items": _texts(names)}
    lists = {"family_members": objects(K.MEMBER_FIELDS), "attachments": objects(K.ATTACHMENT_FIELDS), "assets": {"type": "array", "items": {"type": "string"}}}
    special = {"document_id", "source_files", "page_count", "uncertain_fields", "review_required", "review_notes", *lists}
    return _record(lists, {name: {"type": ["string", "null"]} for name in K.CASE_FIELDS if name not in special})


def certificate_schema() -> dict:
    """The schema of a birth certificate's record."""
    text = {"type": ["string", "null"]}
    ids = _closed({**{f"{who}_national_id": text for who in ("child", "father", "mother")}, "other_ids": {"type": "array", "items": _texts(["label_ar", "value"])}})
    people = _closed({"child": _texts(K.CHILD_FIELDS), "father": _texts(K.PARENT_FIELDS), "mother": _texts(K.PARENT_FIELDS), "misc_notes": text})
    return _record({}, {"birth_certificate": _texts(K.CERTIFICATE_FIELDS), "ids": ids, "personal_and_other": people})
