"""JSON document expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _path(keys: tuple[str, ...]) -> str:
    return "$" + "".join(f"['{key}']" for key in keys)


def json_text(document: Column | str, *keys: str) -> Column:
    """The value at a path as text; null when any step is missing."""
    return F.get_json_object(document, _path(keys))


def json_node(document: Column | str, *keys: str) -> Column:
    """The value at a path as a variant; null when any step is missing."""
    return F.try_variant_get(F.try_parse_json(document), _path(keys), "variant")


def unwrap_id(raw: Column) -> Column:
    """An id read as variant, ``{"$oid": x}`` or a plain value, as text; null for other objects."""
    plain = F.try_variant_get(raw, "$", "string")
    wrapped = F.try_variant_get(raw, "$['$oid']", "string")
    return F.coalesce(wrapped, F.when(~plain.startswith("{"), plain))


def merge_objects(left: Column, right: Column) -> Column:
    """Shallow merge of two ``map<string,variant>``; the right side wins."""
    empty = F.from_json(F.lit("{}"), "map<string,variant>")
    return F.map_concat(F.coalesce(left, empty), F.coalesce(right, empty))


def without_keys(document: Column, keys: Column) -> Column:
    """Drop the top-level keys named in an array (which may be null)."""
    names = F.coalesce(keys, F.array().cast("array<string>"))
    return F.map_filter(document, lambda key, _: ~F.array_contains(names, key))


# Private characters around a string and before a number, once both are JSON strings.
_OPEN, _CLOSE = "\ue001", "\ue000"
_INSIDE = r'[^"\\]*+(?:\\.[^"\\]*+)*+'
_CLOSED = rf'[^"\\{_CLOSE}]*+(?:(?:\\.|{_CLOSE}(?!"))[^"\\{_CLOSE}]*+)*+'


def marked(text: Column | str) -> Column:
    """JSON text with every string, names too, between ``_OPEN`` and ``_CLOSE`` and every number as a string after both.

    A JSON reader turns numbers into doubles; as strings they keep their characters. A number never ends with
    ``_CLOSE``, a string always does, so one pass over the text is enough.
    """
    return F.regexp_replace(text, f'"({_INSIDE})"|(-?[0-9][-+.0-9eE]*+)', f'"{_OPEN}$1{_CLOSE}$2"')


def marked_name(name: str) -> str:
    """A field name as ``marked`` writes it."""
    return f"{_OPEN}{name}{_CLOSE}"


def _unmarked(value: Column) -> Column:
    quoted = F.to_json(F.array(F.substring(value, F.lit(2), F.length(value) - 2)))
    numbers = F.regexp_replace(value, f'"{_OPEN}{_CLOSE}([-+.0-9eE]++)"', "$1")
    nested = F.regexp_replace(numbers, f'"{_OPEN}({_CLOSED}){_CLOSE}"', '"$1"')
    return (
        F.when(value.isNull(), "null")
        .when(~value.startswith(_OPEN), nested)
        .when(value.endswith(_CLOSE), F.substring(quoted, F.lit(2), F.length(quoted) - 2))
        .otherwise(F.substring(value, F.lit(3), F.length(value)))
    )


def exact_fields(fields: Column) -> Column:
    """A ``map<string,string>`` read from marked text, as names and the JSON text of their values, digit by digit."""
    names = F.transform_keys(fields, lambda name, _: F.substring(name, F.lit(2), F.length(name) - 2))
    return F.transform_values(names, lambda _, value: _unmarked(value))


def json_fields(document: Column | str) -> Column:
    """The top-level fields of an object text, values as JSON text with their numbers as they are; null for other texts."""
    return exact_fields(F.from_json(marked(document), "map<string,string>"))


def fields_text(fields: Column) -> Column:
    """Names and JSON texts as one object text, in their order; null gives ``{}``."""
    return F.coalesce(_object(F.map_entries(fields)), F.lit("{}"))


def document_text(document: Column) -> Column:
    """A struct, map or variant as JSON text, null fields kept; null gives ``{}``."""
    return F.coalesce(F.to_json(document, {"ignoreNullFields": "false"}), F.lit("{}"))


def object_from_entries(entries: Column) -> Column:
    """``array<struct<key, value>>`` of JSON-text values to one JSON object text.

    Entries are put in key order, so equal documents are equal text.
    """
    return _object(F.array_sort(entries))


def _object(entries: Column) -> Column:
    def member(entry: Column) -> Column:
        quoted = F.to_json(F.array(entry["key"]))
        return F.concat(F.substring(quoted, F.lit(2), F.length(quoted) - 2), F.lit(":"), entry["value"])

    members = F.transform(entries, member)
    return F.concat(F.lit("{"), F.array_join(members, ","), F.lit("}"))


def is_json(text: Column | str) -> Column:
    """True where the text is one valid JSON value."""
    return F.try_parse_json(text).isNotNull()
