"""Columns of JSON values: lists of strings however they were written, text of fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import BLANK

_NONE = "array<string>"


def strip(c: Column) -> Column:
    """Without blanks at the ends; null becomes empty."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), f"^[{BLANK}]+|[{BLANK}]+$", "")


def _empty() -> Column:
    return F.array().cast(_NONE)


def _as_text(v: Column) -> Column:
    """A JSON value as Python writes it: True, False and None with capitals; nested values as JSON."""
    kind = F.schema_of_variant(v)
    return F.when(kind == "BOOLEAN", F.initcap(v.cast("string"))).when(F.is_variant_null(v), F.lit("None")).when(kind.rlike("^(OBJECT|ARRAY)"), F.to_json(v)).otherwise(v.cast("string"))


def _listed(v: Column, trimmed: bool) -> Column:
    texts = F.transform(F.try_variant_get(v, "$", "array<variant>"), _as_text)
    return F.filter(F.transform(texts, strip) if trimmed else texts, lambda x: strip(x) != "")


def string_list(v: Column, trimmed: bool = True) -> Column:
    """The strings of a JSON value: a list, a text that holds a list as JSON, or one plain value; blank items drop out.

    trimmed: items lose the blanks at their ends, and a text with another JSON value in it counts as that one value. Not trimmed:
    items stay as they are, and such a text gives none. A text that is no JSON is one item. Objects, numbers and null give none.
    """
    kind = F.schema_of_variant(v)
    text = strip(v.cast("string"))
    inner = F.try_parse_json(text)
    inner_kind = F.schema_of_variant(inner)
    truthy = ~F.is_variant_null(inner) & ~_as_text(inner).isin("False", "0", "0.0", "", "{}")
    other = F.when(truthy, F.array(strip(_as_text(inner)))).otherwise(_empty()) if trimmed else _empty()
    of_text = F.when(text == "", _empty()).when(inner.isNull(), F.array(text)).when(inner_kind.startswith("ARRAY"), _listed(inner, trimmed)).otherwise(other)
    return F.coalesce(F.when(kind.startswith("ARRAY"), _listed(v, trimmed)).when(kind == "STRING", of_text), _empty())


def has_field(v: Column, name: str) -> Column:
    """Whether an object has a field of that name, be it null."""
    return F.try_variant_get(v, f"$.{name}", "variant").isNotNull()


def is_string_array(v: Column) -> Column:
    """Whether a JSON value is a list of strings only."""
    items = F.try_variant_get(v, "$", "array<variant>")
    return F.coalesce(F.schema_of_variant(v).startswith("ARRAY") & F.forall(items, lambda x: F.schema_of_variant(x) == "STRING"), F.lit(False))


def field_text(v: Column, name: str) -> Column:
    """The trimmed text of a field; missing, null and false values read as empty."""
    value = F.try_variant_get(v, f"$.{name}", "variant")
    text = F.when(value.isNotNull() & ~F.is_variant_null(value), _as_text(value))
    return F.when(text.isin("False", "0", "0.0"), "").otherwise(strip(text))
