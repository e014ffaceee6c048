"""Chunk references `<doc_id>#<index>`, cut at the last `#`."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import BLANK

_REFERENCE = rf"(?s)^[{BLANK}]*(.*[^{BLANK}])[{BLANK}]*#[{BLANK}]*0*([0-9]+)[{BLANK}]*$"
_PLAIN = r"^[!-\"$-~]+#(?:0|[1-9][0-9]*)$"


def canonical_ref(c: Column) -> Column:
    """`doc#index` without blanks at the ends and around the `#` and without leading zeros; null where it is no reference."""
    return F.when(c.rlike(_PLAIN), c).when(c.rlike(_REFERENCE), F.regexp_replace(c, _REFERENCE, "$1#$2"))


def canonical_refs(c: Column) -> Column:
    """The sorted distinct references of an array; what is no reference is left out, null gives the empty array."""
    return F.array_sort(F.array_distinct(F.array_compact(F.transform(F.coalesce(c, F.array().cast("array<string>")), canonical_ref))))


def ref_doc(c: Column) -> Column:
    """What stands before the last `#`, or the whole string without one."""
    return F.when(F.contains(c, F.lit("#")), F.regexp_extract(c, r"(?s)^(.*)#[^#]*$", 1)).otherwise(c)


def ref_index(c: Column) -> Column:
    """The index as a long; -1 where there is none."""
    tail = F.substring_index(c, "#", -1)
    return F.when(F.contains(c, F.lit("#")), F.coalesce(tail.try_cast("long"), F.lit(-1))).otherwise(F.lit(-1)).cast("long")


def canonical_docs(c: Column) -> Column:
    """The sorted distinct doc ids of an array, trimmed; null and blank ones are left out."""
    trimmed = F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda x: F.regexp_replace(x, f"^[{BLANK}]+|[{BLANK}]+$", ""))
    return F.array_sort(F.array_distinct(F.filter(trimmed, lambda x: x.isNotNull() & (x != ""))))
