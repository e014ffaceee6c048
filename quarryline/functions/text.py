"""Text columns: blanks, folded words, token sets, Jaccard."""

from __future__ import annotations

import functools
import string
import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a blank, inside a character class.
BLANK = r"\s\x{1c}-\x{1f}\x{85}\p{Z}"


def collapse(c: Column) -> Column:
    """Runs of blanks become one space; ends are trimmed. Null stays null."""
    return F.trim(F.regexp_replace(c, f"[{BLANK}]+", " "))


def is_ascii(c: Column) -> Column:
    return F.octet_length(c) == F.length(c)


@functools.cache
def _casefold_rules() -> tuple[str, str, list[tuple[str, str]], str]:
    """(letters that fold to one, what they fold to, pairs of those that fold to more, letters that lower case leaves wrong), by rule from Unicode."""
    one, several, wrong = {}, [], []
    for code in range(0x80, sys.maxunicode + 1):
        c = chr(code)
        if 0xD800 <= code < 0xE000:
            continue
        f = c.casefold()
        if len(f) > 1:
            several.append((c, f))
        elif f != c:
            one[c] = f
        if f != c.lower() and c not in "ßẞſςΣ":
            wrong.append(c)
    return "".join(one), "".join(one.values()), several, "".join(wrong)


def fold(c: Column) -> Column:
    """Case folding as Unicode defines it. Lower case serves nearly all texts; those with a letter that it leaves wrong take a table."""
    one, to, several, wrong = _casefold_rules()
    usual = F.translate(F.replace(F.lower(c), F.lit("ß"), F.lit("ss")), "ſς", "sσ")
    pairs = F.split(F.lit(" ".join(a + b for a, b in several)), " ")
    single = F.translate(c, one + string.ascii_uppercase, to + string.ascii_lowercase)
    table = F.aggregate(pairs, single, lambda acc, x: F.replace(acc, F.substring(x, 1, 1), F.substring(x, 2, 9)))
    return F.when(is_ascii(c), F.lower(c)).when(F.translate(c, wrong, "") != c, table).otherwise(usual)


def normalized_question(c: Column) -> Column:
    """Blanks collapsed, ends trimmed, case folded: what question keys are made of."""
    return fold(collapse(c))


def words(c: Column) -> Column:
    """The words (runs of letters and digits, case folded) with single spaces between; null reads as no words."""
    c = F.coalesce(c, F.lit(""))
    short = F.regexp_replace(F.lower(c), "[^a-z0-9]+", " ")
    return F.trim(F.when(is_ascii(c), short).otherwise(F.regexp_replace(fold(c), r"[^\p{L}\p{N}]+", " ")))


def tokens(c: Column) -> Column:
    """The distinct runs of two or more ASCII letters and digits, in lower case."""
    return F.array_distinct(F.regexp_extract_all(F.translate(F.coalesce(c, F.lit("")), string.ascii_uppercase, string.ascii_lowercase), F.lit("[a-z0-9]{2,}"), F.lit(0)))


def jaccard(a: Column, b: Column) -> Column:
    """|a ∩ b| / |a ∪ b| of two arrays of distinct values; 0 where either is empty."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), both / (F.size(a) + F.size(b) - both)).otherwise(F.lit(0.0))


def truncate(c: Column, n: int) -> Column:
    """Blanks collapsed; a text of more than n characters keeps n - 3, without blanks at the end, and gets three dots."""
    flat = collapse(F.coalesce(c, F.lit("")))
    return F.when(F.length(flat) <= n, flat).otherwise(F.concat(F.rtrim(F.substring(flat, 1, n - 3)), F.lit("...")))
