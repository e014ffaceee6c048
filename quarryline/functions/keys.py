"""Row keys: SHA-256 of canonical JSON (sorted names, no blanks, ASCII escapes)."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from .text import is_ascii, normalized_question

_CONTROL = "[\\x{0}-\\x{1f}\\x{7f}]"  # escapes of control characters are not spelt alike


@pandas_udf(T.StringType())
def _escaped(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else json.dumps(t))


def json_string(c: Column) -> Column:
    """A JSON string literal with ASCII escapes. Only texts beyond printable ASCII go through Python."""
    plain = is_ascii(c) & ~c.rlike(_CONTROL)
    quick = F.substring(F.to_json(F.struct(c.alias("a"))), 6, 2_000_000_000)
    return F.when(plain, _without_last(quick)).otherwise(_escaped(F.when(~plain, c)))


def _without_last(c: Column) -> Column:
    return F.substring(c, F.lit(1), F.length(c) - 1)


@pandas_udf(T.StringType())
def _escaped_list(lists: pd.Series) -> pd.Series:
    return lists.map(lambda x: None if x is None else json.dumps(list(x), separators=(",", ":")))


def json_strings(c: Column) -> Column:
    """A JSON array of strings with ASCII escapes. Only arrays that hold text beyond printable ASCII go through Python."""
    joined = F.array_join(c, "")
    plain = is_ascii(joined) & ~joined.rlike(_CONTROL)
    return F.when(plain, F.to_json(c)).otherwise(_escaped_list(F.when(~plain, c)))


def question_hash(question: Column) -> Column:
    """The hash of a normalised question; null reads as empty."""
    return F.sha2(F.concat(F.lit('{"eval_question":'), json_string(normalized_question(F.coalesce(question, F.lit("")))), F.lit("}")), 256)


def doc_key(docs: Column) -> Column:
    """The hash of a sorted array of distinct doc ids."""
    return F.sha2(json_strings(docs), 256)


def train_key(question: Column, answer: Column, refs: Column) -> Column:
    """The hash of the normalised question and answer and the sorted distinct references."""
    q, a = (json_string(normalized_question(F.coalesce(c, F.lit("")))) for c in (question, answer))
    return F.sha2(F.concat(F.lit('{"answer":'), a, F.lit(',"chunk_ids":'), json_strings(refs), F.lit(',"question":'), q, F.lit("}")), 256)
