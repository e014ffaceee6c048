"""Problem 3: duplicates hidden by formatting differences.

Byte-identical rows collapse first, with their count; only the distinct survivors are brought to canonical text, and a second
grouping on that whole text adds up the counts. Both groupings combine on the map side, so a hot record costs one row a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.chunks import canonical_refs
from ..functions.text import words
from ..operators.skew import join_unique
from ..runtime import Cuts
from .canonical import fingerprint

# Where a field begins: behind a separator, a label of any length that holds a letter, up to its colon.
_LABEL = r"(?:^|[;|\n\r{,])([^;|\n\r{,:]*\p{L}[^;|\n\r{,:]*):"
# The same in a JSON object: a quoted name behind the brace or a comma. Names and values may hold any separator.
_NAME = r'(?:^\s*\{|,)\s*"((?:[^"\\]|\\.)*+)"\s*:'
_LINE = r"[;|\n\r]+"
_MARK = "\u0001"


def _plain_string(piece: Column) -> Column:
    """A piece of JSON text with its escapes resolved; only pieces that hold one are parsed."""
    quoted = F.regexp_replace(F.replace(piece, F.lit('\\"'), F.lit(" ")), '"', " ")
    read = F.get(F.from_json(F.concat(F.lit('["'), quoted, F.lit('"]')), "array<string>", {"allowUnquotedControlChars": "true"}), F.lit(0))
    return F.when(F.contains(piece, F.lit("\\")), F.coalesce(read, piece)).otherwise(piece)


def field_words(c: Column) -> Column:
    """The words of a text; where it is a list of `label: value` fields, plain or a JSON object, the fields are sorted first.

    A JSON object is cut at its quoted names. A plain list is cut at semicolons, bars and line breaks if every part then has a
    label, else also at commas that a label follows; labels may have any length and any other character.
    """
    plain = words(c)
    split = lambda pattern: F.split(F.regexp_replace(c, pattern, f"{_MARK}$1 "), _MARK)
    sorted_words = lambda pieces, first: F.array_join(F.array_sort(F.transform(F.slice(pieces, first, F.greatest(F.size(pieces) - (first - 1), F.lit(1))), words)), " ")
    named, labelled = split(_NAME), split(_LABEL)
    parts = F.filter(F.split(c, _LINE), lambda x: x.rlike(r"[\p{L}\p{N}]"))
    of_json = F.array_join(F.array_sort(F.transform(F.slice(named, 2, F.greatest(F.size(named) - 1, F.lit(1))), lambda x: words(_plain_string(x)))), " ")
    listed = lambda pieces: (F.size(pieces) > 2) & (words(F.element_at(pieces, 1)) == "")
    some = F.when(c.rlike(r"^\s*\{") & listed(named), of_json)
    some = some.when((F.size(parts) > 1) & F.forall(parts, lambda x: x.rlike(r"^[^:]*\p{L}[^:]*:")), sorted_words(parts, 1))
    some = some.when(listed(labelled), sorted_words(labelled, 2)).otherwise(plain)
    return F.when(F.contains(c, F.lit(":")), some).otherwise(plain)


def _raw_print() -> Column:
    return fingerprint(F.to_json(F.struct("question", "answer", "chunk_ids"), {"ignoreNullFields": "false"}))


def collapse_records(df: DataFrame, key: str = "record_number", cited_only: bool = False) -> tuple[DataFrame, DataFrame]:
    """(records, membership) of rows with question, answer and chunk_ids.

    records: first_record (the smallest key), copies (rows of the record), and its canonical words and references.
    membership: first_record, member_record for every row of a record with two or more rows.
    Null texts read as empty ones; rows without any chunk reference can be records like any other, or are left out with
    cited_only. Keys are unique, so no ties occur; other columns are ignored; no rows give no records.
    """
    rows = df.select(F.col(key).alias("record"), "question", "answer", "chunk_ids")
    survivors = rows.groupBy("question", "answer", "chunk_ids").agg(F.min("record").alias("record"), F.count("*").alias("n"))
    canonical = survivors.select("record", "n", _raw_print().alias("raw"), words(F.col("question")).alias("q"), field_words(F.coalesce("answer", F.lit(""))).alias("a"), canonical_refs(F.col("chunk_ids")).alias("refs"))
    form = fingerprint(F.concat_ws("\n", "q", "a", F.array_join("refs", "\n"))).alias("form")
    cuts = Cuts(df.sparkSession, "collapse")
    canonical, seen = cuts.measured(canonical.select("*", form), most=F.max("n"))  # read twice below
    if cited_only:
        canonical = canonical.where(F.size("refs") > 0)
    records = canonical.groupBy("q", "a", "refs").agg(F.min("record").alias("first_record"), F.sum("n").alias("copies"), F.count("*").alias("spellings"))
    several, held = cuts.measured(records.where("copies > 1").select(form, "first_record", "spellings"), most=F.max("spellings"))
    of_raw = join_unique(canonical.select("form", "raw", "n"), several, "form", "spellings", held["most"]).select("raw", "first_record", "n")
    marked = rows.select(_raw_print().alias("raw"), F.col("record").alias("member_record"))
    membership = join_unique(marked, of_raw, "raw", "n", seen["most"]).select("first_record", "member_record")
    return records.drop("spellings"), membership


def hidden_copies(df: DataFrame) -> DataFrame:
    """(first_record, copy_record) of the records with at least one chunk reference and two or more rows."""
    _, membership = collapse_records(df, cited_only=True)
    return membership.where("first_record <> member_record").select("first_record", F.col("member_record").alias("copy_record"))
