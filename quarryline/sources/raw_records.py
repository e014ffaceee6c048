"""Problem 6: rows that fail to parse.

CSV records are assembled quote-aware, each is parsed with Python's strict csv reader inside mapInArrow, and structural
exceptions are captured before any field is typed. What fails comes out as ParseIssue rows; all else loads as SourceRows.
"""

from __future__ import annotations

import csv
import io
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ordinals import with_ordinal
from ..runtime import Cuts

FIELDS = ("question", "answer", "docIds", "chunk_ids", "pipeline", "source_row_number", "is_exact_duplicate", "duplicate_of_row")
# The spellings of a boolean.
TRUE, FALSE = {"true", "yes", "y", "1"}, {"false", "no", "n", "0"}
# A record as the writer makes it: fields quoted whole with inner quotes doubled, or free of quotes.
_WELL_QUOTED = re.compile(r'(?:"(?:[^"]|"")*+"|[^",]*+)(?:,(?:"(?:[^"]|"")*+"|[^",]*+))*+')
_INTEGER = re.compile(r"[+-]?[0-9]+")
_DIGITS = re.compile(r"[0-9]+")

csv.field_size_limit((1 << 31) - 1)

ISSUE = T.StructType([T.StructField("field", T.StringType()), T.StructField("value", T.StringType()), T.StructField("error", T.StringType())])
ROW = T.StructType(
    [
        T.StructField("question", T.StringType()),
        T.StructField("answer", T.StringType()),
        T.StructField("doc_ids", T.ArrayType(T.StringType())),
        T.StructField("chunk_ids", T.ArrayType(T.StringType())),
        T.StructField("pipeline", T.StringType()),
        T.StructField("source_row_number", T.StringType()),
        T.StructField("is_exact_duplicate", T.BooleanType()),
        T.StructField("duplicate_of_row", T.StringType()),
    ]
)
_ARROW_ISSUES = pa.list_(pa.struct([(f, pa.string()) for f in ("field", "value", "error")]))
_ARROW_ROW = pa.struct(
    [(f, t) for f, t in zip(ROW.names, [pa.string(), pa.string(), pa.list_(pa.string()), pa.list_(pa.string()), pa.string(), pa.string(), pa.bool_(), pa.string()], strict=True)]
)


def split_record(line: str, columns: int | None = len(FIELDS)) -> tuple[list[str], str | None]:
    """(fields, None), or ([], error): `broken_quoting`, else `column_count`. columns None allows any number of fields."""
    line = line[:-1] if line.endswith("\r") else line
    try:
        records = list(csv.reader(io.StringIO(line, newline=""), strict=True))
    except csv.Error:
        return [], "broken_quoting"
    # The strict reader lets a quote inside an unquoted field pass.
    if '"' in line and not _WELL_QUOTED.fullmatch(line):
        return [], "broken_quoting"
    if len(records) != 1 or columns is not None and len(records[0]) != columns:
        return [], "column_count"
    return records[0], None


def chunk_error(item: str) -> str | None:
    """What keeps a chunk reference that is not blank from being one. Indexes of any length are looked at as text."""
    doc, hash_mark, index = item.rpartition("#")
    if not hash_mark:
        return "no_hash"
    if not doc.strip():
        return "empty_doc"
    index = index.strip()
    if not _INTEGER.fullmatch(index):
        return "index_not_integer"
    return "index_negative" if index[0] == "-" and index.strip("-0") else None


def canonical_chunk(item: str) -> str:
    doc, _, index = item.rpartition("#")
    return f"{doc.strip()}#{index.strip().lstrip('+-').lstrip('0') or '0'}"


def _json_value(text: str):
    """A JSON value; ValueError also for escapes that are no text, such as half of a surrogate pair."""
    value = json.loads(text, parse_int=lambda digits: int(digits) if len(digits) < 300 else float(digits))
    if "\\u" in text:
        json.dumps(value, ensure_ascii=False).encode()
    return value


def string_array(text: str, issues: list[tuple[str, str, str]], field: str) -> list[str]:
    """The trimmed strings of a JSON array that are not blank; what else it holds becomes an issue."""
    if not text.strip():
        return []
    try:
        value = _json_value(text)
    except (ValueError, RecursionError):
        issues.append((field, text, "invalid_json"))
        return []
    if not isinstance(value, list):
        issues.append((field, text, "not_an_array"))
        return []
    for item in value:
        if not isinstance(item, str):
            issues.append((field, json.dumps(item, ensure_ascii=False), "item_not_string"))
    return [s for x in value if isinstance(x, str) and (s := x.strip())]


def parse_fields(named: dict[str, str]) -> tuple[dict, list[tuple[str, str, str]]]:
    """(the typed row of what is valid, issues as (field, value, error)) of one record by column name; a missing column reads as empty."""
    get = lambda name: named.get(name) or ""
    issues: list[tuple[str, str, str]] = []
    doc_ids = string_array(get("docIds"), issues, "docIds")
    refs = []
    for item in string_array(get("chunk_ids"), issues, "chunk_ids"):
        if bad := chunk_error(item):
            issues.append(("chunk_ids", item, bad))
        else:
            refs.append(canonical_chunk(item))
    number = get("source_row_number")
    if number.strip() and not _DIGITS.fullmatch(number.strip()):
        issues.append(("source_row_number", number, "not_an_integer"))
    flag = get("is_exact_duplicate").strip().casefold()
    if flag and flag not in TRUE | FALSE:
        issues.append(("is_exact_duplicate", get("is_exact_duplicate"), "not_a_boolean"))
    values = (get("question"), get("answer"), doc_ids, refs, get("pipeline"), number, flag in TRUE, get("duplicate_of_row"))
    return dict(zip(ROW.names, values, strict=True)), issues


def parse_record(line: str) -> tuple[dict | None, list[tuple[str, str, str]]]:
    """(the typed row or None, issues as (field, value, error))."""
    fields, error = split_record(line)
    if error:
        return None, [("record", line, error)]
    row, issues = parse_fields(dict(zip(FIELDS, fields, strict=True)))
    return (None if issues else row), issues


def _arrow(parsed: list[tuple[dict | None, list[tuple[str, str, str]]]]) -> tuple[pa.Array, pa.Array]:
    """Arrow columns of typed rows and issues."""
    issues = [[dict(zip(("field", "value", "error"), x, strict=True)) for x in found] for _, found in parsed]
    return pa.array([r for r, _ in parsed], _ARROW_ROW), pa.array(issues, _ARROW_ISSUES)


def parse_lines(lines: DataFrame, key: str = "csv_line_number", text: str = "raw_line") -> DataFrame:
    """(key, row, issues): each line either has a typed row and no issue, or no row and one issue or more.

    A null line reads as the empty one, which has one field and not eight. Repeated lines are kept; other columns are dropped.
    """
    schema = T.StructType([lines.schema[key], T.StructField("row", ROW), T.StructField("issues", T.ArrayType(ISSUE))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parsed = [parse_record(x or "") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *_arrow(parsed)], names=schema.names)

    return lines.select(key, text).mapInArrow(run, schema)


def parse_issues(lines: DataFrame, key: str = "csv_line_number", text: str = "raw_line") -> DataFrame:
    """(key, field, value, error): the ParseIssues."""
    return parse_lines(lines, key, text).select(key, F.explode("issues").alias("issue")).select(key, "issue.*")


def loaded_rows(lines: DataFrame, key: str = "csv_line_number", text: str = "raw_line") -> DataFrame:
    """The lines without issue as typed columns."""
    return parse_lines(lines, key, text).where("row is not null").select(key, "row.*")


# One physical line, as the strict reader goes through it: begun between records and left inside a quoted field, or begun inside one.
_OPENS = r'^(?:(?:"(?:[^"]|"")*+"|[^",]*+),)*+"(?:[^"]|"")*+\z'
_INSIDE = r'^(?:[^"]|"")*+(?:"(?:,(?:"(?:[^"]|"")*+"|[^",]*+)(?=,|\r?\z))*+(?:,"(?:[^"]|"")*+|\r?))?\z'


def assemble_records(lines: DataFrame, *, block_lines: int = 100_000) -> DataFrame:
    """Physical lines (file_name, line_no from 1, line) to records (file_name, csv_line_number, raw_line), quote-aware.

    A record begins on a line before which the file holds an even number of quotes. Those numbers come from sums per block of
    lines and a running sum over the blocks, so a file of any size is spread over tasks; only the block sums of a file meet
    in one. Whether a record of several lines is well quoted shows in each line by itself, as it is known whether the line begins
    inside quotes. One that is not, or whose quotes never close, is taken apart: each of its lines is a record of its own, so that
    the valid lines behind a stray quote load and none is lost. A null line reads as an empty one; records may have any length.
    """
    text = F.coalesce("line", F.lit(""))
    quotes = F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))
    block = F.floor((F.col("line_no") - 1) / block_lines).cast("long")
    marked = lines.select("file_name", "line_no", text.alias("line"), block.alias("block"), quotes.alias("quotes"))
    before = Window.partitionBy("file_name").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    in_block = Window.partitionBy("file_name", "block").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    sums = marked.groupBy("file_name", "block").agg(F.sum("quotes").alias("q")).select("file_name", "block", F.coalesce(F.sum("q").over(before), F.lit(0)).alias("q"))
    opened = marked.join(sums, ["file_name", "block"]).withColumn("starts", (F.col("q") + F.coalesce(F.sum("quotes").over(in_block), F.lit(0))) % 2 == 0)
    # The last record start at or before each line: inside the block, else the last one of an earlier block.
    up_to = Window.partitionBy("file_name", "block").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    here = opened.withColumn("own", F.last(F.when(F.col("starts"), F.col("line_no")), True).over(up_to))
    last = here.groupBy("file_name", "block").agg(F.max("own").alias("m")).select("file_name", "block", F.max("m").over(before).alias("earlier"))
    closed = F.col("quotes") % 2 == 0
    bad = F.when(F.col("starts") & closed, F.lit(False)).when(F.col("starts"), ~F.col("line").rlike(_OPENS)).otherwise(~F.col("line").rlike(_INSIDE))
    owned = here.join(last, ["file_name", "block"]).select("file_name", F.coalesce("own", "earlier").alias("csv_line_number"), "line_no", "line", "quotes", bad.alias("bad"))
    key = ["file_name", "csv_line_number"]
    found = owned.groupBy(*key).agg(F.count("*").alias("n"), F.max("bad").alias("bad"), F.sum("quotes").alias("q"))
    broken = found.where("n > 1 and (bad or q % 2 = 1)").select(*key, F.lit(True).alias("broken"))
    owned = owned.join(broken, key, "left").withColumn("csv_line_number", F.when(F.col("broken"), F.col("line_no")).otherwise(F.col("csv_line_number")))
    pieces = owned.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("line_no", "line"))).alias("p"))
    return pieces.select(*key, F.array_join(F.transform("p", lambda x: x["line"]), "\n").alias("raw_line"))


def read_lines(spark, path: str) -> DataFrame:
    """Physical lines of CSV files, cut at line feeds: (file_name, line_no, line). A byte order mark is dropped.

    Line numbers come from the offset of each line in its file: partition sizes first, then a running sum over partitions.
    """
    raw = spark.read.text(path, lineSep="\n").select(F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("id"), F.regexp_replace("value", "^﻿", "").alias("line"))
    sizes = raw.groupBy("file_name", "at").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    earlier = Window.partitionBy("file_name").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("file_name", "at", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("skip"))
    return raw.join(starts, ["file_name", "at"]).select("file_name", (F.col("id") - F.col("first") + F.col("skip") + 1).alias("line_no"), "line")


def source_rows(spark, path: str) -> tuple[DataFrame, DataFrame]:
    """(rows, issues) of CSV files with a header: the training source as one operator.

    rows: record_number (from 1 in each file, blank lines not counted), csv_line_number (record_number + 1), file_name and the
    typed columns; what is valid of a record loads, whatever else of it is an issue. issues: record_number, csv_line_number,
    file_name, field, value, error. Columns are found by the header of their file, missing ones read as empty, others are
    ignored; a record with too few or too many fields reads as far as it goes, one with broken quoting gives an issue and no row.
    A file with a header alone gives no rows.
    """
    cuts = Cuts(spark, "source")
    records = assemble_records(read_lines(spark, path)).where(F.trim(F.regexp_replace("raw_line", "\r", "")) != "")
    numbered = cuts.cut(with_ordinal(records, [F.col("file_name"), F.col("csv_line_number")]))
    heads = numbered.groupBy("file_name").agg(F.min_by("raw_line", "ordinal").alias("head"), F.min("ordinal").alias("first"))
    body = numbered.join(heads, "file_name").where("ordinal > first").select("file_name", (F.col("ordinal") - F.col("first")).alias("record_number"), "raw_line", "head")
    schema = T.StructType([T.StructField("file_name", T.StringType()), T.StructField("record_number", T.LongType()), T.StructField("row", ROW), T.StructField("issues", T.ArrayType(ISSUE))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[str, list[str]] = {}
        for batch in batches:
            parsed = []
            for line, head in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if head not in names:
                    names = {head: split_record(head, None)[0]}
                fields, error = split_record(line, None)
                parsed.append((None, [("record", line, error)]) if error else parse_fields(dict(zip(names[head], fields, strict=False))))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *_arrow(parsed)], names=schema.names)

    every = cuts.cut(body.mapInArrow(run, schema))
    at = ["record_number", (F.col("record_number") + 1).alias("csv_line_number"), "file_name"]
    issues = every.select(*at, F.explode("issues").alias("issue")).select("record_number", "csv_line_number", "file_name", "issue.*")
    return every.where("row is not null").select(*at, "row.*"), issues
