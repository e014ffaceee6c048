"""The normalised training rows (D1), their citations (D2), and CSV and JSONL scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import keys
from ..functions.chunks import canonical_ref, ref_doc, ref_index
from ..functions.text import BLANK

CSV_FIELDS = ("question", "answer", "docIds", "chunk_ids", "pipeline", "source_row_number", "is_exact_duplicate", "duplicate_of_row")
# Spellings of true.
TRUE = ("1", "true", "yes", "y")


def strip(c: Column) -> Column:
    """Without blanks at the ends; null becomes empty."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), f"^[{BLANK}]+|[{BLANK}]+$", "")


def parse_bool(c: Column) -> Column:
    return F.lower(strip(c)).isin(*TRUE)


def _listed(c: Column, each) -> Column:
    return F.filter(F.transform(F.coalesce(c, F.array().cast("array<string>")), each), lambda x: x.isNotNull() & (x != ""))


def training(rows: DataFrame, with_keys: bool = True) -> DataFrame:
    """SourceRows: trimmed texts, doc_ids and chunk_ids as listed (blank and malformed ones left out), signatures and keys.

    Null fields read as empty. Repeated references stay in chunk_ids and count once in the signatures.
    """
    base = rows.select(
        "record_number",
        "csv_line_number",
        strip(F.col("question")).alias("question"),
        strip(F.col("answer")).alias("answer"),
        _listed(F.col("doc_ids"), lambda x: strip(x)).alias("doc_ids"),
        _listed(F.col("chunk_ids"), canonical_ref).alias("chunk_ids"),
        strip(F.col("pipeline")).alias("pipeline"),
        parse_bool(F.col("is_exact_duplicate")).alias("is_dup"),
        strip(F.col("duplicate_of_row")).alias("duplicate_of"),
        *(["snapshot_id"] if "snapshot_id" in rows.columns else []),
    )
    signed = base.withColumns({"evidence_signature": F.array_sort(F.array_distinct("chunk_ids")), "doc_set_signature": F.array_sort(F.array_distinct("doc_ids"))})
    if not with_keys:
        return signed
    return signed.withColumns({"train_key": keys.train_key(F.col("question"), F.col("answer"), F.col("evidence_signature")), "doc_key": keys.doc_key(F.col("doc_set_signature"))})


def citations(rows: DataFrame, *carry: str) -> DataFrame:
    """(record_number, chunk_id, doc_id, chunk_index, carried columns): a row for each distinct reference of each training row."""
    one = rows.select("record_number", *carry, F.explode("evidence_signature").alias("chunk_id"))
    return one.select("record_number", "chunk_id", ref_doc(F.col("chunk_id")).alias("doc_id"), ref_index(F.col("chunk_id")).alias("chunk_index"), *carry)


def read_training_csv(spark: SparkSession, path: str) -> DataFrame:
    """The training CSV as strings: quoted line breaks, doubled quotes and a byte order mark are handled, missing columns read as empty."""
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("encoding", "UTF-8").csv(path)
    names = {c.lstrip("﻿"): c for c in raw.columns}
    return raw.select(*[F.coalesce(F.col(f"`{names[f]}`"), F.lit("")).alias(f) if f in names else F.lit("").alias(f) for f in CSV_FIELDS])


def column_conformance(columns: list[str]) -> dict[str, list[str]]:
    """Which expected columns are missing and which others there are."""
    return {"missing": [c for c in CSV_FIELDS if c not in columns], "extra": [c for c in columns if c not in CSV_FIELDS]}


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines with a schema; blank lines are skipped, a malformed one fails the read, a missing path is an empty table."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def parse_json_lines(lines: DataFrame, text: str = "value") -> DataFrame:
    """lines with `record` (VARIANT, null unless the line is a JSON object), `parse_error` and `raw_line`; blank lines are left out."""
    kept = lines.where(F.trim(F.coalesce(text, F.lit(""))) != "")
    parsed = kept.withColumn("_v", F.try_parse_json(text))
    is_object = F.schema_of_variant("_v").startswith("OBJECT")
    error = F.when(F.col("_v").isNull(), F.lit("malformed_jsonl")).when(~is_object, F.lit("not_an_object"))
    return parsed.withColumns({"record": F.when(is_object, F.col("_v")), "parse_error": error, "raw_line": F.col(text)}).drop("_v")


def focus_keys(lines: DataFrame, text: str = "value") -> DataFrame:
    """(train_key): the `train_key` of an object line, the string of a string line, else the raw text; other JSON values give none."""
    value = F.trim(F.col(text))
    v = F.try_parse_json(value)
    kind = F.schema_of_variant(v)
    key = F.when(v.isNull(), value).when(kind.startswith("OBJECT"), F.try_variant_get(v, "$.train_key", "string")).when(kind == "STRING", v.cast("string"))
    return lines.where(value != "").select(F.trim(key).alias("train_key")).where("train_key <> ''").distinct()
