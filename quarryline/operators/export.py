"""Ledgers and exports: keep-first dedupe, anti-join appends, subset export, CSV and JSON lines."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import question_hash
from ..functions.text import normalized_question
from ..sources.training import strip
from .skew import join_unique


def keep_first(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each key that is not null. The minimum by key combines on the map side, so a hot key costs one row a task."""
    first = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(F.struct(*rows.columns), F.struct(*order)).alias("_first"))
    return first.select("_first.*")


def export_status(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows with `export_status`: accepted, empty_question or duplicate_final_question; of equal normalised questions the first is accepted."""
    key = normalized_question(F.coalesce("question", F.lit("")))
    marked = rows.withColumn("_q", key)
    first = marked.groupBy("_q").agg(F.min(F.struct(*order)).alias("_first"), F.count("*").alias("_n"))
    both = join_unique(marked, first, "_q", "_n")
    status = F.when(F.col("_q") == "", "empty_question").when(F.struct(*order) == F.col("_first"), "accepted").otherwise("duplicate_final_question")
    return both.withColumn("export_status", status).drop("_q", "_first")


def effective_hash(question: Column, stored: Column) -> Column:
    """The stored hash, or that of the question where it is null or empty."""
    return F.when(F.coalesce(stored, F.lit("")) != "", stored).otherwise(question_hash(strip(question)))


def append_new(existing: DataFrame, fresh: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The rows of fresh to append: keys that existing lacks, the first row of each. Appending twice adds nothing."""
    unseen = fresh.join(existing.select(*keys).distinct(), keys, "left_anti")
    return unseen.groupBy(*keys).agg(F.min_by(F.struct(*unseen.columns), F.struct(*order)).alias("_first")).select("_first.*")


def bank_subset(bank: DataFrame, training: DataFrame, *, contained: bool = False, limit: int | None = None) -> DataFrame:
    """Bank rows with a seed among the training keys, optionally with all chunks cited there; of a hash the first that passes.

    Rows without hash are never merged. bank: eval_id, hash, chunk_ids, seed_train_keys.
    """
    keys = training.select("train_key").distinct()
    seeded = bank.select("eval_id", F.explode("seed_train_keys").alias("train_key")).join(keys, "train_key", "left_semi").select("eval_id").distinct()
    kept = bank.join(seeded, "eval_id", "left_semi")
    if contained:
        cited = training.select(F.explode("evidence_signature").alias("chunk_id")).distinct()
        outside = kept.select("eval_id", F.explode("chunk_ids").alias("chunk_id")).join(cited, "chunk_id", "left_anti").select("eval_id").distinct()
        kept = kept.join(outside, "eval_id", "left_anti")
    hashed = F.coalesce("hash", F.lit("")) != ""
    first = kept.where(hashed).groupBy("hash").agg(F.min("eval_id").alias("eval_id")).select("eval_id")
    out = kept.where(~hashed).unionByName(kept.join(first, "eval_id", "left_semi"))
    return out.orderBy("eval_id").limit(limit) if limit is not None else out


def upsert(previous: DataFrame, attempt: DataFrame, key: str) -> DataFrame:
    """previous with the rows of attempt replaced or added; within attempt the keys are unique."""
    return previous.join(attempt.select(key), key, "left_anti").unionByName(attempt, allowMissingColumns=True)


def json_array(c: Column) -> Column:
    """Text of a JSON array with a blank after each comma."""
    items = F.transform(c, lambda x: F.regexp_extract(F.to_json(F.array(x)), r"(?s)^\[(.*)\]$", 1))
    return F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))


def csv_rows(rows: DataFrame, pipeline: str) -> DataFrame:
    """The five output columns, arrays as JSON text."""
    return rows.select("question", "answer", json_array(F.col("doc_ids")).alias("docIds"), json_array(F.col("chunk_ids")).alias("chunk_ids"), F.lit(pipeline).alias("pipeline"))


def write_csv(rows: DataFrame, path: str) -> None:
    """CSV with a header and doubled quotes, as many files as there are partitions."""
    rows.write.mode("overwrite").option("header", True).option("escape", '"').option("quoteAll", True).csv(path)


def write_jsonl(rows: DataFrame, path: str, append: bool = False) -> None:
    """JSON lines, text unescaped; null fields are written."""
    rows.write.mode("append" if append else "overwrite").option("ignoreNullFields", False).json(path)


def write_summary(row: DataFrame, path: str, sort_keys: bool = False) -> None:
    """A table of one row as an indented JSON file on the driver's disk, keys in order where asked for."""
    first = row.limit(1).collect()
    with open(path, "w", encoding="utf-8") as out:
        json.dump(first[0].asDict(True) if first else {}, out, indent=2, ensure_ascii=False, sort_keys=sort_keys, default=str)


def fail_closed(rows: DataFrame, status: str = "status", version: str | None = None) -> DataFrame:
    """rows, if there are any and all are accepted (and of the judge version, where one is given); else an error."""
    wrong = F.col(status) != "accept"
    if version is not None:
        wrong = wrong | (F.coalesce("judge_version", F.lit("")) != version)
    counted = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.coalesce(wrong, F.lit(True)).cast("long")), F.lit(0)).alias("bad")).first()
    if not counted.n:
        raise ValueError("there are no final rows to export")
    if counted.bad:
        raise ValueError(f"{counted.bad} final rows are not accepted")
    return rows
