"""Snapshot delta: which row keys a persisted key ledger has not seen."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def current_keys(rows: DataFrame) -> DataFrame:
    """(train_key, doc_key): one row a key, the last row (largest record_number) giving the document key."""
    return rows.groupBy("train_key").agg(F.max_by("doc_key", "record_number").alias("doc_key"))


def new_keys(rows: DataFrame, ledger: DataFrame, snapshot: str) -> DataFrame:
    """(train_key, doc_key, first_seen_snapshot): the keys of rows that the ledger lacks; appending them twice adds nothing."""
    fresh = current_keys(rows).join(ledger.select("train_key").distinct(), "train_key", "left_anti")
    return fresh.select("train_key", "doc_key", F.lit(snapshot).alias("first_seen_snapshot"))


def delta_summary(rows: DataFrame, ledger: DataFrame, snapshot: str) -> DataFrame:
    """One row: rows, unique keys, keys known before, new keys, and document keys that no ledger row has."""
    fresh = new_keys(rows, ledger, snapshot)
    counted = rows.agg(F.count("*").alias("row_count"), F.count_distinct("train_key").alias("unique_train_keys"))
    known = ledger.agg(F.count_distinct("train_key").alias("known_train_keys"))
    news = fresh.agg(F.count("*").alias("new_train_keys"))
    docs = fresh.select("doc_key").distinct().join(ledger.select("doc_key").distinct(), "doc_key", "left_anti").agg(F.count("*").alias("new_doc_keys"))
    one = F.lit(1).alias("_k")
    out = counted.select("*", one)
    for part in (known, news, docs):
        out = out.join(F.broadcast(part.select("*", one)), "_k")
    return out.drop("_k")
