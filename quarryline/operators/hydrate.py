"""Hydration: cited chunks joined with the chunk store, cleaned text, and a status for each work unit."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from ..functions.chunks import canonical_ref, ref_doc, ref_index
from ..functions.text import collapse

# Error kinds of a fetch and what they make of a unit, the first that applies.
BLOCKED, UNREACHABLE = "network_permission_denied", ("connection_refused", "timeout")


@pandas_udf(T.StringType())
def _unescape(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else html.unescape(t))


def clean_text(c: Column) -> Column:
    """Without a leading page mark, entities decoded, blanks collapsed; null reads as empty. Only texts with an ampersand go through Python."""
    bare = F.regexp_replace(F.coalesce(c, F.lit("")), r"^\[Page \d+(?:-\d+)?\]\s*", "")
    return collapse(F.when(F.contains(bare, F.lit("&")), _unescape(F.when(F.contains(bare, F.lit("&")), bare))).otherwise(bare))


def chunk_index_of(metadata: Column) -> Column:
    """chunk -> its metadata, from an array of structs with an optional chunk_index: that index, else the position; the last wins."""
    keyed = F.transform(metadata, lambda x, i: F.struct(F.coalesce(x["chunk_index"], i.cast("long")).alias("key"), x.alias("value")))
    return F.aggregate(keyed, F.create_map().cast("map<bigint,string>"), lambda m, x: F.map_concat(F.map_filter(m, lambda k, v: k != x["key"]), F.create_map(x["key"], F.to_json(x["value"]))))


def requested_docs(cited: DataFrame) -> DataFrame:
    """(doc_id, chunk_indexes): what to look up for each document, sorted, each index once."""
    return cited.select(ref_doc(F.col("chunk_id")).alias("doc_id"), ref_index(F.col("chunk_id")).alias("i")).distinct().groupBy("doc_id").agg(F.array_sort(F.collect_list("i")).alias("chunk_indexes"))


def latest_fetches(store: DataFrame) -> DataFrame:
    """One fetch for each chunk: the newest one with text, else the newest."""
    good = F.when(F.col("hydration_status") == "ok", 1).otherwise(0)
    kept = F.struct("hydration_status", "fetch_status", "fetch_error_kind", "text", "fetched_at")
    rank = F.struct(good.alias("good"), "fetched_at", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("fetch_error_kind", F.lit("")).alias("kind"))
    keyed = store.select(canonical_ref(F.col("chunk_id")).alias("chunk_id"), kept.alias("f"), rank.alias("r")).where("chunk_id is not null")
    return keyed.groupBy("chunk_id").agg(F.max_by("f", "r").alias("f")).select("chunk_id", "f.*")


def hydrate(chunks: DataFrame, store: DataFrame, documents: DataFrame) -> DataFrame:
    """(chunk_id, doc_id, hydration_status, fetch_status, fetch_error_kind, text, text_sha256) of each requested chunk.

    Without a fetch the status is missing_chunk where documents (doc_id) has the document, else no_hit. The store is read once
    for the requested chunks only; text that is not ok is null.
    """
    wanted = chunks.select("chunk_id").distinct()
    fetched = latest_fetches(store.join(wanted.select(F.col("chunk_id").alias("_w")), canonical_ref(F.col("chunk_id")) == F.col("_w"), "left_semi"))
    known = documents.select(F.col("doc_id").alias("_doc")).distinct()
    both = wanted.join(fetched, "chunk_id", "left").withColumn("doc_id", ref_doc(F.col("chunk_id"))).join(known, F.col("doc_id") == F.col("_doc"), "left")
    status = F.coalesce("hydration_status", F.when(F.col("_doc").isNotNull(), F.lit("missing_chunk")).otherwise(F.lit("no_hit")))
    fetch = F.coalesce("fetch_status", F.when(F.col("_doc").isNotNull(), F.lit("ok")).otherwise(F.lit("no_hit")))
    text = F.when(status == "ok", clean_text(F.col("text")))
    return both.select("chunk_id", "doc_id", status.alias("hydration_status"), fetch.alias("fetch_status"), F.col("fetch_error_kind"), text.alias("text")).withColumn("text_sha256", F.sha2("text", 256))


def unit_status(units: DataFrame, hydrated: DataFrame, label: str = "store") -> DataFrame:
    """(assignment_id, status, chunks, missing): ok where no chunk is missing, else the gravest cause. Causes of the chunk store begin with its label."""
    one = units.select("assignment_id", F.explode("chunk_ids").alias("chunk_id")).join(hydrated, "chunk_id", "left")
    some = lambda cond: F.coalesce(F.max(F.when(cond, 1)), F.lit(0))
    flags = one.groupBy("assignment_id").agg(
        F.count("*").alias("chunks"),
        F.coalesce(F.sum((F.coalesce("hydration_status", F.lit("")) != "ok").cast("long")), F.lit(0)).alias("missing"),
        some((F.col("fetch_status") == "error") & (F.col("fetch_error_kind") == BLOCKED)).alias("blocked"),
        some((F.col("fetch_status") == "error") & F.col("fetch_error_kind").isin(*UNREACHABLE)).alias("unreachable"),
        some(F.col("fetch_status") == "error").alias("error"),
        some(F.col("fetch_status") == "wrong_doc").alias("wrong"),
        some(F.col("fetch_status") == "no_hit").alias("no_hit"),
        some(F.col("hydration_status") == "missing_chunk").alias("gap"),
    )
    status = F.when(F.col("missing") == 0, "ok").when(F.col("blocked") == 1, f"{label}_access_blocked").when(F.col("unreachable") == 1, f"{label}_unreachable").when(F.col("error") == 1, f"{label}_fetch_error")
    status = status.when(F.col("wrong") == 1, f"{label}_wrong_doc").when(F.col("no_hit") == 1, f"{label}_doc_missing").when(F.col("gap") == 1, "missing_chunks").otherwise("hydration_incomplete")
    return flags.select("assignment_id", status.alias("status"), "chunks", "missing")
