"""Figures for each document that rows cite, hot documents included."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.chunks import canonical_docs, canonical_refs
from ..functions.text import normalized_question
from .keyfigures import distinct_by_key, quantiles_by_key


def _cited(rows: DataFrame, key: str) -> DataFrame:
    return rows.select(F.col(key).alias("record"), F.col("question"), F.col("answer"), canonical_refs(F.col("chunk_ids")).alias("refs"), F.explode(canonical_docs(F.col("doc_ids"))).alias("key"))


def doc_counts(rows: DataFrame, fractions: tuple[float, ...] = (0.5,)) -> DataFrame:
    """(doc_id, rows, answer_chars_p<percent>...): a row counts once for each distinct trimmed doc_id it holds; a null answer is one of 0 characters."""
    lengths = rows.select(F.explode(canonical_docs(F.col("doc_ids"))).alias("key"), F.length(F.coalesce("answer", F.lit(""))).cast("long").alias("value"))
    found = quantiles_by_key(lengths, fractions)
    picks = [F.max(F.when(F.col("fraction") == f, F.col("value"))).alias(f"answer_chars_p{round(100 * f)}") for f in fractions]
    return found.groupBy(F.col("key").alias("doc_id")).agg(F.max("n").alias("rows"), *picks)


def doc_figures(rows: DataFrame, key: str = "record_number") -> DataFrame:
    """(doc_id, rows, distinct_questions, distinct_chunks, answer_chars_p50): chunks are those of the citing rows, any document's.

    Null, blank and repeated doc_ids of a row are left out; questions are compared with blanks collapsed and case folded; rows
    without chunk reference add none. Other columns are ignored.
    """
    cited = _cited(rows, key)
    questions = distinct_by_key(cited.select("key", normalized_question(F.col("question")).alias("questions")), "questions")
    chunks = distinct_by_key(cited.select("key", F.explode("refs").alias("chunks")), "chunks")
    out = doc_counts(rows).join(questions, F.col("doc_id") == questions.key, "left").drop("key").join(chunks, F.col("doc_id") == chunks.key, "left").drop("key")
    return out.select("doc_id", "rows", F.coalesce("distinct_questions", F.lit(0)).alias("distinct_questions"), F.coalesce("distinct_chunks", F.lit(0)).alias("distinct_chunks"), "answer_chars_p50")


def hot_docs(rows: DataFrame, share: float = 0.02) -> DataFrame:
    """(doc_id): held by at least that share of all rows. No rows give none."""
    return doc_counts(rows).where(F.col("rows") >= F.lit(share * rows.count())).select("doc_id")
