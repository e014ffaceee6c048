"""Source profile: counts, distinct counts, frequency tables, signature rankings and numeric summaries of the training rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.chunks import ref_doc
from ..functions.text import normalized_question


def row_counts(rows: DataFrame) -> DataFrame:
    """One row: all, non-duplicate and duplicate rows, and rows without documents or chunks. No rows give zeros."""
    some = lambda cond: F.coalesce(F.sum(cond.cast("long")), F.lit(0))
    return rows.agg(
        F.count("*").alias("total"),
        some(~F.col("is_dup")).alias("non_duplicate"),
        some(F.col("is_dup")).alias("exact_duplicate"),
        some(F.size("doc_ids") == 0).alias("rows_missing_doc_ids"),
        some(F.size("chunk_ids") == 0).alias("rows_missing_chunk_ids"),
    )


def _distinct_values(rows: DataFrame) -> DataFrame:
    """(what, value) once each: the value sets that are counted. One shuffle serves all six counts."""
    pair = lambda what, values: F.transform(values, lambda x: F.struct(F.lit(what).alias("what"), x.alias("value")))
    one = lambda what, value, cond: F.when(cond, F.array(F.struct(F.lit(what).alias("what"), value.alias("value")))).otherwise(F.array().cast("array<struct<what:string,value:string>>"))
    joined = lambda c: F.to_json(c)
    every = F.concat(
        pair("docs_from_docids", F.col("doc_ids")),
        pair("docs_from_chunk_ids", F.transform("chunk_ids", ref_doc)),
        pair("chunks", F.col("chunk_ids")),
        one("evidence_signatures", joined(F.col("evidence_signature")), F.size("evidence_signature") > 0),
        one("doc_set_signatures", joined(F.col("doc_set_signature")), F.size("doc_set_signature") > 0),
        one("normalized_questions", normalized_question(F.col("question")), F.col("question") != ""),
    )
    return rows.select(F.explode(every).alias("p")).select("p.*").distinct()


COUNTED = ("docs_from_docids", "docs_from_chunk_ids", "chunks", "evidence_signatures", "doc_set_signatures", "normalized_questions")


def unique_counts(rows: DataFrame) -> DataFrame:
    """One row of six distinct counts. Empty signatures and questions are not counted."""
    return _distinct_values(rows).agg(*[F.coalesce(F.sum((F.col("what") == w).cast("long")), F.lit(0)).alias(w) for w in COUNTED])


def numeric_summary(values: DataFrame, column: str) -> DataFrame:
    """One row: min, quartiles (linear interpolation), mean and max to two places; all 0 for no values."""
    quarter = lambda p: F.round(F.expr(f"percentile(`{column}`, {p})"), 2)
    zero = F.lit(0)
    return values.agg(
        F.coalesce(F.min(column), zero).cast("double").alias("min"),
        F.coalesce(quarter(0.25), zero).alias("p25"),
        F.coalesce(quarter(0.5), zero).alias("median"),
        F.coalesce(F.round(F.avg(column), 2), zero).alias("mean"),
        F.coalesce(quarter(0.75), zero).alias("p75"),
        F.coalesce(F.max(column), zero).cast("double").alias("max"),
    )


def extent(values: DataFrame, column: str) -> DataFrame:
    """One row: min and max; 0 for no values."""
    return values.agg(F.coalesce(F.min(column), F.lit(0)).alias("min"), F.coalesce(F.max(column), F.lit(0)).alias("max"))


def citation_summaries(rows: DataFrame) -> DataFrame:
    """numeric_summary of chunk references a row, documents a row, and uses of each normalised question."""
    reuse = question_uses(rows).select(F.col("uses").alias("v"))
    parts = {"chunk_ids_per_row": rows.select(F.size("chunk_ids").alias("v")), "doc_ids_per_row": rows.select(F.size("doc_ids").alias("v")), "question_reuse": reuse}
    out = None
    for name, values in parts.items():
        # Few distinct values: percentiles of the counts never hold the rows.
        counted = values.groupBy("v").agg(F.count("*").alias("n"))
        one = counted.agg(
            F.coalesce(F.min("v"), F.lit(0)).cast("double").alias("min"),
            *[F.coalesce(F.round(F.expr(f"percentile(v, {p}, n)"), 2), F.lit(0.0)).alias(a) for a, p in (("p25", 0.25), ("median", 0.5), ("p75", 0.75))],
            F.coalesce(F.round(F.sum(F.col("v") * F.col("n")) / F.sum("n"), 2), F.lit(0.0)).alias("mean"),
            F.coalesce(F.max("v"), F.lit(0)).cast("double").alias("max"),
        ).select(F.lit(name).alias("measure"), "min", "p25", "median", "mean", "p75", "max")
        out = one if out is None else out.unionByName(one)
    return out


def question_uses(rows: DataFrame) -> DataFrame:
    """(question, uses) of each normalised question that is not empty."""
    return rows.where("question <> ''").groupBy(normalized_question(F.col("question")).alias("question")).agg(F.count("*").alias("uses"))


def question_reuse(rows: DataFrame) -> DataFrame:
    """(uses, questions): how many questions are used how often."""
    return question_uses(rows).groupBy("uses").agg(F.count("*").alias("questions"))


def most_common(values: DataFrame, limit: int = 20) -> DataFrame:
    """(value, count) of the most frequent values of (value, record_number): ties by first record, then by value."""
    counted = values.groupBy("value").agg(F.count("*").alias("count"), F.min("record_number").alias("_first"))
    return counted.orderBy(F.desc("count"), "_first", "value").limit(limit).drop("_first")


def _blank(c: str) -> Column:
    return F.when(F.col(c) == "", F.lit("<blank>")).otherwise(F.col(c)).alias("value")


def top_chunks(rows: DataFrame, limit: int = 20) -> DataFrame:
    return most_common(rows.select("record_number", F.explode("evidence_signature").alias("value")), limit)


def top_docs(rows: DataFrame, limit: int = 20) -> DataFrame:
    return most_common(rows.select("record_number", F.explode("doc_set_signature").alias("value")), limit)


def pipelines(rows: DataFrame, duplicates_only: bool = False, limit: int = 20) -> DataFrame:
    return most_common((rows.where("is_dup") if duplicates_only else rows).select("record_number", _blank("pipeline")), limit)


def duplicate_targets(rows: DataFrame, limit: int = 20) -> DataFrame:
    return most_common(rows.select("record_number", _blank("duplicate_of")), limit)


def top_signatures(rows: DataFrame, signature: str, limit: int = 20, sample: int = 20) -> DataFrame:
    """(signature, row_count, first_records): most rows first, then the shorter signature, then its order.

    The sample of record numbers is taken for the ranked signatures only, by rank inside each, never by gathering a signature's rows.
    """
    ranked = rows.where(F.size(signature) > 0).groupBy(signature).agg(F.count("*").alias("row_count")).orderBy(F.desc("row_count"), F.size(signature), signature).limit(limit)
    held = rows.select(signature, "record_number").join(F.broadcast(ranked), signature)
    order = F.row_number().over(Window.partitionBy(signature).orderBy("record_number"))
    few = held.withColumn("_rn", order).where(F.col("_rn") <= sample)
    grouped = few.groupBy(signature).agg(F.max("row_count").alias("row_count"), F.array_sort(F.collect_list("record_number")).alias("r"))
    return grouped.select(F.array_join(signature, "|").alias("signature"), "row_count", F.array_join(F.transform("r", lambda x: x.cast("string")), ",").alias("first_records"))


def undocumented_chunks(rows: DataFrame) -> DataFrame:
    """(record_number, missing_doc_ids): rows that cite chunks of documents they do not list."""
    missing = F.array_sort(F.array_except(F.array_distinct(F.transform("chunk_ids", ref_doc)), "doc_ids"))
    return rows.select("record_number", missing.alias("m")).where(F.size("m") > 0).select("record_number", F.array_join("m", "|").alias("missing_doc_ids"))


def one_sided_docs(rows: DataFrame) -> DataFrame:
    """(doc_id, seen_in): documents seen only in doc_ids or only in chunk references."""
    both = F.concat(F.transform("doc_ids", lambda x: F.struct(x.alias("doc_id"), F.lit(1).alias("side"))), F.transform("chunk_ids", lambda x: F.struct(ref_doc(x).alias("doc_id"), F.lit(2).alias("side"))))
    sides = rows.select(F.explode(both).alias("p")).select("p.*").groupBy("doc_id").agg(F.min("side").alias("lo"), F.max("side").alias("hi"))
    return sides.where("lo = hi").select("doc_id", F.when(F.col("lo") == 1, "doc_ids").otherwise("chunk_ids").alias("seen_in"))
