"""Filtering training rows by a model: ranges, mini-batches with one prompt each, verdicts, a second try row by row, two outputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import Cuts
from .replies import call_model, parse_verdicts


def row_range(rows: DataFrame, start: int, size: int, limit: int | None = None, position: str = "position") -> DataFrame:
    """The rows at positions from start on, at most `size` of them and none at or beyond limit."""
    end = start + size if limit is None else min(start + size, limit)
    return rows.where((F.col(position) >= max(0, start)) & (F.col(position) < end))


def mini_batches(rows: DataFrame, rows_per_call: int, start: int = 0, position: str = "position") -> DataFrame:
    """rows with `batch` and `local_id` (from 0) by position."""
    at = F.col(position) - F.lit(start)
    return rows.withColumns({"batch": F.floor(at / rows_per_call).cast("long"), "local_id": (at % rows_per_call).cast("int")})


def prompts(batched: DataFrame) -> DataFrame:
    """(batch, prompt): the rows of a batch with their local ids, questions and answers, in order. A batch has rows_per_call rows at most."""
    text = F.format_string("[ROW %d]\nQuestion:\n%s\n\nAnswer:\n%s\n", "local_id", F.coalesce("question", F.lit("")), F.coalesce("answer", F.lit("")))
    listed = batched.groupBy("batch").agg(F.array_sort(F.collect_list(F.struct("local_id", text.alias("t")))).alias("r"))
    parts = F.concat(F.transform("r", lambda x: x["t"]), F.array(F.lit("Return your decision as JSON:")))
    return listed.select("batch", F.array_join(parts, "\n---\n").alias("prompt"))


def filter_rows(rows: DataFrame, ask: Callable[[str], str], *, rows_per_call: int = 5, attempts: int = 3) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected with _reject_reason and _source_row_index) of rows (position, question, answer, others).

    Batches whose call fails are asked again row by row; a row that fails alone too is rejected as llm_error. Every row is in one
    of the outputs; the calls are made once, as their results are written.
    """
    cuts = Cuts(rows.sparkSession, "rowfilter")
    batched = cuts.cut(mini_batches(rows, rows_per_call))
    asked = cuts.cut(call_model(prompts(batched).withColumnRenamed("batch", "id"), ask, attempts))
    told = parse_verdicts(asked.where("error is null").select(F.col("id").alias("batch"), "reply"), batched.join(asked.where("error is null").select(F.col("id").alias("batch")), "batch", "left_semi"))
    failed = batched.join(asked.where("error is not null").select(F.col("id").alias("batch")), "batch", "left_semi")
    alone = failed.select(F.col("position").alias("batch"), F.lit(0).alias("local_id"), "question", "answer")
    again = cuts.cut(call_model(prompts(alone).withColumnRenamed("batch", "id"), ask, attempts))
    single = parse_verdicts(again.where("error is null").select(F.col("id").alias("batch"), "reply"), alone, single=True)
    one = single.join(again.select(F.col("id").alias("batch"), "error"), "batch", "left")
    one = one.select(F.col("batch").alias("position"), F.when(F.col("error").isNotNull(), "REJECT").otherwise(F.col("decision")).alias("decision"), F.when(F.col("error").isNotNull(), F.concat(F.lit("llm_error: "), "error")).otherwise(F.col("reason")).alias("reason"))
    many = told.join(batched.select("batch", "local_id", "position"), ["batch", "local_id"]).select("position", "decision", "reason")
    verdicts = cuts.cut(many.unionByName(one))
    both = rows.join(verdicts, "position")
    kept = both.where("decision = 'KEEP'").drop("decision", "reason")
    rejected = both.where("decision <> 'KEEP'").withColumn("_source_row_index", F.col("position")).withColumnRenamed("reason", "_reject_reason").drop("decision")
    return kept, rejected
