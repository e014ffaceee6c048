"""Assignment cards: what a work unit may cite, what is known on it, and which units are admitted, selected and hydrated."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.chunks import ref_doc, ref_index
from ..runtime import Cuts
from . import assign, hydrate, select

MAX_RELATED_ROWS, MAX_EARLIER_QUESTIONS = 200, 5
SEED_CHARS = 72  # a seed key as a line of a card: 64 digits, quotes, indent, comma and line feed


def needed(row_count: int, *, eval_ratio: float = 0.0, max_assignments: int = 0, target_rows: int = 200, questions_per_assignment: int = 2) -> int:
    """How many units are wanted: a share of the rows, else a given number, else as many as give the target at so many questions each."""
    if eval_ratio > 0:
        return max(1, math.ceil(row_count * eval_ratio))
    return max_assignments if max_assignments > 0 else math.ceil(target_rows / max(1, questions_per_assignment))


def card_seeds(units: DataFrame, rows: DataFrame, seeds: DataFrame) -> DataFrame:
    """(assignment_id, train_key) once each: rows that cite a chunk of the unit, and the seeds (cluster_id, train_key) of its cluster. A table, as a unit may have very many."""
    by_chunk = rows.select("train_key", F.explode("evidence_signature").alias("chunk_id")).distinct()
    touching = units.select("assignment_id", F.explode("chunk_ids").alias("chunk_id")).join(by_chunk, "chunk_id").select("assignment_id", "train_key")
    seeded = units.select("assignment_id", F.col("parent_cluster_id").alias("cluster_id")).join(seeds, "cluster_id").select("assignment_id", "train_key")
    return touching.unionByName(seeded).distinct()


def _refs(chunks: Column) -> Column:
    return F.transform(chunks, lambda c: F.struct(c.alias("chunk_id"), ref_doc(c).alias("doc_id"), ref_index(c).alias("chunk_index"), F.array().cast("array<int>").alias("pages"), F.array().cast("array<string>").alias("labels"), F.lit(0).alias("text_char_count")))


def cards(units: DataFrame, rows: DataFrame, seeds: DataFrame, memory: DataFrame, *, questions: int | None = 2, earlier: int = MAX_EARLIER_QUESTIONS, related: int = MAX_RELATED_ROWS, instructions: int = 0, root: str = "") -> DataFrame:
    """One card for each unit, with prompt_chars.

    Beside the unit's own columns: allowed_chunk_ids, allowed_doc_ids, allowed_chunk_refs, rules, paths under root, the counts of its
    related rows (complete, shown, omitted, capped), and the earlier questions to avoid, newest first. questions None leaves
    their number open. prompt_chars is the length of the card as JSON, its seeds counted as SEED_CHARS each, plus the
    instructions' own characters. memory: row_id, created_at, doc_key, question, answer, chunk_ids, assignment_id, status.
    """
    seed_counts = card_seeds(units, rows, seeds).groupBy("assignment_id").agg(F.count("*").alias("related_count"))
    told = memory.select("row_id", F.col("question").alias("q"), F.substring(F.trim("answer"), 1, 500).alias("answer_short"), F.col("chunk_ids").alias("used_chunk_ids"), F.col("assignment_id").alias("of"))
    avoid = assign.earlier_questions(units, memory, earlier).join(told, "row_id")
    item = F.struct("rank", F.trim("q").alias("question"), "answer_short", "used_chunk_ids", F.col("of").alias("assignment_id"))
    listed = avoid.groupBy("assignment_id").agg(F.array_sort(F.collect_list(item)).alias("earlier_questions"))
    path = lambda kind, end: F.concat(F.lit(f"{root}/{kind}/"), "assignment_id", F.lit(end))
    count = F.coalesce("related_count", F.lit(0))
    shown = F.least(count, F.lit(related))
    made = units.join(seed_counts, "assignment_id", "left").join(listed, "assignment_id", "left").withColumns(
        {
            "allowed_chunk_ids": F.col("chunk_ids"),
            "allowed_doc_ids": F.array_sort(F.array_distinct(F.transform("chunk_ids", ref_doc))),
            "allowed_chunk_refs": _refs(F.col("chunk_ids")),
            "microcluster_id": F.col("unit_cluster_id"),
            "cluster_id": F.col("parent_cluster_id"),
            "target_question_count": F.lit(questions).cast("int"),
            "question_count_policy": F.lit("natural" if questions is None else "bounded"),
            "related_count": count,
            "related_rows": F.struct(count.alias("complete"), shown.alias("shown"), F.lit(related).alias("visible_limit"), (count > shown).alias("capped"), (count - shown).alias("omitted")),
            "earlier_questions": F.coalesce("earlier_questions", F.array().cast("array<struct<rank:int,question:string,answer_short:string,used_chunk_ids:array<string>,assignment_id:string>>")),
            "rules": F.struct(F.lit(True).alias("exact_chunks_only"), F.lit(False).alias("neighbor_chunks_allowed"), F.lit(False).alias("external_knowledge_allowed")),
            "paths": F.struct(path("assignments", ".json").alias("assignment"), path("prompts", ".md").alias("prompt"), path("outputs", ".jsonl").alias("output"), path("summaries", ".md").alias("summary"), path("evidence", "_chunks.jsonl").alias("evidence"), path("training_rows", "_training_rows.jsonl").alias("related_rows")),
        }
    )
    card = F.to_json(F.struct(*[c for c in made.columns if c not in ("chunk_ids", "related_count", "unit_cluster_id", "ordinal")]))
    return made.withColumn("prompt_chars", (F.length(card) + F.lit(SEED_CHARS) * F.col("related_count") + F.lit(instructions)).cast("int"))


def hydrated_cards(found: DataFrame, hydrated: DataFrame, *, max_chars: int = assign.MAX_PROMPT_CHARS, label: str = "store") -> DataFrame:
    """Cards with their references filled in from hydrated chunks (chunk_id, hydration_status, text), `hydration_status`,
    missing_chunk_ids and `hydration_reasons`: <status>_after_assignment_hydration, prompt_too_large_after_assignment_hydration."""
    known = hydrated.where("hydration_status = 'ok'").select("chunk_id", F.length("text").alias("chars"))
    one = found.select("assignment_id", F.posexplode("allowed_chunk_ids").alias("at", "chunk_id")).join(known, "chunk_id", "left")
    ref = F.struct("at", "chunk_id", ref_doc(F.col("chunk_id")).alias("doc_id"), ref_index(F.col("chunk_id")).alias("chunk_index"), F.coalesce("chars", F.lit(0)).alias("text_char_count"))
    filled = one.groupBy("assignment_id").agg(F.array_sort(F.collect_list(ref)).alias("r"), F.array_sort(F.collect_list(F.when(F.col("chars").isNull(), F.col("chunk_id")))).alias("missing_chunk_ids"))
    status = hydrate.unit_status(found.select("assignment_id", F.col("allowed_chunk_ids").alias("chunk_ids")), hydrated, label).select("assignment_id", F.col("status").alias("hydration_status"))
    out = found.join(filled, "assignment_id", "left").join(status, "assignment_id", "left")
    longer = F.length(F.to_json("r")) - F.length(F.to_json("allowed_chunk_refs"))
    out = out.withColumn("prompt_chars", (F.col("prompt_chars") + F.coalesce(longer, F.lit(0))).cast("int")).withColumn("allowed_chunk_refs", F.col("r")).drop("r")
    reasons = F.array_compact(F.array(F.when(F.col("hydration_status") != "ok", F.concat("hydration_status", F.lit("_after_assignment_hydration"))), F.when(F.col("prompt_chars") > max_chars, F.lit("prompt_too_large_after_assignment_hydration"))))
    return out.withColumn("hydration_reasons", reasons)


def fatal_count(hydration: DataFrame) -> int:
    """How many units have a status other than ok; a run with any has failed."""
    return hydration.where("hydration_status <> 'ok'").count()


@dataclass(frozen=True)
class Assignments:
    selected: DataFrame
    rejected: DataFrame  # assignment_id, cluster_id, cluster_kind, prompt_chars, chunk_count, reasons: not admitted, not hydrated or not selected
    summary: dict


def build_assignments(found: DataFrame, rows: DataFrame, hydrated: DataFrame | None, *, eval_ratio: float = 0.0, max_per_doc: int = select.MAX_PER_DOC, max_chars: int = assign.MAX_PROMPT_CHARS, min_chunks: int = assign.MIN_CHUNKS, max_chunks: int = assign.MAX_CHUNKS, **sizing: int) -> Assignments:
    """Cards admitted, selected (greedy coverage where a share of the rows is wanted, else balanced), and hydrated where chunks are given."""
    cuts = Cuts(found.sparkSession, "assignments")
    marked = cuts.cut(assign.admission(found, max_chunks=max_chunks, min_chunks=min_chunks, max_chars=max_chars))
    admitted = marked.where(F.size("reasons") == 0)
    total = rows.count()
    limit = needed(total, eval_ratio=eval_ratio, **sizing)
    if eval_ratio > 0:
        ids = select.select_coverage(assign.score(admitted), limit=limit, max_per_doc=max_per_doc)
    else:
        ids = select.select_balanced(admitted, limit=limit, max_per_doc=max_per_doc)
    chosen = found.sparkSession.createDataFrame([(a,) for a in ids], "assignment_id string")  # as many as are wanted
    before = cuts.cut(admitted.join(chosen, "assignment_id", "left_semi"))
    after = cuts.cut(hydrated_cards(before, hydrated, max_chars=max_chars)) if hydrated is not None else before
    shape = lambda df, reasons: df.select("assignment_id", "cluster_id", "cluster_kind", "prompt_chars", F.size("allowed_chunk_ids").alias("chunk_count"), reasons.alias("reasons"))
    rejected = shape(marked.where(F.size("reasons") > 0), F.col("reasons")).unionByName(shape(admitted.join(chosen, "assignment_id", "left_anti"), F.array(F.lit("not_selected"))))
    selected = after
    if hydrated is not None:
        rejected = rejected.unionByName(shape(after.where(F.size("hydration_reasons") > 0), F.col("hydration_reasons")))
        selected = after.where(F.size("hydration_reasons") == 0)
    kinds = {r[0]: r[1] for r in selected.groupBy("cluster_kind").count().collect()}
    sizes = selected.agg(F.coalesce(F.min("prompt_chars"), F.lit(0)), F.coalesce(F.max("prompt_chars"), F.lit(0))).first()
    summary = {"needed_assignments": limit, "candidate_count": admitted.count(), "selected_before_hydration": len(ids), "selected_count": sum(kinds.values()), "selected_kind_counts": kinds, "prompt_chars": {"min": sizes[0], "max": sizes[1]}}
    return Assignments(selected, rejected, summary)


def write_manifest(selected: DataFrame, path: str) -> None:
    """One folder for each assignment with its card as a JSON line."""
    selected.write.mode("overwrite").partitionBy("assignment_id").option("ignoreNullFields", False).json(path)
