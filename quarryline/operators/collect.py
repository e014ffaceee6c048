"""Collection of generated rows: lines of output files become candidates of their assignment or come out with the reasons why not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.chunks import ref_doc
from ..functions.keys import doc_key, question_hash
from ..functions.variants import field_text, string_list
from ..sources.training import parse_json_lines

# The five fields of a generated row.
COLUMNS = ("question", "answer", "docIds", "chunk_ids", "pipeline")


def output_records(lines: DataFrame) -> DataFrame:
    """(assignment_id, ordinal, record, parse_error, raw_line) of output lines (assignment_id, line_no, value).

    Blank lines are skipped; every other line has its ordinal within its assignment, malformed ones too. An assignment's file is
    one answer of a model, so its lines are few.
    """
    place = Window.partitionBy("assignment_id").orderBy("line_no")
    return parse_json_lines(lines).withColumn("ordinal", F.row_number().over(place)).select("assignment_id", "ordinal", "record", "parse_error", "raw_line")


def _field(name: str) -> Column:
    return F.try_variant_get("record", f"$.{name}", "variant")


def extra_columns(record: Column) -> Column:
    """The names of an object's fields beyond COLUMNS, sorted."""
    names = F.map_keys(F.try_variant_get(record, "$", "map<string,variant>"))
    return F.array_sort(F.array_except(F.coalesce(names, F.array().cast("array<string>")), F.array(*[F.lit(c) for c in COLUMNS])))


def collect_outputs(records: DataFrame, cards: DataFrame) -> DataFrame:
    """Records with their assignment's card as candidates: candidate_id, texts, chunk_ids in first-seen order, doc_ids derived from
    them, hash and keys, `reasons` and `warnings`.

    cards: assignment_id, allowed_chunk_ids, cluster_id (of the parent), microcluster_id, cluster_kind. Records of other assignments
    are left out. Reasons, in this order: malformed_jsonl alone; empty_question, empty_answer, empty_chunk_ids,
    chunk_not_in_assignment, then empty_docIds or docIds_do_not_match_chunk_ids. The warning is extra_columns_ignored.
    """
    known = cards.select("assignment_id", "allowed_chunk_ids", "cluster_id", "microcluster_id", "cluster_kind")
    base = records.join(known, "assignment_id").withColumns(
        {
            "question": field_text(F.col("record"), "question"),
            "answer": field_text(F.col("record"), "answer"),
            "chunk_ids": F.array_distinct(string_list(_field("chunk_ids"))),
            "given": F.array_sort(F.array_distinct(string_list(_field("docIds")))),
        }
    )
    derived = F.array_sort(F.array_distinct(F.transform("chunk_ids", ref_doc)))
    base = base.withColumns({"doc_ids": derived, "unauthorized": F.array_sort(F.array_except("chunk_ids", "allowed_chunk_ids")), "extra": extra_columns(F.col("record"))})
    rules = F.array_compact(
        F.array(
            F.when(F.col("question") == "", F.lit("empty_question")),
            F.when(F.col("answer") == "", F.lit("empty_answer")),
            F.when(F.size("chunk_ids") == 0, F.lit("empty_chunk_ids")),
            F.when(F.size("unauthorized") > 0, F.lit("chunk_not_in_assignment")),
            F.when(F.size("given") == 0, F.lit("empty_docIds")).when(F.col("given") != F.col("doc_ids"), F.lit("docIds_do_not_match_chunk_ids")),
        )
    )
    bad = F.col("parse_error").isNotNull()
    none = F.array().cast("array<string>")
    return base.withColumns(
        {
            "candidate_id": F.format_string("%s_q%02d", "assignment_id", "ordinal"),
            "reasons": F.when(bad, F.array(F.lit("malformed_jsonl"))).otherwise(rules),
            "warnings": F.when(~bad & (F.size("extra") > 0), F.array(F.lit("extra_columns_ignored"))).otherwise(none),
            "eval_question_hash": question_hash(F.col("question")),
            "doc_key": doc_key(F.col("doc_ids")),
        }
    ).drop("record", "given", "extra")


def parted(marked: DataFrame, reasons: str = "reasons") -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): the rows without and with reasons. marked is read twice; cut it first."""
    return marked.where(F.size(reasons) == 0), marked.where(F.size(reasons) > 0)


def memory_records(candidates: DataFrame, cards: DataFrame, run_dir: str, created_at: int) -> DataFrame:
    """The run-memory record of each candidate (of collect_outputs): its own values, else those of its card (doc_key, allowed_doc_ids, seed_train_keys)."""
    card = cards.select("assignment_id", F.col("doc_key").alias("_card_key"), "allowed_doc_ids", *(["seed_train_keys"] if "seed_train_keys" in cards.columns else []))
    both = candidates.join(card, "assignment_id", "left")
    seeds = F.col("seed_train_keys") if "seed_train_keys" in card.columns else F.array().cast("array<string>")
    return both.select(
        F.lit(created_at).cast("long").alias("created_at"),
        F.lit(run_dir).alias("run_dir"),
        "assignment_id",
        "cluster_id",
        "microcluster_id",
        "cluster_kind",
        F.coalesce(F.nullif("_card_key", F.lit("")), "doc_key").alias("doc_key"),
        F.coalesce("allowed_doc_ids", F.array().cast("array<string>")).alias("allowed_doc_ids"),
        F.col("chunk_ids").alias("used_chunk_ids"),
        "question",
        F.coalesce(F.nullif("eval_question_hash", F.lit("")), question_hash(F.col("question"))).alias("eval_question_hash"),
        "answer",
        F.coalesce(seeds, F.array().cast("array<string>")).alias("seed_train_keys"),
        F.lit("generated").alias("status"),
    )


def last_cards(cards: DataFrame, order: str) -> DataFrame:
    """One card for each assignment, the last by `order`; cards without an id are left out."""
    named = cards.where(F.coalesce("assignment_id", F.lit("")) != "")
    return named.groupBy("assignment_id").agg(F.max_by(F.struct(*named.columns), order).alias("_card")).select("_card.*")


def require_cards(cards: DataFrame) -> DataFrame:
    """cards, if there are any and each has an id; else an error."""
    counted = cards.agg(F.count("*").alias("n"), F.coalesce(F.sum((F.coalesce("assignment_id", F.lit("")) == "").cast("long")), F.lit(0)).alias("unnamed")).first()
    if not counted.n or counted.unnamed:
        raise ValueError(f"{counted.unnamed} of {counted.n} cards have no id" if counted.n else "there are no cards")
    return cards


def missing_assignments(cards: DataFrame, wanted: list[str]) -> list[str]:
    """Those of a given list of assignment ids that no card has."""
    known = {r[0] for r in cards.where(F.col("assignment_id").isin(wanted)).select("assignment_id").distinct().collect()} if wanted else set()
    return sorted(set(wanted) - known)


def picked(cards: DataFrame, wanted: list[str], done: DataFrame | None = None, limit: int | None = None) -> DataFrame:
    """cards of the assignments wanted (all, where none are named), without those done (assignment_id), the first `limit` by id. An unknown id is an error."""
    if missing := missing_assignments(cards, wanted):
        raise ValueError(f"assignments not found: {', '.join(missing)}")
    out = cards.where(F.col("assignment_id").isin(wanted)) if wanted else cards
    if done is not None:
        out = out.join(done.select("assignment_id").distinct(), "assignment_id", "left_anti")
    return out.orderBy("assignment_id").limit(limit) if limit is not None else out


