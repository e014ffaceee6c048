"""What a run leaves behind: final rows, bank records, distributions, roll-ups and a report."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import doc_key, question_hash
from ..runtime import Cuts, exists
from ..sources.settings import read_summary
from ..sources.training import strip
from . import delta, export


def bank_records(final: DataFrame, run_id: str, version: str, pipeline: str = "Eval-Question-Gen") -> DataFrame:
    """The bank record of each final row (candidate_id, question, answer, doc_ids, chunk_ids, seed_train_keys, and where there
    are some eval_id, eval_question_hash, doc_key, judge_version): stored values first, else made from the row."""
    have = lambda c: F.nullif(F.col(c).cast("string"), F.lit("")) if c in final.columns else F.lit(None).cast("string")
    question = strip(F.col("question"))
    return final.select(
        F.coalesce(have("eval_id"), have("candidate_id"), question_hash(question)).alias("eval_id"),
        question.alias("question"),
        strip(F.col("answer")).alias("answer"),
        "doc_ids",
        "chunk_ids",
        F.lit(pipeline).alias("pipeline"),
        F.coalesce(have("eval_question_hash"), question_hash(question)).alias("eval_question_hash"),
        F.coalesce(have("doc_key"), doc_key(F.array_sort(F.array_distinct("doc_ids")))).alias("doc_key"),
        "seed_train_keys",
        F.lit(run_id).alias("run_id"),
        F.coalesce(have("judge_version"), F.lit(version)).alias("judge_version"),
    )


def distribution(final: DataFrame, limit: int = 10) -> DataFrame:
    """(measure, value, count): difficulty and question_type of the final rows (unknown where blank), and the `limit` most cited documents and chunks; ties by value."""
    named = lambda c: F.coalesce(F.nullif(strip(F.col(c)), F.lit("")), F.lit("unknown")) if c in final.columns else F.lit("unknown")
    out = None
    for measure, values, top in (
        ("difficulty", final.select(named("difficulty").alias("value")), None),
        ("question_type", final.select(named("question_type").alias("value")), None),
        ("doc", final.select(F.explode("doc_ids").alias("value")), limit),
        ("chunk", final.select(F.explode("chunk_ids").alias("value")), limit),
    ):
        counted = values.groupBy("value").agg(F.count("*").alias("count")).select(F.lit(measure).alias("measure"), "value", "count")
        counted = counted.orderBy(F.desc("count"), "value").limit(top) if top else counted
        out = counted if out is None else out.unionByName(counted)
    return out


def roll_up(parts: dict[str, DataFrame]) -> DataFrame:
    """(phase, assignment_id, rows, accepted, rejected, errors) over the tables of the phases (assignment_id, status, and reject_reason where there is one)."""
    out = None
    for phase, df in parts.items():
        error = F.coalesce(F.col("reject_reason") == "judge_error", F.lit(False)) if "reject_reason" in df.columns else F.lit(False)
        good = F.col("status").isin("ok", "accept", "accepted")
        one = df.groupBy("assignment_id").agg(F.count("*").alias("rows"), F.sum(good.cast("long")).alias("accepted"), F.sum((~good).cast("long")).alias("rejected"), F.sum(error.cast("long")).alias("errors")).select(F.lit(phase).alias("phase"), "*")
        out = one if out is None else out.unionByName(one)
    return out


def merge_judged(previous: DataFrame, attempt: DataFrame, key: str = "candidate_id") -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(judged in order of their id, accepted, rejected, errors): the rows of the attempt replace those of the same id; rows without one are left out."""
    named = F.coalesce(F.col(key), F.lit("")) != ""
    judged = export.upsert(previous.where(named), attempt.where(named), key).orderBy(key)
    rejected = judged.where("status <> 'accept'")
    return judged, judged.where("status = 'accept'"), rejected, rejected.where("reject_reason = 'judge_error'")


def subset_counts(bank: DataFrame, training: DataFrame) -> DataFrame:
    """One row: bank rows without a seed among the training keys, and of the others those that cite a chunk outside (bank as for export.bank_subset)."""
    keys = training.select("train_key").distinct()
    seeded = bank.select("eval_id", F.explode("seed_train_keys").alias("train_key")).join(keys, "train_key", "left_semi").select("eval_id").distinct()
    cited = training.select(F.explode("evidence_signature").alias("chunk_id")).distinct()
    kept = bank.join(seeded, "eval_id", "left_semi")
    outside = kept.select("eval_id", F.explode("chunk_ids").alias("chunk_id")).join(cited, "chunk_id", "left_anti").select("eval_id").distinct()
    one = F.lit(1).alias("_k")
    a = bank.join(seeded, "eval_id", "left_anti").agg(F.count("*").alias("no_seed_overlap")).select("*", one)
    return a.join(outside.agg(F.count("*").alias("chunk_outside_subset")).select("*", one), "_k").drop("_k")


def update_state(rows: DataFrame, path: str, snapshot: str) -> tuple[DataFrame, int]:
    """(new keys in order of train_key, how many were appended): the delta against the key ledger under path, which then holds them."""
    spark = rows.sparkSession
    schema = "train_key string, doc_key string, first_seen_snapshot string"
    ledger = spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)
    fresh = Cuts(spark, "state").cut(delta.new_keys(rows, ledger, snapshot).orderBy("train_key"))
    n = fresh.count()
    if n:
        fresh.write.mode("append").parquet(path)
    return fresh.orderBy("train_key"), n


def report(title: str, final: DataFrame, rejected: DataFrame, summaries: list[dict], samples: int = 5) -> str:
    """The run's report as Markdown: counts, distributions, what each phase's summary says, and a few rows of either kind."""
    flat = lambda t: " ".join((t or "").split())
    lines = [f"# {title}", "", f"- final_count: {final.count()}", f"- export_rejected_count: {rejected.count()}", "", "## Final distribution"]
    found: dict[str, list] = {}
    for r in distribution(final).orderBy("measure", F.desc("count"), "value").collect():
        found.setdefault(r.measure, []).append((r.value, r["count"]))
    lines += [f"- {m}: {json.dumps(v, ensure_ascii=False)}" for m, v in found.items()]
    lines += ["", "## Phases"]
    for summary in filter(None, summaries):
        lines += ["", f"### {summary.get('phase', 'unknown')}"]
        lines += [f"- {k}: {json.dumps(v, ensure_ascii=False) if isinstance(v, dict) else v}" for k, v in summary.items() if k != "phase" and ("count" in k or k == "target")]
    shown = final.limit(samples).select("question", "answer").collect()
    if shown:
        lines += ["", "## Accepted rows"]
        for r in shown:
            answer = flat(r.answer)
            lines += [f"- Q: {flat(r.question)}", f"  A: {answer if len(answer) <= 240 else answer[:237].rstrip() + '...'}"]
    bad = rejected.limit(samples).select("export_status").collect()
    if bad:
        lines += ["", "## Rejected at export", *[f"- {r.export_status}" for r in bad]]
    return "\n".join([*lines, ""])


def export_final(judged: DataFrame, bank_path: str, folder: str, *, run_id: str, version: str, order: list[str]) -> dict:
    """Writes what a judged run (status, judge_version, candidate rows) gives: final rows as CSV and JSON lines, rejected ones, and new bank records.

    Fails closed: without rows, or with any that is not accepted or of another judge version, and where folder/judge_summary.json
    is missing or of another version, nothing is written.
    """
    spark, cuts = judged.sparkSession, Cuts(judged.sparkSession, "export")
    summary = read_summary(f"{folder}/judge_summary.json")
    if summary.get("judge_version") != version:
        raise ValueError(f"there is no judge summary of version {version} under {folder}")
    marked = cuts.cut(export.export_status(export.fail_closed(judged, version=version), order))
    final, rejected = marked.where("export_status = 'accepted'"), marked.where("export_status <> 'accepted'")
    export.write_csv(export.csv_rows(final, "Eval-Question-Gen"), f"{folder}/final_csv")
    export.write_jsonl(final, f"{folder}/final_jsonl")
    export.write_jsonl(rejected, f"{folder}/rejected_jsonl")
    records = bank_records(final, run_id, version)
    known = spark.read.parquet(bank_path) if exists(spark, bank_path) else records.limit(0)
    fresh = cuts.cut(export.append_new(known, records, ["eval_question_hash"], ["eval_id"]))
    n = fresh.count()
    if n:
        fresh.write.mode("append").parquet(bank_path)
    reasons = {r[0]: r[1] for r in rejected.groupBy("export_status").count().collect()}
    return {"phase": "export", "input_candidate_count": marked.count(), "final_count": final.count(), "export_rejected_count": sum(reasons.values()), "bank_written_count": n, "reject_reason_counts": reasons}
