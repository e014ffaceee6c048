"""Queries over work units, hydration, rule checks, replies and exports: name -> f(spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.chunks import canonical_ref, ref_doc, ref_index
from ..operators import assign, cards, collect, export, hydrate, replies, reports, rowfilter, select, validate
from ..runtime import load
from ..sources.training import _listed, parse_json_lines
from . import stored
from .oracles_units import DISTINCT_LIMIT, MEMORY_LIMIT, RELATED_LIMIT, REPLY

def _training(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored.rows(spark, sf_dir)


def _units(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(work units, seeds of clusters)."""
    return stored.units(spark, sf_dir), stored.clusters(spark, sf_dir)[1]


def _bars(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.array_join(c, "|") for c in columns})


def assignment_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = _bars(_units(spark, sf_dir)[0], "chunk_ids", "doc_ids")
    return units.select("assignment_id", F.col("unit_cluster_id").alias("cluster_id"), "parent_cluster_id", "cluster_kind", "part", "chunk_ids", "doc_ids", F.coalesce("split_from", F.lit("")).alias("split_from"))


def assignment_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bars(assign.admission(assign.prompt_chars(_units(spark, sf_dir)[0])), "reasons").select("assignment_id", "prompt_chars", "reasons")


def cluster_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign.score(_units(spark, sf_dir)[0]).select("assignment_id", F.round("score", 3).alias("score"))


def related_row_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    units, seeds = _units(spark, sf_dir)
    return assign.related_rows(units, _training(spark, sf_dir), seeds, RELATED_LIMIT)


def run_memory_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign.earlier_questions(_units(spark, sf_dir)[0], load(spark, sf_dir, "generated_eval_rows"), MEMORY_LIMIT)


def _admitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign.score(assign.admission(assign.prompt_chars(_units(spark, sf_dir)[0])).where(F.size("reasons") == 0))


def _chosen(spark: SparkSession, ids: list[str]) -> DataFrame:
    return spark.createDataFrame([(i, a) for i, a in enumerate(ids, 1)], "position int, assignment_id string")


def _limit(spark: SparkSession, sf_dir: str) -> int:
    return cards.needed(_training(spark, sf_dir).count())


def selected_balanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chosen(spark, select.select_balanced(_admitted(spark, sf_dir), limit=_limit(spark, sf_dir)))


def selected_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chosen(spark, select.select_coverage(_admitted(spark, sf_dir), limit=_limit(spark, sf_dir)))


def coverage_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = _admitted(spark, sf_dir)
    return select.coverage(units, _chosen(spark, select.select_coverage(units, limit=_limit(spark, sf_dir))), _training(spark, sf_dir))


def _hydrated(spark: SparkSession, sf_dir: str) -> DataFrame:
    cited = _training(spark, sf_dir).select(F.explode("evidence_signature").alias("chunk_id"))
    return hydrate.hydrate(cited, load(spark, sf_dir, "evidence_chunks"), load(spark, sf_dir, "source_docs"))


def hydrated_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hydrated(spark, sf_dir).select("chunk_id", "doc_id", "hydration_status", "fetch_status", "fetch_error_kind", "text_sha256", F.length("text").alias("chars"))


def hydration_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hydrate.unit_status(_units(spark, sf_dir)[0], _hydrated(spark, sf_dir))


def assignment_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    units, seeds = _units(spark, sf_dir)
    made = cards.cards(units, _training(spark, sf_dir), seeds, load(spark, sf_dir, "generated_eval_rows"), earlier=MEMORY_LIMIT, related=RELATED_LIMIT)
    return made.select("assignment_id", "cluster_id", "microcluster_id", F.array_join("allowed_doc_ids", "|").alias("allowed_doc_ids"), F.size("allowed_chunk_refs").alias("chunk_count"), "related_count", F.col("related_rows.omitted").alias("omitted"), F.size("earlier_questions").alias("earlier_questions"))


def hydrated_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units with the status, text and missing chunks of their hydration."""
    units = stored.units(spark, sf_dir).select("assignment_id", F.col("chunk_ids").alias("allowed_chunk_ids"), F.lit(0).alias("prompt_chars"), F.array().cast("array<string>").alias("allowed_chunk_refs"))
    found = cards.hydrated_cards(units, _hydrated(spark, sf_dir))
    chars = F.aggregate("allowed_chunk_refs", F.lit(0), lambda acc, x: acc + x["text_char_count"])
    return found.select("assignment_id", F.array_join("hydration_reasons", "|").alias("reasons"), F.array_join("missing_chunk_ids", "|").alias("missing"), chars.alias("chars"))


def _links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates with the first unit that holds their first chunk, and its cluster."""
    place = stored.units(spark, sf_dir).select("assignment_id", F.col("parent_cluster_id").alias("cluster_id"), F.explode("chunk_ids").alias("first_chunk"))
    first = place.groupBy("first_chunk").agg(F.min(F.struct("assignment_id", "cluster_id")).alias("u"))
    rows = _candidates(spark, sf_dir).drop("assignment_id", "cluster_id").withColumn("first_chunk", F.get("chunk_ids", F.lit(0)))
    both = rows.join(first, "first_chunk", "left")
    found = F.when(F.col("row_id") % 9 == 0, "").otherwise(F.coalesce("u.assignment_id", F.lit("asg_unknown")))
    return both.select(*rows.columns, found.alias("assignment_id"), F.coalesce("u.cluster_id", F.when(F.col("row_id") % 2 == 0, "eqg_none")).alias("cluster_id")).drop("first_chunk")


def candidate_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _links(spark, sf_dir).select("row_id", "assignment_id", "cluster_id")


def _card_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = stored.units(spark, sf_dir)
    return units.select("assignment_id", F.col("chunk_ids").alias("allowed_chunk_ids"), F.col("parent_cluster_id").alias("cluster_id"), F.col("unit_cluster_id").alias("microcluster_id"), "cluster_kind", "doc_key", F.col("doc_ids").alias("allowed_doc_ids"))


def _output_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates as lines of their assignment's output, some of them odd."""
    rows = _links(spark, sf_dir)
    shape = F.col("row_id") % 10
    docs = F.array_sort(F.array_distinct(F.transform("chunk_ids", ref_doc)))
    full = F.to_json(F.struct("question", "answer", docs.alias("docIds"), "chunk_ids", F.lit("p").alias("pipeline")))
    with_note = F.to_json(F.struct("question", "answer", docs.alias("docIds"), "chunk_ids", F.lit("p").alias("pipeline"), F.lit("x").alias("note")))
    no_answer = F.to_json(F.struct("question", docs.alias("docIds"), "chunk_ids", F.lit("p").alias("pipeline")))
    as_text = F.to_json(F.struct("question", "answer", F.to_json(docs).alias("docIds"), "chunk_ids"))
    scalar = F.to_json(F.struct("question", "answer", docs.alias("docIds"), F.get("chunk_ids", F.lit(0)).alias("chunk_ids")))
    line = F.when(shape == 2, "  ").when(shape == 3, F.substring(full, 1, 20)).when(shape == 4, "[1]").when(shape == 5, with_note).when(shape == 6, no_answer).when(shape == 7, as_text).when(shape == 8, scalar).otherwise(full)
    return rows.select("assignment_id", F.col("row_id").alias("line_no"), line.alias("value"))


def collected_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collect.collect_outputs(collect.output_records(_output_lines(spark, sf_dir)), _card_columns(spark, sf_dir))
    return _bars(found, "reasons", "warnings").select("candidate_id", "reasons", "warnings", F.size("chunk_ids").alias("chunks"))


def memory_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    card = _card_columns(spark, sf_dir)
    found, _ = collect.parted(collect.collect_outputs(collect.output_records(_output_lines(spark, sf_dir)), card))
    return collect.memory_records(found, card, "run", 0).select("assignment_id", "cluster_id", "microcluster_id", "doc_key", "eval_question_hash", "status")


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.candidates(load(spark, sf_dir, "generated_eval_rows"))


def _collected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.collect_rules(_candidates(spark, sf_dir), _training(spark, sf_dir).select(F.explode("evidence_signature").alias("chunk_id")))


def collected_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bars(_collected(spark, sf_dir), "reasons").select("row_id", "reasons")


def collection_reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.reason_counts(_collected(spark, sf_dir))


def max_question_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.most_similar(_candidates(spark, sf_dir), _training(spark, sf_dir)).withColumn("similarity", F.round("similarity", 4))


def _validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates read back from JSON, some without a pipeline or with documents as text, checked against cards and clusters."""
    links = _links(spark, sf_dir)
    docs = F.when(F.col("row_id") % 19 == 0, F.to_json(F.struct("question", "answer", F.lit("x").alias("docIds"), "chunk_ids", F.lit("p").alias("pipeline"))))
    short = F.when(F.col("row_id") % 17 == 0, F.to_json(F.struct("question", "answer", F.col("doc_ids").alias("docIds"), "chunk_ids")))
    line = F.coalesce(docs, short, F.to_json(F.struct("question", "answer", F.col("doc_ids").alias("docIds"), "chunk_ids", F.lit("p").alias("pipeline"))))
    records = parse_json_lines(links.select("row_id", "assignment_id", "cluster_id", "seed_train_keys", line.alias("value"))).drop("value", "parse_error", "raw_line")
    found, seeds = stored.clusters(spark, sf_dir)
    return validate.validate(validate.candidates_of_records(records), _training(spark, sf_dir), cards=_card_columns(spark, sf_dir), clusters=found, seeds=seeds)


def validated_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bars(_validated(spark, sf_dir), "reasons").select("row_id", "reasons", "similarity", "most_similar_train_key")


def validation_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.reason_counts(_validated(spark, sf_dir))


def judge_distinctness_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.distinctness_rows(_candidates(spark, sf_dir), _training(spark, sf_dir), DISTINCT_LIMIT)


def judge_preflight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates against cards some of which lack their evidence or their related rows."""
    number = F.substring("assignment_id", 5, 9).cast("int")
    card = _card_columns(spark, sf_dir).select("assignment_id", "allowed_chunk_ids", F.when(number % 11 != 0, "rows.jsonl").alias("related_path"))
    one = stored.units(spark, sf_dir).where(number % 13 != 0).select("assignment_id", F.explode("chunk_ids").alias("chunk_id"))
    evidence = one.join(_hydrated(spark, sf_dir).select("chunk_id", "hydration_status"), "chunk_id", "left")
    related = stored.units(spark, sf_dir).where(number % 7 != 0).select("assignment_id", F.when(number % 5 == 0, 0).otherwise(3).alias("rows"))
    return validate.preflight(_links(spark, sf_dir), card, evidence, related)


def prior_questions_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    memory = load(spark, sf_dir, "generated_eval_rows").withColumn("assignment_id", F.lit(None).cast("string"))
    held = memory.select("row_id", "question", F.substring("answer", 1, 500).alias("answer_short"))
    earlier = assign.earlier_questions(stored.units(spark, sf_dir), memory, MEMORY_LIMIT).join(held, "row_id").select("assignment_id", "rank", "question", "answer_short")
    return validate.earlier_questions_topk(_links(spark, sf_dir), earlier, 2)


def _gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates with made-up replies of seven shapes, normalised and gated."""
    rows = _candidates(spark, sf_dir).withColumn("first_chunk", F.coalesce(F.get("chunk_ids", F.lit(0)), F.lit("zz-999#0")))
    return replies.gate(replies.normalize_replies(rows.withColumn("reply", F.expr(REPLY))))


def judge_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bars(_gated(spark, sf_dir), "gate_reasons").select("row_id", "status", "gate_reasons", "reject_reason")


def judge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second attempt on the later batches replaces the first."""
    judged = _gated(spark, sf_dir).select("row_id", "batch_no", "status")
    first = judged.where("batch_no <= 4").select("row_id", F.lit("first").alias("attempt"), "status")
    second = judged.where("batch_no >= 4").select("row_id", F.lit("second").alias("attempt"), "status")
    return export.upsert(first, second, "row_id")


def filter_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts of mini-batches of five rows, from replies of four shapes."""
    at = F.col("record_number") - 1
    rows = load(spark, sf_dir, "training_rows").select(F.floor(at / 5).alias("batch"), (at % 5).alias("local_id"))
    shape = F.col("batch") % 4
    reply = F.when(shape == 0, '{"decisions":[{"row_id":0,"decision":"keep"},{"row_id":1,"decision":"REJECT","reason":"short"},{"id":2,"verdict":"KEEP"}]}')
    reply = reply.when(shape == 1, '```json\n[{"row_id":0,"decision":"maybe"},{"row_id":"4","decision":"KEEP","reason":"ok"},7]\n```').when(shape == 2, "no JSON here").otherwise('Here: {"row_id":3,"decision":"KEEP"}')
    return replies.parse_verdicts(rows.select("batch").distinct().withColumn("reply", reply), rows)


def filter_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "training_rows").select((F.col("record_number") - 1).alias("position"), "question", "answer")
    batched = rowfilter.mini_batches(rowfilter.row_range(rows, 10, 1 << 40), 5, 10)
    return rowfilter.prompts(batched).select("batch", F.length("prompt").alias("chars"), F.sha2("prompt", 256).alias("sha"))


def final_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _gated(spark, sf_dir).select("row_id", "difficulty", F.array_sort("chunk_ids").alias("chunk_ids"), F.array_sort(F.array_distinct(F.transform("chunk_ids", ref_doc))).alias("doc_ids"))
    return reports.distribution(rows)


def bank_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _candidates(spark, sf_dir).withColumn("candidate_id", F.when(F.col("row_id") % 3 > 0, F.concat(F.lit("c"), F.col("row_id").cast("string"))))
    made = reports.bank_records(rows, "run", "v3")
    return made.select("eval_id", "eval_question_hash", "doc_key", "run_id", "judge_version")


def judge_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = _gated(spark, sf_dir).select(F.coalesce("assignment_id", F.lit("")).alias("assignment_id"), "status", F.when(F.col("row_id") % 11 == 0, "judge_error").otherwise(F.col("reject_reason")).alias("reject_reason"))
    valid = _validated(spark, sf_dir).select("assignment_id", "status")
    return reports.roll_up({"judge": judged, "validate": valid})


def subset_reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    bank = load(spark, sf_dir, "eval_bank").select("eval_id", _listed(F.col("chunk_ids"), canonical_ref).alias("chunk_ids"), "seed_train_keys")
    return reports.subset_counts(bank, _training(spark, sf_dir))


def _hashed(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return load(spark, sf_dir, table).withColumn("hash", export.effective_hash(F.col("question"), F.col("eval_question_hash")))


def ledger_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _hashed(spark, sf_dir, "generated_eval_rows").select("row_id", "batch_no", F.coalesce("assignment_id", F.lit("")).alias("assignment_id"), "hash")
    last = load(spark, sf_dir, "generated_eval_rows").agg(F.max("batch_no")).first()[0] or 0
    return export.append_new(rows.where(F.col("batch_no") < last), rows.where(F.col("batch_no") == last), ["assignment_id", "hash"], ["row_id"]).select("row_id", "assignment_id", "hash")


def bank_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.append_new(_hashed(spark, sf_dir, "eval_bank"), _hashed(spark, sf_dir, "generated_eval_rows").select("row_id", "batch_no", "hash"), ["hash"], ["batch_no", "row_id"]).select("row_id", "hash")


def _subset(contained: bool) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        bank = load(spark, sf_dir, "eval_bank").select("eval_id", F.col("eval_question_hash").alias("hash"), _listed(F.col("chunk_ids"), canonical_ref).alias("chunk_ids"), "seed_train_keys")
        return export.bank_subset(bank, _training(spark, sf_dir), contained=contained).select("eval_id")

    return run


def export_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.export_status(load(spark, sf_dir, "generated_eval_rows"), ["batch_no", "row_id"]).select("row_id", "export_status")


def chunk_id_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = load(spark, sf_dir, "training_rows").select(F.explode("chunk_ids").alias("raw")).where("raw is not null").distinct()
    parsed = raw.select("raw", canonical_ref(F.col("raw")).alias("chunk_id"))
    return parsed.select("raw", "chunk_id", ref_doc(F.col("chunk_id")).alias("doc_id"), F.when(F.col("chunk_id").isNotNull(), ref_index(F.col("chunk_id"))).alias("chunk_index"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [assignment_splits, assignment_admission, cluster_scores, related_row_rank, run_memory_topk, selected_balanced, selected_coverage, coverage_metrics, hydrated_chunks, hydration_status]
    own += [collected_candidates, collection_reject_reasons, max_question_jaccard, validated_candidates, validation_reasons, judge_distinctness_topk, judge_preflight, judge_gate, judge_upsert]
    own += [assignment_cards, hydrated_cards, candidate_links, collected_outputs, memory_records, prior_questions_topk, filter_prompts, final_distribution, bank_records, judge_rollup, subset_reject_counts]
    own += [filter_verdicts, ledger_append, bank_append, export_dedupe, chunk_id_parse]
    return {f.__name__: f for f in own} | {"bank_subset": _subset(False), "bank_subset_contained": _subset(True)}
