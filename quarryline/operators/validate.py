"""Rule checks of generated rows: collection rules, set containment, near-duplicate questions, all as arrays of reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.chunks import canonical_ref, ref_doc
from ..functions.text import jaccard, normalized_question, tokens, truncate
from ..functions.variants import field_text, has_field, is_string_array
from ..sources.training import _listed, strip
from .assign import last_rows
from .collect import COLUMNS

# Fixed value: what an internal chunk id looks like.
INTERNAL_ID = r"(?i)\bclf-[a-z0-9]+#\d+\b"
SIMILARITY = 0.85


def _reasons(*pairs: tuple[Column, str]) -> Column:
    return F.array_compact(F.array(*[F.when(cond, F.lit(name)) for cond, name in pairs]))


def candidates(generated: DataFrame) -> DataFrame:
    """Generated rows with trimmed texts, canonical references in first-seen order, listed documents and seeds. Null arrays read as empty."""
    return generated.select(
        "row_id",
        "batch_no",
        "assignment_id",
        "eval_question_hash",
        "cluster_id",
        strip(F.col("question")).alias("question"),
        strip(F.col("answer")).alias("answer"),
        F.array_distinct(_listed(F.col("chunk_ids"), canonical_ref)).alias("chunk_ids"),
        F.array_sort(F.array_distinct(_listed(F.col("allowed_doc_ids"), strip))).alias("doc_ids"),
        F.array_distinct(_listed(F.col("seed_train_keys"), strip)).alias("seed_train_keys"),
    )


def _outside(rows: DataFrame, allowed: DataFrame, name: str) -> DataFrame:
    """rows with the sorted array `name` of their references that are not in allowed (chunk_id)."""
    one = rows.select("row_id", F.explode("chunk_ids").alias("chunk_id"))
    bad = one.join(allowed.select("chunk_id").distinct(), "chunk_id", "left_anti").groupBy("row_id").agg(F.array_sort(F.collect_list("chunk_id")).alias(name))
    return rows.join(bad, "row_id", "left").withColumn(name, F.coalesce(name, F.array().cast("array<string>")))


def collect_rules(rows: DataFrame, seen: DataFrame) -> DataFrame:
    """candidates with `reasons`: empty_question, empty_answer, empty_chunk_ids, chunk_not_in_assignment, then empty_docIds or docIds_do_not_match_chunk_ids.

    A row's assignment allows the seen chunks (chunk_id) of its documents.
    """
    marked = _outside(rows, seen, "unauthorized")
    derived = F.array_sort(F.array_distinct(F.transform("chunk_ids", ref_doc)))
    foreign = F.exists("chunk_ids", lambda x: ~F.array_contains("doc_ids", ref_doc(x)))
    reasons = _reasons(
        (F.col("question") == "", "empty_question"),
        (F.col("answer") == "", "empty_answer"),
        (F.size("chunk_ids") == 0, "empty_chunk_ids"),
        ((F.size("unauthorized") > 0) | foreign, "chunk_not_in_assignment"),
        (F.size("doc_ids") == 0, "empty_docIds"),
        ((F.size("doc_ids") > 0) & (F.col("doc_ids") != derived), "docIds_do_not_match_chunk_ids"),
    )
    return marked.withColumn("reasons", reasons)


def column_reasons(record: Column) -> tuple[Column, Column]:
    """(missing_column:<name> of an object's fields, docIds_not_string_array and chunk_ids_not_string_array) as arrays."""
    missing = F.array_compact(F.array(*[F.when(~has_field(record, c), F.lit(f"missing_column:{c}")) for c in COLUMNS]))
    arrays = F.array_compact(F.array(*[F.when(~is_string_array(F.try_variant_get(record, f"$.{c}", "variant")), F.lit(f"{c}_not_string_array")) for c in ("docIds", "chunk_ids")]))
    return missing, arrays


def candidates_of_records(records: DataFrame) -> DataFrame:
    """records (row_id, record, others) with the candidate's texts and arrays and what is wrong with its columns, as validate() reads them.

    Arrays that are no lists of strings read as empty ones; null arrays do so too, and are wrong.
    """
    missing, wrong = column_reasons(F.col("record"))
    field = lambda name: F.try_variant_get("record", f"$.{name}", "variant")
    strings = lambda name: F.when(is_string_array(field(name)), F.try_variant_get(field(name), "$", "array<string>")).otherwise(F.array().cast("array<string>"))
    return records.withColumns(
        {
            "question": field_text(F.col("record"), "question"),
            "answer": field_text(F.col("record"), "answer"),
            "chunk_ids": F.array_distinct(strings("chunk_ids")),
            "doc_ids": F.array_sort(F.array_distinct(strings("docIds"))),
            "missing_columns": missing,
            "wrong_arrays": wrong,
        }
    ).drop("record")


def related_keys(rows: DataFrame, seeds: DataFrame | None) -> DataFrame:
    """(row_id, train_key) once each: the seeds of each row and, where seeds (cluster_id, train_key) are given, those of its cluster."""
    own = rows.select("row_id", F.explode("seed_train_keys").alias("train_key"))
    if seeds is not None:
        own = own.unionByName(rows.select("row_id", "cluster_id").join(seeds.select("cluster_id", "train_key"), "cluster_id").select("row_id", "train_key"))
    return own.distinct()


def most_similar(rows: DataFrame, training: DataFrame, seeds: DataFrame | None = None) -> DataFrame:
    """(row_id, train_key, similarity): of the training rows related to a row, the one with the most similar question, if any is similar at all.

    Related are the seeds of the row and, where seeds (cluster_id, train_key) are given, those of its cluster. Token-set Jaccard;
    equal values go to the least train key. Only related rows are compared, by key; of a key the last row counts.
    """
    asked = rows.select("row_id", tokens(F.col("question")).alias("t"))
    known = last_rows(training.select("train_key", "record_number", tokens(F.col("question")).alias("other")))
    both = related_keys(rows, seeds).join(known.select("train_key", "other"), "train_key").join(asked, "row_id")
    scored = both.select("row_id", "train_key", jaccard(F.col("t"), F.col("other")).alias("similarity")).where("similarity > 0")
    best = scored.groupBy("row_id").agg(F.min(F.struct((-F.col("similarity")).alias("s"), "train_key")).alias("b"))
    return best.select("row_id", (-F.col("b.s")).alias("similarity"), F.col("b.train_key").alias("train_key"))


def validate(rows: DataFrame, training: DataFrame, threshold: float = SIMILARITY, *, cards: DataFrame | None = None, clusters: DataFrame | None = None, seeds: DataFrame | None = None) -> DataFrame:
    """candidates with `reasons`, `status` (ok or reject), `similarity` (four places), `most_similar_train_key` and what lies outside.

    Order: missing_column:*, empty_question, empty_answer, docIds_not_string_array, chunk_ids_not_string_array, empty_chunk_ids,
    unseen_chunk_id, docIds_do_not_match_chunk_ids, question_contains_internal_chunk_id, exact_training_question_duplicate,
    chunk_id_not_in_assignment_allowed_chunks, unknown_candidate_cluster, chunk_id_not_in_candidate_cluster,
    too_similar_to_related_training_question. The threshold meets the similarity before rounding. The first and the array
    reasons come from columns missing_columns and wrong_arrays, where rows have them. cards: assignment_id, allowed_chunk_ids;
    clusters: cluster_id, chunk_ids; seeds: cluster_id, train_key. Without them their rules find nothing; a row without a cluster, or with one that
    is unknown, lies in none.
    """
    none = F.array().cast("array<string>")
    rows = rows.withColumns({c: none for c in ("missing_columns", "wrong_arrays") if c not in rows.columns})
    if "cluster_id" not in rows.columns:
        rows = rows.withColumn("cluster_id", F.lit(None).cast("string"))
    seen = training.select(F.explode("evidence_signature").alias("chunk_id"))
    marked = _outside(rows, seen, "unseen")
    exact = training.select(normalized_question(F.col("question")).alias("_q")).where("_q <> ''").distinct().withColumn("_exact", F.lit(True))
    marked = marked.join(exact, normalized_question(F.col("question")) == F.col("_q"), "left")
    marked = marked.join(most_similar(rows, training, seeds), "row_id", "left")
    allowed = cards.select("assignment_id", F.col("allowed_chunk_ids").alias("_allowed")) if cards is not None else None
    marked = marked.join(allowed, "assignment_id", "left") if cards is not None else marked.withColumn("_allowed", none)
    known = clusters.select("cluster_id", F.col("chunk_ids").alias("_cluster")) if clusters is not None else None
    marked = marked.join(known, "cluster_id", "left") if clusters is not None else marked.withColumn("_cluster", none)
    beyond = lambda c: F.when(F.size(F.coalesce(c, none)) > 0, F.array_sort(F.array_except("chunk_ids", c))).otherwise(none)
    marked = marked.withColumns({"outside_assignment": beyond(F.col("_allowed")), "outside_cluster": beyond(F.col("_cluster"))})
    named = F.coalesce("cluster_id", F.lit("")) != ""
    unknown = named & F.col("_cluster").isNull() if clusters is not None else F.lit(False)
    derived = F.array_sort(F.array_distinct(F.transform("chunk_ids", ref_doc)))
    wrong = lambda name: F.array_contains("wrong_arrays", name)
    own = _reasons(
        (F.col("question") == "", "empty_question"),
        (F.col("answer") == "", "empty_answer"),
        (wrong("docIds_not_string_array"), "docIds_not_string_array"),
        (wrong("chunk_ids_not_string_array"), "chunk_ids_not_string_array"),
        (F.size("chunk_ids") == 0, "empty_chunk_ids"),
        (F.size("unseen") > 0, "unseen_chunk_id"),
        (F.col("doc_ids") != derived, "docIds_do_not_match_chunk_ids"),
        (F.col("question").rlike(INTERNAL_ID), "question_contains_internal_chunk_id"),
        (F.coalesce("_exact", F.lit(False)), "exact_training_question_duplicate"),
        (F.size("outside_assignment") > 0, "chunk_id_not_in_assignment_allowed_chunks"),
        (unknown, "unknown_candidate_cluster"),
        (F.size("outside_cluster") > 0, "chunk_id_not_in_candidate_cluster"),
        (F.coalesce("similarity", F.lit(0.0)) >= threshold, "too_similar_to_related_training_question"),
    )
    out = marked.withColumns({"reasons": F.concat("missing_columns", own), "similarity": F.round(F.coalesce("similarity", F.lit(0.0)), 4), "most_similar_train_key": F.col("train_key")})
    return out.withColumn("status", F.when(F.size("reasons") == 0, "ok").otherwise("reject")).drop("_q", "_exact", "train_key", "_allowed", "_cluster")


def reason_counts(marked: DataFrame) -> DataFrame:
    """(reason, rows)."""
    return marked.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("rows"))


def distinctness_rows(rows: DataFrame, training: DataFrame, limit: int) -> DataFrame:
    """(row_id, rank, train_key, overlap, similarity): up to `limit` training rows that share a chunk with a row.

    More shared chunks first, then the more similar question, then the train key.
    """
    by_chunk = training.select("train_key", F.explode("evidence_signature").alias("chunk_id")).distinct()
    shared = rows.select("row_id", F.explode("chunk_ids").alias("chunk_id")).join(by_chunk, "chunk_id").groupBy("row_id", "train_key").agg(F.count("*").alias("overlap"))
    known = last_rows(training.select("train_key", "record_number", tokens(F.col("question")).alias("other"))).select("train_key", "other")
    both = shared.join(known, "train_key").join(rows.select("row_id", tokens(F.col("question")).alias("t")), "row_id")
    scored = both.select("row_id", "train_key", "overlap", jaccard(F.col("t"), F.col("other")).alias("similarity"))
    order = Window.partitionBy("row_id").orderBy(F.desc("overlap"), F.desc("similarity"), "train_key")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit).withColumn("similarity", F.round("similarity", 4))


def preflight(rows: DataFrame, cards: DataFrame, evidence: DataFrame, related: DataFrame) -> DataFrame:
    """(row_id, reason): what keeps a row (row_id, assignment_id, chunk_ids) from being judged; empty where nothing does.

    The first of missing_assignment_id, assignment_not_found, empty_cited_chunks, cited_chunk_outside_assignment,
    missing_assignment_evidence_bundle, missing_cited_chunk_text, missing_related_training_rows_artifact,
    missing_related_training_rows_bundle, empty_related_training_rows_bundle. cards: assignment_id, allowed_chunk_ids,
    related_path (null or blank: no artifact). evidence: assignment_id, chunk_id, hydration_status, a row for each chunk of a
    written bundle. related: assignment_id, rows, one for each written bundle.
    """
    known = cards.select("assignment_id", F.col("allowed_chunk_ids").alias("_allowed"), F.coalesce("related_path", F.lit("")).alias("_path"))
    both = rows.select("row_id", strip(F.col("assignment_id")).alias("assignment_id"), "chunk_ids").join(known, "assignment_id", "left")
    bundles = evidence.groupBy("assignment_id").agg(F.lit(True).alias("_bundle"))
    both = both.join(bundles, "assignment_id", "left").join(related.select("assignment_id", F.col("rows").alias("_rows")), "assignment_id", "left")
    good = evidence.where("hydration_status = 'ok'").select("assignment_id", "chunk_id").distinct()
    bad = both.select("row_id", "assignment_id", F.explode("chunk_ids").alias("chunk_id")).join(good, ["assignment_id", "chunk_id"], "left_anti").select("row_id").distinct().withColumn("_missing", F.lit(True))
    both = both.join(bad, "row_id", "left")
    reason = F.when(F.col("assignment_id") == "", "missing_assignment_id").when(F.col("_allowed").isNull(), "assignment_not_found").when(F.size("chunk_ids") == 0, "empty_cited_chunks")
    reason = reason.when(F.size(F.array_except("chunk_ids", "_allowed")) > 0, "cited_chunk_outside_assignment").when(F.col("_bundle").isNull(), "missing_assignment_evidence_bundle").when(F.col("_missing"), "missing_cited_chunk_text")
    reason = reason.when(strip(F.col("_path")) == "", "missing_related_training_rows_artifact").when(F.col("_rows").isNull(), "missing_related_training_rows_bundle").when(F.col("_rows") == 0, "empty_related_training_rows_bundle").otherwise("")
    return both.select("row_id", reason.alias("reason"))


def earlier_questions_topk(rows: DataFrame, earlier: DataFrame, limit: int) -> DataFrame:
    """(row_id, rank, question, answer_short, similarity): of the earlier questions of a row's assignment (assignment_id, rank,
    question, answer_short) the `limit` most similar ones, equal ones in the order given; blank questions drop out after that."""
    both = rows.select("row_id", "assignment_id", tokens(F.col("question")).alias("t")).join(earlier.withColumnRenamed("rank", "_at"), "assignment_id")
    scored = both.withColumn("similarity", jaccard(F.col("t"), tokens(F.col("question"))))
    order = Window.partitionBy("row_id").orderBy(F.desc("similarity"), "_at")
    top = scored.withColumn("rank", F.row_number().over(order)).where((F.col("rank") <= limit) & (strip(F.col("question")) != ""))
    return top.select("row_id", "rank", truncate(F.col("question"), 400).alias("question"), truncate(F.col("answer_short"), 300).alias("answer_short"), F.round("similarity", 4).alias("similarity"))


def packets(rows: DataFrame, evidence: DataFrame, compact: DataFrame, earlier: DataFrame, *, max_chunk_chars: int = 1600) -> DataFrame:
    """(row_id, packet): what a judge is shown of each row that passed preflight, as JSON.

    Cited chunks in cited order with their text cut to max_chunk_chars (evidence: assignment_id, chunk_id, text), the related rows
    that tell it apart (compact: row_id, rank, train_key, question, answer, chunk_ids, all cut before), earlier questions
    (of earlier_questions_topk). Each list is bounded by what was chosen before.
    """
    cited = rows.select("row_id", "assignment_id", F.posexplode("chunk_ids").alias("at", "chunk_id")).join(evidence, ["assignment_id", "chunk_id"])
    chunk = F.struct("at", "chunk_id", ref_doc(F.col("chunk_id")).alias("doc_id"), truncate(F.col("text"), max_chunk_chars).alias("text"))
    lists = [cited.groupBy("row_id").agg(F.array_sort(F.collect_list(chunk)).alias("cited_chunks"))]
    for name, table in (("related_training_rows", compact), ("earlier_questions", earlier)):
        fields = [c for c in table.columns if c not in ("row_id", "rank")]
        lists.append(table.groupBy("row_id").agg(F.array_sort(F.collect_list(F.struct("rank", *fields))).alias(name)))
    both = rows
    for part in lists:
        both = both.join(part, "row_id", "left")
    candidate = F.struct("question", "answer", F.col("doc_ids").alias("docIds"), "chunk_ids", "seed_train_keys").alias("candidate")
    return both.select("row_id", F.to_json(F.struct(candidate, F.struct("assignment_id", "cluster_id").alias("assignment"), "cited_chunks", "related_training_rows", "earlier_questions")).alias("packet"))
