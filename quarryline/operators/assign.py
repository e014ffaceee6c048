"""Work units from clusters: slices, ordinals, admission, scores and related training rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.chunks import ref_doc, ref_index
from ..functions.keys import doc_key
from ..functions.text import fold
from ..sources.training import strip
from .ordinals import with_ordinal

MAX_CHUNKS, MIN_CHUNKS, MAX_PROMPT_CHARS = 6, 2, 30_000
# The order in which kinds are served; others come last.
KIND_RANK = {"co_citation": 0, "doc_set": 1, "doc_local_seen_chunks": 2, "multi_doc_bridge": 3, "exact_evidence_set": 4}


def kind_rank(kind: Column) -> Column:
    out = F.lit(9)
    for name, rank in KIND_RANK.items():
        out = F.when(kind == name, rank).otherwise(out)
    return out


def split_units(found: DataFrame, *, max_chunks: int = MAX_CHUNKS, prefix: str = "asg", split_label: str = "microcluster_budget") -> DataFrame:
    """Clusters in priority order, each cut into slices of max_chunks in chunk order, all slices numbered.

    Adds assignment_id, part (from 1), parent_cluster_id; slices of a larger cluster get `_partNN` ids and keep the support of
    their parent. Clusters have a bounded number of chunks, so a slice never waits for more than its cluster.
    """
    key = lambda x: F.struct(ref_doc(x).alias("doc"), ref_index(x).alias("idx"), x.alias("chunk_id"))
    ordered = F.transform(F.array_sort(F.transform(F.array_distinct("chunk_ids"), key)), lambda x: x["chunk_id"])
    base = found.withColumn("_all", ordered).withColumn("_slices", F.greatest(F.lit(1), F.ceil(F.size("_all") / max_chunks)).cast("int"))
    parts = base.withColumn("part", F.explode(F.sequence(F.lit(1), F.col("_slices"))))
    cut = parts.withColumn("chunk_ids", F.slice("_all", (F.col("part") - 1) * max_chunks + 1, F.lit(max_chunks)))
    many = F.col("_slices") > 1
    named = cut.withColumns(
        {
            "parent_cluster_id": F.col("cluster_id"),
            "unit_cluster_id": F.when(many, F.format_string("%s_part%02d", "cluster_id", "part")).otherwise(F.col("cluster_id")),
            "unit_doc_ids": F.when(many, F.array_sort(F.array_distinct(F.transform("chunk_ids", ref_doc)))).otherwise(F.col("doc_ids")),
            "split_from": F.when(many, F.coalesce("split_from", F.lit(split_label))).otherwise(F.col("split_from")),
        }
    )
    order = [kind_rank(F.col("cluster_kind")), -F.size("doc_ids"), F.size("_all"), F.col("cluster_id"), F.col("part")]
    numbered = with_ordinal(named.drop("ordinal"), order)
    return numbered.withColumn("assignment_id", F.format_string(f"{prefix}_%06d", "ordinal")).drop("_all", "_slices").withColumnsRenamed({"doc_ids": "cluster_doc_ids", "unit_doc_ids": "doc_ids"}).withColumn("doc_key", doc_key(F.col("doc_ids")))


def prompt_chars(units: DataFrame, instructions: int = 0) -> DataFrame:
    """units with prompt_chars: the characters of the unit's card as JSON, and of the instructions that go with it."""
    card = F.to_json(F.struct("assignment_id", "cluster_kind", F.col("chunk_ids"), F.col("doc_ids")))
    return units.withColumn("prompt_chars", F.length(card) + F.lit(instructions))


def admission(units: DataFrame, *, max_chunks: int = MAX_CHUNKS, min_chunks: int = MIN_CHUNKS, max_chars: int = MAX_PROMPT_CHARS) -> DataFrame:
    """units with `reasons`: too_many_chunks, too_few_chunks, prompt_too_large, in this order; admitted ones have none."""
    n = F.size("chunk_ids")
    reasons = F.array_compact(F.array(F.when(n > max_chunks, F.lit("too_many_chunks")), F.when(n < min_chunks, F.lit("too_few_chunks")), F.when(F.col("prompt_chars") > max_chars, F.lit("prompt_too_large"))))
    return units.withColumn("reasons", reasons)


def score(units: DataFrame) -> DataFrame:
    """units with `score`: density times the root of the rows, weighted by how many chunks and documents there are."""
    n, d = F.size("chunk_ids"), F.size("doc_ids")
    by_chunks = F.when(n.between(4, 6), 1.15).when(n.between(3, 8), 1.0).when(n == 2, 0.7).otherwise(0.6)
    by_docs = F.when(d.between(2, 3), 1.2).when(d > 5, 0.8).otherwise(1.0)
    return units.withColumn("score", F.col("edge_density") * F.sqrt("row_count") * by_chunks * by_docs)


def last_rows(rows: DataFrame) -> DataFrame:
    """One row for each train_key: the one with the largest record number."""
    kept = [c for c in rows.columns if c != "train_key"]
    return rows.groupBy("train_key").agg(F.max_by(F.struct(*kept), "record_number").alias("r")).select("train_key", "r.*")


def related_rows(units: DataFrame, rows: DataFrame, seeds: DataFrame, limit: int) -> DataFrame:
    """(assignment_id, rank, train_key, overlap, exact_same, is_subset): up to `limit` training rows that share a chunk with the unit or seeded its cluster.

    Same chunk set first, then subsets, more overlap, fewer other chunks, train key. All rows take part, duplicates too; of a
    train key the last row counts. The rank is cut per unit before it is sorted further.
    """
    by_chunk = rows.select("train_key", F.explode("evidence_signature").alias("chunk_id")).distinct()
    ours = units.select("assignment_id", F.explode("chunk_ids").alias("chunk_id"))
    touching = ours.join(by_chunk, "chunk_id").select("assignment_id", "train_key")
    seeded = units.select("assignment_id", F.col("parent_cluster_id").alias("cluster_id")).join(seeds, "cluster_id").select("assignment_id", "train_key")
    pairs = touching.unionByName(seeded).distinct()
    known = last_rows(rows.select("train_key", "record_number", F.col("evidence_signature").alias("row_chunks")))
    both = pairs.join(known.select("train_key", "row_chunks"), "train_key").join(units.select("assignment_id", F.array_sort("chunk_ids").alias("allowed")), "assignment_id")
    overlap = F.size(F.array_intersect("row_chunks", "allowed"))
    ranked = both.select(
        "assignment_id",
        "train_key",
        overlap.alias("overlap"),
        (F.col("row_chunks") == F.col("allowed")).alias("exact_same"),
        ((F.size("row_chunks") > 0) & (overlap == F.size("row_chunks"))).alias("is_subset"),
        (F.size("row_chunks") - overlap).alias("extra"),
    )
    order = Window.partitionBy("assignment_id").orderBy(F.desc("exact_same"), F.desc("is_subset"), F.desc("overlap"), "extra", "train_key")
    return ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit).drop("extra")


def earlier_questions(units: DataFrame, memory: DataFrame, limit: int) -> DataFrame:
    """(assignment_id, rank, row_id): up to `limit` remembered questions of the unit's document set, newest first, equal ones once.

    memory: row_id, created_at, doc_key, question, status. Only generated and accepted ones count; blank questions do not. The
    best are kept for each document set first, so that units only meet `limit` rows; a limit of 0 gives none.
    """
    live = memory.where(F.col("status").isin("generated", "accepted") & (F.coalesce("doc_key", F.lit("")) != "")).withColumn("_q", fold(strip(F.col("question")))).where("_q <> ''")
    newest = live.groupBy("doc_key", "_q").agg(F.min(F.struct((-F.unix_micros(F.col("created_at").cast("timestamp"))).alias("age"), "row_id")).alias("m"))
    top = newest.withColumn("rank", F.row_number().over(Window.partitionBy("doc_key").orderBy("m.age", "m.row_id"))).where(F.col("rank") <= limit)
    return units.select("assignment_id", "doc_key").join(top, "doc_key").select("assignment_id", "rank", F.col("m.row_id").alias("row_id"))
