"""Queries of the core: name -> f(spark, sf_dir), and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from ..functions import keys
from ..operators import cluster, delta, docfigures, graph, profile
from ..runtime import load
from ..sources import raw_records
from ..sources.training import citations, training
from . import oracles, oracles_clusters, oracles_units, stored, units


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_records.parse_issues(load(spark, sf_dir, "raw_training_lines")).select("csv_line_number", "field", "error").distinct()


def p6_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_records.loaded_rows(load(spark, sf_dir, "raw_training_lines"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docfigures.hot_docs(load(spark, sf_dir, "training_rows"))


def p7_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docfigures.doc_figures(load(spark, sf_dir, "training_rows"))


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training(load(spark, sf_dir, "training_rows"), False)


def _of_rows(operator: Callable[..., DataFrame], **options) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: operator(_rows(spark, sf_dir), **options)


def _snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, str]:
    """(rows of the latest snapshot, ledger of the earlier ones, its name)."""
    rows = stored.rows(spark, sf_dir).select("record_number", "snapshot_id", "train_key", "doc_key")
    latest = load(spark, sf_dir, "training_rows").agg(F.max("snapshot_id")).first()[0] or ""
    return rows.where(F.col("snapshot_id") == latest), delta.current_keys(rows.where(F.col("snapshot_id") < latest)), latest


def train_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training(load(spark, sf_dir, "training_rows")).select("record_number", "train_key", "doc_key")


def eval_question_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "generated_eval_rows").select("row_id", keys.question_hash(F.col("question")).alias("question_hash"))


def delta_new_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delta.new_keys(*_snapshots(spark, sf_dir))


def delta_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delta.delta_summary(*_snapshots(spark, sf_dir))


def _live(spark: SparkSession, sf_dir: str) -> DataFrame:
    return citations(_rows(spark, sf_dir).where("not is_dup"))


def cocitation_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.edges(_live(spark, sf_dir))


def cocitation_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.component_sizes(graph.chunk_components(_live(spark, sf_dir)))


def flat_clusters(found: DataFrame) -> DataFrame:
    """Clusters with arrays joined by bars."""
    joined = {c: F.array_join(c, "|") for c in ("chunk_ids", "doc_ids", "source_pipelines")}
    flat = found.withColumns(joined | {"split_from": F.coalesce("split_from", F.lit(""))})
    return flat.select("cluster_id", *joined, "split_from", "row_count", "unique_question_count", "chunk_count", "doc_count", "edge_density")


def _of_kind(kind: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        found, _ = stored.clusters(spark, sf_dir)
        return flat_clusters(found.where(F.col("cluster_kind") == kind))

    return run


def cluster_edge_density_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Densities with edges looked up in both orders, for the same clusters."""
    members = stored.clusters(spark, sf_dir)[0].select(F.col("cluster_id").alias("cluster"), F.explode("chunk_ids").alias("chunk_id"))
    return graph.densities(members, graph.edges(_live(spark, sf_dir)), fixed=True).withColumnRenamed("cluster", "cluster_id")


def cluster_kind_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster.kind_summary(stored.clusters(spark, sf_dir)[0])


def focused_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters with a seed that some row marked as a duplicate also has."""
    rows = stored.rows(spark, sf_dir)
    found, seeds = stored.clusters(spark, sf_dir)
    return cluster.final_order(cluster.focused(found, seeds, rows.where("is_dup"))).select("cluster_id", "cluster_kind", "row_count", "chunk_count")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "p6_found": p6_found,
        "p6_loaded": p6_loaded,
        "p7_found": p7_found,
        "p7_figures": p7_figures,
        "source_row_counts": _of_rows(profile.row_counts),
        "source_unique_counts": _of_rows(profile.unique_counts),
        "citations_per_row_summary": _of_rows(profile.citation_summaries),
        "top_chunks": _of_rows(profile.top_chunks),
        "top_docs": _of_rows(profile.top_docs),
        "pipeline_distribution": _of_rows(profile.pipelines),
        "duplicate_pipeline_distribution": _of_rows(profile.pipelines, duplicates_only=True),
        "duplicate_of_distribution": _of_rows(profile.duplicate_targets),
        "top_evidence_signatures": _of_rows(profile.top_signatures, signature="evidence_signature"),
        "top_doc_sets": _of_rows(profile.top_signatures, signature="doc_set_signature"),
        "question_reuse": _of_rows(profile.question_reuse),
        "docids_chunk_mismatch": _of_rows(profile.undocumented_chunks),
        "one_sided_docs": _of_rows(profile.one_sided_docs),
        "train_keys": train_keys,
        "eval_question_hashes": eval_question_hashes,
        "delta_new_keys": delta_new_keys,
        "delta_summary": delta_summary,
        "cocitation_edges": cocitation_edges,
        "cocitation_components": cocitation_components,
        "exact_evidence_clusters": _of_kind("exact_evidence_set"),
        "doc_set_clusters": _of_kind("doc_set"),
        "cocitation_clusters": _of_kind("co_citation"),
        "doc_local_clusters": _of_kind("doc_local_seen_chunks"),
        "multi_doc_bridge_clusters": _of_kind("multi_doc_bridge"),
        "cluster_edge_density_fixed": cluster_edge_density_fixed,
        "cluster_kind_summary": cluster_kind_summary,
        "focused_clusters": focused_clusters,
        **units.queries(),
    }


def oracle_sql() -> dict[str, str]:
    return oracles.ORACLES | oracles_clusters.ORACLES | oracles_units.ORACLES
