"""Queries of this subpackage: name -> f(spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..runtime import load
from . import canonical, collapse, defects, groups, leaks, linkage, mixing, oracles, packing


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = leaks.corpus_texts(load(spark, sf_dir, "training_rows"), load(spark, sf_dir, "documents"))
    return leaks.leaked_items(texts, leaks.item_texts(load(spark, sf_dir, "eval_items")), ["corpus", "row_key"])


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linkage.link_batches(load(spark, sf_dir, "eval_bank"), load(spark, sf_dir, "generated_eval_rows"))[0]


def p2_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linkage.link_batches(load(spark, sf_dir, "eval_bank"), load(spark, sf_dir, "generated_eval_rows"))[1]


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collapse.hidden_copies(load(spark, sf_dir, "training_rows"))


def p3_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    records, _ = collapse.collapse_records(load(spark, sf_dir, "training_rows"))
    return records.select("first_record", "copies")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups.row_groups(load(spark, sf_dir, "training_rows"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "training_rows")
    return defects.broken_pairs(rows, defects.train(rows))


def p8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_all(load(spark, sf_dir, "documents"), load(spark, sf_dir, "pack_capacities"))


def p8_room(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.room_used(p8_packing(spark, sf_dir), load(spark, sf_dir, "pack_capacities"))


def p9_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(load(spark, sf_dir, "documents"), load(spark, sf_dir, "mix_targets"))


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.shares_reached(p9_mixture(spark, sf_dir), load(spark, sf_dir, "mix_targets"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical.look_alike_pairs(load(spark, sf_dir, "documents"))


def p10_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical.look_alike_classes(load(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "p1_found": p1_found,
        "p2_found": p2_found,
        "p2_clusters": p2_clusters,
        "p3_found": p3_found,
        "p3_records": p3_records,
        "p4_found": p4_found,
        "p5_found": p5_found,
        "p8_packing": p8_packing,
        "p8_room": p8_room,
        "p9_mixture": p9_mixture,
        "p9_shares": p9_shares,
        "p10_found": p10_found,
        "p10_classes": p10_classes,
    }


def oracle_sql() -> dict[str, str]:
    return oracles.ORACLES
