"""Tables that many queries read, written once for a data folder and session: normalised rows with keys, clusters and their seeds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import assign, cluster
from ..runtime import Cuts, exists, load
from ..sources.training import training

_made: dict[tuple[str, str, str], list[DataFrame]] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], list[DataFrame]]) -> list[DataFrame]:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _made or not all(exists(spark, df._cut_path) for df in _made[key]):
        cuts = Cuts(spark, name)
        _made[key] = [cuts.cut(df) for df in make()]
    return _made[key]


def rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training rows, normalised, with their keys."""
    return _once(spark, sf_dir, "rows", lambda: [training(load(spark, sf_dir, "training_rows"))])[0]


def clusters(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(clusters of all kinds, seeds)."""
    found, seeds = _once(spark, sf_dir, "clusters", lambda: list(cluster.clusters(rows(spark, sf_dir))))
    return found, seeds


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The work units cut from the clusters."""
    return _once(spark, sf_dir, "units", lambda: [assign.split_units(clusters(spark, sf_dir)[0])])[0]
