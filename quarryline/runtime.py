"""Session helpers: table loading, and cutting lineage through tables in the shared folder."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import threading
import uuid
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Observation, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_lock, _writing = threading.Lock(), Counter()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the parquet tables of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share. The session names it; a temporary one is made only where it is unset (tests)."""
    named = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{CHECKPOINT_KEY} must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="quarryline-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        named = "file://" + folder
        spark.conf.set(CHECKPOINT_KEY, named)
    return named.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, under the name of this application."""
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


@contextlib.contextmanager
def _shuffles_end(spark: SparkSession) -> Iterator[None]:
    """Writes begun in here delete their shuffle files when they end, as nothing reads them again; else they stay until the driver collects its garbage.

    The setting goes back with the last of the writes that run at a time, since other results may be read twice.
    """
    at = spark._jsparkSession.sessionUUID()
    with _lock:
        own = spark.conf.get(CLEANUP_KEY, "false") == "true" and not _writing[at]  # the session's own wish stays
        if not own:
            _writing[at] += 1
            spark.conf.set(CLEANUP_KEY, "true")
    try:
        yield
    finally:
        with _lock:
            if not own:
                _writing[at] -= 1
                if not _writing[at]:
                    spark.conf.unset(CLEANUP_KEY)


class Cuts:
    """Tables written to the shared folder to cut lineage. They outlive a lost executor; a superseded one is dropped."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, name

    def cut(self, df: DataFrame) -> DataFrame:
        """Writes df and reads it back."""
        path = scratch_path(self.spark, self.name)
        with _shuffles_end(self.spark):
            df.write.parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        back._cut_path = path
        return back

    def measured(self, df: DataFrame, **figures: Column) -> tuple[DataFrame, dict]:
        """The same, with aggregates over df that are taken while it is written. A task that ran twice may count twice: bounds only."""
        seen = Observation()
        back = self.cut(df.observe(seen, *[c.alias(k) for k, c in figures.items()]))
        return back, seen.get

    def observed(self) -> Observation:
        return Observation()

    def drop(self, df: DataFrame) -> None:
        """Deletes the table behind a frame that no later plan reads."""
        path = getattr(df, "_cut_path", None)
        if path:
            drop_path(self.spark, path)


def clear_scratch(spark: SparkSession) -> None:
    """Deletes all tables that this application cut, once no result that reads them is needed."""
    drop_path(spark, f"{shared_dir(spark)}/{spark.sparkContext.applicationId}")


def exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def drop_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
