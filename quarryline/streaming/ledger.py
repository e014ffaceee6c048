"""Incremental ledgers: files of generated rows arrive in a folder, each micro-batch appends what the ledger lacks.

A stream is a convenience over the batch operators: a batch that is replayed after a failure appends nothing twice, because
every append is an anti-join with keep-first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.export import append_new, effective_hash

ROW = T.StructType(
    [T.StructField("row_id", T.LongType()), T.StructField("assignment_id", T.StringType()), T.StructField("question", T.StringType()), T.StructField("eval_question_hash", T.StringType())]
)
KEYS = ["assignment_id", "hash"]


def with_keys(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"assignment_id": F.coalesce("assignment_id", F.lit("")), "hash": effective_hash(F.col("question"), F.col("eval_question_hash"))})


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger table; empty where it was not written yet."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    schema = T.StructType([*ROW.fields, T.StructField("hash", T.StringType()), T.StructField("batch", T.LongType())])
    there = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)
    return spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)


def append_batch(path: str):
    """The foreachBatch function: overwrites its own batch folder, so that a replay replaces and never repeats."""

    def run(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        before = ledger(spark, path).where(F.coalesce("batch", F.lit(-1)) != batch)
        fresh = append_new(before, with_keys(rows), KEYS, ["row_id"])
        fresh.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    return run


def follow(spark: SparkSession, folder: str, path: str, checkpoint: str, files_per_batch: int = 100) -> StreamingQuery:
    """Reads the JSON line files of a folder, those there now, into the ledger, and stops when all are in."""
    rows = spark.readStream.schema(ROW).option("maxFilesPerTrigger", files_per_batch).json(folder)
    return rows.writeStream.foreachBatch(append_batch(path)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
