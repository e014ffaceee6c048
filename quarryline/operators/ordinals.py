"""Row numbers over a whole table without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import Cuts


def with_ordinal(df: DataFrame, order: list[Column], name: str = "ordinal") -> DataFrame:
    """df with numbers from 1 in the given order, which must be total.

    A range-partitioned sort, numbers inside each partition, and the sum of the partitions before: the only window is over one
    row a partition. The sorted table is written once, so that both readings see the same partitions.
    """
    cuts = Cuts(df.sparkSession, "ordinal")
    placed = cuts.cut(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33).alias("_part")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy(part).agg(F.count("*").alias("_n"), F.min("_at").alias("_first")).select("_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    joined = placed.withColumn("_part", F.shiftright("_at", 33)).join(F.broadcast(starts), "_part")
    return joined.withColumn(name, (F.col("_start") + F.col("_at") - F.col("_first") + 1).cast("long")).drop("_at", "_part", "_first", "_start")
