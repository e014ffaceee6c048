"""Problem 7: a few keys holding most records.

Per-key figures without a task per key: rows and quantiles by distributed exact selection (histograms of mergeable counts,
refined until the wanted ranks resolve), distinct values by grouping on (key, value) before the key. Every shuffle carries
counts that were combined on the map side; no task ever gathers the values of a hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import Cuts
from .skew import join_unique

BINS = 256


def quantiles_by_key(rows: DataFrame, fractions: tuple[float, ...] = (0.5,)) -> DataFrame:
    """(key, n, fraction, value) for rows (key, value: long): the value of rank ceil(fraction * n), at least 1, of each key.

    Round by round, the range in which a rank lies is cut into BINS bins, counts per (key, fraction, bin) are added up, and the
    range shrinks to the bin that holds the rank; a range of one value is the answer. At most eight rounds resolve 64 bits. Null
    keys and values are left out; ties count as often as they occur; no rows give no rows.
    """
    spark, cuts = rows.sparkSession, Cuts(rows.sparkSession, "quantiles")
    counts = cuts.cut(rows.where("key is not null and value is not null").groupBy("key", F.col("value").cast("long").alias("value")).agg(F.count("*").alias("c")))
    ranges = counts.groupBy("key").agg(F.sum("c").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"), F.count("*").alias("values"))
    wanted = F.explode(F.array(*[F.lit(float(f)) for f in fractions])).alias("fraction")
    state = ranges.select("key", "n", "values", "lo", "hi", wanted).withColumn("rank", F.greatest(F.lit(1), F.ceil(F.col("fraction") * F.col("n"))).cast("long"))
    figures = {"open": F.max(F.col("lo") < F.col("hi")), "most": F.max("values")}
    state, seen = cuts.measured(state, **figures)
    done = []
    while True:
        done.append(state.where("lo = hi").select("key", "n", "fraction", F.col("lo").alias("value")))
        open_ = state.where("lo < hi")
        if not seen["open"]:
            break
        # Unsigned arithmetic in decimals keeps ranges that span all 64 bits exact.
        wide = open_.withColumn("step", F.ceil((F.col("hi").cast("decimal(20,0)") - F.col("lo") + 1) / F.lit(BINS)).cast("decimal(20,0)"))
        # The values of a key with very many of them stay where they are.
        held = join_unique(counts, wide.withColumn("size", F.col("values")), "key", "size", seen["most"]).where("value between lo and hi")
        binned = held.groupBy("key", "n", "values", "fraction", "rank", "lo", "hi", "step", F.floor((F.col("value").cast("decimal(20,0)") - F.col("lo")) / F.col("step")).cast("int").alias("bin")).agg(F.sum("c").alias("c"), F.min("value").alias("least"), F.max("value").alias("most"))
        # At most BINS counts of a key and fraction meet here, however many rows the key has.
        whole = binned.groupBy("key", "n", "values", "fraction", "rank").agg(F.sort_array(F.collect_list(F.struct("bin", "c", "least", "most"))).alias("h"))
        start = F.struct(F.lit(0).cast("long").alias("below"), F.lit(None).cast("long").alias("lo"), F.lit(None).cast("long").alias("hi"))

        def step(acc, x):
            inside = acc["lo"].isNull() & (acc["below"] + x["c"] >= F.col("rank"))
            below = F.when(acc["lo"].isNull() & ~inside, acc["below"] + x["c"]).otherwise(acc["below"])
            return F.struct(below.alias("below"), F.when(inside, x["least"]).otherwise(acc["lo"]).alias("lo"), F.when(inside, x["most"]).otherwise(acc["hi"]).alias("hi"))

        found = whole.withColumn("f", F.aggregate("h", start, step))
        state, seen = cuts.measured(found.select("key", "n", "values", F.col("f.lo").alias("lo"), F.col("f.hi").alias("hi"), "fraction", (F.col("rank") - F.col("f.below")).alias("rank")), **figures)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def distinct_by_key(rows: DataFrame, *columns: str) -> DataFrame:
    """(key, distinct_<column>...) : distinct values that are not null, for rows (key, columns). Repeats drop out on the map side first."""
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("what"), F.col(c).cast("string").alias("value")) for i, c in enumerate(columns)])).alias("p")
    single = rows.select("key", pairs).where("p.value is not null and key is not null").select("key", "p.what", F.unhex(F.md5("p.value")).alias("mark")).distinct()
    counted = single.groupBy("key", "what").count()
    return counted.groupBy("key").agg(*[F.coalesce(F.sum(F.when(F.col("what") == i, F.col("count"))), F.lit(0)).alias(f"distinct_{c}") for i, c in enumerate(columns)])
