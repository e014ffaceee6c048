"""The co-citation graph: weighted edges between chunks that one row cites, their components and densities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import Cuts
from .components import components, star_edges
from .ordinals import with_ordinal
from .skew import join_unique


def chunk_order(chunk: Column, doc: Column, index: Column) -> Column:
    """Sort key of a chunk: document, index, reference."""
    return F.struct(doc.alias("doc_id"), index.alias("chunk_index"), chunk.alias("chunk_id"))


def edges(cited: DataFrame) -> DataFrame:
    """(src, dst, weight): pairs of chunks by the rows that cite both; src comes first in chunk order.

    Pairs are made from the references of one row, of which there are few; they are never gathered by chunk.
    """
    key = chunk_order(F.col("chunk_id"), F.col("doc_id"), F.col("chunk_index"))
    listed = cited.groupBy("record_number").agg(F.array_sort(F.collect_list(key)).alias("c")).where(F.size("c") > 1)
    later = F.flatten(F.transform("c", lambda x, i: F.transform(F.slice("c", i + 2, F.size("c")), lambda y: F.struct(x["chunk_id"].alias("src"), y["chunk_id"].alias("dst")))))
    return listed.select(F.explode(later).alias("e")).select("e.*").groupBy("src", "dst").agg(F.count("*").alias("weight"))


def chunk_components(cited: DataFrame) -> DataFrame:
    """(chunk_id, component): component is the least chunk, as a string, of all that rows tie together, directly or through others.

    Chunks get numbers in string order first, so that hooking compares longs. A chunk cited alone is a component of one.
    """
    nodes = with_ordinal(cited.select("chunk_id").distinct(), [F.col("chunk_id")], "node")
    links = cited.select("record_number", "chunk_id").join(nodes, "chunk_id").select(F.col("record_number").alias("key"), "node")
    named = components(star_edges(links))
    cuts = Cuts(cited.sparkSession, "graph")
    # What follows reads it several times, and `named` is a join for each round.
    tied = cuts.cut(nodes.join(named, "node", "left").select("chunk_id", F.coalesce("component", "node").alias("c")))
    sizes = tied.groupBy("c").agg(F.count("*").alias("n")).join(nodes.select(F.col("node").alias("c"), F.col("chunk_id").alias("component")), "c")
    sizes, seen = cuts.measured(sizes, most=F.max("n"))
    return join_unique(tied, sizes, "c", "n", seen["most"]).select("chunk_id", "component")


def component_sizes(members: DataFrame) -> DataFrame:
    """(chunk_id, component, size) for components of two or more chunks."""
    sizes = members.groupBy("component").agg(F.count("*").alias("size")).where("size > 1")
    sizes, seen = Cuts(members.sparkSession, "graph").measured(sizes, most=F.coalesce(F.max("size"), F.lit(0)))
    return join_unique(members, sizes.withColumn("n", F.col("size")), "component", "n", seen["most"]).select("chunk_id", "component", "size")


def densities(members: DataFrame, weighted: DataFrame, fixed: bool = False) -> DataFrame:
    """(cluster, edge_density) for members (cluster, chunk_id): edges present among the pairs of a cluster, to four places.

    Edges are stored in chunk order but looked up in string order, as in the original definition, so that `d#9`-`d#10` is not found;
    `fixed` looks up both orders. Each edge meets the clusters of its source, then must meet the same cluster at its target: the
    pairs of a cluster are never made.
    """
    look_up = weighted.select("src", "dst")
    if not fixed:
        look_up = look_up.where("src < dst")
    sources = members.select("cluster", F.col("chunk_id").alias("src"))
    targets = members.select("cluster", F.col("chunk_id").alias("dst"))
    present = look_up.join(sources, "src").join(targets, ["cluster", "dst"]).groupBy("cluster").agg(F.count("*").alias("present"))
    sizes = members.groupBy("cluster").agg(F.count("*").alias("n"))
    ratio = F.coalesce("present", F.lit(0)) / (F.col("n") * (F.col("n") - 1) / 2)
    return sizes.join(present, "cluster", "left").select("cluster", F.when(F.col("n") > 1, F.round(ratio, 4)).otherwise(F.lit(0.0)).alias("edge_density"))
