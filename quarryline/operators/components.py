"""Connected components of a graph of any size: deterministic Borůvka hooking.

Each round, every component takes its smallest outgoing edge, by (smaller end, larger end), and hooks to the component at
its other end. As all compare edges by one strict order, the only cycles are two components that chose the same edge; the
smaller of them becomes the root. Pointer doubling then collapses the trees, edges are relabelled, and loops and repeats drop
out. Every round at least halves the components that still have edges. Nothing is gathered on the driver but counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import Cuts
from .skew import join_unique


SALTS = 1024  # parts that the nodes of one key are tied in first


def _hook(edges: DataFrame) -> DataFrame:
    """(node, up): the other end of each node's smallest edge. The minimum is taken on the map side first."""
    both = edges.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("other")), F.struct(F.col("b").alias("node"), F.col("a").alias("other")))).alias("e")).select("e.*")
    key = F.struct(F.least("node", "other").alias("lo"), F.greatest("node", "other").alias("hi"))
    chosen = both.groupBy("node").agg(F.min(key).alias("k"))
    return chosen.select("node", (F.col("k.lo") + F.col("k.hi") - F.col("node")).alias("up"))


def _collapse(cuts: Cuts, chosen: DataFrame) -> DataFrame:
    """Pointer doubling, until every node points to its root; of two nodes that chose one edge, the smaller is the root.

    Both sides of each join are shuffles of a written table, so that adaptive execution can split the tasks of a hub.
    """
    back = chosen.select(F.col("node").alias("up"), F.col("up").alias("back"))
    root = (F.col("back") == F.col("node")) & (F.col("node") < F.col("up"))
    trees = cuts.cut(chosen.join(back, "up").select("node", F.when(root, F.col("node")).otherwise(F.col("up")).alias("up")))
    cuts.drop(chosen)
    while True:
        above = trees.select(F.col("node").alias("up"), F.col("up").alias("top"))
        doubled, seen = cuts.measured(trees.join(above, "up").select("node", F.col("top").alias("up"), (F.col("top") != F.col("up")).alias("moved")), moved=F.max("moved"))
        cuts.drop(trees)
        trees = doubled.select("node", "up")
        trees._cut_path = doubled._cut_path
        if not seen["moved"]:
            return trees


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b) of longs; component is the smallest node tied to it.

    Loops, repeats and both directions of an edge are allowed; an edge with a null end ties nothing; a node with loops only is
    its own component. No edges give no rows. Other columns are ignored.
    """
    cuts = Cuts(edges.sparkSession, "components")
    clean = edges.where("a is not null and b is not null")
    proper = F.max(F.col("a") != F.col("b"))
    every, seen = cuts.measured(clean.select(F.least("a", "b").cast("long").alias("a"), F.greatest("a", "b").cast("long").alias("b")).distinct(), live=proper, loops=F.max(F.col("a") == F.col("b")))
    some_loops = seen["loops"]
    live, maps = every.where("a <> b"), []
    while seen["live"]:
        trees = _collapse(cuts, cuts.cut(_hook(live)))
        # A component is named by its smallest member, which every earlier name already is for its own members.
        least, figures = cuts.measured(trees.groupBy("up").agg(F.min("node").alias("name"), F.count("*").alias("n")), most=F.max("n"))
        names = cuts.cut(join_unique(trees, least, "up", "n", figures["most"]).select("node", "name"))
        maps.append(names)
        a, b = (names.select(F.col("node").alias(x), F.col("name").alias(f"to_{x}")) for x in "ab")
        moved = live.join(a, "a").join(b, "b").select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b"))
        nxt, seen = cuts.measured(moved.where("a <> b").distinct(), live=proper)
        if len(maps) > 1:
            cuts.drop(live)
        live = nxt
    # From the last and smallest map back to the first: each is resolved once.
    final = None
    for names in reversed(maps):
        if final is not None:
            later = final.select(F.col("node").alias("name"), F.col("component"))
            final = names.join(later, "name", "left").select("node", F.coalesce("component", "name").alias("component"))
        else:
            final = names.select("node", F.col("name").alias("component"))
    if final is not None and not some_loops:
        return final
    loops = every.where("a = b").select(F.col("a").alias("node"))
    if final is None:
        return loops.select("node", F.col("node").alias("component"))
    alone = loops.join(final, "node", "left_anti").select("node", F.col("node").alias("component"))
    return final.unionByName(alone)


def star_edges(links: DataFrame, salts: int = SALTS) -> DataFrame:
    """Edges (a, b) for links (key, node): the nodes of each key are tied to the least of their salt, those leasts to the least of the key.

    One edge a link at most, never all pairs of a key; a hot key is spread over as many tasks as there are salts. A node alone
    in its key gives none.
    """
    salted = Window.partitionBy("key", "salt")
    local = links.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(salts))).withColumn("least", F.min("node").over(salted)).select("key", "salt", "node", "least")
    heads = local.where("node = least").select("key", "node").distinct().withColumn("least", F.min("node").over(Window.partitionBy("key"))).where("node <> least")
    return local.where("node <> least").select(F.col("least").alias("a"), F.col("node").alias("b")).unionByName(heads.select(F.col("least").alias("a"), F.col("node").alias("b")))
