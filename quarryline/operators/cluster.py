"""Candidate evidence clusters of five kinds, from citation metadata alone.

Each builder returns members (group key, split key, chunk) and the rows that touch each split; clusters are assembled from both
by grouping. Arrays of a cluster hold at most its chunks; its rows stay a table (cluster, train_key).
"""

from __future__ import annotations

import functools
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.chunks import ref_doc, ref_index
from ..functions.text import normalized_question
from ..runtime import Cuts
from ..sources.training import citations
from . import graph
from .ordinals import with_ordinal
from .skew import join_unique

MAX_CHUNKS = 30
MAX_GAP = 3
# The kinds in build order, with the prefix of their ids.
KINDS = {"exact_evidence_set": "exact", "doc_set": "docset", "co_citation": "cocite", "doc_local_seen_chunks": "doclocal", "multi_doc_bridge": "multidoc"}


@dataclass(frozen=True)
class Built:
    """members: group, split, chunk_id (distinct); rows: group, split, record_number (distinct); order columns are in `splits`."""

    kind: str
    members: DataFrame
    rows: DataFrame
    group_rows: DataFrame | None = None  # group, group_rows: where groups are ordered by their rows


def _split_keys(members: DataFrame, max_chunks: int) -> DataFrame:
    """members (group, chunk_id, doc_id, chunk_index) with `split` and `group_size`: one split up to max_chunks, else slices of max_chunks by document.

    Given back as a table, as members, sizes and the rows that touch them are read several times and plans would multiply.
    """
    cuts = Cuts(members.sparkSession, "clusters")
    members = cuts.cut(members)
    sizes, seen = cuts.measured(members.groupBy("group").agg(F.count("*").alias("group_size")), most=F.coalesce(F.max("group_size"), F.lit(0)))
    sized = join_unique(members, sizes.withColumn("n", F.col("group_size")), "group", "n", seen["most"])
    rn = F.row_number().over(Window.partitionBy("group", "doc_id").orderBy("chunk_index", "chunk_id"))
    small = sized.where(F.col("group_size") <= max_chunks).withColumn("split", F.struct(F.lit("").alias("doc"), F.lit(0).cast("long").alias("slice")))
    large = sized.where(F.col("group_size") > max_chunks).withColumn("split", F.struct(F.col("doc_id").alias("doc"), F.floor((rn - 1) / max_chunks).cast("long").alias("slice")))
    out = cuts.cut(small.unionByName(large))
    for used in (members, sizes):
        cuts.drop(used)
    return out


def _touching(split: DataFrame, cited: DataFrame, on: list[str]) -> DataFrame:
    """(group, split, record_number): the rows that cite a chunk of the split."""
    return split.select("group", "split", "chunk_id").join(cited.select("record_number", *on), on).select("group", "split", "record_number").distinct()


def _row_numbers(rows: DataFrame, signature: str) -> DataFrame:
    return rows.groupBy(F.to_json(signature).alias("group")).agg(F.count("*").alias("group_rows"))


def build(rows: DataFrame, kind: str, *, max_chunks: int = MAX_CHUNKS, max_gap: int = MAX_GAP) -> Built:
    """The members and rows of each cluster of a kind, over rows that are no duplicates."""
    cited = citations(rows, "evidence_signature", "doc_set_signature")
    if kind == "exact_evidence_set":
        keyed = rows.where(F.size("evidence_signature") > 0).select("record_number", F.to_json("evidence_signature").alias("group"), "evidence_signature")
        whole = F.struct(F.lit("").alias("doc"), F.lit(0).cast("long").alias("slice")).alias("split")
        members = keyed.select("group", "evidence_signature").distinct().select("group", whole, F.explode("evidence_signature").alias("chunk_id")).withColumn("group_size", F.lit(0).cast("long"))
        return Built(kind, members, keyed.select("group", whole, "record_number"), _row_numbers(rows, "evidence_signature"))
    if kind in ("doc_set", "multi_doc_bridge"):
        least = 1 if kind == "multi_doc_bridge" else 0
        keyed = cited.where(F.size("doc_set_signature") > least).withColumn("group", F.to_json("doc_set_signature"))
        members = _split_keys(keyed.select("group", "chunk_id", "doc_id", "chunk_index").distinct(), max_chunks)
        return Built(kind, members, _touching(members, keyed, ["group", "chunk_id"]), _row_numbers(rows, "doc_set_signature"))
    if kind == "co_citation":
        tied = graph.component_sizes(graph.chunk_components(cited)).select(F.col("component").alias("group"), "chunk_id")
        members = _split_keys(tied.select("group", "chunk_id", ref_doc(F.col("chunk_id")).alias("doc_id"), ref_index(F.col("chunk_id")).alias("chunk_index")), max_chunks)
        return Built(kind, members, _touching(members, cited, ["chunk_id"]))
    if kind == "doc_local_seen_chunks":
        seen = gap_groups(cited, max_gap)
        sizes = seen.groupBy("group").agg(F.count("*").alias("n")).where("n > 1").select("group")
        members = _split_keys(seen.join(sizes, "group"), max_chunks)
        return Built(kind, members, _touching(members, cited, ["chunk_id"]))
    raise ValueError(kind)


def gap_groups(cited: DataFrame, max_gap: int = MAX_GAP) -> DataFrame:
    """(group, chunk_id, doc_id, chunk_index): the chunks of a document in order of index, a new group after each gap above max_gap."""
    chunks = cited.select("chunk_id", "doc_id", "chunk_index").distinct()
    order = Window.partitionBy("doc_id").orderBy("chunk_index", "chunk_id")
    gap = F.col("chunk_index") - F.lag("chunk_index").over(order)
    breaks = ((F.col("chunk_index") >= 0) & (gap > max_gap)).cast("long")
    numbered = chunks.withColumn("_b", F.coalesce(breaks, F.lit(0))).withColumn("_g", F.sum("_b").over(order))
    return numbered.select(F.to_json(F.struct("doc_id", "_g")).alias("group"), "chunk_id", "doc_id", "chunk_index")


def _assembled(cuts: Cuts, built: Built, rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(clusters, members, seeds) of one kind, keyed by (group, split)."""
    key = ["group", "split"]
    members = built.members if hasattr(built.members, "_cut_path") else cuts.cut(built.members.select(*key, "chunk_id", "group_size"))
    listed = F.array_sort(F.collect_list(F.struct(ref_doc(F.col("chunk_id")).alias("doc_id"), ref_index(F.col("chunk_id")).alias("chunk_index"), "chunk_id"))).alias("c")
    sets = members.groupBy(*key).agg(listed, F.max("group_size").alias("group_size"))
    sets = sets.select(*key, F.transform("c", lambda x: x["chunk_id"]).alias("chunk_ids"), F.array_sort(F.array_distinct(F.transform("c", lambda x: x["doc_id"]))).alias("doc_ids"), "group_size")
    if built.kind in ("doc_set", "doc_local_seen_chunks"):
        sets = sets.where(F.size("chunk_ids") > 1)
    if built.kind == "multi_doc_bridge":
        sets = sets.where(F.size("doc_ids") > 1)
    touched = cuts.cut(built.rows.join(rows.select("record_number", "key", "pipeline", "question_key"), "record_number"))
    seeds = touched.select(*key, "key").distinct()
    counts = seeds.groupBy(*key).agg(F.count("*").alias("row_count"))
    questions = touched.where("question_key is not null").select(*key, "question_key").distinct().groupBy(*key).agg(F.count("*").alias("unique_question_count"))
    sources = touched.where("pipeline <> ''").select(*key, "pipeline").distinct().groupBy(*key).agg(F.array_sort(F.collect_list("pipeline")).alias("source_pipelines"))
    out = sets.join(counts, key).join(questions, key, "left").join(sources, key, "left")
    out = out.join(built.group_rows, "group") if built.group_rows is not None else out.withColumn("group_rows", F.lit(0).cast("long"))
    return out.withColumn("unique_question_count", F.coalesce("unique_question_count", F.lit(0))), members, seeds


def _split_from(kind: str) -> Column:
    many = F.col("splits") > 1
    if kind == "doc_local_seen_chunks":
        return F.when(F.col("group_size") > F.size("chunk_ids"), F.lit("doc_local_large_group"))
    names = {"doc_set": "large_doc_set", "co_citation": "large_co_citation_component", "multi_doc_bridge": "large_multi_doc_bridge"}
    return F.when(many, F.lit(names[kind])) if kind in names else F.lit(None).cast("string")


def _of_kind(cuts: Cuts, live: DataFrame, at: int, kind: str, max_chunks: int, max_gap: int) -> tuple[DataFrame, DataFrame]:
    """(clusters of one kind with the columns that order them, their seeds by group and split)."""
    built = build(live, kind, max_chunks=max_chunks, max_gap=max_gap)
    out, members, seeds = _assembled(cuts, built, live)
    per_group = members.select("group", "split").distinct().groupBy("group").agg(F.count("*").alias("splits"))
    sized = members.select("group", "chunk_id").distinct().groupBy("group").agg(F.count("*").alias("group_chunks")) if kind == "co_citation" else None
    out = out.join(per_group, "group")
    if sized is not None:
        # A component is ordered by size, then by its least member, which no other component has.
        out = out.join(sized.select("group", "group_chunks"), "group").withColumn("rank", F.struct((-F.col("group_chunks")).alias("size"), F.col("group").alias("name")))
    elif kind == "doc_local_seen_chunks":
        group = F.from_json("group", "doc_id string, _g long")
        out = out.withColumn("rank", F.struct(group["_g"].alias("size"), group["doc_id"].alias("name")))
    else:
        out = out.withColumn("rank", F.struct((-F.col("group_rows")).alias("size"), F.lit("").alias("name")))
    signature = F.from_json("group", "array<string>") if kind in ("exact_evidence_set", "doc_set", "multi_doc_bridge") else F.array().cast("array<string>")
    first = F.col("rank.name") if kind == "doc_local_seen_chunks" else F.lit("")
    part = out.select(
        F.lit(at).alias("kind_at"),
        first.alias("by_name"),
        F.col("rank.size").alias("by_size"),
        F.when(F.lit(kind == "co_citation"), F.col("rank.name")).otherwise(F.lit("")).alias("by_member"),
        signature.alias("by_signature"),
        "split",
        "group",
        F.lit(kind).alias("cluster_kind"),
        "chunk_ids",
        "doc_ids",
        F.coalesce("source_pipelines", F.array().cast("array<string>")).alias("source_pipelines"),
        _split_from(kind).alias("split_from"),
        "row_count",
        "unique_question_count",
    )
    keyed = seeds.select(F.lit(kind).alias("cluster_kind"), "group", "split", "key")
    part = cuts.cut(part)  # plans stay small, and the sort below reads a table
    return part, keyed


def clusters(rows: DataFrame, *, max_chunks: int = MAX_CHUNKS, max_gap: int = MAX_GAP, kinds: tuple[str, ...] = tuple(KINDS), fixed_density: bool = False) -> tuple[DataFrame, DataFrame]:
    """(clusters, seeds) of training rows. seeds: cluster_id, train_key.

    clusters: cluster_id, cluster_kind, chunk_ids, doc_ids, source_pipelines, split_from, row_count, unique_question_count,
    chunk_count, doc_count, edge_density. Rows marked as duplicates take no part. Ids number the clusters of all kinds in build
    order, ties resolved by signature; row_count counts distinct train keys. Kinds that are left out consume no numbers.
    """
    cuts = Cuts(rows.sparkSession, "clusters")
    # Questions travel as 128 bits of their normal form, which is made once a row, and train keys as 128 bits: as text they would fill the disk.
    asked = F.when(F.col("question") != "", F.unhex(F.md5(normalized_question(F.col("question")))))
    live = cuts.cut(rows.where("not is_dup").select("record_number", "train_key", F.unhex(F.md5("train_key")).alias("key"), "pipeline", "evidence_signature", "doc_set_signature", asked.alias("question_key")))
    # The kinds do not depend on each other: their many small jobs share the executors.
    with ThreadPoolExecutor(len(KINDS) + 1) as pool:
        edges = pool.submit(lambda: cuts.cut(graph.edges(citations(live))))
        made = [pool.submit(_of_kind, cuts, live, at, kind, max_chunks, max_gap) for at, kind in enumerate(KINDS) if kind in kinds]
        parts, weighted = [m.result() for m in made], edges.result()
    found, tied = (functools.reduce(DataFrame.unionByName, side) for side in zip(*parts, strict=True))
    numbered = with_ordinal(found, [F.col(c) for c in ("kind_at", "by_name", "by_size", "by_member", "by_signature", "split")])
    prefix = F.element_at(F.create_map(*[F.lit(x) for pair in KINDS.items() for x in pair]), F.col("cluster_kind"))
    numbered = cuts.cut(numbered.withColumn("cluster_id", F.format_string("eqg_%s_%06d", prefix, "ordinal")))
    members = numbered.select(F.col("cluster_id").alias("cluster"), F.explode("chunk_ids").alias("chunk_id"))
    dense = graph.densities(members, weighted, fixed_density)
    whole = numbered.join(dense, F.col("cluster_id") == F.col("cluster")).select(
        "cluster_id", "cluster_kind", "ordinal", "chunk_ids", "doc_ids", "source_pipelines", "split_from", "row_count", "unique_question_count", F.size("chunk_ids").alias("chunk_count"), F.size("doc_ids").alias("doc_count"), "edge_density"
    )
    seeds = tied.join(numbered.select("cluster_id", "cluster_kind", "group", "split"), ["cluster_kind", "group", "split"]).select("cluster_id", "key")
    seeds = seeds.join(live.select("key", "train_key").distinct(), "key").select("cluster_id", "train_key")
    return whole, seeds


def focused(found: DataFrame, seeds: DataFrame, focus: DataFrame) -> DataFrame:
    """The clusters with a seed among the focus keys (train_key). Ids stay as they are."""
    touched = seeds.join(focus.select("train_key").distinct(), "train_key", "left_semi").select("cluster_id").distinct()
    return found.join(touched, "cluster_id", "left_semi")


def final_order(found: DataFrame, limit: int | None = None) -> DataFrame:
    """Kind, most rows, most chunks, id; cut to limit where one is given."""
    ordered = found.orderBy("cluster_kind", F.desc("row_count"), F.desc("chunk_count"), "cluster_id")
    return ordered.limit(limit) if limit is not None else ordered


def kind_summary(found: DataFrame) -> DataFrame:
    """(cluster_kind, split_from, clusters, chunks, rows)."""
    return found.groupBy("cluster_kind", F.coalesce("split_from", F.lit("")).alias("split_from")).agg(F.count("*").alias("clusters"), F.sum("chunk_count").alias("chunks"), F.sum("row_count").alias("rows"))
