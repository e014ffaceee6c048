"""Problem 4: consolidating pairwise matches into groups, by deterministic Borůvka hooking (operators.components)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.chunks import canonical_ref
from ..operators.components import components, star_edges


def row_groups(rows: DataFrame, key: str = "record_number", refs: str = "chunk_ids") -> DataFrame:
    """(group_record, member_record): rows that hold one chunk reference are tied, directly or through others.

    group_record is the smallest key of the group, member_record each other one. Null and malformed references tie nothing;
    a reference repeated in its row counts once; rows tied to none are left out.
    """
    links = rows.select(F.col(key).cast("long").alias("node"), F.explode(refs).alias("ref")).select("node", canonical_ref(F.col("ref")).alias("key")).where("key is not null").distinct()
    found = components(star_edges(links))
    return found.where("node <> component").select(F.col("component").alias("group_record"), F.col("node").alias("member_record"))
