"""Problem 9: mixing sources to target weights.

The tokens of each source are packed into blocks of fixed length. Every output shard draws its source counts from a multinomial
distribution; small repairs make the totals meet the quotas exactly. Shards always have one size; they are drawn in two steps, the
counts of groups of shards on the driver, those of the shards inside the task of their group, so that any number of them can be drawn. Slot j of a source takes block p(j mod blocks), p being a
pseudorandom permutation of each pass through the source, so no block comes a second time before all have come once. Slots and
blocks are joined by index.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import Cuts
from .codepoints import mix
from .tokens import VOCABULARY, token_counts

BLOCK_TOKENS = 256
SHARD_SLOTS = 1024
GROUP_SHARDS = 1024  # shards that one task draws and fills; a trillion tokens are some four thousand groups
BATCH_ROWS = 1 << 16
CELL_DOCUMENTS = 100_000


def permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of range(n), by key: a four-round Feistel network, walked until it falls inside the range."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> np.uint64(half), out[todo] & low
        for round_ in range(4):
            left, right = right, left ^ (mix(right + np.uint64((key * 4 + round_) % (1 << 63))) & low)
        out[todo] = left << np.uint64(half) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def blocks_of(cuts: Cuts, counts: DataFrame, block_tokens: int) -> DataFrame:
    """(source, block, doc_id, token_from, tokens): which part of which document stands in each block.

    Documents follow each other in an order by hash. Offsets are sums inside cells plus the cells before, so that a source of
    any size is spread over tasks.
    """
    n = counts.count()
    cells = max(4, -(-n // CELL_DOCUMENTS))
    placed = counts.withColumn("cell", F.pmod(F.xxhash64("doc_id"), F.lit(cells)))
    before = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("source", "cell").agg(F.sum("tokens").alias("t")).select("source", "cell", F.coalesce(F.sum("t").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("source", "cell").orderBy("doc_id").rowsBetween(Window.unboundedPreceding, -1)
    at = placed.withColumn("own", F.coalesce(F.sum("tokens").over(inside), F.lit(0))).join(starts, ["source", "cell"]).withColumn("at", F.col("start") + F.col("own"))
    size = F.lit(block_tokens).cast("long")
    spread = F.explode(F.sequence(F.floor(F.col("at") / size), F.floor((F.col("at") + F.col("tokens") - 1) / size))).alias("block")
    cut = at.select("source", "doc_id", "at", "tokens", spread)
    start = F.greatest(F.col("block") * size, F.col("at"))
    end = F.least((F.col("block") + 1) * size, F.col("at") + F.col("tokens"))
    return cut.select("source", "block", "doc_id", (start - F.col("at")).alias("token_from"), (end - start).alias("tokens"))


def quotas(share: np.ndarray, repeats: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """Slots of each source: the most that keep the shares while no source is passed through more than `repeats` times."""
    usable = (share > 0) & (blocks > 0) & (repeats > 0)
    weight = np.where(usable, share, 0)
    if not weight.sum():
        return np.zeros(len(share), np.int64)
    weight = weight / weight.sum()
    cap = repeats * blocks
    total = np.floor((cap[usable] / weight[usable]).min() + 1e-9)
    exact = weight * total
    out = np.minimum(np.floor(exact + 1e-9).astype(np.int64), cap)
    for k in np.argsort(-(exact - out), kind="stable")[: int(total - out.sum())]:
        if out[k] < cap[k] and usable[k]:
            out[k] += 1
    return out


def shard_counts(quota: np.ndarray, slots: int, seed: int | tuple[int, ...]) -> np.ndarray:
    """(shard, source) counts: a multinomial draw for each shard, repaired by single moves until every source meets its quota."""
    total = int(quota.sum())
    if not total:
        return np.zeros((1, len(quota)), np.int64)
    shards = max(1, -(-total // slots))
    sizes = np.full(shards, slots)
    sizes[-1] = total - slots * (shards - 1)
    rng = np.random.default_rng(seed)
    drawn = rng.multinomial(sizes, quota / max(total, 1)).astype(np.int64)
    surplus = drawn.sum(0) - quota
    while (surplus > 0).any():
        s, t = int(surplus.argmax()), int(surplus.argmin())
        moves = int(min(surplus[s], -surplus[t]))
        give = np.flatnonzero(drawn[:, s])
        at = rng.permutation(give)[:moves]
        drawn[at, s] -= 1
        drawn[at, t] += 1
        surplus[s] -= len(at)
        surplus[t] += len(at)
    return drawn


def mixture(documents: DataFrame, targets: DataFrame, *, block_tokens: int = BLOCK_TOKENS, shard_slots: int = SHARD_SLOTS, group_shards: int = GROUP_SHARDS, seed: int = 5, vocabulary: str = VOCABULARY) -> DataFrame:
    """(shard, position, source, block, repeat_no, doc_id, token_from, tokens): the parts of documents in each slot of the mixture.

    targets: source, target_share, max_repeats, a fixed table with one row a source. Documents of other or null sources and
    without tokens are in no block. The total is the largest at which each source holds its share and none is repeated
    beyond max_repeats; sources that have no document leave their share to the others. repeat_no counts from 1.
    """
    spark = documents.sparkSession
    cuts = Cuts(spark, "mixing")
    wanted = [r for r in targets.where("source is not null").select("source", "target_share", "max_repeats").orderBy("source").collect()]
    names = [r[0] for r in wanted]
    chosen = documents.select("doc_id", "source", "text").join(F.broadcast(targets.select("source").distinct()), "source", "left_semi")
    counts = cuts.cut(token_counts(chosen, vocabulary=vocabulary).where("tokens > 0"))
    blocks = cuts.cut(blocks_of(cuts, counts, block_tokens))
    held = {r[0]: r[1] for r in blocks.groupBy("source").agg(F.max("block") + 1).collect()}  # a row for each source of targets at most
    share = np.array([r[1] or 0.0 for r in wanted], float)
    size = np.array([held.get(s, 0) for s in names], np.int64)
    quota = quotas(share, np.array([r[2] or 0 for r in wanted], np.int64), size)
    groups = shard_counts(quota, shard_slots * group_shards, seed)
    starts = np.cumsum(groups, axis=0) - groups
    rows = [(g, groups[g].tolist(), starts[g].tolist()) for g in range(len(groups))] if quota.sum() else []

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g, counts, first in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                drawn = shard_counts(np.array(counts, np.int64), shard_slots, (seed, g))
                shard, source, block, turn = [], [], [], []
                for s in np.flatnonzero(counts):
                    j = first[s] + np.arange(counts[s])
                    passes, index = j // size[s], j % size[s]
                    for e in np.unique(passes):
                        index[passes == e] = permuted(index[passes == e], int(size[s]), int(seed * 1_000_003 + s * 1009 + e))
                    shard.append(np.repeat(np.arange(len(drawn)), drawn[:, s]))
                    source.append(np.full(len(j), s))
                    block.append(index)
                    turn.append(passes + 1)
                shard, source, block, turn = (np.concatenate(x) for x in (shard, source, block, turn))
                # Slots of a shard come in a random order.
                order = np.lexsort((np.random.default_rng((seed, g, 1)).random(len(shard)), shard))
                shard, source, block, turn = (x[order] for x in (shard, source, block, turn))
                position = np.arange(len(shard)) - np.searchsorted(shard, shard)
                named = pa.array(names, pa.string()).take(pa.array(source))
                columns = [pa.array(shard + g * group_shards), pa.array(position), named, pa.array(block), pa.array(turn.astype(np.int32))]
                whole = pa.RecordBatch.from_arrays(columns, names=["shard", "position", "source", "block", "repeat_no"])
                yield from (whole.slice(k, BATCH_ROWS) for k in range(0, len(shard), BATCH_ROWS))

    drawn_groups = spark.createDataFrame(rows, "g long, counts array<long>, first array<long>").repartition(max(1, min(len(rows), 4096)), "g")
    placed = drawn_groups.mapInArrow(fill, "shard long, position long, source string, block long, repeat_no int")
    return placed.join(blocks, ["source", "block"]).select("shard", "position", "source", "block", "repeat_no", "doc_id", "token_from", "tokens")


def shares_reached(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, max_repeats, tokens, share, most_repeats) of every target source; 0 where it is not in the mixture."""
    got = mixed.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.max("repeat_no").alias("most_repeats"))
    both = targets.select("source", "target_share", "max_repeats").join(got, "source", "left").select("source", "target_share", "max_repeats", F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"))
    total = Window.partitionBy()
    return both.select("source", "target_share", "max_repeats", "tokens", F.round(F.col("tokens") / F.greatest(F.sum("tokens").over(total), F.lit(1)), 6).alias("share"), "most_repeats")
