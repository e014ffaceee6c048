"""Problem 8: filling fixed-capacity containers with items.

The lengths form a histogram of a bounded number of classes. Over it, the configuration linear program (fewest containers so
that the patterns chosen cover all items) is solved by multiplicative weights: the dearest pattern under the prices of the
moment comes from a knapsack dynamic program, prices fall with coverage. Every price vector also gives a lower bound (its total
over the dearest pattern), and the program stops when its rounded plan is within `gap` of the best bound. The solution is
rounded down, what is left is filled longest first. Only the histogram and the patterns reach the driver; items find their
container by their rank.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import Cuts
from .tokens import VOCABULARY, token_counts

GRID = 0.002  # relative width of a length class: the room lost to it is at most that share of an item; shorter lengths than 500 are exact
GAP = 0.002  # a plan this near to the lower bound is good enough
ROUNDS = 512  # of the averaged program, for any capacity
ETA = 3.0  # how fast prices fall with coverage
CELL_ITEMS = 200_000  # items that are ranked in one task


def class_bounds(lengths: np.ndarray, grid: float = GRID) -> np.ndarray:
    """Upper bounds of the length classes, each a length that occurs. A class spans at most the share `grid` of its bound."""
    bounds: list[int] = []
    for length in np.sort(lengths)[::-1]:
        if not bounds or length < bounds[-1] * (1 - grid):
            bounds.append(int(length))
    return np.array(bounds[::-1], np.int64)


def best_pattern(size: np.ndarray, price: np.ndarray, stock: np.ndarray, capacity: int) -> np.ndarray:
    """How many of each class the dearest container holds: a knapsack with at most `stock` of each, by dynamic programming."""
    value = np.zeros(capacity + 1, np.float32)
    parts, took = [], []
    for k in np.flatnonzero((stock > 0) & (price > 0)):
        left, chunk = min(int(stock[k]), capacity // int(size[k])), 1
        while left > 0:  # binary splitting of the multiplicity
            n = min(chunk, left)
            room = n * int(size[k])
            if room <= capacity:
                with_it, tail = value[: capacity + 1 - room] + np.float32(n * price[k]), value[room:]
                better = with_it > tail
                np.copyto(tail, with_it, where=better)
                parts.append((int(k), n, room))
                took.append(np.packbits(better))
            left -= n
            chunk *= 2
    out = np.zeros(len(size), np.int64)
    room = int(value.argmax())
    for (k, n, need), bits in zip(reversed(parts), reversed(took), strict=True):
        at = room - need
        if at >= 0 and bits[at >> 3] >> (7 - (at & 7)) & 1:
            out[k] += n
            room = at
    return out


@dataclass(frozen=True)
class Plan:
    patterns: list[tuple[np.ndarray, int]]  # (how many of each class, copies)
    bound: int  # no plan for these classes has fewer containers

    @property
    def containers(self) -> int:
        return sum(copies for _, copies in self.patterns)


class _Program:
    """The configuration program of one histogram: prices, coverage and the best lower bound so far."""

    def __init__(self, size: np.ndarray, count: np.ndarray, capacity: int):
        self.size, self.count, self.capacity = size, count, capacity
        self.volume = float((size * count).sum()) / capacity
        self.bound = int(np.ceil(self.volume - 1e-9))

    def pattern(self, ahead: np.ndarray, stock: np.ndarray) -> np.ndarray:
        """The dearest pattern when the coverage of each class is `ahead` of the others' (in shares of its items)."""
        price = self.size / self.capacity * np.exp(np.clip(-ETA * ahead, -30, 30)) * (self.count > 0)
        found = best_pattern(self.size, price, stock, self.capacity)
        if (stock >= np.minimum(self.count, self.capacity // self.size)).all():  # else the pattern is the dearest of fewer
            dearest = float((found * price).sum()) * 1.0001  # prices are added up in single precision
            self.bound = max(self.bound, int(np.ceil(float((price * self.count).sum()) / dearest - 1e-6)))
        return found

    def longest_first(self, left: np.ndarray) -> list[tuple[np.ndarray, int]]:
        """Patterns for what is left: each container takes the longest item that fits, again and again."""
        left, out = left.copy(), []
        while left.any():
            room, pattern, alive = self.capacity, np.zeros(len(left), np.int64), np.flatnonzero(left)
            top = len(alive)
            while (top := int(np.searchsorted(self.size[alive[:top]], room, side="right"))) > 0:
                k = alive[top - 1]
                pattern[k] = min(int(left[k]), room // int(self.size[k]))
                room -= int(pattern[k] * self.size[k])
                top -= 1
            copies = int((left[pattern > 0] // pattern[pattern > 0]).min())
            out.append((pattern, copies))
            left -= pattern * copies
        return out

    def shrinking(self, gap: float) -> list[tuple[np.ndarray, int]]:
        """Steps of many containers first, then of half as many and so on; a step never covers more than there is."""
        covered, used, chosen, step = np.zeros(len(self.size), np.int64), 0, [], max(1, int(self.volume / 64))
        while True:
            while ((stock := (self.count - covered) // step) > 0).any():
                pattern = self.pattern(covered / np.maximum(self.count, 1) - used / self.volume, stock)
                if (pattern * self.size).sum() < self.capacity * (1 - gap / 2):
                    break
                held = pattern > 0
                copies = min(step, int(((self.count - covered)[held] // pattern[held]).min()))
                covered += pattern * copies
                used += copies
                chosen.append((pattern, copies))
            if step == 1 or step * 8192 <= self.volume:
                return chosen + self.longest_first(self.count - covered)
            step = max(1, step // 2)

    def averaged(self, gap: float, rounds: int) -> list[tuple[np.ndarray, int]]:
        """Every round adds an equal share of its pattern; their number doubles until the rounded plan is near enough."""
        covered, pool, best, turns, t = np.zeros(len(self.size)), {}, None, 32, 0
        while True:
            for t in range(t, turns):
                pattern = self.pattern(covered / np.maximum(self.count, 1) - (t + 0.5) / turns, self.count)
                covered += pattern * (self.volume / turns)
                pool[pattern.tobytes()] = pool.get(pattern.tobytes(), 0.0) + self.volume / turns
            left, chosen = self.count.copy(), []
            for key, share in sorted(pool.items(), key=lambda x: (-x[1], x[0])):
                pattern = np.frombuffer(key, np.int64)
                held = pattern > 0
                copies = min(int(share), int((left[held] // pattern[held]).min()))
                if copies > 0:
                    left -= pattern * copies
                    chosen.append((pattern, copies))
            chosen += self.longest_first(left)
            if best is None or sum(c for _, c in chosen) < sum(c for _, c in best):
                best = chosen
            if sum(c for _, c in best) <= self.bound * (1 + gap) or turns >= rounds:
                return best
            covered, pool = covered / 2, {k: v / 2 for k, v in pool.items()}
            t, turns = turns, 2 * turns


def plan_patterns(size: np.ndarray, count: np.ndarray, capacity: int, gap: float = GAP, rounds: int = ROUNDS) -> Plan:
    """Patterns with copies that hold count[k] items of size[k] exactly, none above capacity.

    Shrinking steps come first; where their plan is farther than `gap` from the lower bound, the averaged program is run too
    and the better plan is taken.
    """
    size, count = size.astype(np.int64), count.astype(np.int64)
    if not count.sum():
        return Plan([], 0)
    program = _Program(size, count, capacity)
    program.pattern(np.zeros(len(size)), count)
    plans = [program.shrinking(gap)]
    if sum(c for _, c in plans[0]) > program.bound * (1 + gap):
        plans.append(program.averaged(gap, rounds))
    return Plan(min(plans, key=lambda p: sum(c for _, c in p)), program.bound)


def _slots(plan: Plan) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(key class << 40 | first rank, first container, items a container) of each run of slots, and the number of containers."""
    keys, first, per, used, base = [], [], [], {}, 0
    for pattern, copies in plan.patterns:
        for k in np.flatnonzero(pattern):
            at = used.get(int(k), 0)
            keys.append(int(k) << 40 | at)
            first.append(base)
            per.append(int(pattern[k]))
            used[int(k)] = at + int(pattern[k]) * copies
        base += copies
    order = np.argsort(np.array(keys, np.int64), kind="stable")
    return np.array(keys, np.int64)[order], np.array(first, np.int64)[order], np.array(per, np.int64)[order], base


def _ranked(cuts: Cuts, items: DataFrame, n: int) -> DataFrame:
    """items with `rank` from 0 within each class: ranks inside cells of a class, plus the cells before. No class meets in one task."""
    cells = max(4, -(-n // CELL_ITEMS))
    placed = cuts.cut(items.withColumn("cell", F.pmod(F.xxhash64("doc_id", "piece_no"), F.lit(cells))))
    before = Window.partitionBy("class").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("class", "cell").agg(F.count("*").alias("c")).select("class", "cell", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("class", "cell").orderBy("doc_id", "piece_no")
    return placed.withColumn("own", F.row_number().over(inside)).join(starts, ["class", "cell"]).withColumn("rank", (F.col("start") + F.col("own") - 1).cast("long"))


def pack(counts: DataFrame, capacity: int, kind: str, cuts: Cuts) -> DataFrame:
    """(container_kind, container_id, doc_id, piece_no, tokens) for counts (doc_id, tokens): every text, whole if it fits.

    A text longer than the capacity is cut into full pieces and the rest. Texts without tokens need no room and are listed
    in container 0. Equal lengths are told apart by doc_id; no texts give no rows.
    """
    whole = F.floor(F.col("tokens") / F.lit(capacity)).cast("long")
    rest = F.col("tokens") % F.lit(capacity)
    pieces = F.concat(F.transform(F.sequence(F.lit(1).cast("long"), whole), lambda i: F.lit(capacity).cast("long")), F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<bigint>")))
    pieces = F.when(whole > 0, pieces).otherwise(F.array(rest))
    items = counts.where("tokens > 0").select("doc_id", F.posexplode(pieces).alias("piece_no", "tokens"))
    histogram = items.groupBy("tokens").agg(F.count("*").alias("n")).collect()  # at most `capacity` rows
    lengths, numbers = (np.array([r[i] for r in histogram], np.int64) for i in (0, 1))
    bounds = class_bounds(lengths)
    count = np.bincount(np.searchsorted(bounds, lengths), weights=numbers, minlength=len(bounds)).astype(np.int64)
    plan = plan_patterns(bounds, count, capacity)
    keys, first, per, _ = _slots(plan)
    sent = counts.sparkSession.sparkContext.broadcast((bounds, keys, first, per))
    schema = T.StructType([T.StructField("container_kind", T.StringType()), T.StructField("container_id", T.LongType()), counts.schema["doc_id"], T.StructField("piece_no", T.IntegerType()), T.StructField("tokens", T.LongType())])

    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = np.searchsorted(sent.value[0], batch.column(2).to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(k, pa.int32())], names=[*batch.schema.names, "class"])

    def containers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, keys, first, per = sent.value
        for batch in batches:
            key = batch.column(3).to_numpy().astype(np.int64) << 40 | batch.column(4).to_numpy()
            at = np.searchsorted(keys, key, side="right") - 1
            where = first[at] + (key - keys[at]) // per[at]
            kinds = pa.array([kind] * len(key), pa.string())
            yield pa.RecordBatch.from_arrays([kinds, pa.array(where), *batch.columns[:3]], names=schema.names)

    with_class = items.select("doc_id", F.col("piece_no").cast("int").alias("piece_no"), "tokens").mapInArrow(classes, T.StructType([*schema.fields[2:], T.StructField("class", T.IntegerType())]))
    ranked = _ranked(cuts, with_class, int(count.sum())).select("doc_id", "piece_no", "tokens", "class", "rank")
    empty = counts.where("tokens = 0").select(F.lit(kind).alias("container_kind"), F.lit(0).cast("long").alias("container_id"), "doc_id", F.lit(0).alias("piece_no"), F.lit(0).cast("long").alias("tokens"))
    return ranked.mapInArrow(containers, schema).unionByName(empty)


def pack_all(documents: DataFrame, capacities: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """The packing of documents (doc_id, text) for each row (container_kind, capacity_tokens) of a fixed table. Null and non-positive capacities are left out; without any the result is empty."""
    cuts = Cuts(documents.sparkSession, "packing")
    counts = cuts.cut(token_counts(documents.select("doc_id", "text"), vocabulary=vocabulary))
    out = None
    for kind, capacity in capacities.where("capacity_tokens > 0").select("container_kind", "capacity_tokens").distinct().orderBy("capacity_tokens", "container_kind").collect():
        packed = pack(counts, int(capacity), kind, cuts)
        out = packed if out is None else out.unionByName(packed)
    if out is None:
        return counts.limit(0).select(F.lit("").alias("container_kind"), F.lit(0).cast("long").alias("container_id"), "doc_id", F.lit(0).alias("piece_no"), "tokens")
    return out


def room_used(packed: DataFrame, capacities: DataFrame) -> DataFrame:
    """(container_kind, capacity_tokens, containers, tokens, least_containers, gap, share_used).

    least_containers is what the tokens alone would need, a lower bound of any packing; gap is how much more than that were used.
    """
    used = packed.where("tokens > 0").groupBy("container_kind", "container_id").agg(F.sum("tokens").alias("t")).groupBy("container_kind").agg(F.count("*").alias("containers"), F.sum("t").alias("tokens"))
    both = used.join(F.broadcast(capacities.select("container_kind", "capacity_tokens").distinct()), "container_kind")
    least = F.ceil(F.col("tokens") / F.col("capacity_tokens"))
    share = F.round(F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")), 4)
    return both.select("container_kind", "capacity_tokens", "containers", "tokens", least.alias("least_containers"), F.round(F.col("containers") / least - 1, 4).alias("gap"), share.alias("share_used"))
