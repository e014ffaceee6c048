"""Constrained selection of work units: round-robin over kinds, or greedy coverage of chunks, both under a cap for each document.

The choice is sequential by nature, the ranking is not: Spark sorts the units, the driver reads the sorted stream partition by
partition and keeps only what it has selected (and, for coverage, units whose gain has to be looked at again).
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from ..runtime import Cuts

MAX_PER_DOC = 2


def _stream(df: DataFrame, *order) -> Iterator[Row]:
    return df.orderBy(*order).toLocalIterator(prefetchPartitions=False)


def select_balanced(units: DataFrame, *, limit: int, max_per_doc: int = MAX_PER_DOC) -> list[str]:
    """assignment_ids in order of selection: kinds take turns in alphabetical order, each giving its best admissible unit.

    A unit whose chunk set is taken or one of whose documents is at its cap is dropped for good.
    """
    cuts = Cuts(units.sparkSession, "select")
    cards = cuts.cut(units.select("assignment_id", "cluster_kind", F.array_sort("chunk_ids").alias("chunks"), "doc_ids", "row_count", "prompt_chars"))
    order = (F.when(F.size("doc_ids") > 1, 0).otherwise(1), F.abs(4 - F.size("chunks")), -F.least("row_count", F.lit(8)), "prompt_chars", "assignment_id")
    kinds = [r[0] for r in cards.select("cluster_kind").distinct().orderBy("cluster_kind").collect()]
    streams = {k: _stream(cards.where(F.col("cluster_kind") == k), *order) for k in kinds}
    chosen, taken, used = [], set(), Counter()
    while len(chosen) < limit and streams:
        moved = False
        for kind in list(streams):
            for card in streams[kind]:
                key = tuple(card.chunks)
                if key in taken or any(used[d] >= max_per_doc for d in card.doc_ids):
                    continue
                chosen.append(card.assignment_id)
                taken.add(key)
                used.update(card.doc_ids)
                moved = True
                break
            else:
                del streams[kind]
            if len(chosen) >= limit:
                break
        if not moved:
            break
    return chosen


class _Gains:
    """Units by (gain, score, order), best first, gains looked up when a unit is reached: a gain can only shrink."""

    def __init__(self, stream: Iterator[Row], covered: set[str]):
        self.stream, self.covered, self.heap = stream, covered, []
        self.ahead = next(stream, None)

    def _gain(self, card: Row) -> int:
        return sum(c not in self.covered for c in card.chunks)

    def _fill(self) -> None:
        # The next of the stream has at most as many new chunks as it has chunks.
        while self.ahead is not None and (not self.heap or (-len(self.ahead.chunks), -self.ahead.score, self.ahead.ordinal) <= self.heap[0][:3]):
            card = self.ahead
            heapq.heappush(self.heap, (-self._gain(card), -card.score, card.ordinal, card))
            self.ahead = next(self.stream, None)

    def pop(self) -> tuple[int, Row] | None:
        while True:
            self._fill()
            if not self.heap:
                return None
            gain, rank, at, card = heapq.heappop(self.heap)
            now = -self._gain(card)
            if now == gain:
                return -gain, card
            heapq.heappush(self.heap, (now, rank, at, card))


def select_coverage(units: DataFrame, *, limit: int, max_per_doc: int = MAX_PER_DOC, threshold: float = 0.98) -> list[str]:
    """assignment_ids in order of selection, by new chunks covered, then score, then ordinal.

    First every kind gets its floor, ranked by the coverage at its turn; then the greatest gain is taken until all but a share of
    1 - threshold of the chunks is covered; then the best of the rest fill up. Units at a document's cap are passed over.
    """
    cuts = Cuts(units.sparkSession, "select")
    cards = cuts.cut(units.select("assignment_id", "cluster_kind", F.array_distinct("chunk_ids").alias("chunks"), "doc_ids", "score", "ordinal"))
    order = (-F.size("chunks"), F.desc("score"), "ordinal")
    total = cards.select(F.explode("chunks").alias("c")).distinct().count()
    pool = {r[0]: r[1] for r in cards.groupBy("cluster_kind").count().orderBy("cluster_kind").collect()}
    n_cards = sum(pool.values())
    covered: set[str] = set()
    chosen: dict[str, None] = {}
    used: Counter = Counter()

    def admissible(card: Row) -> bool:
        return card.assignment_id not in chosen and all(used[d] < max_per_doc for d in card.doc_ids)

    def take(card: Row) -> None:
        chosen[card.assignment_id] = None
        covered.update(card.chunks)
        used.update(card.doc_ids)

    for kind, n in pool.items():
        floor, added = max(3, int(n * limit / max(1, n_cards))), 0
        gains = _Gains(_stream(cards.where(F.col("cluster_kind") == kind), *order), set(covered))
        while added < floor and len(chosen) < limit and (best := gains.pop()) is not None:
            if admissible(best[1]) and best[1].chunks:
                take(best[1])
                added += 1
    cutoff = int(total * (1 - threshold))
    gains = _Gains(_stream(cards, *order), covered)
    while len(chosen) < limit and total - len(covered) > cutoff and (best := gains.pop()) is not None:
        if best[0] == 0:
            break
        if admissible(best[1]):
            take(best[1])
    if len(chosen) < limit:
        gains = _Gains(_stream(cards, *order), set(covered))
        while len(chosen) < limit and (best := gains.pop()) is not None:
            if admissible(best[1]):
                take(best[1])
    return list(chosen)


def coverage(units: DataFrame, chosen: DataFrame, rows: DataFrame) -> DataFrame:
    """One row: chunks and train keys of all units and of the chosen ones (assignment_id), with ratios to four places."""
    picked = units.join(chosen.select("assignment_id").distinct(), "assignment_id", "left_semi")
    chunks = lambda u, n: u.select(F.explode("chunk_ids").alias("c")).distinct().agg(F.count("*").alias(n))
    cited = rows.select("train_key", F.explode("evidence_signature").alias("c"))
    keys = lambda u, n: cited.join(u.select(F.explode("chunk_ids").alias("c")).distinct(), "c", "left_semi").select("train_key").distinct().agg(F.count("*").alias(n))
    one = F.lit(1).alias("_k")
    out = chunks(units, "chunks").select("*", one)
    for part in (chunks(picked, "chosen_chunks"), keys(units, "train_keys"), keys(picked, "chosen_train_keys")):
        out = out.join(part.select("*", one), "_k")
    ratio = lambda a, b: F.when(F.col(b) > 0, F.round(F.col(a) / F.col(b), 4)).otherwise(F.lit(0.0))
    return out.select("chunks", "chosen_chunks", ratio("chosen_chunks", "chunks").alias("chunk_ratio"), "train_keys", "chosen_train_keys", ratio("chosen_train_keys", "train_keys").alias("train_key_ratio"))
