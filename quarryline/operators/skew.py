"""Joins whose large side has keys that hold a great share of its rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 100_000  # a key of more rows meets its partner by broadcast; there are at most (all rows / HOT_ROWS) of them


def join_unique(big: DataFrame, small: DataFrame, key: str, rows: str, most: int | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """big joined with small, which has one row for each key and in column `rows` how many rows of big hold it (dropped).

    Rows of hot keys never move: they meet the few hot rows of small in place. All other keys meet by shuffle, where none holds
    more than hot_rows rows. `most`, the largest number where it is known, saves the first half when no key is hot. Null keys
    join nothing.
    """
    cold = big.join(small.where(F.col(rows) <= hot_rows).drop(rows), key)
    if most is not None and most <= hot_rows:
        return cold
    hot = small.where(F.col(rows) > hot_rows).drop(rows)
    rest = big.join(F.broadcast(hot.select(key)), key, "left_anti").join(small.where(F.col(rows) <= hot_rows).drop(rows), key)
    return big.join(F.broadcast(hot), key).unionByName(rest)
