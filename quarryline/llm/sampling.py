"""Bounded samples of a table, to fit models on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def least_hashes(rows: DataFrame, key: str, n: int) -> DataFrame:
    """The n rows with the least hash of their key, ties by key.

    Rows that cannot be among them drop out in the scan, by a bound on the hash that leaves about four times as many: no task
    sends more than its share of those, whatever the number of tasks.
    """
    total = rows.count()
    if total > 8 * n:
        bound = int(-(1 << 63) + (1 << 64) * (4 * n / total))
        fewer = rows.where(F.xxhash64(key) < F.lit(bound))
        rows = fewer if fewer.count() >= n else rows
    return rows.orderBy(F.xxhash64(key), key).limit(n)
