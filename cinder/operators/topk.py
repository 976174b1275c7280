"""Global top-k: ``orderBy(...).limit(k)`` -> TakeOrderedAndProject (k rows per task, then k overall)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def top_k(df: DataFrame, order: list, k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)
