"""Aggregates (A1-A3, A13-A15, A20) beyond plain groupBy calls."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A2 / A3: DISTINCT (or GROUP BY every column with no aggregate)."""
    return df.dropDuplicates(list(cols)) if cols else df.distinct()


def max_per_key(df: DataFrame, keys: Sequence[str], value: str, out: str | None = None) -> DataFrame:
    """Per key keep the largest numeric value."""
    return df.groupBy(*keys).agg(F.max(F.col(value).cast("double")).alias(out or value))


def ordered_lines(df: DataFrame, key: str, order: str, line: str, sep: str = "") -> DataFrame:
    """Concatenate ``line`` per key in ``order`` order (newline-terminated
    lines use sep='')."""
    return (df.groupBy(key)
              .agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("_o"), F.col(line).alias("_l"))))
                   .alias("_a"))
              .select(key, F.array_join(F.transform("_a", lambda x: x["_l"]), sep).alias(line)))


def collect_ids(df: DataFrame, key: str, order: str, id_col: str = "id", out: str = "ids") -> DataFrame:
    """Ordered id arrays per key."""
    return (df.groupBy(key)
              .agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("_o"), F.col(id_col).alias("_i"))))
                   .alias("_a"))
              .select(key, F.transform("_a", lambda x: x["_i"]).alias(out)))


def accuracy(df: DataFrame, pred: str, label: str) -> DataFrame:
    """Share of rows where prediction equals label (rounded to 6)."""
    return df.agg(F.round(F.avg(F.when(F.col(pred) == F.col(label), 1.0).otherwise(0.0)), 6).alias("accuracy"),
                  F.count(F.lit(1)).alias("n"))
