"""Joins of many rows with a table that has one row per key, hot keys included."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot that holds more than one in SHARE of the rows; so there are fewer than SHARE of them.
SHARE = 2048


def lookup(rows: DataFrame, keyed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` left-joined with ``keyed`` (one row per key) on ``keys``.

    The rows of a hot key stay where they are: the rows of ``keyed`` for the
    hot keys, fewer than SHARE, are broadcast. All others are shuffled, no key
    with more than one in SHARE of the rows. ``rows`` is read several times, so
    it should be a written table. A null key finds nothing."""
    keys = list(keys)
    most = rows.count() / SHARE
    hot = rows.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > most).select(*keys)
    found = F.broadcast(keyed.join(F.broadcast(hot), keys, "left_semi"))
    few = F.broadcast(hot.join(found, keys, "left").withColumn("_hot", F.lit(True)))
    marked = rows.join(few, keys, "left")
    added = [c for c in keyed.columns if c not in keys]
    hit = marked.where("_hot").select(*rows.columns, *added)
    rest = marked.where("_hot IS NULL").select(*rows.columns)
    nowhere = rest.where(" OR ".join(f"{k} IS NULL" for k in keys)) \
        .select("*", *[F.lit(None).cast(keyed.schema[c].dataType).alias(c) for c in added])
    held = rest.where(" AND ".join(f"{k} IS NOT NULL" for k in keys)).join(keyed, keys, "left")
    return hit.unionByName(held.select(*rows.columns, *added)).unionByName(nowhere)
