"""Explode helpers that keep expensive array expressions single-evaluated.

For a plain ``explode``/``posexplode`` the optimizer infers a filter
``size(array) > 0`` and pushes it below the projection that computes the
array, so an expensive array expression (a token pipeline, a set of field
parsers) is evaluated twice. ``posexplode_outer`` gets no inferred filter;
the row it emits for an empty or NULL array has a NULL position and is
dropped right after the generator, which the optimizer cannot push down.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_rows(df: DataFrame, array: Column, alias: str, *keep) -> DataFrame:
    """``select(*keep, explode(array) AS alias)`` without re-evaluation."""
    return (df.select(*keep, F.posexplode_outer(array).alias("_xpos", alias))
              .filter(F.col("_xpos").isNotNull()).drop("_xpos"))


def posexplode_rows(df: DataFrame, array: Column, pos: str, alias: str, *keep) -> DataFrame:
    """``select(*keep, posexplode(array) AS (pos, alias))`` without re-evaluation."""
    return (df.select(*keep, F.posexplode_outer(array).alias(pos, alias))
              .filter(F.col(pos).isNotNull()))
