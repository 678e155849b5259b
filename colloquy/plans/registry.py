"""Registry of named queries: a Spark builder ``(spark, sf_dir) -> DataFrame``
and, where the result is expressible in SQL, the DuckDB oracle text over the
same driver tables."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import compiled_only

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        @functools.wraps(fn)
        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            compiled_only(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = build
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def add(name: str, fn: Builder, oracle: str | None = None) -> None:
    """Register a builder that lives outside this package (again, if it is there)."""
    QUERIES[name] = fn
    if oracle is not None:
        ORACLES[name] = oracle


def load_all() -> None:
    """Import every query module so that their ``register`` calls run."""
    from . import (q_conversation, q_graph, q_io, q_misc, q_models, q_state, q_text,
                   q_versions)  # noqa: F401
