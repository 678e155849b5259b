"""Term statistics (A4-A9, T4): frequency, document frequency, IDF, TF-IDF,
per-channel variants and top-k lists.

Counting is ``explode`` + ``groupBy`` so Spark combines partial counts on the
map side before the shuffle; a token or channel holding a third of all rows
costs one partial row per task, not one task. ``N`` for IDF is a single count
(one number to the driver, then a literal in the plan).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_tokens(df: DataFrame, text_col: str, tokens: Column, drop_empty: bool = False) -> DataFrame:
    """Attach ``tokens`` and ``num_tokens``.

    F13 (rows without tokens do not count) needs no filter on the way to the
    statistics: ``explode`` yields nothing for an empty array and N counts
    the documents that produced a token. A filter on ``num_tokens`` would be
    pushed below this projection by the optimizer and evaluate the whole
    token pipeline twice, so ``drop_empty`` is only for small inputs."""
    out = df.withColumn("tokens", tokens).withColumn("num_tokens", F.coalesce(F.size("tokens"), F.lit(0)))
    return out.filter(F.col("num_tokens") > 0) if drop_empty else out


def _exploded(df: DataFrame, tokens_col: str, cols: list[str], stopwords: Iterable[str] | None) -> DataFrame:
    from .generate import explode_rows
    x = explode_rows(df, F.col(tokens_col), "token", *cols)
    if stopwords is not None:
        x = x.filter(~F.lower(F.col("token")).isin(list(stopwords)))
    return x


def term_counts(df: DataFrame, tokens_col: str = "tokens", key: str = "doc_id",
                by: Iterable[str] = (), stopwords: Iterable[str] | None = None) -> DataFrame:
    """Occurrences per (group, document, token): the one pass over the
    tokens that frequency, document frequency and N are all derived from.
    ``stopwords`` are removed after the explode (X9 as a hash-set filter)."""
    by = list(by)
    return (_exploded(df, tokens_col, by + [key], stopwords)
              .groupBy(*by, key, "token").agg(F.count(F.lit(1)).alias("n")))


def frequency_from_counts(tc: DataFrame, min_freq: int = 2, by: Iterable[str] = ()) -> DataFrame:
    """A5 / A8 from ``term_counts``."""
    by = list(by)
    return (tc.groupBy(*by, "token").agg(F.sum("n").alias("freq"))
              .filter(F.col("freq") >= min_freq))


def idf_from_counts(tc: DataFrame, key: str = "doc_id", min_df: int = 2) -> DataFrame:
    """A6 from ``term_counts`` (one row per document and token, so the rows
    per token are its document frequency; N = documents with a token)."""
    n = tc.select(key).distinct().count()  # one number to the driver
    d = tc.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter(F.col("df") >= min_df)
    return d.withColumn("idf", F.log(F.lit(float(n)) / F.col("df")) + F.lit(0.1))


def term_stats(df: DataFrame, tokens_col: str = "tokens", by: Iterable[str] = (),
               stopwords: Iterable[str] | None = None) -> tuple[DataFrame, int]:
    """((*by, token, freq, df), N) from one aggregate: every row of ``df`` (a
    document) sends its tokens, its distinct tokens and, if it has a token,
    one mark, so frequency, document frequency and N come out of the same
    map-side combined ``groupBy``. The result, a row per (group, token), is
    written once. ``df`` counts documents of the group."""
    from ..session import cut_lineage
    from .generate import explode_rows
    by, stops = list(by), list(stopwords or [])
    entry = lambda kind: lambda t: F.struct(t.alias("token"), F.lit(kind).alias("kind"))
    tokens = F.coalesce(F.col(tokens_col), F.array().cast("array<string>"))
    counted = (lambda t: ~F.lower(t).isin(stops)) if stops else (lambda t: t.isNotNull())
    mark = F.array(F.struct(F.lit(None).cast("string").alias("token"), F.lit(2).alias("kind")))
    sent = F.concat(F.transform(tokens, entry(0)), F.transform(F.array_distinct(tokens), entry(1)),
                    F.when(F.exists(tokens, counted), mark).otherwise(F.slice(mark, 1, 0)))
    x = explode_rows(df, sent, "_t", *by).select(*by, "_t.token", "_t.kind")
    if stops:
        x = x.filter(F.col("token").isNull() | ~F.lower("token").isin(stops))
    table = cut_lineage(x.groupBy(*by, "token").agg(
        F.count_if(F.col("kind") == 0).alias("freq"), F.count_if(F.col("kind") == 1).alias("df"),
        F.count_if(F.col("kind") == 2).alias("_n")))
    n = table.agg(F.sum("_n").alias("n")).first()["n"] or 0  # one number to the driver
    return table.filter(F.col("token").isNotNull()).drop("_n"), n


def idf_of(df_col, n: int, min_df: int = 2) -> Column:
    """``ln(N / df) + 0.1``, NULL below ``min_df``."""
    c = F.col(df_col) if isinstance(df_col, str) else df_col
    return F.when(c >= min_df, F.log(F.lit(float(n)) / c) + F.lit(0.1))


def token_frequency(df: DataFrame, tokens_col: str = "tokens", min_freq: int = 2,
                    by: Iterable[str] = (), stopwords: Iterable[str] | None = None) -> DataFrame:
    """A5 (A8 with ``by``): occurrences per token (per group), ``freq >= min_freq``."""
    by = list(by)
    return (_exploded(df, tokens_col, by, stopwords)
              .groupBy(*by, "token").agg(F.count(F.lit(1)).alias("freq"))
              .filter(F.col("freq") >= min_freq))


def document_frequency(df: DataFrame, tokens_col: str = "tokens", min_df: int = 2) -> DataFrame:
    """Documents containing each token, ``df >= min_df``, and
    ``idf = ln(N / df) + 0.1`` with N = number of rows that have a token."""
    n = df.agg(F.count_if(F.coalesce(F.size(tokens_col), F.lit(0)) > 0).alias("n")).first()["n"]
    from .generate import explode_rows
    d = (explode_rows(df, F.array_distinct(tokens_col), "token")
           .groupBy("token").agg(F.count(F.lit(1)).alias("df"))
           .filter(F.col("df") >= min_df))
    return d.withColumn("idf", F.log(F.lit(float(n)) / F.col("df")) + F.lit(0.1))


def tfidf(freq: DataFrame, idf: DataFrame, by: Iterable[str] = ()) -> DataFrame:
    """``freq * idf`` aligned on token; tokens without an idf get NULL."""
    return (freq.join(idf.select("token", "idf"), "token", "left")
                .withColumn("tfidf", F.col("freq") * F.col("idf")))


def group_sizes(df: DataFrame, key: str, k: int = 5, count_if: Column | None = None) -> DataFrame:
    """A4: rows per key (or rows satisfying ``count_if``), largest first,
    top ``k`` (ties by key); keys with no counted row are left out."""
    c = F.count(F.lit(1)) if count_if is None else F.count_if(count_if)
    return (df.groupBy(key).agg(c.alias("n")).filter(F.col("n") > 0)
              .orderBy(F.desc("n"), F.asc(key)).limit(k))


def top_terms(freq: DataFrame, k: int, score: str = "freq", by: Iterable[str] = (),
              exclude: Iterable[str] = ()) -> DataFrame:
    """T4: top ``k`` tokens by ``score`` (per group with ``by``), optionally
    without an extra stop list. Per group the row_number filter is planned as
    a WindowGroupLimit, which trims each partition before the shuffle."""
    by = list(by)
    ex = list(exclude)
    f = freq.filter(~F.col("token").isin(ex)) if ex else freq
    order = [F.desc(score), F.asc("token")]
    if not by:
        return f.orderBy(*order).limit(k)
    w = Window.partitionBy(*by).orderBy(*order)
    return f.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
