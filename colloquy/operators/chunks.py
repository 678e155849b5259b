"""Token-bounded overlapping chunks of a channel's log (W3), their time
span (A19) and fixed-size batches (W2).

The original joins a channel's lines with newlines and slices the token
stream into windows of ``size`` tokens every ``step = size - overlap``
tokens. Here only the per-line running token count needs channel order
(``with_positions`` with a weight, skew-safe); a line whose tokens occupy
offsets [g0, g0 + n) then belongs to every chunk k with
``k * step < g0 + n`` and ``k * step + size > g0``, computed arithmetically.
Rows are (line, chunk) pairs, never single tokens, and a chunk is assembled
from at most ``size`` tokens, so no group is unbounded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import text as T
from .ordering import with_positions


def word_tokens(c: Column) -> Column:
    """Default tokenizer for chunking: whitespace-separated words."""
    return F.filter(F.split(c, f"{P.WS_J}+"), lambda w: w != "")


def token_chunks(lines: DataFrame, key: str = "channel_id", order: tuple[str, ...] = ("ts", "id"),
                 line_col: str = "line", size: int = 3000, overlap: int = 100,
                 tokenizer=word_tokens) -> DataFrame:
    """lines: (key, *order, line). Returns (key, chunk, n_tokens, text) with
    text = the chunk's lines (their token slices joined by spaces) joined by
    newlines."""
    from ..session import cut_lineage
    step = size - overlap
    t = lines.withColumn("_tok", tokenizer(F.col(line_col)))
    t = t.withColumn("_n", F.coalesce(F.size("_tok"), F.lit(0)))
    # the token table is read by the position pass several times: write it once
    t = cut_lineage(t.select(key, *order, "_tok", "_n"))
    t = with_positions(t, [key], order[0], out="_g0", tiebreak=list(order[1:]), weight=F.col("_n"))
    g0, n = F.col("_g0"), F.col("_n")
    k_lo = F.greatest(F.lit(0), F.floor((g0 - size) / step) + 1)
    k_hi = F.floor((g0 + n - 1) / step)
    chunks = F.when(n > 0, F.sequence(k_lo.cast("bigint"), k_hi.cast("bigint")))
    t = t.withColumn("chunk", F.explode(chunks))   # lines without tokens yield no rows
    start = F.greatest(F.col("chunk") * step, g0)
    end = F.least(F.col("chunk") * step + size, g0 + n)
    piece = F.slice("_tok", (start - g0 + 1).cast("int"), (end - start).cast("int"))
    t = t.select(key, "chunk", "_g0", (end - start).alias("_cnt"), F.array_join(piece, " ").alias("_piece"))
    return (t.groupBy(key, "chunk")
             .agg(F.sum("_cnt").alias("n_tokens"),
                  F.array_sort(F.collect_list(F.struct("_g0", "_piece"))).alias("_p"))
             .select(key, "chunk", "n_tokens",
                     F.array_join(F.transform("_p", lambda x: x["_piece"]), "\n").alias("text")))


def chunk_span(text: Column) -> tuple[Column, Column]:
    """First and last ``MM-dd-yyyy@HH:mm`` stamp found in a chunk."""
    stamps = F.regexp_extract_all(text, F.lit(P.LOG_TIME), 0)
    # a chunk cut from the middle of one long line may hold no stamp: NULL
    return F.try_element_at(stamps, F.lit(1)), F.try_element_at(stamps, F.lit(-1))


def log_lines(messages: DataFrame, keep_empty: bool = False) -> DataFrame:
    """Summary input: X1 + X3 + X4 cleaning, then X35 ``MM-dd-yyyy@HH:mm
    user: text`` lines. Rows without text get a NULL line; they are dropped
    unless ``keep_empty`` (the chunker skips them itself, which avoids a
    pushed-down filter re-running the cleaning)."""
    from ..functions.extract import format_log
    c = T.prepare(F.col("content"), [T.strip_emojis, T.replace_empty_strings, T.clean_content])
    m = messages.withColumn("clean_content", F.nullif(c, F.lit("")))
    m = m.withColumn("line", format_log(F.col("ts"), F.col("author_tag"), F.col("clean_content")))
    return m if keep_empty else m.filter(F.col("line").isNotNull())
