"""Positions inside ordered groups without putting a whole group in one task.

``with_positions`` numbers the rows of every group (``keys``) by an order
column. A plain ``row_number() OVER (PARTITION BY key ORDER BY ..)`` sends a
whole key to one task; a channel holding a third of all messages would then
be one task. Here all rows are range-partitioned by (keys, order, tiebreak),
so partitions hold about equal numbers of rows whatever the values are (an
outlier or a burst on one time stamp changes nothing). Rows are numbered
inside (partition, key) windows, and the offsets come from a prefix sum over
the small count table with one row per (key, partition).

``neighbors`` finds, for anchor rows, the ``n`` nearest rows before or after
them in the same group that pass a predicate (e.g. "not written by the
asker"). Each tier probes a fixed number of positions with an equi-join on
(key, position); only anchors that are still short probe further, with the
probe width doubling. Where the rows carry the ends of their run of equal
``runs`` values (``run_ends``), a probe that stops inside a run that fails
goes on behind it, so a long run costs one step.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, discard

ROWS_PER_SEGMENT = 1 << 20
ROWS_PER_RUN_SEGMENT = 4096


def with_positions(df: DataFrame, keys: Sequence[str], order_col: str,
                   out: str = "pos", tiebreak: Sequence[str] = (),
                   weight: Column | None = None, rows_per_segment: int = ROWS_PER_SEGMENT) -> DataFrame:
    """Add ``out`` = number of rows (or sum of ``weight``) of the same key that
    come strictly before this row in (order_col, *tiebreak) order; 0-based.
    The rows are dealt over the shuffle partitions, or over more so that none
    holds many more than ``rows_per_segment``."""
    keys, order = list(keys), [order_col, *tiebreak]
    # the input is computed once, by this write; the count and the sample of the ranges read the written rows
    rows = cut_lineage(df.withColumn("_w", (weight if weight is not None else F.lit(1)).cast("bigint")))
    n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")),
            math.ceil(rows.count() / rows_per_segment))
    # written again as dealt: a second range partitioning could cut elsewhere
    base = cut_lineage(rows.repartitionByRange(n, *keys, *order).withColumn("_seg", F.spark_partition_id()))
    discard(rows)
    inner_w = Window.partitionBy("_seg", *keys).orderBy(*order)
    before = inner_w.rowsBetween(Window.unboundedPreceding, -1)
    inner = F.row_number().over(inner_w) - 1 if weight is None else F.coalesce(F.sum("_w").over(before), F.lit(0))
    totals = base.groupBy(*keys, "_seg").agg(F.sum("_w").alias("_segsum"))
    off_w = Window.partitionBy(*keys).orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_seg").alias("_s"),
                            F.coalesce(F.sum("_segsum").over(off_w), F.lit(0)).alias("_off"))
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    on = F.col("_seg") == F.col("_s")
    for c in same:
        on = on & c
    return (base.withColumn("_inner", inner).join(offsets, on)
                .withColumn(out, (F.col("_off") + F.col("_inner")).cast("bigint"))
                .select(*df.columns, out))


def run_ends(rows: DataFrame, key: str, col: str, span: int = ROWS_PER_RUN_SEGMENT) -> DataFrame:
    """``rows`` (key, dense ``pos``, ``col``) with ``run_lo`` and ``run_hi``:
    first and last position of the run of equal ``col`` values around a row.

    Positions are dense, so segments of ``span`` positions hold that many rows
    at most. A ``lag`` finds the pieces of runs inside a segment; only its
    first and its last piece can go on in a neighbour, so the merge across
    segments is a window over two rows for each segment."""
    inside = Window.partitionBy(key, "_seg")
    ordered, piece = inside.orderBy("pos"), Window.partitionBy(key, "_seg", "_piece")
    starts = (F.row_number().over(ordered) == 1) | ~F.col(col).eqNullSafe(F.lag(col).over(ordered))
    marked = (rows.withColumn("_seg", F.floor(F.col("pos") / span))
              .withColumn("_new", starts.cast("int"))
              .withColumn("_piece", F.sum("_new").over(ordered)).drop("_new")
              .withColumn("_lo", F.min("pos").over(piece)).withColumn("_hi", F.max("pos").over(piece))
              .withColumn("_last", F.max("_piece").over(inside)))
    marked = cut_lineage(marked)
    across = Window.partitionBy(key).orderBy("_seg", "_piece")
    breaks = F.lag("_hi").over(across).isNull() | (F.col("_lo") != F.lag("_hi").over(across) + 1) \
        | ~F.col(col).eqNullSafe(F.lag(col).over(across))
    whole = Window.partitionBy(key, "_run")
    edges = (marked.where("pos = _lo AND (_piece = 1 OR _piece = _last)")
             .withColumn("_break", breaks.cast("int")).withColumn("_run", F.sum("_break").over(across))
             .select(F.col(key).alias("_k"), F.col("_seg").alias("_s"), F.col("_piece").alias("_p"),
                     F.min("_lo").over(whole).alias("_from"), F.max("_hi").over(whole).alias("_to")))
    on = marked[key].eqNullSafe(edges["_k"]) & (marked["_seg"] == edges["_s"]) & (marked["_piece"] == edges["_p"])
    return (marked.join(edges, on, "left")
            .withColumn("run_lo", F.coalesce("_from", "_lo")).withColumn("run_hi", F.coalesce("_to", "_hi"))
            .select(*rows.columns, "run_lo", "run_hi"))


def neighbors(rows: DataFrame, anchors: DataFrame, key: str, n: int = 0, direction: int = 1,
              keep: Callable[[], Column] | None = None, slack: int = 5,
              counts: dict[int, int] | None = None) -> DataFrame:
    """Nearest rows before (direction -1) and/or after (+1) each anchor.

    rows    : (key, pos, id, ...) with dense 0-based ``pos`` per key
    anchors : (anchor_id, key, anchor_pos, a_* ...) one row per anchor
    keep    : predicate over the joined row (row columns + anchor columns);
              rows failing it are skipped but still count as examined.
    counts  : {direction: n}; defaults to {direction: n}. Both directions
              are probed in the same join and tallied together.
    Returns (anchor_id, dir, dist, <row columns>): at most n rows per
    anchor and direction, nearest first by ``dist`` (>= 1)."""
    counts = {d: k for d, k in (counts or {direction: n}).items() if k > 0}
    runs = {"run_lo", "run_hi"} <= set(rows.columns)
    row_cols = [c for c in rows.columns if c not in (key, "pos", "run_lo", "run_hi")]
    if not counts:
        return anchors.limit(0).select("anchor_id", F.lit(0).alias("dir"), F.lit(0).alias("dist"),
                                       *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in row_cols])
    need = F.create_map(*[x for d, k in counts.items() for x in (F.lit(d), F.lit(k))])
    width = max(counts.values()) + (slack if keep is not None else 0)
    r = rows.withColumnRenamed("pos", "_tpos")
    dirs = F.array(*[F.lit(d) for d in counts])
    pending = (anchors.select("*", F.explode(dirs).alias("dir")).withColumn("_have", F.lit(0).cast("bigint"))
                      .withColumn("_lo", F.lit(1).cast("bigint")))
    found: list[DataFrame] = []
    for _ in itertools.count():  # ends: an anchor that goes on has moved, and stops at its group's end
        probes = (pending.withColumn("dist", F.explode(F.sequence(F.col("_lo"), F.col("_lo") + (width - 1))))
                         .withColumn("_tpos", F.col("anchor_pos") + F.col("dist") * F.col("dir")))
        matched = probes.join(r, [key, "_tpos"], "inner")
        ok = keep() if keep is not None else F.lit(True)
        matched = matched.withColumn("_ok", F.coalesce(ok, F.lit(False)))
        if keep is not None:
            matched = cut_lineage(matched)  # reliable: a lost executor does not lose the round
        found.append(matched.filter("_ok").select("anchor_id", "dir", "dist", *row_cols))
        if keep is None:
            break
        after = F.col("dist")
        if runs:  # a run that fails is left behind as a whole
            end = F.when(F.col("dir") > 0, F.col("run_hi")).otherwise(F.col("run_lo"))
            after = F.when(F.col("_ok"), F.col("dist")).otherwise((end - F.col("anchor_pos")) * F.col("dir"))
        tally = matched.groupBy("anchor_id", "dir").agg(
            F.count(F.lit(1)).alias("_seen"), F.count_if("_ok").alias("_got"), F.max(after).alias("_to"))
        nxt = (pending.join(tally, ["anchor_id", "dir"])
                      .filter((F.col("_seen") == F.lit(width)) & (F.col("_have") + F.col("_got") < need[F.col("dir")]))
                      .withColumn("_have", F.col("_have") + F.col("_got"))
                      .withColumn("_lo", F.col("_to") + 1).drop("_seen", "_got", "_to"))
        nxt = cut_lineage(nxt)
        if nxt.isEmpty():
            break
        pending, width = nxt, 2 * width
    out = found[0]
    for h in found[1:]:
        out = out.unionByName(h)
    w = Window.partitionBy("anchor_id", "dir").orderBy("dist")
    return (out.withColumn("_rk", F.row_number().over(w))
               .filter(F.col("_rk") <= need[F.col("dir")]).drop("_rk"))
