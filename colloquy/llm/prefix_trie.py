"""Conversation prefix trie with depth-band rollups, in DataFrame functions only.

A node is a distinct sequence of first turns. It is named by its depth and 128
bits: the exclusive or, over its turns, of a hash of (place, role, text), which
a prefix sum gives for every prefix. A conversation of any length is cut into
segments for that, so no task holds a whole one.

*Rollup.* Depths are cut into bands of HEIGHT. A node is exploded only to its
ancestors inside its band, at most HEIGHT of them, and summed there. The first
nodes of the bands (the band roots) then hold the sums of their own bands and
are a tree themselves, HEIGHT times flatter; the same rollup completes their
totals, and each band root sends its completed total to the at most HEIGHT
ancestors in the band above. Rounds go by the logarithm of the depth.

A node that very many conversations share is summed before it is shuffled; a
parent of very many children is joined by broadcast (``lookup``).
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordering import with_positions
from ..session import cut_lineage, discard
from ..operators.lookup import lookup

#: Depths of a band; turns of a segment (a multiple of HEIGHT); conversations of one run of ids.
HEIGHT, SEGMENT, IDS = 8, 1024, 12
#: Rebuilt conversations take their first turns from the one at the start of their block of BLOCK ids.
BLOCK, SHARED = 20, 4
KEY = ["depth", "x", "y"]
WORD = r"[^\x20\x09-\x0D]+"


def _turns(talk: DataFrame) -> DataFrame:
    """conv_id, pos (from 0), x, y (hashes of role and text), words of every
    turn that has a conv_id."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = talk.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.xxhash64(role, text).alias("x"),
        F.xxhash64(F.lit(1), text, role).alias("y"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    return cut_lineage(with_positions(rows, ["conv_id"], "turn", tiebreak=["x", "y"]).drop("turn"))


def _rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id of every conversation; conv_id, depth, x, y, words of every turn
    of the rebuilt ones, x and y with the place in them)."""
    base = F.col("conv_id") - F.col("conv_id") % BLOCK
    shared = (F.crc32(F.col("conv_id").cast("string")) % SHARED).cast("int")
    ids = cut_lineage(turns.where("pos = 0").select("conv_id", base.alias("base"), shared.alias("h")))
    heads = turns.where((F.col("conv_id") % BLOCK == 0) & (F.col("pos") < SHARED - 1)) \
        .groupBy(F.col("conv_id").alias("base")) \
        .agg(F.array_sort(F.collect_list(F.struct("pos", "x", "y", "words"))).alias("head"))
    known = cut_lineage(ids.join(heads, "base", "left").select(
        "conv_id", "h", F.slice(F.coalesce("head", F.array().cast(heads.schema["head"].dataType)), F.lit(1), F.col("h")).alias("head")))
    first = known.select("conv_id", F.explode("head").alias("t")).select(
        "conv_id", (F.col("t.pos") + 1).alias("depth"), "t.x", "t.y", "t.words")
    own = lookup(turns, known.select("conv_id", "h", F.size("head").alias("k")), ["conv_id"]).where("pos >= h") \
        .select("conv_id", (F.col("k") + F.col("pos") - F.col("h") + 1).cast("long").alias("depth"), "x", "y", "words")
    placed = first.unionByName(own).select("conv_id", "depth", F.xxhash64("depth", "x", "y").alias("x"),
                                           F.xxhash64("y", "x", "depth").alias("y"), "words")
    return ids.select("conv_id"), placed


def _prefixes(placed: DataFrame) -> DataFrame:
    """conv_id, depth, x, y (of the whole prefix), words, up: the keys (x, y) of
    its ancestors down from the start of its band. A band's first
    node stands at a multiple of HEIGHT and is not in its own band's list, but
    at the end of the one above."""
    rows = cut_lineage(placed.withColumn("segment", F.floor((F.col("depth") - 1) / SEGMENT)))
    sums = rows.groupBy("conv_id", "segment").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    before = Window.partitionBy("conv_id").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("conv_id", "segment", F.bit_xor("x").over(before).alias("x0"),
                         F.bit_xor("y").over(before).alias("y0")).where("segment > 0")
    upto = Window.partitionBy("conv_id", "segment").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    band = Window.partitionBy("conv_id", "segment", "band").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    run = rows.select("conv_id", "segment", "depth", "words", F.col("x").alias("hx"), F.col("y").alias("hy"),
                      F.bit_xor("x").over(upto).alias("x"), F.bit_xor("y").over(upto).alias("y"))
    whole = run.join(starts, ["conv_id", "segment"], "left").withColumns({
        "x": F.expr("x ^ coalesce(x0, 0)"), "y": F.expr("y ^ coalesce(y0, 0)"),
        "band": F.floor((F.col("depth") - 1) / HEIGHT)})
    parent = F.struct(F.expr("x ^ hx").alias("x"), F.expr("y ^ hy").alias("y"))
    return cut_lineage(whole.withColumn("parent", parent).select(
        "conv_id", "depth", "x", "y", "words", F.collect_list("parent").over(band).alias("up")))


def _band_roots(prefixes: DataFrame, step: int) -> DataFrame:
    """The prefixes at multiples of ``step`` (HEIGHT times that of
    ``prefixes``), ``up`` now counted in such steps."""
    rows = prefixes.where(F.col("depth") % step == 0).withColumns({
        "above": F.col("up")[0], "band": F.floor((F.col("depth") / step - 1) / HEIGHT)})
    band = Window.partitionBy("conv_id", "band").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    return cut_lineage(rows.select("conv_id", "depth", "x", "y", F.collect_list("above").over(band).alias("up")))


def _to_ancestors(nodes: DataFrame, step: int, values: list[str]) -> DataFrame:
    """The values of every node, at each of its ancestors in ``up``."""
    first = F.floor((F.col("depth") / step - 1) / HEIGHT) * HEIGHT * step
    return nodes.select(*values, first.alias("first"), F.posexplode("up").alias("at", "key")).select(
        (F.col("first") + F.col("at") * step).cast("long").alias("depth"), "key.x", "key.y", *values)


def _summed(rows: DataFrame, values: list[str]) -> DataFrame:
    return rows.groupBy(*KEY).agg(*[F.sum(v).alias(v) for v in values])


def subtree_totals(nodes: DataFrame, prefixes: DataFrame, values: list[str], step: int = 1) -> DataFrame:
    """KEY and ``values`` summed over the subtree of every node. ``nodes``: KEY,
    up, values, depths at multiples of ``step``; ``prefixes`` holds every node
    at least once, with ``up``. The root (depth 0) has an empty ``up``."""
    wide = HEIGHT * step
    inner = nodes.where(F.col("depth") % wide != 0)
    own = cut_lineage(_summed(nodes.select(*KEY, *values).unionByName(_to_ancestors(inner, step, values)), values))
    roots = nodes.where((F.col("depth") > 0) & (F.col("depth") % wide == 0)).select(*KEY, "up")
    if roots.isEmpty():
        return own
    upper = _band_roots(prefixes, wide)
    chains = upper.groupBy(*KEY).agg(F.first("up").alias("up")) \
        .unionByName(nodes.where("depth = 0").select(*KEY, F.array().cast(upper.schema["up"].dataType).alias("up")))
    banded = cut_lineage(chains.join(own, KEY))
    done = subtree_totals(banded, upper, values, wide)
    sent = _to_ancestors(roots.join(done, KEY), step, values)
    out = cut_lineage(_summed(own.unionByName(sent), values))
    for old in (own, upper, banded):
        discard(old)
    return out


def _ends_digest(ends: DataFrame) -> DataFrame:
    """KEY and the digest of the decimal conv_ids, ascending and joined by
    commas. Ids meet in runs of at most 2**IDS; the runs of a node pass through
    the digest one after the other, none is held beside the next."""
    runs = ends.groupBy(*KEY, F.shiftright("conv_id", IDS).alias("run")).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))

    def digest(batches):
        key, state = None, None
        for batch in batches:
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(3))))
            out = []
            for k, ids in zip(keys, batch.column(4).to_pylist()):
                if k == key:
                    state.update(b",")
                else:
                    if key is not None:
                        out.append((*key, state.hexdigest()))
                    key, state = k, hashlib.sha256()
                state.update(ids.encode())
            yield _digests(out)
        if key is not None:
            yield _digests([(*key, state.hexdigest())])

    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return runs.repartition(parts, *KEY).sortWithinPartitions(*KEY, "run").select(*KEY, "run", "ids") \
        .mapInArrow(digest, "depth long, x long, y long, ends_sha256 string")


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[], [], [], []]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [*KEY, "ends_sha256"])


def trie(talk: DataFrame) -> DataFrame:
    """One row per node of the rebuilt conversations of ``talk`` (conv_id, turn,
    role, text): conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.

    Turns are ordered by turn, null first, then by a hash of role and text;
    repeated rows are repeated turns; null roles and texts are empty. Rows
    without a conv_id belong to no conversation and are left out. Words are
    counted over whole texts. Other columns are not read. An empty table has
    no conversation and so no node, not even the root."""
    turns = _turns(talk)
    ids, placed = _rebuilt(turns)
    prefixes = _prefixes(placed)
    zero = [F.lit(0).cast("long").alias(c) for c in KEY]
    none = F.array().cast(prefixes.schema["up"].dataType).alias("up")
    nodes = prefixes.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("words").alias("words"),
        F.first("up").alias("up"))
    root = ids.groupBy(*zero).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")) \
        .select(*KEY, "conv_id", "n_convs", F.lit(0).cast("long").alias("words"), none)
    nodes = cut_lineage(nodes.unionByName(root))

    above = (F.col("depth") - 1).alias("depth"), F.element_at("up", -1)["x"].alias("x"), F.element_at("up", -1)["y"].alias("y")
    children = nodes.where("depth > 0").select(*above).groupBy(*KEY).agg(F.count("*").alias("n_children"))
    valued = cut_lineage(nodes.join(children, KEY, "left").withColumns({
        "n_children": F.coalesce("n_children", F.lit(0).cast("long")),
        "n_leaves": F.col("n_children").isNull().cast("long"),
        "saved_tokens": (F.col("n_convs") - 1) * F.col("words")}))
    totals = subtree_totals(valued.select(*KEY, "up", "n_leaves", "saved_tokens"), prefixes, ["n_leaves", "saved_tokens"])

    parents = nodes.select((F.col("depth") + 1).alias("p"), F.col("x").alias("px"), F.col("y").alias("py"),
                           F.col("conv_id").alias("parent_conv_id"))
    linked = cut_lineage(valued.where("depth > 0").select(
        *KEY, "conv_id", "n_convs", "n_children", F.col("depth").alias("p"),
        F.element_at("up", -1)["x"].alias("px"), F.element_at("up", -1)["y"].alias("py")))
    named = lookup(linked, parents, ["p", "px", "py"]).drop("p", "px", "py").unionByName(
        valued.where("depth = 0").select(*KEY, "conv_id", "n_convs", "n_children",
                                         F.lit(None).cast("long").alias("parent_conv_id")))

    last = prefixes.groupBy("conv_id").agg(F.max(F.struct(*KEY)).alias("end"))
    ends = ids.join(last, "conv_id", "left").select(
        "conv_id", *[F.coalesce(F.col("end")[c], F.lit(0).cast("long")).alias(c) for c in KEY])
    digests = _ends_digest(ends)
    return named.join(totals, KEY).join(digests, KEY, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
