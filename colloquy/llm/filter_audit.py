"""Filter interaction audit by count-weighted decision diagrams.

Every document has a mask: the filters that it fails. Spark counts the
documents of each (part, mask); that is all an audit needs. In a part, the
counts are a function of five bits, which is built as a decision diagram: a
node asks one filter, its edges lead to the documents that pass and that fail,
a leaf holds counts, equal nodes are one, and every node knows the sum below.
Two neighbouring levels are swapped by relinking the nodes of the upper one.

All orders of the filters are visited by swaps of neighbours. In each order,
the path that passes every filter is the run of the filters in that order: at
each of its nodes the fail edge carries what this step removes, and the pass
edge what it keeps.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from ..operators.lookup import lookup

#: The filters, a bit each, in this order.
FILTERS = "ABCDE"
#: Fixed values of the filters' contract.
LEAST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT, SYMBOLS = 50, 65, 5, "[#$%&*|]"
SPACE = r"[\x20\x09-\x0D]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
COUNTS = ["n", "good", "toxic"]
OUT = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
       "good_lost long, toxic_lost long, shapley long")


def failures(docs: DataFrame) -> DataFrame:
    """part, doc_id, same (a digest of the whole text), mask of the filters A to
    D of every row. A null text is empty, a null source the part ""."""
    text = docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                       F.coalesce("text", F.lit("")).alias("text"))
    split = text.select("doc_id", "part", "text", F.split("text", SPACE).alias("pieces"))
    edge = lambda at: F.substring("text", at, 1).isin(*" \t\n\x0b\x0c\r")
    held = split.select(
        "doc_id", "part", F.unhex(F.sha2("text", 256)).alias("same"),
        F.size("pieces").cast("long").alias("pieces"), F.size(F.array_distinct("pieces")).cast("long").alias("kinds"),
        # a separator at an end, and an empty text, leave an empty piece
        (edge(1) | (F.col("text") == "")).cast("int").alias("front"), edge(-1).cast("int").alias("back"),
        F.length("text").cast("long").alias("chars"), F.length(F.translate("text", CAPITALS, "")).cast("long").alias("others"),
        F.col("text").rlike(SYMBOLS).alias("symbols"))
    return held.select("doc_id", "part", "same", _mask(held))


def _mask(held: DataFrame) -> Column:
    empty = F.col("front") + F.col("back")
    words, kinds = F.col("pieces") - empty, F.col("kinds") - F.when(empty > 0, 1).otherwise(0)
    failed = [words < LEAST_WORDS, 100 * kinds < DISTINCT_PERCENT * words,
              100 * (F.col("chars") - F.col("others")) > CAPITAL_PERCENT * F.col("chars"), F.col("symbols")]
    return sum((f.cast("int") * (1 << i) for i, f in enumerate(failed)), F.lit(0)).alias("mask")


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask (all filters), n, good (labelled quality = 1), toxic (labelled
    toxic = 1): counts of documents, computed over all rows.

    Copies are found by the digests of whole texts: rows are first counted for
    each (text, id, part, labels), then for each (text, part, labels), so a
    text with very many copies is a few rows before its smallest id is looked
    up. A null doc_id is smaller than none and has no labels; of several label
    rows of an id, one that says 1 decides."""
    rows = cut_lineage(failures(docs).groupBy("same", "doc_id", "part", "mask").agg(F.count("*").alias("n")))
    told = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    labelled = lookup(rows, told, ["doc_id"]).withColumns({
        "good": F.coalesce("good", F.lit(False)), "toxic": F.coalesce("toxic", F.lit(False))})
    group = ["same", "part", "mask", "good", "toxic"]
    # rows of a group, its smallest id and how many rows have it
    merged = cut_lineage(labelled.groupBy(*group).agg(
        F.sum("n").alias("n"), F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("least"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("nameless"))
        .select(*group, "n", "nameless", F.col("least.doc_id").alias("least"), F.col("least.n").alias("at_least")))
    smallest = merged.groupBy("same").agg(F.min("least").alias("first"))
    joined = lookup(merged, smallest, ["same"])
    alone = F.col("nameless") + F.when(F.col("least") == F.col("first"), F.col("at_least")).otherwise(0)
    copies = 1 << FILTERS.index("E")
    sides = F.explode(F.array(F.struct(F.col("mask").alias("mask"), alone.alias("n")),
                              F.struct((F.col("mask") + copies).alias("mask"), (F.col("n") - alone).alias("n"))))
    side = joined.select("part", "good", "toxic", sides.alias("s")).where("s.n > 0")
    return side.groupBy("part", F.col("s.mask").alias("mask")).agg(
        F.sum("s.n").alias("n"), F.sum(F.when(F.col("good"), F.col("s.n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("s.n")).otherwise(0)).alias("toxic"))


class Diagram:
    """A decision diagram over counts: ``order`` names the filter that each
    level asks, the top first. Nodes of a level are (pass, fail) pairs of nodes
    of the next one, leaves are tuples of counts; equal ones are one object in
    a table, and ``total`` is the sum of the leaves below."""

    def __init__(self, counts: dict[int, tuple[int, ...]], filters: str):
        self.order = list(filters)
        self._made: dict[tuple, tuple] = {}
        zero = (0,) * len(next(iter(counts.values()), COUNTS))
        nodes = [self._node((), counts.get(mask, zero)) for mask in range(1 << len(filters))]
        while len(nodes) > 1:  # join the halves that differ in the highest bit, so that the first filter ends on top
            half = len(nodes) // 2
            nodes = [self._node((nodes[i], nodes[half + i])) for i in range(half)]
        self.root = nodes[0]

    def _node(self, edges: tuple, total: tuple | None = None) -> tuple:
        """(edges, total), the same object for the same edges or leaf."""
        if total is None:
            total = tuple(a + b for a, b in zip(edges[0][1], edges[1][1]))
            key = (id(edges[0]), id(edges[1]))
        else:
            key = ("leaf", *total)
        if key not in self._made:
            self._made[key] = (edges, total)
        return self._made[key]

    def swap(self, level: int) -> None:
        """Exchange the filters of ``level`` and the one below it."""
        done: dict[int, tuple] = {}

        def at(node, depth):
            if id(node) in done:
                return done[id(node)]
            (passed, failed), _ = node
            if depth < level:
                new = self._node((at(passed, depth + 1), at(failed, depth + 1)))
            else:
                (pp, pf), (fp, ff) = passed[0], failed[0]
                new = self._node((self._node((pp, fp)), self._node((pf, ff))))
            done[id(node)] = new
            return new
        self.root = at(self.root, 0)
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def path(self) -> list[tuple[tuple, tuple]]:
        """(kept, removed) at every level of the path that passes all filters."""
        node, out = self.root, []
        while node[0]:
            out.append((node[0][0][1], node[0][1][1]))
            node = node[0][0]
        return out


def neighbour_swaps(n: int) -> Iterator[int]:
    """The levels to swap, one after the other, to visit all orders of ``n``."""
    if n < 2:
        return
    inner = list(neighbour_swaps(n - 1))
    for k in range(len(inner) + 1):
        down = k % 2 == 0  # the last one walks to the top, then back down
        yield from range(n - 2, -1, -1) if down else range(n - 1)
        if k < len(inner):
            yield inner[k] + 1 if down else inner[k]


def steps(counts: dict[int, tuple[int, ...]]) -> list[tuple]:
    """Of one part: (filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley) for all orders."""
    diagram, seen = Diagram(counts, FILTERS), []
    for level in [None, *neighbour_swaps(len(FILTERS))]:
        if level is not None:
            diagram.swap(level)
        seen.append(("".join(diagram.order), diagram.path()))
    fails, alone, sums = {}, {}, dict.fromkeys(FILTERS, 0)
    for order, path in seen:
        for name, (_, removed) in zip(order, path):
            sums[name] += removed[0]
        fails[order[0]] = path[0][1][0]  # first, a filter removes all that fail it; last, those that fail it alone
        alone[order[-1]] = path[-1][1][0]
    return [(order, i + 1, kept[0], removed[0], fails[name] - removed[0], alone[name], removed[1], removed[2], sums[name])
            for order, path in seen for i, (name, (kept, removed)) in enumerate(zip(order, path))]


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, filter_order (all orders of FILTERS) and step: part,
    filter_order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley.

    Null and empty texts have no words and no characters (they fail A alone,
    unless a smaller id has an empty text too). Every row of ``docs`` counts,
    repeated ones too; rows of one id are not each other's copies. A part is
    at most 32 rows of counts when it meets. Very long texts are read whole.
    Other columns are not read. An empty table gives no rows."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        counts = {int(m): tuple(map(int, v)) for m, v in zip(pdf["mask"], np.stack([pdf[c] for c in COUNTS], 1))}
        out = pd.DataFrame(steps(counts), columns=[f.split()[0] for f in OUT.split(", ")][1:])
        out.insert(0, "part", pdf["part"].iloc[0])
        return out

    return mask_counts(docs, labels).groupBy("part").applyInPandas(one, OUT)
