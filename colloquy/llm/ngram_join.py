"""N-gram Jaccard join by vertical partitioning.

A document is the set of its distinct word shingles, as 64-bit hashes. The
hashes give the shingles a global order, which is cut into fragments; a set is
the sum of its parts in the fragments, and so is the overlap of two sets.

*Candidates.* Two sets of n1 and n2 shingles that reach the threshold differ
in at most H(n1 + n2) shingles. Cut into H + 1 fragments, they agree wholly in
one at least, so documents that share no fragment need no comparison. The
number of fragments goes by size class; a document near a class's end also
registers in the next one. A fragment holds several shingles, so a passage or
line that many documents share, without being alike otherwise, rarely fills a
fragment alone. Where a set leaves so many fragments empty that the agreeing
one could be empty, it registers its empty fragments too; nothing is lost.

*Overlaps.* For a candidate pair, the overlap is counted in every fragment of
the order separately, and summed for the pair.

*Groups.* Documents with equal sets are one class, and only classes are
compared. As the result is the components, a pair inside one component needs
no test. First every class is compared with the class that leads most of its
shared fragments; then, fragment by fragment, the classes that are still apart
are searched: a lossless sketch (a byte for each of some 4 H fragments; at most
H of them differ) picks pairs. Of these, one for each two components is counted
as above, over all fragments; the components that meet are one; then up to
four for each two components are counted, sixteen, and so on until no untested
pair of different components passes the sketch. A fragment shared by
very many classes is dealt into blocks, so no task holds an unbounded group.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, discard, release, small_batches
from . import textbytes
from .components import components, written
from ..operators.lookup import lookup

#: Least cells of a sketch; fragments in which overlaps are counted; classes in a block.
CELLS, PARTS, BLOCK = 64, 8, 4096
#: Most classes whose ids may be broadcast (8 bytes each); beyond it, a shuffle join.
BROADCAST_IDS = 1 << 21
#: Most classes whose places may be broadcast (some 50 bytes each).
BROADCAST_ROUTES = 1 << 19
#: Pairs of a class that one copy of its set meets; sets that a task remembers to have sent.
PAIRS, SEEN = 256, 100_000
#: Smallest id, which stands for a null one.
NONE = -(1 << 63)


@dataclass(frozen=True)
class Rule:
    """Shingles of ``size`` words; linked when den * overlap >= num * union."""
    size: int = 5
    num: int = 80
    den: int = 100
    seed: int = 0

    def most_apart(self, total):
        """H: the most shingles in which two linked sets of ``total`` shingles
        together differ; it never falls as ``total`` grows."""
        return total * (self.den - self.num) // (self.num + self.den)

    def bounds(self, largest: int) -> list[int]:
        """Where the size classes begin; smaller sets link only with equal ones."""
        out, n = [], 1
        while self.most_apart(2 * n + 1) < 1:
            n += 1
        while n <= largest:
            out.append(n)
            n = max(n + 1, n * 3 // 2)
        return [*out, n, max(n + 1, n * 3 // 2)]


def _mixed(s: np.ndarray, salt: int) -> np.ndarray:
    return textbytes.mix(s ^ np.uint64(salt * 0x9E3779B97F4A7C15 & (1 << 64) - 1))


def class_hash(s: np.ndarray, rule: Rule) -> tuple[int, int]:
    """128 bits that stand for a whole set."""
    return tuple(int(_mixed(s, 2 * rule.seed + k + 1).sum().view(np.int64)) for k in (0, 1))


def _cuts(n: int, rule: Rule, bounds: list[int]) -> list[tuple[int, int, int]]:
    """The size classes in which a set of ``n`` shingles registers: label,
    largest size and number of fragments."""
    k = int(np.searchsorted(bounds, n, "right")) - 1
    if k < 0:
        return []
    labels = (k, k + 1) if n * rule.den // rule.num >= bounds[k + 1] else (k,)
    return [(x, top := bounds[x + 1] - 1, rule.most_apart(2 * top) + 1) for x in labels]


def signatures(s: np.ndarray, rule: Rule, bounds: list[int]) -> np.ndarray:
    """A hash for each fragment of the sorted set ``s``, in its size classes."""
    n, value, out = len(s), _mixed(s, 11), [np.zeros(0, np.uint64)]
    for label, top, count in _cuts(n, rule, bounds):
        fragment = ((s >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)
        first = np.flatnonzero(np.concatenate([[True], fragment[1:] != fragment[:-1]]))
        sums, held = np.add.reduceat(value, first), fragment[first]
        if len(held) <= rule.most_apart(n + top):
            full = np.zeros(count, np.uint64)
            full[held.astype(np.int64)] = sums
            sums, held = full, np.arange(count, dtype=np.uint64)
        out.append(textbytes.mix(sums + textbytes.mix(held + np.uint64(label << 40))))
    return np.concatenate(out).view(np.int64)


def sketch(s: np.ndarray, rule: Rule) -> bytes:
    """A byte for each of 2**k fragments: the exclusive or of a byte of every
    hash in it. Folding neighbours gives the sketch of fewer fragments."""
    wanted = max(CELLS, 4 * (rule.most_apart(2 * len(s) * rule.den // rule.num) + 1))
    bits = (wanted - 1).bit_length()
    out = np.zeros(1 << bits, np.uint8)
    np.bitwise_xor.at(out, (s >> np.uint64(64 - bits)).astype(np.int64), (_mixed(s, 13) >> np.uint64(56)).astype(np.uint8))
    return out.tobytes()


def folded(sketches: list[bytes]) -> np.ndarray:
    """Sketches as rows of the fewest fragments that one of them has."""
    width = min(map(len, sketches))
    rows = []
    for x in sketches:
        row = np.frombuffer(x, np.uint8)
        rows.append(row if len(row) == width else np.bitwise_xor.reduce(row.reshape(width, -1), axis=1))
    return np.stack(rows)


def _sets(batches, rule: Rule):
    """(rows of a slice, sorted set of every row)."""
    for batch in batches:
        for part in textbytes.slices(batch, "text", textbytes.BLOCK_BYTES):
            hashes, edges = textbytes.shingle_hashes(*textbytes.word_hashes(part.column(1)), rule.size)
            yield part, [np.unique(hashes[a:b]) for a, b in zip(edges[:-1], edges[1:])]


def _features(docs: DataFrame, rule: Rule, signed: bool = True) -> DataFrame:
    """doc_id, key, n_shingles, c1, c2, the most signatures that the set has, and
    the signatures (left out where the same task has sent them for an equal set,
    and everywhere unless ``signed``)."""

    def run(batches):
        bounds, seen = rule.bounds(1 << 40), set()
        for part, sets in _sets(batches, rule):
            c = [class_hash(s, rule) for s in sets]
            sigs, most = [], [sum(count for _, _, count in _cuts(len(s), rule, bounds)) for s in sets]
            for s, key in zip(sets, c):
                sigs.append(signatures(s, rule, bounds) if signed and key not in seen else np.zeros(0, np.int64))
                if len(seen) < SEEN:
                    seen.add(key)
            edges = np.concatenate([[0], np.cumsum([len(x) for x in sigs])])
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([x for x, _ in c], pa.int64()), pa.array([y for _, y in c], pa.int64()),
                 pa.array(most, pa.int64()), pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(np.concatenate(sigs)))],
                ["doc_id", "key", "n_shingles", "c1", "c2", "n_sigs", "sigs"])

    return docs.mapInArrow(run, "doc_id long, key long, n_shingles long, c1 long, c2 long, n_sigs long, sigs array<long>")


def _shared(batches):
    """Of rows (sig, node) in order: those whose sig has two nodes at least, each
    once. Only the last row seen waits for the next batch."""
    sig, node = np.zeros(0, np.int64), np.zeros(0, np.int64)
    joined = False  # whether the waiting row's sig has stood before it
    for batch in itertools.chain(batches, [None]):
        if batch is not None:
            sig, node = (np.concatenate([w, np.asarray(c)]) for w, c in zip((sig, node), batch.columns))
        if not len(sig):
            continue
        fresh = np.concatenate([[True], (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])])
        sig, node = sig[fresh], node[fresh]
        same = sig[1:] == sig[:-1]
        keep = np.concatenate([[joined], same]) | np.concatenate([same, [False]])
        joined = bool(same[-1]) if len(same) else joined
        end = len(sig) if batch is None else len(sig) - 1
        keep = keep[:end]
        yield pa.RecordBatch.from_arrays([pa.array(sig[:end][keep]), pa.array(node[:end][keep])], ["sig", "node"])
        sig, node = sig[end:], node[end:]


def _members(features: DataFrame, bits: int) -> DataFrame:
    """(sig, node, weight): the classes of every fragment that two classes
    share. Fragments with the same classes are interchangeable: one stands for
    all, ``weight`` says for how many. Signatures are cut to ``bits`` bits to
    move less; a chance match costs a comparison and nothing else."""
    rows = features.select(F.explode("sigs").alias("sig"), F.col("c1").alias("node")) \
        .select(F.shiftrightunsigned("sig", 64 - bits).alias("sig"), "node")
    dealt = rows.repartition("sig").sortWithinPartitions("sig", "node")
    held = cut_lineage(dealt.mapInArrow(_shared, "sig long, node long"))
    lists = held.groupBy("sig").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("x"),
        F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y")).where("n > 1")
    one = lists.groupBy("n", "x", "y").agg(F.min("sig").alias("sig"), F.count("*").alias("weight"))
    out = cut_lineage(held.join(one.select("sig", "weight"), "sig"))
    discard(held)
    return out


def _documents_of(nodes: DataFrame, classes: DataFrame) -> DataFrame:
    """doc_id of one document of each class in ``nodes``."""
    ids = written(classes.join(nodes.distinct(), F.col("c1") == F.col("node"), "left_semi").select("doc_id"))
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def _once(rows: DataFrame) -> DataFrame:
    """``rows`` written, with one row for each node (documents may repeat)."""
    rows = cut_lineage(rows)
    if rows.groupBy("node").count().where("count > 1").isEmpty():
        return rows
    once = cut_lineage(rows.dropDuplicates(["node"]))
    discard(rows)
    return once


def _sketches(docs: DataFrame, ids: DataFrame, rule: Rule) -> DataFrame:
    """(node, n, sketch) of the documents in ``ids``."""

    def run(batches):
        for _, sets in _sets(batches, rule):
            yield pa.RecordBatch.from_arrays([
                pa.array([class_hash(s, rule)[0] for s in sets], pa.int64()),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([sketch(s, rule) for s in sets], pa.binary())], ["node", "n", "sketch"])

    return _once(docs.join(ids, "doc_id", "left_semi").select("doc_id", "text")
                 .mapInArrow(run, "node long, n long, sketch binary"))


def _routed(pairs: DataFrame) -> DataFrame:
    """(node, places): where the sets of the pairs' classes have to meet. Each
    pair is turned so that the class in more pairs leads; a leader's set goes
    to a place of its own for each PAIRS of its pairs, the other one to its
    leader's place. ``pairs`` (a, b) is a written table without repeats."""
    ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))
    degree = ends.groupBy("node").agg(F.count("*").alias("d"))
    held = cut_lineage(lookup(cut_lineage(lookup(pairs, degree.select(F.col("node").alias("a"), F.col("d").alias("da")), ["a"])),
                              degree.select(F.col("node").alias("b"), F.col("d").alias("db")), ["b"]))
    swap = F.col("db") > F.col("da")
    led = held.select(F.when(swap, F.col("b")).otherwise(F.col("a")).alias("lead"),
                      F.when(swap, F.col("a")).otherwise(F.col("b")).alias("node"),
                      F.ceil(F.greatest("da", "db") / PAIRS).alias("copies"))
    led = led.select("lead", "node", F.pmod(F.xxhash64("node", "lead"), F.col("copies")).cast("int").alias("copy"))
    leaders = led.select("lead", F.col("lead").alias("node"), "copy").distinct()
    return led.unionByName(leaders).groupBy("node").agg(F.collect_list(F.struct("lead", "copy")).alias("places"))


def _set_parts(docs: DataFrame, pairs: DataFrame, classes: DataFrame, rule: Rule) -> DataFrame:
    """(lead, copy, fragment, node, n, part): the sets of the pairs' classes, cut
    into PARTS fragments of the order, at every place they have to go to. They
    come straight from one document of each class, and move once."""
    routes = written(_routed(pairs).join(classes, F.col("node") == F.col("c1")).select("doc_id", "node", "places"))
    routes = F.broadcast(routes) if routes.count() <= BROADCAST_ROUTES else routes

    def run(batches):
        cut = np.arange(1, PARTS, dtype=np.uint64) << np.uint64(64 - PARTS.bit_length() + 1)
        for batch in batches:
            for part in textbytes.slices(batch, "text", textbytes.BLOCK_BYTES):
                hashes, edges = textbytes.shingle_hashes(*textbytes.word_hashes(part.column(1)), rule.size)
                rows = []
                for a, b, node, places in zip(edges[:-1], edges[1:], part.column(2).to_pylist(), part.column(3).to_pylist()):
                    s = np.unique(hashes[a:b])
                    if class_hash(s, rule)[0] != node:  # another row of that id
                        continue
                    pieces = [x.tobytes() for x in np.split(s, np.searchsorted(s, cut))]
                    rows += [(p["lead"], p["copy"], i, node, len(s), piece) for p in places for i, piece in enumerate(pieces)]
                    if len(rows) >= 4096:
                        yield _rows(rows, _PARTS)
                        rows = []
                yield _rows(rows, _PARTS)

    return docs.join(routes, "doc_id").select("doc_id", "text", "node", "places") \
        .mapInArrow(run, "lead long, copy int, fragment int, node long, n long, part binary")


_PARTS = [("lead", pa.int64()), ("copy", pa.int32()), ("fragment", pa.int32()), ("node", pa.int64()), ("n", pa.int64()),
          ("part", pa.binary())]
_PARTIAL = [("a", pa.int64()), ("b", pa.int64()), ("total", pa.int64()), ("partial", pa.int64())]


def _rows(rows: list[tuple], columns: list[tuple]) -> pa.RecordBatch:
    values = list(zip(*rows)) or [[]] * len(columns)
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, (_, t) in zip(values, columns)], [c for c, _ in columns])


def _overlaps(docs: DataFrame, pairs: DataFrame, classes: DataFrame, rule: Rule) -> DataFrame:
    """(a, b, overlap, total): partial overlaps counted fragment by fragment,
    and summed for each pair. ``pairs`` (a, b) is a written table without repeats."""
    place = ["lead", "copy", "fragment"]
    parts = _set_parts(docs, pairs, classes, rule).repartition(*place) \
        .sortWithinPartitions(*place, (F.col("node") != F.col("lead")), "node")

    def count(batches):
        at, lead, size, last = None, None, 0, None
        for batch in batches:
            out = []
            columns = [batch.column(i).to_pylist() for i in range(6)]
            for row in zip(*columns):
                here, node = row[:3], row[3]
                if here != at:  # the leader's own part stands first
                    at, lead, size, last = here, np.frombuffer(row[5], np.uint64), row[4], node
                elif node != last:  # repeated rows of a document say nothing new
                    n = len(np.intersect1d(lead, np.frombuffer(row[5], np.uint64), True))
                    out.append((min(at[0], node), max(at[0], node), size + row[4], n))
                    last = node
            yield _rows(out, _PARTIAL)

    return parts.mapInArrow(count, "a long, b long, total long, partial long") \
        .groupBy("a", "b", "total").agg(F.sum("partial").alias("overlap"))


def _leading_pairs(members: DataFrame) -> DataFrame:
    """(a, b): every class with the class that leads (is smallest in) most of
    its shared fragments."""
    leads = members.groupBy("sig").agg(F.min("node").alias("lead"))
    votes = members.join(leads, "sig").where("node != lead").groupBy("node", "lead").agg(F.sum("weight").alias("n"))
    return votes.groupBy("node").agg(F.max_by("lead", F.struct("n", "lead")).alias("a")) \
        .select("a", F.col("node").alias("b"))


def _apart(members: DataFrame, found: DataFrame) -> DataFrame:
    """(sig, node, component) of the fragments whose classes are in more than
    one component."""
    held = members.join(found.withColumnRenamed("component", "c"), "node", "left") \
        .select("sig", "node", F.coalesce("c", "node").alias("component"))
    mixed = held.groupBy("sig").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y")
    return held.join(mixed.select("sig"), "sig")


def _dealt(apart: DataFrame) -> DataFrame:
    """(task, sig, node, component): the comparison tasks, each of one fragment,
    that a class takes part in. Up to BLOCK classes are one task. Beyond it the largest
    component and the other classes are dealt into blocks; tasks are the pairs
    of blocks that hold pairs of different components."""
    counts = apart.groupBy("sig", "component").agg(F.count("*").alias("n"))
    plan = counts.groupBy("sig").agg(F.max_by("component", F.struct("n", "component")).alias("main"),
                                     F.max("n").alias("n_main"), F.sum("n").alias("n_all"))
    rows = apart.join(plan, "sig")
    p = F.ceil(F.col("n_main") / BLOCK).cast("int")
    q = F.ceil((F.col("n_all") - F.col("n_main")) / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("node"), F.when(F.col("component") == F.col("main"), p).otherwise(q)).cast("int")
    upto = lambda n: F.sequence(F.lit(0), n - 1)
    name = lambda kind, x, y: F.concat(F.lit(kind), x.cast("string"), F.lit("-"), y.cast("string"))
    tasks = F.when(F.col("n_all") <= BLOCK, F.array(F.lit("all"))) \
        .when(F.col("component") == F.col("main"), F.transform(upto(q), lambda i: name("main", i, block))) \
        .otherwise(F.concat(F.transform(upto(p), lambda j: name("main", block, j)),
                            F.transform(upto(q), lambda j: name("rest", F.least(block, j), F.greatest(block, j)))))
    return rows.select("sig", "node", "component", F.explode(tasks).alias("task")) \
        .select(F.xxhash64("sig", "task").alias("task"), "sig", "node", "component")


def _search(nodes: np.ndarray, component: np.ndarray, n: np.ndarray, cells: np.ndarray,
            done: set, spare: int, rule: Rule) -> list[tuple[int, int, int, int]]:
    """(a, b, and their components): pairs of one task, of different components,
    that pass the sketch and are not ``done``: one for each two components that
    would join, and ``spare`` beside them. The rest comes in later rounds,
    unless the components have met by then. Every class of such a pair, listed or
    not, stands beside them as a pair with itself; the others are through."""
    joined, out, still = component.copy(), [], set()
    for i in range(len(nodes) - 1):
        j = i + 1 + np.flatnonzero(component[i + 1:] != component[i])
        if not len(j):
            continue
        apart = rule.most_apart(n[i] + n[j])
        j = j[(np.abs(n[i] - n[j]) <= apart) & ((cells[j] != cells[i]).sum(1) <= apart)]
        for k in j:
            (a, ca), (b, cb) = sorted([(int(nodes[i]), int(component[i])), (int(nodes[k]), int(component[k]))])
            if (a, b) in done:
                continue
            still |= {(a, ca), (b, cb)}
            joins = joined[i] != joined[k]
            if joins or spare > 0:
                out.append((a, b, min(ca, cb), max(ca, cb)))
                spare -= not joins
            if joins:  # taken as joined within this round; the pair is counted before the next
                joined[joined == joined[k]] = joined[i]
    return out + [(a, a, c, c) for a, c in still]


def _searched(batches, spare: int, rule: Rule):
    """``_search`` over rows sorted by task: classes, then pairs done before. A
    task that goes on in the next batch waits for it."""
    rest = None
    for batch in itertools.chain(batches, [None]):
        table = pa.Table.from_batches([b for b in (rest, batch) if b is not None]).combine_chunks() \
            if rest is not None or batch is not None else None
        if table is None or not table.num_rows:
            continue
        rows = table.to_batches()[0]
        task = np.asarray(rows.column(0))
        edges = np.flatnonzero(np.concatenate([[True], task[1:] != task[:-1], [True]]))
        end = len(edges) - 1 if batch is None else len(edges) - 2
        rest = rows.slice(int(edges[end]))
        node, component, n, sig = (np.asarray(rows.column(c).fill_null(0)) for c in (2, 3, 4, 6))
        kind, sketches, found = np.asarray(rows.column(1)), rows.column(5), []
        for x, y in zip(edges[:end], edges[1:end + 1]):
            m = x + int((kind[x:y] == 0).sum())
            if m - x < 2:
                continue
            cells = folded(sketches[int(x):int(m)].to_pylist())
            done = set(zip(node[m:y].tolist(), component[m:y].tolist()))
            pairs = _search(node[x:m], component[x:m], n[x:m], cells, done, spare * int(m - x), rule)
            found += [(int(task[x]), int(sig[x]), *pair) for pair in pairs]
        columns = list(zip(*found)) or [[]] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["task", "sig", "a", "b", "ca", "cb"])


def _further_pairs(apart: DataFrame, sketches: DataFrame, tested: DataFrame, spare: int, rule: Rule) -> DataFrame:
    """(task, sig, a, b, ca, cb): pairs of different components ca and cb that
    pass the sketch and that the task does not know as tested; all of them are
    found over the rounds. Where a = b, that class still has a pair in the task."""
    left = _dealt(apart).join(sketches, "node") \
        .select("task", F.lit(0).alias("kind"), "node", "component", "n", "sketch", "sig")
    done = tested.select("task", F.lit(1).alias("kind"), F.col("a").alias("node"), F.col("b").alias("component"),
                         F.lit(None).cast("long").alias("n"), F.lit(None).cast("binary").alias("sketch"), "sig")
    parts = int(apart.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (left.unionByName(done).repartition(parts, "task").sortWithinPartitions("task", "kind")
            .mapInArrow(lambda batches: _searched(batches, spare, rule),
                        "task long, sig long, a long, b long, ca long, cb long"))


def _chosen(raw: DataFrame, counted: DataFrame, most: int) -> DataFrame:
    """(a, b): of the pairs in ``raw`` that are not ``counted``, at most ``most``
    for each two components, over all fragments."""
    fresh = raw.select("a", "b", "ca", "cb").distinct().join(counted, ["a", "b"], "left_anti")
    rank = F.row_number().over(Window.partitionBy("ca", "cb").orderBy(F.xxhash64("a", "b"), "a", "b"))
    return fresh.withColumn("rank", rank).where(F.col("rank") <= most).select("a", "b")


def link_classes(docs: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame]:
    """(documents: doc_id, key, n_shingles, node; components of nodes: node,
    component), where ``docs`` has doc_id (not null), text and key."""
    spark = docs.sparkSession
    small_batches(spark)
    while True:
        features = cut_lineage(_features(docs, rule, signed=False).drop("sigs"))
        classes = cut_lineage(features.groupBy("c1").agg(F.min("doc_id").alias("doc_id"), F.min("c2").alias("x"),
                                                         F.max("c2").alias("y"), F.max("n_sigs").alias("n_sigs")))
        if classes.where("x != y").isEmpty():
            break
        rule = replace(rule, seed=rule.seed + 1)  # two sets share 64 bits: hash anew
    documents = features.select("doc_id", "key", "n_shingles", F.col("c1").alias("node"))
    total = classes.agg(F.sum("n_sigs").alias("n")).first()["n"] or 0
    # the signatures are made again, straight into their shuffle: a table of them would lie beside it
    members = _members(_features(docs, rule), min(64, int(total).bit_length() + 16))
    release(spark)
    sketches = _sketches(docs, _documents_of(members.select("node"), classes), rule)
    threshold = (rule.num + rule.den) * F.col("overlap") >= rule.num * F.col("total")
    empty = spark.range(0).where("false")  # rows from the driver's Python would start further workers
    found = empty.selectExpr("id AS node", "id AS component")
    none, seen = empty.selectExpr("id AS a", "id AS b"), []
    todo, tested, turn = written(_leading_pairs(members).distinct()), [], 0
    while True:
        counted = written(_overlaps(docs, todo, classes, rule).withColumn("linked", threshold))
        seen.append(todo)
        links = counted.where("linked").select("a", "b")
        met = not links.isEmpty()  # the files of the job before the last one can go
        release(spark)
        if met:
            found = _joined(found, links)
        before = reduce(DataFrame.unionByName, seen, none)
        apart = written(_apart(members, found))
        discard(members)
        while True:  # until there are pairs to count; a task may bring up what another one has had counted
            known = reduce(DataFrame.unionByName, tested, none.selectExpr("a AS task", "a AS sig", "a", "b"))
            raw = written(_further_pairs(apart, sketches, known, 4 ** turn - 1, rule))
            if raw.isEmpty():
                return documents, found
            release(spark)
            pairs = raw.where("a != b")
            todo = written(_chosen(pairs, before, 4 ** turn))
            tested.append(written(pairs.join(todo.unionByName(before).distinct(), ["a", "b"], "left_semi")
                                  .select("task", "sig", "a", "b")))
            if not todo.isEmpty():
                break
        turn += 1
        # a class without a pair in a fragment by now has none there later
        members = written(raw.where("a = b").select("sig", F.col("a").alias("node")).distinct())
        discard(apart)


def _joined(found: DataFrame, links: DataFrame) -> DataFrame:
    """The components after more links: a node's component may itself have
    moved to a smaller one."""
    ends = lambda c: found.select(F.col("node").alias(c), F.col("component").alias(f"of_{c}"))
    between = links.join(ends("a"), "a", "left").join(ends("b"), "b", "left") \
        .select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b"))
    moved = written(components(between))
    kept = found.join(moved.select(F.col("node").alias("component"), F.col("component").alias("next")),
                      "component", "left").select("node", F.coalesce("next", "component").alias("component"))
    new = moved.join(found.select("node"), "node", "left_anti")
    return written(kept.unionByName(new.select("node", "component")))


def _resolved(docs: DataFrame, rule: Rule) -> DataFrame:
    """doc_id, key, n_shingles, component_id of every row, NONE for a null id.
    ``key`` is a hash of the text, so (doc_id, key) names equal rows."""
    docs = docs.select(F.coalesce("doc_id", F.lit(NONE).cast("long")).alias("doc_id"), "text",
                       F.xxhash64("text").alias("key"))
    documents, found = link_classes(docs, rule)
    worded = documents.where("n_shingles > 0")
    classes = worded.groupBy("node").agg(F.min("doc_id").alias("first"))
    members = classes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    first = members.groupBy("component").agg(F.min("first").alias("component_id"))
    named = members.join(first, "component").select("node", "component_id")
    return (worded.join(named, "node").select("doc_id", "key", "n_shingles", "component_id")
            .unionByName(documents.where("n_shingles = 0")
                         .select("doc_id", "key", "n_shingles", F.col("doc_id").alias("component_id"))))


def components_of(docs: DataFrame, rule: Rule) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles (size of its set),
    component_id (smallest doc_id reachable by links, itself included).

    Null and empty texts, and texts without words, have no shingles and no
    links; copies are one class, and every copy gets its row. A null doc_id
    counts as the smallest id and is returned as null. Rows that share a doc_id
    but not a text are separate members. Very long texts are hashed in blocks.
    Other columns are not read; an empty table gives no rows."""
    back = lambda c: F.when(F.col(c) != NONE, F.col(c)).alias(c)
    return _resolved(docs, rule).select(back("doc_id"), "n_shingles", back("component_id"))


def keep_one(docs: DataFrame, rule: Rule) -> DataFrame:
    """``docs`` (same columns) with one document of each component: the one
    whose doc_id names it, once. Documents without shingles have no copies and
    all stay, also repeated ones."""
    found = cut_lineage(_resolved(docs, rule).where("n_shingles > 0"))
    named = found.where("doc_id = component_id").groupBy("component_id").agg(F.min("key").alias("first_key"))
    gone = (found.join(named, "component_id").where("doc_id != component_id OR key != first_key")
            .select("doc_id", "key").distinct())
    twice = found.groupBy("doc_id", "key").count().where("count > 1").select("doc_id", "key")
    id_, key = textbytes.unused(docs, "own_id"), textbytes.unused(docs, "own_key")
    keyed = docs.withColumns({id_: F.coalesce("doc_id", F.lit(NONE).cast("long")), key: F.xxhash64("text")})
    gone, twice = (t.toDF(f"{id_}_", f"{key}_") for t in (gone, twice))
    on = [F.col(id_) == F.col(f"{id_}_"), F.col(key) == F.col(f"{key}_")]
    kept = keyed.join(gone, on, "left_anti")
    if not twice.isEmpty():
        again = kept.join(twice, on, "left_semi").dropDuplicates([id_, key])
        kept = kept.join(twice, on, "left_anti").unionByName(again)
    return kept.select(*docs.columns)
