"""Embeddings and nearest-neighbour retrieval.

Top-k is a matrix product in blocks. Queries and vectors are dealt to the
cells of a grid, a vector to every row of cells and a query to every column,
so each pair meets in one cell, inside Spark and without a pair table. A task
holds the queries of its cell (QUERY_BYTES at most), lets the vectors stream
by and keeps the k best for each query; what the columns found is merged in a
tree. Any number of queries is one pass over the vectors.

The approximate search (an inverted file) does the same inside the cells of a
k-means partition: every vector is posted in one cell, a query visits the cells
whose centres are nearest to it.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .inference import Model, function_of, retried

#: Most bytes of a cell's queries (as doubles); vectors that a cell sees; cells' results merged at once.
QUERY_BYTES, CELL_VECTORS, FAN = 1 << 26, 1 << 18, 64
#: Queries and vectors scored at once.
TILE = 1024
#: Products this close are told apart by the exact sum, not by the matrix product; scores that agree to
#: DIGITS places are ties.
SLACK, DIGITS = 1e-8, 10
#: Most queries that every task of an LSH search holds.
HELD = 4096
#: Inverted file: most vectors that the centres are fitted on, most centres, vectors that recall is measured for.
SAMPLE, CENTRES, JUDGES = 20_000, 4096, 256


def _matrix(column: pa.Array) -> np.ndarray:
    """The vectors of a list column as rows of one matrix."""
    flat = np.asarray(column.flatten(), np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


class _Best:
    """The k best vectors so far of each query of a cell."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray, k: int):
        self.ids, self.k, self.matrix = ids, k, matrix
        self.query, self.id, self.score = np.zeros(0, np.int64), None, np.zeros(0)
        self.least = np.full(len(ids), -np.inf)

    def see(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        ids, vectors = self._alike(ids, vectors)
        for a in range(0, len(vectors), TILE):
            for b in range(0, len(self.matrix), TILE):
                self._tile(b, ids[a:a + TILE], vectors[a:a + TILE])

    def _alike(self, ids, vectors):
        """Of equal vectors, the k smallest ids are enough."""
        if len(ids) <= self.k:
            return ids, vectors
        key = np.ascontiguousarray(vectors).view(np.dtype((np.void, vectors.shape[1] * 8))).ravel()
        _, same = np.unique(key, return_inverse=True)
        order = np.lexsort((ids, same))
        kept = order[_place(same[order]) < self.k]
        return ids[kept], vectors[kept]

    def _tile(self, at: int, ids: np.ndarray, vectors: np.ndarray) -> None:
        queries = self.matrix[at:at + TILE]
        product = queries @ vectors.T
        floor = self.least[at:at + TILE]
        if product.shape[1] > self.k:
            floor = np.maximum(floor, np.partition(product, -self.k, axis=1)[:, -self.k])
        row, col = np.nonzero(product >= floor[:, None] - SLACK)
        if not len(row):
            return
        # one order of summing for every pair: equal vectors get equal scores
        exact = np.round((queries[row] * vectors[col]).sum(axis=1), DIGITS)
        query = np.concatenate([self.query, row + at])
        score = np.concatenate([self.score, exact])
        every = ids[col] if self.id is None else np.concatenate([self.id, ids[col]])
        order = np.lexsort((every, -score, query))
        order = order[_place(query[order]) < self.k]
        self.query, self.id, self.score = query[order], every[order], score[order]
        full = np.flatnonzero(_place(self.query) == self.k - 1)
        self.least[self.query[full]] = self.score[full]


def _place(sorted_keys: np.ndarray) -> np.ndarray:
    """0, 1, 2, ... inside each run of equal keys."""
    n = len(sorted_keys)
    starts = np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]])) if n else np.zeros(0, int)
    return np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n)))


def _score_cells(k: int, names: list[str]):
    """Over rows (cell, kind, piece, query id, id, vector) sorted by cell and
    kind, queries (kind 0) before vectors: the k best of every cell."""

    def run(batches):
        cell, best, held, piece = None, None, [], 0

        def done():
            if best is None or best.id is None:
                return
            order = np.arange(len(best.query))
            yield pa.RecordBatch.from_arrays([
                pa.array(best.ids[best.query[order]]), pa.array(best.id), pa.array(best.score),
                pa.array(np.full(len(order), piece), pa.int64())], names)

        for batch in batches:
            cells, kinds = (np.asarray(batch.column(i)) for i in (0, 1))
            edges = np.flatnonzero(np.concatenate([[True], (cells[1:] != cells[:-1]) | (kinds[1:] != kinds[:-1]), [True]])) \
                if len(cells) else [0]
            for a, b in zip(edges[:-1], edges[1:]):
                part = batch.slice(int(a), int(b - a))
                if cells[a] != cell:
                    yield from done()
                    cell, best, held, piece = cells[a], None, [], int(np.asarray(part.column(2))[0])
                vectors = _matrix(part.column(5))
                if kinds[a] == 0:
                    held.append((np.asarray(part.column(3)), vectors))
                elif held:
                    if best is None:
                        best = _Best(np.concatenate([i for i, _ in held]), np.concatenate([m for _, m in held]), k)
                    best.see(np.asarray(part.column(4)), vectors)
        yield from done()
    return run


def _unit(df: DataFrame, id_col: str, vec_col: str, out: str) -> DataFrame:
    """(<out>, v): the vectors as doubles of length 1; null and zero vectors,
    and those with a part that is no finite number, are left out."""
    v = F.col(vec_col).cast("array<double>")
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))
    scaled = df.select(F.col(id_col).alias(out), v.alias("v"), norm.alias("_n"))
    return scaled.where("_n > 0 AND _n < double('Infinity') AND NOT isnan(_n)") \
        .select(out, F.transform("v", lambda x: x / F.col("_n")).alias("v"))


def _best_of_grid(queries: DataFrame, vectors: DataFrame, k: int, cells: int, dim: int) -> DataFrame:
    """(query_id, id, score): the k best of every query among the vectors of its
    cells. ``queries`` (cell, query_id, v) and ``vectors`` (cell, id, v) are
    written tables; there are at most ``cells`` (<= CENTRES) cells. A cell with
    many queries or vectors is a grid of its own."""
    spark = queries.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    room = max(1, QUERY_BYTES // (8 * dim))
    nq = queries.groupBy("cell").agg(F.count("*").alias("nq"))
    nv = vectors.groupBy("cell").agg(F.count("*").alias("nv"))
    spread = math.ceil(width / cells)
    grid = F.broadcast(cut_lineage(nq.join(nv, "cell").select(  # at most CENTRES rows
        "cell", F.ceil(F.col("nq") / room).alias("r"),
        F.greatest(F.ceil(F.col("nv") / CELL_VECTORS), F.least(F.lit(spread), F.ceil(F.col("nv") / TILE))).alias("c"))))
    turn = F.monotonically_increasing_id()
    qid, vid = queries.schema["query_id"].dataType, vectors.schema["id"].dataType
    name = lambda i, j: F.col("cell").cast("bigint") * (1 << 48) + F.col(i) * (1 << 24) + F.col(j)
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n).cast("long") - 1))
    q = queries.withColumn("_t", turn).join(grid, "cell").withColumn("i", F.pmod("_t", F.col("r"))) \
        .withColumn("j", upto("c"))
    v = vectors.withColumn("_t", turn).join(grid, "cell").withColumn("j", F.pmod("_t", F.col("c"))) \
        .withColumn("i", upto("r"))
    rows = q.select(name("i", "j").alias("place"), F.lit(0).alias("kind"), F.col("j").cast("long").alias("piece"),
                    "query_id", F.lit(None).cast(vid).alias("id"), "v").unionByName(
           v.select(name("i", "j").alias("place"), F.lit(1).alias("kind"), F.col("j").cast("long").alias("piece"),
                    F.lit(None).cast(qid).alias("query_id"), "id", "v"))
    cols = ["query_id", "id", "score", "piece"]
    found = rows.repartition(max(width, cells), "place").sortWithinPartitions("place", "kind").mapInArrow(
        _score_cells(k, cols), f"query_id {qid.simpleString()}, id {vid.simpleString()}, score double, piece long")
    return _merged(found, k, math.ceil(vectors.count() / CELL_VECTORS) + spread)


def _merged(found: DataFrame, k: int, pieces: int) -> DataFrame:
    """The k best of each query over all pieces, FAN pieces at a time."""
    while True:
        top = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "id"))), 1, k)
        found = found.groupBy("query_id", F.floor(F.col("piece") / FAN).alias("piece")).agg(top.alias("b")) \
            .select("query_id", "piece", F.posexplode("b").alias("rank", "b")) \
            .select("query_id", "piece", (F.col("rank") + 1).alias("rank"), F.col("b.id").alias("id"),
                    (-F.col("b.s")).alias("score"))
        pieces = math.ceil(pieces / FAN)
        if pieces <= 1:
            return found.select("query_id", "id", "score", "rank")


def _dim(table: DataFrame) -> int:
    first = table.select(F.size("v").alias("n")).first()
    return first["n"] if first else 1


def vector_topk(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id",
                vec_col: str = "embedding", qid_col: str = "query_id", qvec_col: str = "embedding") -> DataFrame:
    """T5 exact: (query_id, <id_col>, score, rank) for the k most cosine-similar
    vectors of every query (ties by id). Null and zero vectors never match."""
    q = cut_lineage(_unit(queries, qid_col, qvec_col, "query_id").select(F.lit(0).alias("cell"), "query_id", "v"))
    v = cut_lineage(_unit(vectors, id_col, vec_col, "id").select(F.lit(0).alias("cell"), "id", "v"))
    best = _best_of_grid(q, v, k, 1, _dim(v))
    return best.select("query_id", F.col("id").alias(id_col), "score", "rank")


class InvertedFile:
    """T5 approximate: an inverted file over the vectors of a table.

    ``cells`` centres are fitted by k-means on at most SAMPLE vectors (those
    whose ids have the smallest hashes); every vector is posted in the cell of
    the nearest centre. ``search`` scores the vectors of the ``probes`` cells
    nearest to a query, exactly; candidates are counted by ``candidates``.

    How many cells a recall takes depends on the data: a few where the vectors
    have clusters, about half of all where they spread evenly in many
    dimensions. ``probes_for`` measures it."""

    def __init__(self, vectors: DataFrame, cells: int | None = None, id_col: str = "vec_id",
                 vec_col: str = "embedding", seed: int = 7):
        from pyspark.ml.clustering import KMeans
        from pyspark.ml.functions import array_to_vector
        self.id_col = id_col
        rows = cut_lineage(_unit(vectors, id_col, vec_col, "id"))
        self.size, self.dim = rows.count(), _dim(rows)
        cells = cells or math.ceil(2 * math.sqrt(self.size))
        sample = rows.orderBy(F.xxhash64("id", "v")).limit(SAMPLE)
        fit = KMeans(k=max(2, min(cells, CENTRES)), seed=seed, maxIter=20, featuresCol="f", initMode="k-means||")
        self.centres = np.stack(fit.fit(sample.select(array_to_vector("v").alias("f"))).clusterCenters()) \
            if self.size > 1 else np.zeros((1, self.dim))
        self.postings = cut_lineage(self._nearest(rows, "id", 1).select("cell", "id", "v"))

    def _nearest(self, rows: DataFrame, id_col: str, n: int) -> DataFrame:
        """(cell, <id_col>, v): the rows once for each of their n nearest centres."""
        centres, n = self.centres, min(n, len(self.centres))
        half = (centres ** 2).sum(axis=1) / 2

        def run(batches):
            for batch in batches:
                for a in range(0, batch.num_rows, TILE):
                    part = batch.slice(a, TILE)
                    near = np.argsort(half - _matrix(part.column(1)) @ centres.T, axis=1, kind="stable")[:, :n]
                    at = np.repeat(np.arange(part.num_rows), n)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(near.ravel().astype(np.int32)), part.column(0).take(pa.array(at)),
                         part.column(1).take(pa.array(at)), pa.array(np.tile(np.arange(1, n + 1, dtype=np.int32), part.num_rows))],
                        ["cell", id_col, "v", "place"])
        kind = rows.schema[id_col].dataType.simpleString()
        return rows.select(id_col, "v").mapInArrow(run, f"cell int, {id_col} {kind}, v array<double>, place int")

    def _visits(self, queries: DataFrame, probes: int, qid_col: str, qvec_col: str) -> DataFrame:
        return cut_lineage(self._nearest(_unit(queries, qid_col, qvec_col, "query_id"), "query_id", probes))

    def search(self, queries: DataFrame, k: int = 5, probes: int = 4, qid_col: str = "query_id",
               qvec_col: str = "embedding") -> DataFrame:
        """(query_id, <id_col>, score, rank): the k best vectors of every query
        in the ``probes`` cells it visits (ties by id)."""
        visits = self._visits(queries, probes, qid_col, qvec_col)
        found = _best_of_grid(visits, self.postings, k, len(self.centres), self.dim)
        return found.select("query_id", F.col("id").alias(self.id_col), "score", "rank")

    def probes_for(self, share: float = 0.95, k: int = 5) -> int:
        """The least number of cells for which ``share`` of the exact k nearest
        vectors of JUDGES stored vectors (those whose ids have the smallest
        hashes) lie in the cells that these visit."""
        judges = self.postings.orderBy(F.xxhash64("v", "id")).limit(JUDGES) \
            .select(F.col("id").alias("query_id"), F.col("v").alias("embedding"))
        judges = cut_lineage(judges)
        exact = vector_topk(self.postings, judges, k, "id", "v")
        where = self.postings.select("id", "cell").distinct()
        order = self._visits(judges, len(self.centres), "query_id", "embedding").select("query_id", "cell", "place")
        far = exact.join(where, "id").join(order, ["query_id", "cell"]) \
            .agg(F.percentile("place", F.lit(share)).alias("p")).first()["p"]
        return math.ceil(far) if far else 1

    def candidates(self, queries: DataFrame, probes: int = 4, qid_col: str = "query_id",
                   qvec_col: str = "embedding") -> DataFrame:
        """One row: queries, pairs that a search scores, pairs that there are."""
        visits = self._visits(queries, probes, qid_col, qvec_col).groupBy("cell").agg(F.count("*").alias("q"))
        sizes = self.postings.groupBy("cell").agg(F.count("*").alias("v"))
        both = visits.join(sizes, "cell", "left").agg(
            F.sum("q").alias("q"), F.sum(F.col("q") * F.coalesce("v", F.lit(0))).alias("scored"))
        n = (F.col("q") / min(probes, len(self.centres))).cast("long")
        return both.select(n.alias("queries"), "scored", (n * self.size).alias("pairs"))


def recall(found: DataFrame, exact: DataFrame, id_col: str = "vec_id") -> DataFrame:
    """One row: the share of the rows of ``exact`` (query_id, id) that ``found`` holds."""
    hit = exact.join(found.select("query_id", id_col, F.lit(1).alias("_hit")), ["query_id", id_col], "left")
    return hit.agg((F.count("_hit") / F.count("*")).alias("recall"))


def vector_topk_lsh(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id",
                    vec_col: str = "embedding", bucket_length: float = 0.5, num_tables: int = 4) -> DataFrame:
    """T5 approximate: random-projection LSH on normalised vectors; only
    candidates that share a bucket in some table meet, then they are ranked by
    distance. Rows that are equal count once, and a pair is scored in the first
    table where it meets, so no pairs are made distinct; up to HELD queries are held by every task and the vectors
    stream by, and each task keeps k for a query before anything is moved."""
    from pyspark.ml.feature import BucketedRandomProjectionLSH, Normalizer
    from pyspark.ml.functions import array_to_vector, vector_to_array
    v, q = (d.distinct() for d in (vectors.select(id_col, vec_col), queries.select("query_id", "embedding")))
    v = v.select(id_col, array_to_vector(F.col(vec_col)).alias("_raw"))
    q = q.select(F.col("query_id"), array_to_vector(F.col("embedding")).alias("_raw"))
    norm = Normalizer(inputCol="_raw", outputCol="features")
    v, q = norm.transform(v), norm.transform(q)
    lsh = BucketedRandomProjectionLSH(inputCol="features", outputCol="hashes",
                                      bucketLength=bucket_length, numHashTables=num_tables, seed=42)
    model = lsh.fit(v)

    def hashed(df, key, vec, hashes):
        cells = F.transform("hashes", lambda h: vector_to_array(h)[0])
        return model.transform(df).select(key, vector_to_array("features").alias(vec), cells.alias(hashes))

    queries = cut_lineage(hashed(q, "query_id", "a", "ha"))
    few = queries.count() <= HELD
    at = lambda h: F.posexplode(h).alias("table", "cell")
    asked = queries.select("*", at("ha"))
    rows = hashed(v, id_col, "b", "hb").select("*", at("hb"))
    met = rows.join(F.broadcast(asked) if few else asked, ["table", "cell"])
    met = met.where(F.array_position(F.zip_with("ha", "hb", lambda x, y: x == y), True) == F.col("table") + 1)
    gap = F.zip_with("a", "b", lambda x, y: (x - y) * (x - y))
    r = met.select("query_id", id_col, F.sqrt(F.aggregate(gap, F.lit(0.0), lambda s, x: s + x)).alias("dist"))
    r = r.where("dist < 2.0").select("query_id", id_col, (1 - F.col("dist") ** 2 / 2).alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc(id_col))
    return r.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def hashing_embed(df: DataFrame, text_col: str, out: str = "embedding") -> DataFrame:
    """M5 built-in: counts of lower-case words by the first byte of their MD5
    digest (256 parts), scaled to length 1 (all zeros without words). All
    JVM-side; swap in ``embed_with`` for a model."""
    from pyspark.ml.feature import CountVectorizerModel, Normalizer
    from pyspark.ml.functions import vector_to_array
    words = F.filter(F.split(F.lower(F.coalesce(F.col(text_col), F.lit(""))), "[^0-9a-z_]+"), lambda w: w != "")
    slots = df.withColumn("_slots", F.transform(words, lambda w: F.substring(F.md5(w), 1, 2)))
    count = CountVectorizerModel.from_vocabulary([f"{i:02x}" for i in range(256)], "_slots", "_counts")
    unit = Normalizer(inputCol="_counts", outputCol="_unit").transform(count.transform(slots))
    return unit.withColumn(out, vector_to_array("_unit")).drop("_slots", "_counts", "_unit")


def embed_with(df: DataFrame, text_col: str, fn: Callable[[list[str]], list[list[float]]] | Model,
               key_col: str, batch_size: int = 32, retries: int = 7, out: str = "embedding",
               pause: float = 0.01) -> DataFrame:
    """M5 pluggable: ``fn(texts) -> vectors`` called inside the tasks for every
    ``batch_size`` texts, whatever the Arrow batches are; only the last call of a
    partition has fewer. A ``Model`` is loaded once for a worker. A call is retried
    with a doubling wait; rows whose call still fails have a null vector and the
    status 'failed'."""
    def run(batches):
        call = function_of(fn)

        def embedded(b):
            vecs, _ = retried(lambda: call(b[text_col].tolist()), retries, pause)
            status = "failed" if vecs is None else "ok"
            return pd.DataFrame({key_col: b[key_col].to_numpy(), out: list(vecs or [None] * len(b)), "status": status})

        rest = None
        for pdf in batches:
            rest = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            whole = len(rest) // batch_size * batch_size
            for i in range(0, whole, batch_size):
                yield embedded(rest.iloc[i:i + batch_size])
            rest = rest.iloc[whole:]
        if rest is not None and len(rest):
            yield embedded(rest)

    schema = f"{key_col} {df.schema[key_col].dataType.simpleString()}, {out} array<double>, status string"
    return df.select(key_col, text_col).mapInPandas(run, schema)


def load_word_hasher() -> Callable[[list[str | None]], list[list[float]]]:
    """A stand-in embedding model with the vectors of ``hashing_embed``."""
    word = re.compile("[0-9a-z_]+")

    def embed(texts):
        counts = np.zeros((len(texts), 256))
        for row, text in zip(counts, texts):
            for w in word.findall((text or "").lower()):
                row[hashlib.md5(w.encode()).digest()[0]] += 1
        norm = np.sqrt((counts ** 2).sum(1, keepdims=True))
        return (counts / np.where(norm > 0, norm, 1.0)).tolist()
    return embed


def vector_upsert(index: DataFrame, new: DataFrame, key: str = "message_id",
                  order: str | None = None) -> DataFrame:
    """Write (key, vector, metadata) replacing equal keys; of equal keys
    inside ``new`` the last by ``order`` stays (without one, the greatest row).
    Keyed by the message id, so a rebuild from visible rows drops hidden ones."""
    from .state import keep_by_order
    new = keep_by_order(new, key, order or [c for c in new.columns if c != key])
    if order and order not in index.columns:
        new = new.drop(order)
    return index.join(new.select(key), key, "left_anti").unionByName(new)


def hits_with_answers(hits: DataFrame, qa: DataFrame, key: str = "message_id") -> DataFrame:
    """Neighbours joined to their Q&A rows (hits are k per query)."""
    return hits.join(qa, key, "inner")
