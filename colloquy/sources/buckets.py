"""Tables kept in buckets, of which a change rewrites only those it touches (S14 for D1, D5 and D7).

The bucket of a row is a SQL expression over its key, chosen when the table is
created and stored with it: a hash (``pmod(xxhash64(entity), 256)``) spreads
random keys, a range of numbers (``message_id div 65536``) keeps the newest keys
together, so that a batch of new rows touches few buckets however long the table is.

Layout below the table's folder::

    data/kb_version=<name>/kb_bucket=<b>/part-*.parquet   never changed once written
    manifest-<number>/                                     one JSON row, written last

A manifest names the version folders each bucket consists of; the highest
finished one is the table. A reader resolves it once and is pinned to it: later
merges write new folders and a new manifest. Of two writers that start from the same
manifest the second raises, as no manifest is ever replaced. A run that fails
before its manifest leaves folders that no reader looks at.

The driver holds one entry for each bucket (and one for each unfolded insert into
it), never rows; choose the expression so that a bucket holds at least tens of megabytes.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_VERSION, _BUCKET = "kb_version", "kb_bucket"


@dataclass(frozen=True)
class Manifest:
    """One state of a table: its number, bucket expression, schema, and the
    version folders of every bucket that holds rows."""
    number: int
    bucket: str
    schema: StructType
    versions: dict[str, tuple[str, ...]]

    def folders(self, base: str, buckets: Sequence[str] | None = None) -> list[str]:
        wanted = self.versions if buckets is None else [b for b in buckets if b in self.versions]
        return [f"{base}/data/{_VERSION}={v}/{_BUCKET}={b}" for b in sorted(wanted) for v in self.versions[b]]


def _glob(spark: SparkSession, pattern: str) -> list:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return [f.getPath() for f in found or []]


def current(spark: SparkSession, base: str) -> Manifest | None:
    """The newest finished manifest of a table, or None where there is no table."""
    base = base.rstrip("/")
    done = [int(p.getParent().getName().split("-")[1]) for p in _glob(spark, f"{base}/manifest-*/_SUCCESS")]
    if not done:
        return None
    row = spark.read.schema("bucket string, schema string, versions string").json(
        f"{base}/manifest-{max(done):012d}").first()
    return Manifest(max(done), row["bucket"], StructType.fromJson(json.loads(row["schema"])),
                    {b: tuple(v) for b, v in json.loads(row["versions"]).items()})


def _publish(spark: SparkSession, base: str, m: Manifest) -> Manifest:
    row = (m.bucket, m.schema.json(), json.dumps(m.versions))
    (spark.createDataFrame([row], "bucket string, schema string, versions string").coalesce(1)
          .write.mode("errorifexists").json(f"{base}/manifest-{m.number:012d}"))
    return m


def _write(df: DataFrame, base: str, bucket: str) -> tuple[str, list[str]]:
    """Rows written by bucket as one new version; its name and its buckets. The
    rebalance hint lets a bucket far above the advisory size take several
    tasks (and files), so a hot key is not one task."""
    spark, version = df.sparkSession, uuid.uuid4().hex[:12]
    path = f"{base}/data/{_VERSION}={version}"
    # a bucket's name is text: a NULL key has the bucket 'null'
    named = df.withColumn(_BUCKET, F.coalesce(F.expr(bucket).cast("string"), F.lit("null")))
    named.hint("rebalance", F.col(_BUCKET)).write.partitionBy(_BUCKET).mode("errorifexists").parquet(path)
    return version, [p.getName().split("=", 1)[1] for p in _glob(spark, f"{path}/{_BUCKET}=*")]


def _read(spark: SparkSession, base: str, m: Manifest, buckets: Sequence[str] | None = None) -> DataFrame:
    folders = m.folders(base, buckets)
    if not folders:
        return spark.createDataFrame([], m.schema)
    return spark.read.schema(m.schema).parquet(*folders)


def create(df: DataFrame, base: str, bucket: str) -> Manifest:
    """A new table of the rows of ``df``; raises where one exists."""
    spark, base = df.sparkSession, base.rstrip("/")
    if current(spark, base):
        raise ValueError(f"{base} holds a table")
    version, buckets = _write(df, base, bucket)
    return _publish(spark, base, Manifest(1, bucket, df.schema, {b: (version,) for b in buckets}))


def read(spark: SparkSession, base: str, manifest: Manifest | None = None) -> DataFrame:
    """The table, or its state at ``manifest``."""
    base = base.rstrip("/")
    m = manifest or current(spark, base)
    if m is None:
        raise ValueError(f"{base} holds no table")
    return _read(spark, base, m)


def touched(changes: DataFrame, m: Manifest) -> list[str]:
    """Names of the buckets that the keys of ``changes`` fall into."""
    name = F.coalesce(F.expr(m.bucket).cast("string"), F.lit("null"))
    return sorted(r[0] for r in changes.select(name.alias("b")).distinct().collect())


def merge(changes: DataFrame, base: str, how: Callable[[DataFrame, DataFrame], DataFrame]) -> Manifest:
    """``how(old, changes)`` applied to the buckets that ``changes`` touch; the
    other buckets keep their files. ``how`` must decide about a row from
    rows of the same bucket alone (a keyed merge whose key contains the bucket's
    columns). Folds the inserts of those buckets into one version."""
    spark, base = changes.sparkSession, base.rstrip("/")
    m = current(spark, base)
    names = touched(changes, m)
    if not names:
        return m
    new = how(_read(spark, base, m, names), changes).select(*m.schema.names)
    version, written = _write(new, base, m.bucket)
    strange = set(written) - set(names)
    if strange:
        raise ValueError(f"the merge moved rows into buckets it did not read: {sorted(strange)[:5]}")
    kept = {b: v for b, v in m.versions.items() if b not in names}
    return _publish(spark, base, Manifest(m.number + 1, m.bucket, m.schema,
                                          kept | {b: (version,) for b in written}))


def insert_absent(changes: DataFrame, base: str, key: str | Sequence[str],
                  order: str | Sequence[str] | None = None) -> Manifest:
    """D1 on a table in buckets: rows whose key is new are added as further
    files of their buckets. Only the key columns of the touched buckets are read,
    and nothing is rewritten; repeated keys are resolved as in
    ``state.insert_if_absent``. A NULL key equals no other, as there."""
    from ..operators.state import insert_if_absent
    spark, base = changes.sparkSession, base.rstrip("/")
    m = current(spark, base)
    key = [key] if isinstance(key, str) else list(key)
    names = touched(changes, m)
    known = _read(spark, base, m, names).select(*key)
    first = insert_if_absent(spark.createDataFrame([], m.schema), changes, key, order)
    version, written = _write(first.join(known, key, "left_anti"), base, m.bucket)
    if not written:
        return m
    grown = {b: (*m.versions.get(b, ()), version) for b in written}
    return _publish(spark, base, Manifest(m.number + 1, m.bucket, m.schema, m.versions | grown))


def files(spark: SparkSession, base: str, manifest: Manifest) -> set[str]:
    """Paths of the data files of one state of a table."""
    return {p.toString() for f in manifest.folders(base.rstrip("/")) for p in _glob(spark, f"{f}/*.parquet")}
