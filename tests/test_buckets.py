"""Tables in buckets: a merge equals the whole merge and writes little."""

import pytest
from pyspark.sql import functions as F

from colloquy.operators import state as D
from colloquy.operators.statements import merge_statements
from colloquy.sources import buckets as B
from colloquy.sources.io import scratch_path


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _statements(spark, lo, hi, tag):
    r = spark.range(lo, hi)
    return r.select(F.concat(F.lit("Proposal "), F.col("id").cast("string")).alias("entity"),
                    F.lit("Status").alias("property"), F.concat(F.lit(tag), F.col("id").cast("string")).alias("value"))


BY_NUMBER = "cast(substring_index(entity, ' ', -1) as bigint) div 50"


@pytest.mark.parametrize("mode", ["replace_all", "append_or_replace"])
def test_merge_of_one_percent_writes_few_files(spark, mode):
    old, new = _statements(spark, 0, 10000, "a"), _statements(spark, 9950, 10050, "b")
    base = scratch_path(spark, "buckets")
    first = B.create(old, base, BY_NUMBER)
    pinned = B.read(spark, base)
    second = B.merge(new, base, lambda o, c: merge_statements(o, c, mode))
    assert _rows(B.read(spark, base)) == _rows(merge_statements(old, new, mode))
    assert _rows(pinned) == _rows(old) == _rows(B.read(spark, base, first))
    before, after = B.files(spark, base, first), B.files(spark, base, second)
    assert len(after - before) < 0.05 * len(after)
    assert len(before & after) >= 199


def test_hashed_buckets_null_keys_and_deletions(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    base = scratch_path(spark, "buckets")
    B.create(old, base, "pmod(xxhash64(k), 16)")
    gone = spark.createDataFrame([("a", 0)], "k string, v int")
    B.merge(gone, base, lambda o, c: o.join(c.select("k"), "k", "left_anti"))
    assert _rows(B.read(spark, base)) == _rows(old.filter("k = 'b' or k is null"))
    with pytest.raises(ValueError, match="holds a table"):
        B.create(old, base, "k")


def test_insert_absent_reads_only_touched_buckets_and_replays(spark):
    base = scratch_path(spark, "buckets")
    rows = spark.range(0, 4000, 2).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    first = B.create(rows, base, "k div 100")
    batch = spark.range(150, 260).select(F.col("id").alias("k"), F.lit("new").alias("v"))
    assert B.touched(batch, first) == ["1", "2"]
    second = B.insert_absent(batch, base, "k")
    want = D.insert_if_absent(rows, batch, "k")
    assert _rows(B.read(spark, base)) == _rows(want)
    assert B.files(spark, base, first) < B.files(spark, base, second)
    assert B.insert_absent(batch, base, "k") == second      # a replayed batch adds nothing
    B.merge(batch.limit(0).unionByName(batch), base, lambda o, c: D.update_by_key(o, c, "k"))
    assert all(len(v) == 1 for v in B.current(spark, base).versions.values())


def test_a_merge_may_not_move_rows(spark):
    base = scratch_path(spark, "buckets")
    rows = spark.createDataFrame([(1, "a"), (25, "b")], "k long, v string")
    m = B.create(rows, base, "k div 10")
    with pytest.raises(ValueError, match="did not read"):
        B.merge(rows.filter("k = 1"), base, lambda o, c: o.withColumn("k", F.col("k") + 100))
    assert B.current(spark, base) == m and _rows(B.read(spark, base)) == _rows(rows)


def test_empty_table_and_empty_changes(spark):
    base = scratch_path(spark, "buckets")
    none = spark.createDataFrame([], "k long, v string")
    m = B.create(none, base, "k div 10")
    assert B.read(spark, base).count() == 0
    assert B.merge(none, base, lambda o, c: o.unionByName(c)) == m
    B.insert_absent(spark.createDataFrame([(5, "x"), (5, "y"), (None, "z")], "k long, v string"), base, "k")
    assert _rows(B.read(spark, base)) == [(5, "x"), (None, "z")]
