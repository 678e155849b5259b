"""F5 and F9 of round 3: the channel export and the typed catalogue."""

import glob
import re

from pyspark.sql import functions as F

from colloquy.operators import product as P
from colloquy.operators import statements as ST
from colloquy.sources import io as IO

TRIPLES = "subject string, relation string, object string"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tasks_go_by_bytes_and_texts_stand_together(spark, monkeypatch):
    """F5"""
    left = spark.range(40).select((F.col("id") % 2).alias("k"), F.col("id").alias("a"), F.lit("é").alias("t"))
    right = spark.range(24).select((F.col("id") % 2).alias("k"), F.repeat(F.lit("x"), 1000).alias("b"), F.col("id").alias("c"))
    f = P.factorise(left, right, "k")
    assert f._sizes() == (480, 480 * 1002)
    monkeypatch.setattr(P, "TASK_BYTES", 10_000)
    rows = f.rows()
    assert int(re.search(r"RoundRobinPartitioning\((\d+)\)", _plan(rows)).group(1)) == 49
    seen = rows.select(F.spark_partition_id().alias("p"), "k", "a", "c").collect()
    assert len({(r.a, r.c) for r in seen}) == len(seen) == 480
    runs = sum(x.c != y.c for x, y in zip(seen, seen[1:])) + 1
    assert runs <= 24 * f.left.count()  # once for each left list


def test_csv_is_read_as_it_was_compressed(spark, tmp_path):
    """F5"""
    rows = [(1, 'a "b", c\nd', None), (2, None, "x,y"), (3, "ü", "u\nv")]
    df = spark.createDataFrame(rows, "i long, a string, b string")
    path = f"file://{tmp_path}/t"
    IO.write_csv(df, path, compression="lz4")
    assert glob.glob(f"{tmp_path}/t/*.csv.lz4") and not glob.glob(f"{tmp_path}/t/*.csv")
    assert sorted(map(tuple, IO.read_csv(spark, path, "i long, a string, b string", multiline=True).collect())) == rows


def test_catalog_takes_the_least_type_by_hash(spark):
    """F9"""
    v1 = spark.createDataFrame([("Proposal 1", "Status", "0x1"), ("Proposal 1", "Proposer", "0x1"), ("Proposal 1", "Id", None),
                                ("0x1", "Proposer", "Proposal 1"), ("Proposal 2", "Odd", "z"), (None, "Status", None)], TRIPLES)
    v2 = spark.createDataFrame([("Proposal 2", "Supported By", "Proposal 1")], TRIPLES)
    c = ST.entity_catalog(spark, v1, v2, ST.datatype_table(spark))
    assert "SortAggregate" not in _plan(c)
    got = {(r.kind, r.label): r.type for r in c.collect()}
    assert got == {("property", "Status"): "wikibase-item", ("property", "Proposer"): "wikibase-item",
                   ("property", "Id"): "quantity", ("property", "Odd"): "string", ("property", "Supported By"): "wikibase-item",
                   ("item", "Proposal 1"): "Individual", ("item", "0x1"): "Individual", ("item", "Proposal 2"): "Proposal",
                   ("item", None): "Proposal"}


def test_votes_and_actions_are_sorted_by_compiled_code(spark, tmp_path):
    """F9"""
    from colloquy.sources import proposals as PR
    spark.sql("select 1L o_orderkey, 2L o_custkey, 'F' o_orderstatus, 10.0D o_totalprice, timestamp'1996-01-02' o_orderdate, "
              "'1-URGENT' o_orderpriority").write.parquet(f"{tmp_path}/orders.parquet")
    line = "1L l_orderkey, {}L l_partkey, {}L l_suppkey, {} l_linenumber, 3.0D l_quantity, 9.5D l_extendedprice, 'R' l_returnflag, 'O' l_linestatus"
    rows = [line.format(5, 7, "2"), line.format(4, 6, "1"), line.format(4, 3, "1"), line.format(9, 9, "cast(null as int)")]
    spark.sql(" union all ".join(f"select {r}" for r in rows)).write.parquet(f"{tmp_path}/lineitem.parquet")
    p = PR.proposals(spark, str(tmp_path))
    assert "array_sort" not in p._jdf.queryExecution().optimizedPlan().toString()
    r = p.first()
    assert r.targets == ["0x00000009", "0x00000003", "0x00000006", "0x00000007"]
    assert [v.id for v in r.votes] == [f"{t}-1" for t in r.targets]
