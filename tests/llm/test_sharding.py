import zlib

from colloquy.llm import sharding
from tests.llm.conftest import SF


def brute(rows, shards):
    rows = sorted((-(1 << 63) if i is None else i, zlib.crc32((t or "").encode()), len((t or "").encode()) + 1)
                  for i, t in rows)
    total, before, out, slots = sum(r[2] for r in rows), 0, [], {}
    for i, crc, size in rows:
        shard = min(shards - 1, (2 * before + size) * shards // (2 * total))
        out.append((None if i == -(1 << 63) else i, size, crc, "bytes", shard, slots.setdefault(shard, 0), None))
        slots[shard] += 1
        before += size
    return sorted(out, key=str)


def test_query_equals_brute_force_on_whole_table(spark, queries):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted((tuple(r) for r in queries["op7_sharding"](spark, SF).collect()), key=str)
    assert got == brute(rows, 8)
    sizes = [sum(r[1] for r in got if r[4] == s) for s in range(8)]
    assert max(sizes) - min(sizes) <= 2 * max(r[1] for r in got)


def test_edge_rows(docs_of):
    for rows in ([], [(1, None)], [(None, "a"), (None, "a"), (2, ""), (2, "b" * 90_000), (1, "é")],
                 [(i // 3, "same") for i in range(50)]):
        assert sorted((tuple(r) for r in sharding.assign(docs_of(rows), 8).collect()), key=str) == brute(rows, 8)
