import duckdb
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def queries():
    import __spark_entry__
    return __spark_entry__.queries()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in "documents pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents frame from texts; ids count from 0 unless pairs are given."""
    def make(rows):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows],
                                     "doc_id long, text string, lang string, source string, n_chars long")
    return make
