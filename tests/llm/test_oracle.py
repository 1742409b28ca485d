import duckdb
import pytest

from benelake.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_give_the_rows_of_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = queries.QUERIES[name](spark, SF)
    expected = con.sql(queries.ORACLE_SQL[name])
    assert got.columns == expected.columns
    assert sorted(map(tuple, got.collect())) == sorted(expected.fetchall())
