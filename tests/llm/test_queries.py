import duckdb
import pytest

from loomline.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_against_sql(spark, sf, name):
    c = duckdb.connect()
    for t in ("documents", "embeddings"):
        c.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    want = c.execute(queries.ORACLES[name]).df()
    got = queries.QUERIES[name](spark, sf).toPandas()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    assert sorted(map(tuple, got[columns].astype(object).to_numpy())) == sorted(map(tuple, want[columns].astype(object).to_numpy()))


def test_all_ten_are_registered():
    assert sorted(int(k.split("_")[0][2:]) for k in queries.QUERIES) == list(range(1, 11))
