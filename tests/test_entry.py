import os
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from loomline.plans import catalogue

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents"]


def rows(df):
    df = df[sorted(df.columns)]
    return sorted(repr([None if v != v or v is None else float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v) for v in r]) for r in df.astype(object).where(df.notna(), None).itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_against_sql(spark, duck, sf, name):
    got, want = catalogue.QUERIES[name](spark, sf).toPandas(), duck.execute(catalogue.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0


def test_contract_without_the_optional_part(tmp_path):
    """With the optional part deleted, with or without the pipeline, the rest imports and its queries are the same."""
    root = Path(entry.__file__).parent
    code = "import __spark_entry__ as e; print(sorted(e.queries()) == sorted(e.catalogue.QUERIES), sorted(e.oracle_sql()) == sorted(e.catalogue.ORACLES))"
    for drop in ((), ("corpus_pipeline.py",)):
        place = tmp_path / str(len(drop))
        shutil.copytree(root, place, ignore=lambda d, names: [n for n in names if n in (".git", "llm", "__pycache__", *drop)])
        assert not (place / "loomline" / "llm").exists()
        out = subprocess.run([sys.executable, "-c", code], cwd=place, env=os.environ | {"PYTHONPATH": str(place)}, capture_output=True, text=True)
        assert out.stdout.split() == ["True", "True"], out.stderr
