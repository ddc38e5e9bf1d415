"""Every query with SQL against DuckDB, on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from metaloom.functions.normalise import award, funding
from metaloom.plans import registry

registry.load()
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    return v


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_equals_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    mine = [tuple(map(plain, r)) for r in df.select(*columns).collect()]
    found = duck.execute(registry.ORACLES[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == columns
    theirs = [tuple(plain(r[names.index(c)]) for c in columns) for r in found.fetchall()]
    assert sorted(mine, key=repr) == sorted(theirs, key=repr)


def check_keys(spark, folder, name, table, column, keys):
    """A query against its SQL, on a table of these keys alone."""
    path = str(folder / f"{table}.parquet")
    spark.createDataFrame([(k,) for k in keys], f"{column} bigint").coalesce(1).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}/*.parquet'")
    assert sorted(map(tuple, registry.QUERIES[name](spark, str(folder)).collect())) == sorted(con.execute(registry.ORACLES[name]).fetchall())


def test_award_clean_mends_awards_with_more_behind(spark, tmp_path):
    check_keys(spark, tmp_path, "award_clean", "orders", "o_orderkey", [*range(23856, 23872), *range(238640, 238650), 1238641, 2386423864])


def test_funding_split_leaves_the_award_that_lost_a_zero(spark, tmp_path):
    check_keys(spark, tmp_path, "funding_split", "part", "p_partkey", [*range(23860, 23868), *range(238640, 238648), 1023864])


@pytest.mark.parametrize("text, mended", [("OT2OD23864", "OT2OD023864"), ("OT3OD238641", "OT3OD238641"), ("U18-D23864-01", "U18D023864")])
def test_awards_are_mended_at_their_end(spark, text, mended):
    """Where no other place is asked for."""
    df = spark.createDataFrame([(text,)], "v string")
    assert df.select(award(F.col("v"))).first()[0] == mended
    assert df.select(F.array_join(funding(F.col("v")), "/")).first()[0] == (mended if "OT" in text else text)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
