"""Every registered query against its SQL."""

import duckdb
import pytest

from spanloom.operators import aligned as al
from spanloom.plans import registry
from spanloom.plans.fixtures import TABLES

SF = "/root/testdata/sf0.001"
registry.load()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", list(registry.ORACLES))
def test_query_gives_the_rows_of_its_sql(spark, con, name):
    got = registry.QUERIES[name](spark, SF)
    want = con.execute(registry.ORACLES[name])
    names = sorted(x[0] for x in want.description)
    assert sorted(got.columns) == names
    at = [[x[0] for x in want.description].index(n) for n in names]
    plain = lambda v: round(v, 9) if isinstance(v, float) else v
    assert sorted((tuple(plain(r[n]) for n in names) for r in got.collect()), key=str) == sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=str)


def test_gaps_take_the_cheapest_price(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(n,) for n in (0, 1, 5, 20, 50, 500)], "n int").select(al.Affine().gap(F.col("n")).alias("g")).collect()
    assert [r.g for r in rows] == [0, -6, -14, -44, -74, -524]


def test_bad_cigar_raises(spark):
    with pytest.raises(Exception, match="not a CIGAR"):
        al.parse_cigar(spark.createDataFrame([(1, "5=3Z")], "k int, c string"), "k", "c").collect()
