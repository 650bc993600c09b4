"""Findings of round 4: keys, sizes and shapes that the small tables lack."""

import duckdb
import pytest

from placeloom.operators import joins
from placeloom.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    """A folder for given tables, made by SQL."""
    folder = tmp_path_factory.mktemp("tables")

    def make(**sql):
        con = duckdb.connect()
        for name, text in sql.items():
            con.sql(f"COPY ({text}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
            con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
        return str(folder), con

    return make


def same(spark, folder, con, name):
    got = QUERIES[name](spark, folder)
    cols = sorted(got.columns)
    show = lambda rows: sorted(tuple(f"{x:.9g}" if isinstance(x, float) else str(x) for x in r) for r in rows)
    want = show(con.sql(SQL[name]).select(*[f'"{c}"' for c in cols]).fetchall())
    assert want and show(got.select(*cols).collect()) == want


def test_postcodes_of_keys_of_five_figures(spark, tables):
    same(spark, *tables(customer="SELECT i AS c_custkey FROM range(9990, 10020) r(i)"), "p05_postcodes")


def test_names_are_not_joined_through_the_driver(spark):
    """Exploded texts are small on disk and large in memory: no join by their stretches or words may be a broadcast."""
    a = spark.createDataFrame([(1, "abcdefgh ij"), (1, "xy")], "block int, _a string")
    b = a.withColumnRenamed("_a", "_b")
    found = joins.matching_names(a, b, ["block"])
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 2
