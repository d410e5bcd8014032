"""The corpus queries against their SQL, on whole tables."""

import duckdb
import pytest

import __spark_entry__

SF = "/root/testdata/sf0.001"
NAMES = [n for n in __spark_entry__.oracle_sql() if n.startswith("op") or n == "pipeline"]


def shown(rows):
    return sorted(repr([round(float(v), 6) if isinstance(v, float) else v for v in r]) for r in rows)


@pytest.mark.parametrize("name", NAMES)
def test_queries_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got = __spark_entry__.queries()[name](spark, SF)
    cur = con.execute(__spark_entry__.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(got.columns)
    assert shown(tuple(r) for r in got.select(*[f"`{n}`" for n in names]).collect()) == shown(cur.fetchall())
