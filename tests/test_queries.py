"""Every registered query of the library against its SQL in DuckDB."""

import datetime
import decimal
import os

import duckdb
import pytest

from ferrywright.plans import registry
from ferrywright.plans.tables import NAMES


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for name in NAMES:
        if os.path.exists(f"{data}/{name}.parquet"):
            con.execute(f"create view {name} as select * from '{data}/{name}.parquet'")
    return con


def plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 6) + 0.0
    if isinstance(v, datetime.datetime) and v.tzinfo:
        return v.astimezone(datetime.timezone.utc).replace(tzinfo=None)
    return v


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in values), key=lambda r: tuple(map(str, r)))


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, data, duck, name):
    df = registry.queries()[name](spark, data)
    got = rows(df.columns, df.collect())
    sql = registry.oracle_sql().get(name)
    if not sql:
        assert got
        return
    cursor = duck.execute(sql)
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    want = rows(columns, cursor.fetchall())
    assert got == want
    kinds = dict(df.dtypes)
    told = {d[0]: str(d[1]) for d in cursor.description}
    for c in columns:
        wide = {"NUMBER": ("bigint", "int", "smallint", "double", "float", "decimal")}.get(told[c])
        assert wide is None or kinds[c].startswith(wide)
