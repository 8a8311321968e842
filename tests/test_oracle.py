"""Every registered query against its SQL, on whole tables."""

import math
import sys

import pytest
from places import SF01

sys.path.append("/opt/oracle")
duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as entry_module  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF01}/{table}.parquet'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(v)
        return str(v)

    return sorted(columns), sorted(tuple(value(r[i]) for i in order) for r in rows)


def test_every_operator_of_the_loader_has_its_sql():
    optional = {k for m in entry_module._more for k in m.queries()}
    assert set(entry_module.queries()) - set(entry_module.oracle_sql()) <= optional


@pytest.mark.parametrize("name", sorted(entry_module.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = entry_module.queries()[name](spark, SF01)
    ours = canonical(df.columns, [tuple(r) for r in df.collect()])
    result = duck.execute(entry_module.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    theirs = canonical(columns, result.fetchall())
    assert ours[0] == theirs[0]
    assert len(ours[1]) == len(theirs[1])
    assert ours[1] == theirs[1]


def test_flagship(spark):
    rows = entry_module.entry(spark).orderBy("batch_id").collect()
    assert len(rows) == 15
    assert rows[-1]["loaded_rows"] == 1500
    assert rows[-1]["percent"] == 100.0
