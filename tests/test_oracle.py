"""Every registered query against its SQL, on whole tables, through DuckDB."""

from __future__ import annotations

import os
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as spark_entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = spark_entry.queries()
ORACLES = spark_entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in sorted(Path(SF_DIR).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    yield con
    con.close()


def normal(value):
    return repr(value) if isinstance(value, float) else value


def as_bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(normal(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    found = as_bag(result.columns, result.collect())
    answer = duck.execute(ORACLES[name])
    names = [d[0] for d in answer.description]
    expected = as_bag(names, answer.fetchall())
    assert sorted(result.columns) == sorted(names)
    assert sum(found.values()) == sum(expected.values())
    assert found == expected


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_types_are_stable(spark, duck, name):
    """No HUGEINT or DECIMAL may hide behind a sum in the SQL."""
    answer = duck.execute(f"SELECT * FROM ({ORACLES[name]}) LIMIT 0")
    assert not {str(d[1]) for d in answer.description} & {"HUGEINT"}


def test_entry_runs(spark):
    assert spark_entry.entry(spark).count() > 0
