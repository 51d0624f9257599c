"""Every query against its SQL equivalent, at the smallest scale."""

import duckdb
import pytest

from vesselflow.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute(f"CREATE VIEW events AS SELECT * FROM '{SF}/events.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, con, name):
    frame = registry.queries()[name](spark, SF)
    rows = [tuple(r) for r in frame.collect()]
    if name not in registry.oracle_sql():
        assert rows
        return
    asked = con.execute(registry.oracle_sql()[name])
    columns, want = [d[0] for d in asked.description], asked.fetchall()
    assert sorted(columns) == sorted(frame.columns)
    by = lambda rows, names: sorted(repr([r[names.index(c)] for c in sorted(names)]) for r in rows)
    assert by(rows, frame.columns) == by(want, columns)
