"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as registered
from testbed import inputs
from compare import duck, plain, rows_as_frame

# The queries of an optional subpackage are held against their SQL by its own tests.
QUERIES, ORACLES = ({n: q for n, q in found.items() if n.startswith("q_")} for found in (registered.queries(), registered.oracle_sql()))
TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def connection(smallest):
    return duck(smallest)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_result(spark, smallest, connection, name):
    df = QUERIES[name](spark, smallest)
    cursor = connection.execute(ORACLES[name])
    expected = {c[0]: str(c[1]) for c in cursor.description}
    assert {n: TYPES[t] for n, t in df.dtypes} == expected
    got, want = rows_as_frame(df.collect(), df.columns), rows_as_frame(cursor.fetchall(), list(expected))
    assert len(want) > 0
    assert plain(got).equals(plain(want))


def test_every_kind_of_change_occurs(spark, smallest):
    """The upsert and versioning inputs have unchanged, changed, new, missing, nulled and returning keys."""
    t = inputs.Tables(spark, smallest)
    old, new = inputs.merge_old(t).alias("o"), inputs.merge_new(t).alias("n")
    both = old.join(new, "o_orderkey")
    classes = {
        "missing": old.join(new, "o_orderkey", "left_anti"),
        "new": new.join(old, "o_orderkey", "left_anti"),
        "changed": both.where("o.o_totalprice <> n.o_totalprice"),
        "unchanged": both.where("o.o_totalprice = n.o_totalprice AND o.o_orderstatus = n.o_orderstatus"),
        "value to null": both.where("o.o_orderpriority IS NOT NULL AND n.o_orderpriority IS NULL"),
        "null to value": both.where("o.o_orderpriority IS NULL AND n.o_orderpriority IS NOT NULL"),
    }
    history, snapshot = inputs.profile_history(t), inputs.profile_snapshot(t)
    current, closed = history.where("is_current").alias("h"), history.where("NOT is_current").alias("h")
    met = current.join(snapshot.alias("s"), "c_custkey")
    classes |= {
        "absent customer": current.join(snapshot, "c_custkey", "left_anti"),
        "new customer": snapshot.join(history, "c_custkey", "left_anti"),
        "same customer": met.where("h.c_mktsegment = s.c_mktsegment"),
        "changed customer": met.where("h.c_mktsegment <> s.c_mktsegment"),
        "back to an earlier version": met.where("h.c_mktsegment <> s.c_mktsegment").select("c_custkey", "s.c_mktsegment")
        .join(closed, ["c_custkey", "c_mktsegment"]),
        "closed only, returns": closed.join(current, "c_custkey", "left_anti").join(snapshot, "c_custkey", "left_semi"),
    }
    assert [name for name, df in classes.items() if df.isEmpty()] == []


def test_entry(spark, smallest):
    assert not registered.entry(spark).isEmpty()
