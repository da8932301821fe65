"""Loads that are there as a whole or not at all: statements and ledger on an embedded library, inside the test's own process."""

import sqlite3

import pytest
from pyspark.sql import types as T

from sealframe.sinks.ledger import Statements, _say, load_part, switch

SCHEMA = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("s", T.StringType()), T.StructField("n", T.LongType())])
PARTS = {p: [[(p + i / 4, f"r{p}-{i}", None if i % 2 else i) for i in range(some)] for some in (3, 0, 2)] for p in range(4)}


@pytest.fixture
def connection():
    made = sqlite3.connect(":memory:", isolation_level="DEFERRED")
    yield made
    made.close()


@pytest.fixture
def say(connection):
    made = Statements.of(SCHEMA, "t", mark="?", renames=False)
    _say(connection, made.begin())
    return made


def stored(connection, table):
    return sorted(connection.execute(f"SELECT s FROM {table}").fetchall())


def test_a_part_is_stored_once(connection, say):
    """However often a task is tried, and although a try broke off in the middle."""
    for _ in range(3):
        assert load_part(connection, say, 0, PARTS[0]) == 5

    def broken():
        yield PARTS[1][0]
        raise OSError("the executor is lost")

    with pytest.raises(OSError):
        load_part(connection, say, 1, broken())
    assert len(stored(connection, say.side)) == 5
    assert load_part(connection, say, 1, PARTS[1]) == 5
    assert len(stored(connection, say.side)) == 10


def test_a_quicker_attempt_wins(connection, say):
    """Another attempt of the task commits while this one is still storing."""
    def overtaken():
        yield PARTS[2][0]
        other = Statements(say.table, say.columns, say.load, "?", False)
        connection.rollback()  # one connection stands for two
        load_part(connection, other, 2, PARTS[2])
        yield PARTS[2][2]

    assert load_part(connection, say, 2, overtaken()) == 5
    assert len(stored(connection, say.side)) == 5


def test_switch(connection, say):
    connection.execute("CREATE TABLE t (old TEXT)")
    connection.execute("INSERT INTO t VALUES ('old')")
    connection.commit()
    for part, rows in PARTS.items():
        if part < 3:
            load_part(connection, say, part, rows)
    with pytest.raises(RuntimeError, match=r"\(3, 15, 15\), not \(4, 20, 20\)"):
        switch(connection, say, 4, 20)
    assert connection.execute("SELECT old FROM t").fetchall() == [("old",)]
    load_part(connection, say, 3, PARTS[3])
    switch(connection, say, 4, 20)
    assert len(stored(connection, "t")) == 20
    _say(connection, say.end())
    names = [r[0] for r in connection.execute("SELECT name FROM sqlite_master WHERE type = 'table'")]
    assert names == ["t"]


def test_a_table_that_is_new(connection, say):
    switch(connection, say, 0, 0)
    _say(connection, say.end())
    assert stored(connection, "t") == []


def test_statements():
    say = Statements.of(SCHEMA, "flowers", 50)
    assert say.columns == (("x", "DOUBLE PRECISION"), ("s", "VARCHAR(50)"), ("n", "BIGINT"))
    assert say.insert() == f"INSERT INTO flowers__{say.load} (x, s, n) VALUES (%s, %s, %s)"
    assert say.switch(True) == [f"RENAME TABLE flowers TO {say.before}, {say.side} TO flowers"]
    assert say.switch(False) == [f"ALTER TABLE {say.side} RENAME TO flowers"]
    assert Statements.of(SCHEMA, "flowers").load != say.load
    for bad in ("t; DROP TABLE t", "a b"):
        with pytest.raises(ValueError):
            Statements.of(SCHEMA, bad)
    with pytest.raises(TypeError):
        Statements.of(T.StructType([T.StructField("b", T.BinaryType())]), "t")
