"""JDBC reads: the SQL they send, run on DuckDB, and the reader calls they make.

No database is started here. The predicates are checked on an in-process DuckDB table, with
its way of writing a binary literal.
"""

import duckdb
import pytest

import fixtures as fx
from rows import change, change_frame, lsn
from tidefeed.operators import LSN, SEQVAL
from tidefeed.sources import jdbc_changes, jdbc_newest, jdbc_oldest, searched_cuts, slice_predicates


def duck_literal(value):
    return f"unhex('{value.hex()}')"


class Asked:
    """Answers a query by DuckDB, and keeps it."""

    def __init__(self, connection):
        self.connection, self.queries = connection, []

    def __call__(self, query):
        self.queries.append(query)
        return self.connection.execute(query).fetchall()


@pytest.fixture
def duck():
    connection = duckdb.connect()
    connection.execute(
        f'CREATE TABLE ct AS SELECT unhex(lpad(to_hex(CASE WHEN i BETWEEN 100 AND 799 THEN 50 '
        f'ELSE i // 3 + 1 END), 20, \'0\')) AS "{LSN}", '
        f'unhex(lpad(to_hex(i), 20, \'0\')) AS "{SEQVAL}", i FROM range(1000) t(i)'
    )
    # One transaction has also rows without a sequence value, and one row has no LSN.
    connection.execute(f"INSERT INTO ct VALUES ({duck_literal(lsn(50))}, NULL, 5000)")
    connection.execute(f"INSERT INTO ct VALUES (NULL, {duck_literal(lsn(1))}, 5001)")
    yield connection
    connection.close()


@pytest.mark.parametrize("slices", [2, 3, 8])
@pytest.mark.parametrize("through", [None, lsn(300)])
def test_slices_hold_each_wanted_row_once_and_cut_a_hot_transaction(duck, slices, through):
    after = lsn(10)
    ask = Asked(duck)
    cuts = searched_cuts(ask, "ct", slices, after, through, duck_literal)
    assert len(ask.queries) < 45  # rounds, whatever the number of cuts
    assert not any("ROW_NUMBER" in q or "ORDER BY" in q for q in ask.queries)
    assert 0 < len(cuts) < slices
    predicates = slice_predicates(cuts, after, through, duck_literal)
    parts = [
        {row[0] for row in duck.execute(f"SELECT i FROM ct WHERE {p}").fetchall()}
        for p in predicates
    ]
    upper = "" if through is None else f' AND "{LSN}" <= {duck_literal(through)}'
    wanted = duck.execute(f'SELECT i FROM ct WHERE "{LSN}" > {duck_literal(after)}{upper}').fetchall()
    assert sum(map(len, parts)) == len(wanted)
    assert set().union(*parts) == {row[0] for row in wanted}
    # 700 of about 970 rows are one transaction, yet no slice is far above its share.
    assert max(map(len, parts)) <= 1.1 * len(wanted) / slices + 2


def test_cuts_may_be_whole_transactions(duck):
    cuts = [(lsn(60), None), (lsn(200), None), (lsn(60), None)]
    predicates = slice_predicates(cuts, literal=duck_literal)
    assert len(predicates) == 3
    sizes = [duck.execute(f"SELECT count(*) FROM ct WHERE {p}").fetchone()[0] for p in predicates]
    assert sum(sizes) == 1001


def test_no_cuts_is_one_slice():
    assert slice_predicates([]) == ['"__$start_lsn" > 0x00000000000000000000']


def test_few_rows_give_few_cuts(duck):
    assert searched_cuts(Asked(duck), "ct", 8, lsn(333), None, duck_literal) == []
    assert searched_cuts(Asked(duck), "ct", 8, lsn(9999), None, duck_literal) == []


@pytest.mark.parametrize("slices", [2, 7, 64])
def test_cuts_of_a_lopsided_log_are_equal_within_a_tenth(slices):
    """LSNs far apart, in clusters, and one transaction of a third of all rows."""
    connection = duckdb.connect()
    connection.execute(
        f'CREATE TABLE ct AS SELECT unhex(lpad(to_hex(CASE WHEN i % 3 = 0 THEN 70000000000 '
        f"ELSE i * i * i + 1 END), 20, '0')) AS \"{LSN}\", "
        f"unhex(lpad(to_hex(i * i + 5), 20, '0')) AS \"{SEQVAL}\", i FROM range(60000) t(i)"
    )
    ask = Asked(connection)
    cuts = searched_cuts(ask, "ct", slices, literal=duck_literal)
    assert len(cuts) == slices - 1 and len(ask.queries) < 120
    predicates = slice_predicates(cuts, literal=duck_literal)
    sizes = [connection.execute(f"SELECT count(*) FROM ct WHERE {p}").fetchone()[0] for p in predicates]
    assert sum(sizes) == 60000
    assert max(sizes) <= 1.1 * 60000 / slices and min(sizes) >= 0.9 * 60000 / slices


def test_database_slices_are_the_whole_table_of_the_test_data(sf_dir):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW orders AS FROM '{sf_dir}/orders.parquet'")
    rows = fx.changes_sql("orders").replace("AS lsn", "AS lsn_text").replace("AS seqval", "AS seq_text")
    connection.execute(
        f'CREATE TABLE ct AS SELECT unhex(substr(lsn_text, 3)) AS "{LSN}", '
        f'unhex(substr(seq_text, 3)) AS "{SEQVAL}", o_orderkey FROM ({rows})'
    )
    after = fx.SAVED["orders"]
    found = searched_cuts(Asked(connection), "ct", 6, after, None, duck_literal, tolerance=0.002)
    predicates = slice_predicates(found, after, None, duck_literal)
    sizes = [connection.execute(f"SELECT count(*) FROM ct WHERE {p}").fetchone()[0] for p in predicates]
    total = connection.execute(
        f'SELECT count(*) FROM ct WHERE "{LSN}" > {duck_literal(after)}'
    ).fetchone()[0]
    assert len(sizes) == 6 and sum(sizes) == total
    assert max(sizes) - min(sizes) <= max(12, 0.01 * total)


class FakeReader:
    """Answers like ``spark.read`` and remembers what it was asked."""

    def __init__(self, answers):
        self.answers, self.asked = answers, []

    def format(self, name):
        self.asked.append(("format", name))
        return self

    def options(self, **options):
        self.asked.append(("options", options))
        return self

    def load(self):
        return self.answers.pop(0)

    def jdbc(self, url, table, predicates, properties):
        self.asked.append(("jdbc", url, table, predicates, properties))
        return self.answers.pop(0)


class FakeSession:
    def __init__(self, *answers):
        self.read = FakeReader(list(answers))


def test_one_slice_filters_through_spark(spark):
    table = change_frame(spark, [change(i, i, 2, i) for i in range(1, 6)])
    session = FakeSession(table)
    rows = jdbc_changes(
        session, "jdbc:x", "cdc.dbo_t_CT", lsn(2), lsn(4), columns=["id"], properties={"user": "u"}
    )
    assert [row.id for row in rows.collect()] == [3, 4]
    assert session.read.asked == [
        ("format", "jdbc"),
        ("options", {"user": "u", "url": "jdbc:x", "dbtable": "cdc.dbo_t_CT"}),
    ]


class DuckReader(FakeReader):
    """Has DuckDB answer queries, and a table its slices."""

    def __init__(self, duck, table):
        super().__init__([table])
        self.duck = duck

    def load(self):
        self.query = self.asked[-1][1]["query"]
        return self

    def collect(self):
        return self.duck.execute(self.query).fetchall()


def test_many_slices_ask_for_cuts_first(spark, duck):
    session = FakeSession()
    session.read = DuckReader(duck, change_frame(spark, [change(i, i, 2, i) for i in range(1, 6)]))
    rows = jdbc_changes(session, "jdbc:x", "ct", slices=2, literal=duck_literal)
    assert rows.count() == 5
    _, url, name, predicates, _ = session.read.asked[-1]
    assert (url, name, len(predicates)) == ("jdbc:x", "ct", 2)
    sizes = [duck.execute(f"SELECT count(*) FROM ct WHERE {p}").fetchone()[0] for p in predicates]
    assert sum(sizes) == 1001 and max(sizes) < 560


def test_the_database_tells_its_oldest_lsn(spark):
    found = spark.createDataFrame([(lsn(3),)], "oldest BINARY")
    session = FakeSession(found)
    assert jdbc_oldest(session, "jdbc:x", "ct") == lsn(3)
    assert session.read.asked[1][1]["query"] == 'SELECT MIN("__$start_lsn") AS oldest FROM ct'


def test_the_database_tells_its_newest_lsn(spark):
    found = spark.createDataFrame([(lsn(9),)], "newest BINARY")
    session = FakeSession(found, found.selectExpr("CAST(NULL AS BINARY) AS newest"))
    assert jdbc_newest(session, "jdbc:x", "ct") == lsn(9)
    assert session.read.asked[1][1]["query"] == 'SELECT MAX("__$start_lsn") AS newest FROM ct'
    assert jdbc_newest(session, "jdbc:x", "ct") is None
