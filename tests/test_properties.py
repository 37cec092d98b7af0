"""Random feeds against brute force."""

import json
import tempfile

import duckdb
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rows import Recorder, change, change_frame, lsn, recorded
from tidefeed import change_feed, publish
from tidefeed.operators import LSN, SEQVAL, envelopes, fan_in, with_position
from tidefeed.sources import slice_predicates

slow = settings(
    max_examples=6,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)

# Few LSNs and tables, so that ties, groups across slices and whole-slice groups are common.
feed_rows = st.lists(
    st.tuples(st.sampled_from("abbbb"), st.integers(1, 6), st.integers(1, 5), st.integers(1, 5)),
    min_size=1,
    max_size=120,
)


def feed_of(spark, rows):
    """Rows as a feed; the id tells them apart."""
    numbered = [(table, change(n, s, op, i)) for i, (table, n, s, op) in enumerate(rows)]
    feeds = [
        envelopes(change_frame(spark, [c for t, c in numbered if t == table]), table)
        for table in sorted({t for t, _ in numbered})
    ]
    return fan_in(feeds).repartition(3, "message")


def place(row):
    return (bytes(row.lsn), bytes(row.seqval), row.operation)


@slow
@given(rows=feed_rows, partitions=st.integers(1, 9))
def test_positions(spark, rows, partitions):
    result = with_position(feed_of(spark, rows), partitions).collect()
    assert sorted(json.loads(r.message)["id"] for r in result) == list(range(len(rows)))
    for table in {t for t, *_ in rows}:
        mine = sorted((r for r in result if r.table_name == table), key=lambda r: r.position)
        assert [r.position for r in mine] == list(range(1, len(mine) + 1))
        assert [place(r) for r in mine] == sorted(place(r) for r in mine)


@slow
@given(rows=feed_rows, partitions=st.integers(1, 9))
def test_ordered_publishing(spark, rows, partitions):
    with tempfile.TemporaryDirectory() as folder:
        order = ["table_name"]
        publish(feed_of(spark, rows), Recorder(folder), order=order, partitions=partitions)
        messages = recorded(folder)
    assert sorted(json.loads(m["message"])["id"] for m in messages) == list(range(len(rows)))
    for table in {t for t, *_ in rows}:
        mine = [(m["lsn"], m["seqval"], m["operation"]) for m in messages if m["table_name"] == table]
        assert mine == sorted(mine)


@slow
@given(
    numbers=st.lists(st.one_of(st.none(), st.integers(0, 300)), max_size=60),
    cuts=st.lists(st.integers(0, 300), max_size=5),
)
def test_incremental_reads_add_up(spark, numbers, cuts):
    rows = [change(n, i, 1 + i % 5, i) for i, n in enumerate(numbers)]
    frame = change_frame(spark, rows)
    edges = [0, *sorted(cuts), 301]
    parts = [
        change_feed({"t": frame}, {"t": lsn(a)}, {"t": lsn(b)}) for a, b in zip(edges, edges[1:])
    ]
    ids = fan_in(parts).select(F.get_json_object("message", "$.id").cast("int").alias("id"))
    expected = [i for i, n in enumerate(numbers) if n is not None and n > 0]
    assert sorted(r.id for r in ids.collect()) == expected


cut_points = st.lists(
    st.tuples(st.integers(0, 8), st.one_of(st.none(), st.integers(0, 8))), max_size=6
)


@settings(max_examples=60, deadline=None)
@given(cuts=cut_points, after=st.integers(0, 8), through=st.one_of(st.none(), st.integers(0, 9)))
def test_database_slices(cuts, after, through):
    def literal(value):
        return f"unhex('{value.hex()}')"

    connection = duckdb.connect()
    rows = [(a, b) for a in (None, *range(9)) for b in (None, *range(9))]
    values = ", ".join(
        f"({i}, {'NULL' if a is None else literal(lsn(a))}, {'NULL' if b is None else literal(lsn(b))})"
        for i, (a, b) in enumerate(rows)
    )
    connection.execute(f'CREATE TABLE ct AS FROM (VALUES {values}) AS t(i, "{LSN}", "{SEQVAL}")')
    positions = [(lsn(a), None if b is None else lsn(b)) for a, b in cuts]
    upper = None if through is None else lsn(through)
    found = []
    for predicate in slice_predicates(positions, lsn(after), upper, literal):
        found += [r[0] for r in connection.execute(f"SELECT i FROM ct WHERE {predicate}").fetchall()]
    connection.close()
    expected = [
        i
        for i, (a, _) in enumerate(rows)
        if a is not None and a > after and (through is None or a <= through)
    ]
    assert sorted(found) == expected
