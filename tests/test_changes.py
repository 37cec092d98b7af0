"""Scan, filter, decoding and JSON on hand-written rows."""

import json

import pytest
from pyspark.sql import functions as F

from rows import change, change_frame, lsn
from tidefeed import change_feed
from tidefeed.functions import (
    ZERO_LSN,
    console_line,
    format_lsn,
    operation_type,
    parse_lsn,
    payload_json,
)
from tidefeed.operators import (
    changes_since,
    data_columns,
    envelopes,
    fan_in,
    scan_changes,
    with_record,
)


def types_of(spark, before_image="delete"):
    frame = change_frame(spark, [change(i, i, i, i) for i in (1, 2, 3, 4, 5)])
    rows = with_record(frame, before_image=before_image).select("operation", "record.OperationType")
    return {row[0]: row[1] for row in rows.collect()}


def test_only_two_and_four_are_not_deletes(spark):
    assert types_of(spark) == {1: "Delete", 2: "Insert", 3: "Delete", 4: "Update", 5: "Delete"}


def test_before_images_can_be_dropped_or_labelled(spark):
    assert types_of(spark, "drop") == {1: "Delete", 2: "Insert", 4: "Update", 5: "Delete"}
    assert types_of(spark, "label")[3] == "UpdateBefore"
    with pytest.raises(ValueError):
        operation_type("operation", "keep")


def test_null_operation_is_a_delete_and_survives_drop(spark):
    frame = change_frame(spark, [change(1, 1, None, 1)])
    rows = with_record(frame, before_image="drop").select("record.OperationType").collect()
    assert [row[0] for row in rows] == ["Delete"]


def test_lsns_compare_as_unsigned_bytes(spark):
    frame = change_frame(spark, [change(0x7F, 1, 2, 1), change(0x80, 2, 2, 2)])
    assert [row.id for row in changes_since(frame, lsn(0x7F)).collect()] == [2]


def test_filter_is_strict_and_drops_null_lsns(spark):
    rows = [change(5, 1, 2, 1), change(6, 2, 2, 2), change(7, 3, 2, 3), change(None, 4, 2, 4)]
    frame = change_frame(spark, rows)
    assert [row.id for row in changes_since(frame, lsn(5)).collect()] == [2, 3]
    assert [row.id for row in changes_since(frame, lsn(5), lsn(6)).collect()] == [2]
    assert [row.id for row in changes_since(frame).collect()] == [1, 2, 3]
    assert changes_since(frame, lsn(7)).count() == 0


def test_columns_are_discovered_in_order(spark):
    frame = change_frame(spark, [])
    assert data_columns(frame) == ["id", "name", "amount", "raw"]
    assert scan_changes(frame).columns == frame.columns
    assert scan_changes(frame, ["name"]).columns == [
        "__$start_lsn",
        "__$seqval",
        "__$operation",
        "name",
    ]


def test_columns_of_a_catalog_table(spark):
    frame = change_frame(spark, [change(1, 1, 2, 1)])
    frame.createOrReplaceTempView("changes_of_a_table")
    listed = [column.name for column in spark.catalog.listColumns("changes_of_a_table")]
    table = spark.table("changes_of_a_table")
    assert data_columns(table) == [name for name in listed if not name.startswith("__$")]
    assert envelopes(table, "t").count() == 1


def message_of(frame, **options):
    return envelopes(frame, "t", **options).first().message


def test_payload_keeps_nulls_scale_bytes_and_text(spark):
    text = 'a "quoted"\nline, snö, <&>  '
    frame = change_frame(spark, [change(1, 1, 2, 1, text), change(2, 2, 2, 2, None, None, None)])
    first, second = [row.message for row in envelopes(frame, "t").orderBy("lsn").collect()]
    assert json.loads(first) == {
        "OperationType": "Insert",
        "id": 1,
        "name": text,
        "amount": 1.5,
        "raw": "Cgs=",
    }
    assert '"amount":1.50' in first
    assert json.loads(second) == {
        "OperationType": "Insert",
        "id": 2,
        "name": None,
        "amount": None,
        "raw": None,
    }


def test_operation_type_is_the_first_key_and_pretty_changes_only_whitespace(spark):
    frame = change_frame(spark, [change(1, 1, 4, 1)])
    compact, pretty = message_of(frame), message_of(frame, pretty=True)
    assert list(json.loads(compact)) == ["OperationType", "id", "name", "amount", "raw"]
    assert "\n" in pretty and "\n" not in compact
    assert json.loads(pretty) == json.loads(compact)


def test_times_do_not_depend_on_the_session(spark):
    frame = spark.sql(
        "SELECT X'00000000000000000001' AS `__$start_lsn`, 2 AS `__$operation`, "
        "TIMESTAMP_NTZ '2024-02-29 01:02:03.000004' AS local, "
        "TIMESTAMP '2024-02-29 01:02:03Z' AS instant, DATE '2024-02-29' AS day"
    )
    zone = spark.conf.get("spark.sql.session.timeZone")
    expected = {
        "OperationType": "Insert",
        "local": "2024-02-29T01:02:03.000004",
        "instant": "2024-02-29T01:02:03.000000Z",
        "day": "2024-02-29",
    }
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        assert json.loads(message_of(frame)) == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_a_column_named_operation_type_wins_and_keeps_first_place(spark):
    frame = change_frame(spark, [change(1, 1, 2, 1)])
    clash = frame.select("`__$start_lsn`", "`__$operation`", "id", F.lit("mine").alias("OperationType"))
    message = message_of(clash)
    assert message == '{"OperationType":"mine","id":1}'


def test_a_column_that_differs_in_case_is_its_own_key(spark):
    frame = change_frame(spark, [change(1, 1, 2, 1)])
    other = frame.select(
        "`__$start_lsn`",
        "`__$operation`",
        F.lit("lower").alias("operationtype"),
        F.lit("mine").alias("OperationType"),
    )
    assert message_of(other) == '{"OperationType":"mine","operationtype":"lower"}'


def test_odd_column_names(spark):
    frame = change_frame(spark, [change(1, 1, 2, 1)]).withColumnRenamed("name", "a.b `c`")
    assert json.loads(message_of(frame))["a.b `c`"] == "x"
    assert changes_since(scan_changes(frame, ["a.b `c`"])).columns[-1] == "a.b `c`"


def test_envelope_without_a_sequence_column(spark):
    frame = change_frame(spark, [change(1, 1, 2, 1)]).drop("__$seqval")
    row = envelopes(frame, "dbo.t").first()
    assert (row.table_name, row.event_type, row.seqval) == ("dbo.t", "ChangeDetected", None)
    assert bytes(row.lsn) == lsn(1)


def test_row_key_comes_from_the_record(spark):
    frame = change_frame(spark, [change(1, 1, 2, 17)])
    assert envelopes(frame, "t", row_key=F.col("record.id")).first().row_key == "17"


def test_empty_change_table(spark):
    feed = change_feed({"t": change_frame(spark, [])})
    assert feed.columns[:3] == ["table_name", "event_type", "message"]
    assert feed.count() == 0


def test_fan_in_of_different_schemas_keeps_every_row(spark):
    one = change_frame(spark, [change(1, 1, 2, 1)])
    two = one.select("`__$start_lsn`", "`__$operation`", F.lit(1.5).alias("other"))
    tables = {f"t{i}": (one if i % 2 else two) for i in range(7)}
    feed = change_feed(tables)
    assert sorted(row.table_name for row in feed.collect()) == sorted(tables)
    with pytest.raises(ValueError):
        fan_in([])


def test_lsn_text(spark):
    frame = spark.createDataFrame([(lsn(0xABC),)], "lsn BINARY")
    text = frame.select(format_lsn("lsn")).first()[0]
    assert text == "0x00000000000000000ABC"
    assert parse_lsn(text) == lsn(0xABC)
    assert parse_lsn("0x" + "00" * 10) == ZERO_LSN


def test_console_line(spark):
    frame = change_frame(spark, [change(1, 1, 2, 1)]).select("`__$start_lsn`", "`__$operation`", "id")
    lines = envelopes(frame, "t").select(console_line(), console_line(prefix="P: "))
    plain, prefixed = lines.first()
    assert plain == '[ChangeDetected] t: {"OperationType":"Insert","id":1}'
    assert prefixed == "P: " + plain


def test_incremental_reads_add_up_to_one_full_read(spark):
    frame = change_frame(spark, [change(i // 3, i, 1 + i % 4, i) for i in range(3, 60)])
    cuts = [None, lsn(4), lsn(9), lsn(15), lsn(1000)]
    parts = [changes_since(frame, a, b) for a, b in zip(cuts, cuts[1:])]
    ids = [row.id for part in parts for row in part.collect()]
    assert sorted(ids) == list(range(3, 60))


def test_lsn_filter_and_columns_reach_the_parquet_scan(spark, tmp_path):
    path = str(tmp_path / "changes")
    change_frame(spark, [change(1, 1, 2, 1)]).write.parquet(path)
    frame = changes_since(spark.read.parquet(path), lsn(1)).select("id")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(`__$start_lsn`" in plan
    assert "ReadSchema: struct<__$start_lsn:binary,id:bigint>" in plan
    feed = change_feed({"t": spark.read.parquet(path)}, {"t": lsn(1)})
    plan = feed._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(`__$start_lsn`" in plan
    assert "Exchange" not in plan and "Python" not in plan


def test_payload_options_can_be_overridden(spark):
    record = spark.sql("SELECT struct(DATE '2024-02-29' AS day) AS record")
    text = record.select(payload_json("record", options={"dateFormat": "yyyy"})).first()[0]
    assert text == '{"day":"2024"}'
