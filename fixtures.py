"""Change tables derived from the test data, for the registered queries and the tests.

A group of consecutive keys is one transaction and shares an LSN; the key itself is the
sequence value; a column of the row decides the operation.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefeed.operators import LSN, OPERATION, SEQVAL, offsets_frame
from tidefeed.sources import read_changes, stream_changes


@dataclass(frozen=True)
class Derived:
    """How one table becomes a change table."""

    key: str  # Spark SQL for a unique number
    transaction: int
    kind: str
    codes: dict[str, int]
    columns: tuple[str, ...]
    duckdb: dict[str, str] = field(default_factory=dict)  # columns DuckDB must render itself


TIME = "strftime({}, '%Y-%m-%dT%H:%M:%S.%f')"

DERIVED = {
    "events": Derived(
        key="event_id",
        transaction=3,
        kind="event_type",
        codes={"signup": 2, "purchase": 4, "view": 3},
        columns=("event_id", "ts", "user_id", "event_type", "value", "props"),
        duckdb={"ts": TIME.format("ts")},
    ),
    "orders": Derived(
        key="o_orderkey",
        transaction=4,
        kind="o_orderstatus",
        codes={"O": 2, "P": 4},
        columns=(
            "o_orderkey",
            "o_custkey",
            "o_orderstatus",
            "o_totalprice",
            "o_orderdate",
            "o_orderpriority",
        ),
        duckdb={"o_orderdate": TIME.format("o_orderdate")},
    ),
    "customer": Derived(
        key="c_custkey",
        transaction=5,
        kind="c_mktsegment",
        codes={"BUILDING": 2, "MACHINERY": 4, "FURNITURE": 3},
        columns=("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"),
    ),
    "lineitem": Derived(
        key="l_orderkey * 8 + l_linenumber",
        transaction=8,
        kind="l_returnflag",
        codes={"N": 2, "R": 4, "A": 3},
        columns=(
            "l_orderkey",
            "l_partkey",
            "l_suppkey",
            "l_linenumber",
            "l_quantity",
            "l_extendedprice",
            "l_discount",
            "l_tax",
            "l_returnflag",
            "l_linestatus",
            "l_shipdate",
        ),
        duckdb={"l_shipdate": TIME.format("l_shipdate")},
    ),
    "documents": Derived(
        key="doc_id",
        transaction=2,
        kind="lang",
        codes={"en": 2, "de": 4},
        columns=("doc_id", "text", "lang", "source", "n_chars"),
    ),
}

# Saved positions to start from; customer, lineitem and documents have none.
SAVED = {"events": (0x64).to_bytes(10), "orders": (0x3E8).to_bytes(10)}

FEED_TABLES = ("events", "orders", "customer")


def as_changes(rows: DataFrame, table: str) -> DataFrame:
    derived = DERIVED[table]

    def ten_bytes(number: str):
        return F.unhex(F.lpad(F.hex(F.expr(number)), 20, "0"))

    code = F.lit(1)
    for value, operation in derived.codes.items():
        code = F.when(F.col(derived.kind) == value, operation).otherwise(code)
    return rows.select(
        ten_bytes(f"({derived.key}) DIV {derived.transaction} + 1").alias(LSN),
        ten_bytes(derived.key).alias(SEQVAL),
        code.alias(OPERATION),
        *derived.columns,
    )


def change_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return as_changes(read_changes(spark, f"{sf_dir}/{table}.parquet"), table)


def change_stream(spark: SparkSession, sf_dir: str, table: str, **limits) -> DataFrame:
    source = stream_changes(spark, f"{sf_dir}/{{{table}.parquet}}", **limits)
    return as_changes(source, table)


def change_tables(spark: SparkSession, sf_dir: str, tables=FEED_TABLES) -> dict[str, DataFrame]:
    return {table: change_table(spark, sf_dir, table) for table in tables}


def saved_offsets(spark: SparkSession) -> DataFrame:
    return offsets_frame(spark, SAVED)


# DuckDB's side.


def changes_sql(table: str) -> str:
    derived = DERIVED[table]
    cases = " ".join(f"WHEN '{value}' THEN {code}" for value, code in derived.codes.items())

    def ten_bytes(number: str) -> str:
        return f"lpad(to_hex(CAST({number} AS BIGINT)), 20, '0')"

    return (
        f"SELECT '0x' || {ten_bytes(f'({derived.key}) // {derived.transaction} + 1')} AS lsn, "
        f"'0x' || {ten_bytes(derived.key)} AS seqval, "
        f"CASE {derived.kind} {cases} ELSE 1 END AS operation, * FROM {table}"
    )


OPERATION_TYPE_SQL = "CASE operation WHEN 2 THEN 'Insert' WHEN 4 THEN 'Update' ELSE 'Delete' END"


def message_sql(table: str, operation_type: str = OPERATION_TYPE_SQL, without: str = "") -> str:
    derived = DERIVED[table]
    names = [c for c in derived.columns if c != without]
    pairs = ", ".join(f"'{c}', {derived.duckdb.get(c, c)}" for c in names)
    return f"CAST(json_object('OperationType', {operation_type}, {pairs}) AS VARCHAR)"


def envelopes_sql(table: str) -> str:
    last = "0x" + SAVED.get(table, bytes(10)).hex().upper()
    return (
        f"SELECT '{table}' AS table_name, 'ChangeDetected' AS event_type, "
        f"{message_sql(table)} AS message, lsn, seqval, operation "
        f"FROM ({changes_sql(table)}) WHERE lsn > '{last}'"
    )


def feed_sql(tables=FEED_TABLES) -> str:
    return " UNION ALL ".join(envelopes_sql(table) for table in tables)
