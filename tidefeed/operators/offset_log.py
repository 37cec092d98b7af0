"""Saved positions as a log of numbered commits: for stores that several runs write.

Each commit is a small file that holds all positions. It is created under the next number only if
nobody else has done so; who comes second reads what was committed, merges again and tries the
number after. So two runs of one query, a reset beside a running feed, or feeds that share a store
lose nothing.

A position belongs to an era of its table. A reset begins a new one. A run keeps to the eras it
started in, and what it saves in an era that is over changes nothing.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from tidefeed.functions.lsn import ZERO_LSN
from tidefeed.operators.offsets import OFFSETS_SCHEMA
from tidefeed.workspace import create_file, list_folder, read_file, remove_folder

#: Commits that stay, the newest included; a reader may be at one of them.
KEPT = 20
#: Times that a commit is tried again, when others are faster.
TRIES = 100


class CommitConflict(Exception):
    """Other runs took every number that was tried."""


class OffsetLog:
    """A folder of commits. Rows of a commit: table, era, LSN, time, whether complete."""

    def __init__(self, path: str):
        self.path = path

    def _numbers(self, spark: SparkSession) -> list[int]:
        names = (name.partition(".") for name in list_folder(spark, self.path))
        return sorted(int(a) for a, _, b in names if b == "json" and a.isdigit())

    def _file(self, number: int) -> str:
        return f"{self.path}/{number:012d}.json"

    def state(self, spark: SparkSession) -> tuple[int, dict[str, dict]]:
        """The number of the newest commit (0: none), and its positions by table."""
        for _ in range(TRIES):
            numbers = self._numbers(spark)
            if not numbers:
                return 0, {}
            text = read_file(spark, self._file(numbers[-1]))
            if text is not None:  # else others went on and cleaned up meanwhile
                return numbers[-1], json.loads(text)
        raise CommitConflict(self.path)

    def eras(self, spark: SparkSession) -> dict[str, int]:
        """The era that each table is in; of a table that is not here, 0."""
        return {table: row["era"] for table, row in self.state(spark)[1].items()}

    def _commit(self, spark: SparkSession, change) -> int:
        for attempt in range(TRIES):
            number, rows = self.state(spark)
            changed = change(json.loads(json.dumps(rows)))
            if changed == rows:
                return number
            text = json.dumps(changed, sort_keys=True)
            if create_file(spark, self._file(number + 1), text):
                for old in self._numbers(spark)[:-KEPT]:
                    remove_folder(spark, self._file(old))
                return number + 1
            time.sleep(min(1.0, 0.01 * (attempt + 1)))
        raise CommitConflict(self.path)

    def save(
        self,
        spark: SparkSession,
        positions: Mapping[str, bytes],
        complete: bool = True,
        eras: Mapping[str, int] | None = None,
    ) -> int:
        """Commit positions that never go back within an era. Returns the commit's number.

        ``eras`` are those the run started in; a table whose era is another by now is left alone.
        """
        kind = "complete" if complete else "seen"
        now = datetime.now(timezone.utc).isoformat()

        def change(rows: dict) -> dict:
            for table, lsn in positions.items():
                row = rows.setdefault(table, {"era": 0})
                if eras is not None and eras.get(table, 0) != row["era"]:
                    continue
                if bytes(lsn).hex() > row.get(kind, ""):
                    row[kind], row[f"{kind}_at"] = bytes(lsn).hex(), now
            return rows

        return self._commit(spark, change)

    def reset(self, spark: SparkSession, table: str, lsn: bytes = ZERO_LSN) -> int:
        """Set one table's position, also back, in a new era."""
        now = datetime.now(timezone.utc).isoformat()
        own = uuid.uuid4().hex

        def change(rows: dict) -> dict:
            era = rows.get(table, {"era": 0})["era"] + 1
            rows[table] = {"era": era, "complete": bytes(lsn).hex(), "complete_at": now, "by": own}
            return rows

        return self._commit(spark, change)

    def read(self, spark: SparkSession, complete: bool = True) -> DataFrame:
        """Rows of table_name, last_lsn, updated_at."""
        found = []
        for table, row in self.state(spark)[1].items():
            kinds = ("complete",) if complete else ("complete", "seen")
            known = max(((row[k], row[f"{k}_at"]) for k in kinds if k in row), default=None)
            if known:
                found.append((table, bytes.fromhex(known[0]), datetime.fromisoformat(known[1])))
        return spark.createDataFrame(found, OFFSETS_SCHEMA)

    def history(self, spark: SparkSession) -> Iterable[int]:
        """The numbers of the commits that are kept."""
        return self._numbers(spark)
