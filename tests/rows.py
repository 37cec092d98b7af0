"""Hand-written change rows and publishers for the tests."""

from __future__ import annotations

import json
import os
import time
import uuid
from decimal import Decimal

from tidefeed.streaming import Publisher

CHANGE_SCHEMA = (
    "`__$start_lsn` BINARY, `__$seqval` BINARY, `__$operation` INT, "
    "id BIGINT, name STRING, amount DECIMAL(9,2), raw BINARY"
)


def lsn(number: int) -> bytes:
    return number.to_bytes(10, "big")


def change(number, seq, operation, id, name="x", amount=Decimal("1.50"), raw=b"\x0a\x0b"):
    start = None if number is None else lsn(number)
    return (start, lsn(seq), operation, id, name, amount, raw)


def change_frame(spark, rows):
    return spark.createDataFrame(rows, CHANGE_SCHEMA)


class Recorder(Publisher):
    """Writes every message, with the time it was handled, to a file of its own per task."""

    def __init__(self, folder):
        self.folder = str(folder)

    def open(self, partition_id, epoch_id):
        self.partition_id = partition_id
        name = f"{epoch_id}-{partition_id}-{uuid.uuid4().hex}.jsonl"
        self.file = open(os.path.join(self.folder, name), "w")
        return True

    def process(self, row):
        record = {
            "at": time.time_ns(),
            "partition": self.partition_id,
            "table_name": row.table_name,
            "event_type": row.event_type,
            "message": row.message,
            "lsn": row.lsn.hex() if row.lsn else None,
            "seqval": row.seqval.hex() if row.seqval else None,
            "operation": row.operation,
        }
        self.file.write(json.dumps(record) + "\n")

    def close(self, error):
        self.file.close()


class FailsOnce(Recorder):
    """Fails on the first message it ever sees, after some that it records."""

    def __init__(self, folder, marker):
        super().__init__(folder)
        self.marker = str(marker)

    def process(self, row):
        super().process(row)
        try:
            os.close(os.open(self.marker, os.O_CREAT | os.O_EXCL))
        except FileExistsError:
            return
        raise RuntimeError("no connection")


def recorded(folder):
    """All recorded messages, in the order they were handled."""
    found = []
    for name in os.listdir(folder):
        with open(os.path.join(folder, name)) as lines:
            found += [json.loads(line) for line in lines]
    return sorted(found, key=lambda record: record["at"])
