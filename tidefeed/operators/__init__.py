"""DataFrame-to-DataFrame operators of a change feed."""

from tidefeed.operators.changes import (
    LSN,
    OPERATION,
    SEQVAL,
    changes_since,
    data_columns,
    scan_changes,
    with_record,
)
from tidefeed.operators.envelope import envelopes, fan_in
from tidefeed.operators.gaps import RetentionGap, guard_gaps, retention_gaps
from tidefeed.operators.offset_log import CommitConflict, OffsetLog
from tidefeed.operators.offsets import (
    compact_offsets,
    compact_offsets_table,
    complete_offsets,
    create_offsets_table,
    empty_offsets,
    last_lsns,
    merge_offsets,
    merge_offsets_into,
    offsets_frame,
    read_offsets,
    reset_offset,
    save_offsets,
    with_last_lsn,
)
from tidefeed.operators.ordering import in_order, with_position
from tidefeed.operators.progress import feed_high_water, live_progress, progress

__all__ = [
    "LSN",
    "OPERATION",
    "SEQVAL",
    "CommitConflict",
    "OffsetLog",
    "RetentionGap",
    "changes_since",
    "compact_offsets",
    "compact_offsets_table",
    "complete_offsets",
    "create_offsets_table",
    "data_columns",
    "empty_offsets",
    "envelopes",
    "fan_in",
    "feed_high_water",
    "guard_gaps",
    "in_order",
    "last_lsns",
    "live_progress",
    "merge_offsets",
    "merge_offsets_into",
    "offsets_frame",
    "progress",
    "read_offsets",
    "reset_offset",
    "retention_gaps",
    "save_offsets",
    "scan_changes",
    "with_last_lsn",
    "with_position",
    "with_record",
]
