"""Where change tables come from: files, catalog tables, databases over JDBC."""

from tidefeed.sources.files import read_changes, stream_changes
from tidefeed.sources.jdbc import (
    jdbc_changes,
    jdbc_newest,
    jdbc_oldest,
    searched_cuts,
    slice_predicates,
)

__all__ = [
    "jdbc_changes",
    "jdbc_newest",
    "jdbc_oldest",
    "read_changes",
    "searched_cuts",
    "slice_predicates",
    "stream_changes",
]
