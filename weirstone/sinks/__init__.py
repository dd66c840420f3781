"""Writers: JDBC tables, stages and the load log."""

from .jdbc import append, truncate_load, write
from .load_log import append_log, error_entry, load_key
from .stages import JdbcStage, ParquetStage

__all__ = [
    "JdbcStage",
    "ParquetStage",
    "append",
    "append_log",
    "error_entry",
    "load_key",
    "truncate_load",
    "write",
]
