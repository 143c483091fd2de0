"""Readers and writers."""

from logvigil.sources.read import raw_files, read_logs, read_raw_csv, read_rejects, read_result, read_stored
from logvigil.sources.scratch import remove_dir, scratch, scratch_dir
from logvigil.sources.versions import current_version, exists, publish, remove, write_version
from logvigil.sources.write import saved_rows, write_days, write_result

__all__ = [
    "current_version",
    "exists",
    "publish",
    "raw_files",
    "read_logs",
    "read_raw_csv",
    "read_rejects",
    "read_result",
    "read_stored",
    "remove",
    "remove_dir",
    "saved_rows",
    "scratch",
    "scratch_dir",
    "write_days",
    "write_result",
    "write_version",
]
