"""Sinks: verified Parquet/CSV/JSON writes, versions, multi-format fan-out, file compaction, summaries."""

from stratus.sinks.compaction import compact_files, recover
from stratus.sinks.files import (
    VerificationError,
    WriteResult,
    known_formats,
    load_summary,
    read_back,
    write_csv,
    write_json,
    write_multiple_formats,
    write_parquet,
)
from stratus.sinks.versions import Version, VersionedTable

__all__ = ["VerificationError", "Version", "VersionedTable", "WriteResult", "compact_files", "known_formats", "load_summary",
           "read_back", "recover", "write_csv", "write_json", "write_multiple_formats", "write_parquet"]
