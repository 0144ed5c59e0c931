"""Scans: the derived readings view, CSV/Parquet readers and the input contract."""

from stratus.sources.contract import RAW_CONTRACT, STANDARD_CONTRACT
from stratus.sources.files import read_csv, read_csv_glob, read_parquet, scan_csv
from stratus.sources.records import whole_lines
from stratus.sources.readings import raw_readings, readings, table, text_readings

__all__ = ["RAW_CONTRACT", "STANDARD_CONTRACT", "read_csv", "read_csv_glob", "read_parquet",
           "scan_csv", "text_readings", "whole_lines",
           "raw_readings", "readings", "table"]
