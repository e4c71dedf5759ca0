"""Scans and sinks: Parquet/CSV files with explicit schemas, and the retail
role mapping over the driver-generated tables."""

from tidecast.sources.files import read_csv, read_csv_by_name, read_parquet, write_csv, write_parquet
from tidecast.sources.tables import read_table

__all__ = ["read_csv", "read_csv_by_name", "read_parquet", "write_csv", "write_parquet", "read_table"]
