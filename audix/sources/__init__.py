"""Readers, writers and the adapter from the driver's test tables."""

from audix.sources.readers import (file_row_counts, read_catalog, read_many, read_spec_csv, read_table,
                                   spec_frame)
from audix.sources.sinks import stage_table, write_table

__all__ = ["file_row_counts", "read_catalog", "read_many", "read_spec_csv", "read_table", "spec_frame",
           "stage_table", "write_table"]
