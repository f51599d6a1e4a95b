"""Reading and writing tables of readings on any Hadoop path."""

from meterlab.sources.incremental import merge_readings, refresh_features
from meterlab.sources.readings import (
    READINGS_SCHEMA,
    query,
    read_raw_text,
    read_readings,
    register,
    write_table,
)

__all__ = ["READINGS_SCHEMA", "merge_readings", "query", "read_raw_text", "read_readings", "refresh_features", "register", "write_table"]
