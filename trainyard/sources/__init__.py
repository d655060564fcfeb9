"""Readers and writers."""

from trainyard.sources.xml import (list_timetable_files, read_timetable_docs,
                                   split_rejects, read_plan_raw,
                                   read_change_raw, write_timetable_xml)
from trainyard.sources.stations import read_station_entries
from trainyard.sources.tables import (write_parquet, write_movements,
                                      read_movements, write_partitioned)

__all__ = [
    "list_timetable_files", "read_timetable_docs", "split_rejects",
    "read_plan_raw", "read_change_raw", "write_timetable_xml",
    "read_station_entries", "write_parquet", "write_movements",
    "read_movements", "write_partitioned",
]
