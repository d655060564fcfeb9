"""Native Column expressions (no Python UDFs)."""

from trainyard.functions.text import (strip, norm_name, station_from_file,
                                      split_path, normalize_station,
                                      LIVE_PATH_ALIASES)
from trainyard.functions.times import (parse_stamp, parse_stamp_strict,
                                       time_key, lenient_time_key,
                                       calendar_columns, snapshot_stamp,
                                       stamp_key)
from trainyard.functions.delay import (signed_delay, clamped_delay,
                                       cancelled_event, cancelled_stop,
                                       movement_date, movement_hour,
                                       minutes_between, sq_distance)

__all__ = [
    "strip", "norm_name", "station_from_file", "split_path",
    "normalize_station", "LIVE_PATH_ALIASES", "parse_stamp",
    "parse_stamp_strict", "time_key", "lenient_time_key", "calendar_columns",
    "snapshot_stamp", "stamp_key", "signed_delay", "clamped_delay",
    "cancelled_event", "cancelled_stop", "movement_date", "movement_hour",
    "minutes_between", "sq_distance",
]
