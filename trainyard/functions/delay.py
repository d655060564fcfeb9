"""Delay, cancellation and movement-time expressions.

Two delay definitions exist side by side on purpose:

* :func:`signed_delay` (star schema): the numeric delta text wins, else the
  signed minutes between the event's own planned and changed time, else NULL.
* :func:`clamped_delay` (lake table): 0 when there is no actual time, never
  below 0, NULL when the actual time exists but the planned one does not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def minutes_between(start, end) -> Column:
    """(end - start) in minutes as double."""
    return F.timestamp_diff("SECOND", _c(start), _c(end)) / F.lit(60.0)


def signed_delay(dc, planned_ts, changed_ts) -> Column:
    dc = _c(dc)
    from_delta = F.when(dc.rlike(r"^-?[0-9]+$"), dc.try_cast("int"))
    from_times = F.round(minutes_between(planned_ts, changed_ts)).cast("int")
    return F.coalesce(from_delta, from_times)


def clamped_delay(actual, planned) -> Column:
    actual = _c(actual)
    d = minutes_between(planned, actual)
    return F.when(actual.isNull(), F.lit(0.0)) \
        .otherwise(F.when(d < 0, F.lit(0.0)).otherwise(d))


def cancelled_event(status) -> Column:
    return F.coalesce(_c(status) == "c", F.lit(False))


def cancelled_stop(arr_status, dep_status) -> Column:
    return cancelled_event(arr_status) | cancelled_event(dep_status)


def movement_date(planned_dep, planned_arr) -> Column:
    return F.to_date(F.coalesce(_c(planned_dep), _c(planned_arr)))


def movement_hour(planned_dep, planned_arr) -> Column:
    return F.hour(F.coalesce(_c(planned_dep), _c(planned_arr)))


def sq_distance(lat, lon, lat0, lon0) -> Column:
    """Squared distance in raw degrees (no projection)."""
    return F.pow(_c(lat) - _c(lat0), 2) + F.pow(_c(lon) - _c(lon0), 2)
