"""User-level analyses over the star schema and the movement table.

Each analysis accepts either one parameter (as the original queries do) or
a batch of requests answered by one job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trainyard.functions.times import stamp_key
from trainyard.operators.textmatch import like_pattern, text_matches

PEAK_HOURS = [7, 8, 17, 18]


def round_ratio(num, den, scale: int = 2) -> F.Column:
    """``num/den`` rounded half away from zero to ``scale`` decimals,
    computed exactly on integers (as a numeric AVG rounded in SQL), returned
    as double.  ``num`` and ``den`` are integral."""
    num, den = F.col(num) if isinstance(num, str) else num, \
        F.col(den) if isinstance(den, str) else den
    f = 10 ** scale
    a = F.abs(num).cast("long") * (2 * f) + den.cast("long")
    b = den.cast("long") * 2
    q = F.call_function("div", a, b)            # exact integer division
    return (F.signum(num) * q).cast("double") / F.lit(float(f))


# ------------------------------------------------------------- Q21 lookup
def station_lookup(dim_station: DataFrame, text: str) -> DataFrame:
    """First station (by name, then EVA) whose name contains ``text``
    case-insensitively; ``%`` and ``_`` in the text act as wildcards."""
    hits = dim_station.filter(F.ilike(F.col("station_name"),
                                      like_pattern(F.lit(text))))
    return hits.orderBy("station_name", "eva").limit(1).select(
        "station_name", "lat", "lon", F.col("eva").alias("identifier"))


def station_lookup_batch(dim_station: DataFrame, requests: DataFrame
                         ) -> DataFrame:
    """Batch form: ``requests(request_id, text)``, with the same wildcards.
    Requests without a match are absent."""
    first = dim_station.groupBy("station_name").agg(F.min(
        F.struct("eva", "lat", "lon")).alias("s"))
    hits = text_matches(dim_station, "station_name", requests.select("text"),
                        wildcards=True)
    best = hits.groupBy("text").agg(F.min("name").alias("station_name"))
    # as many rows as requests or names: not to be broadcast
    return requests.join(best.hint("merge"), "text").join(
        first.hint("merge"), "station_name").select(
        "request_id", "station_name", F.col("s.lat").alias("lat"),
        F.col("s.lon").alias("lon"), F.col("s.eva").alias("identifier"))


# ----------------------------------------------------- Q23 cancellations
def cancelled_trains(fact: DataFrame, stamp: str | None = None
                     ) -> DataFrame:
    """Distinct (station, stop) with a cancelled event, per snapshot; with
    ``stamp`` (``YYMMDDHHMM``) only that snapshot (a partition filter when
    the fact is partitioned by snapshot)."""
    f = fact
    if stamp is not None:
        f = f.filter(F.col("snapshot_time_key") == stamp_key(F.lit(stamp)))
    f = f.filter(F.col("is_cancelled"))
    return f.groupBy("snapshot_time_key").agg(
        F.count_distinct(F.struct("station_key", "stop_id"))
        .alias("cancelled_trains"))


# ---------------------------------------------------------- Q24 avg delay
def avg_departure_delay(fact: DataFrame, dim_station: DataFrame,
                        text: str | None = None) -> DataFrame:
    """Average signed departure delay per station name (departures, not
    cancelled, delay known), rounded to 2 decimals, with the number of
    events used; largest count first.  The fact side is reduced to one row
    per station key before the join."""
    per_key = (fact.filter((F.col("event_type") == "D") &
                           ~F.col("is_cancelled") &
                           F.col("delay_minutes").isNotNull())
               .groupBy("station_key")
               .agg(F.sum(F.col("delay_minutes").cast("long")).alias("s"),
                    F.count(F.lit(1)).alias("n")))
    st = dim_station.select("station_key", "station_name")
    if text is not None:
        st = st.filter(F.ilike(F.col("station_name"),
                               like_pattern(F.lit(text))))
    j = per_key.join(st, "station_key")
    g = j.groupBy("station_name").agg(F.sum("s").alias("s"),
                                      F.sum("n").alias("n"))
    return g.select("station_name",
                    round_ratio("s", "n").alias("avg_delay_minutes"),
                    F.col("n").alias("num_events_used")) \
        .orderBy(F.col("num_events_used").desc())


# --------------------------------------------------- Q32 daily mean delay
def daily_mean_delay(movements: DataFrame,
                     station: str | Sequence[str] | None = None
                     ) -> DataFrame:
    """Mean over days of the daily mean arrival delay of non-cancelled
    movements (each day weighs the same), per station.  Stations without
    rows give no row."""
    m = movements.filter(~F.col("is_cancelled"))
    if isinstance(station, str):
        m = m.filter(F.col("station_name") == station)
    elif station is not None:
        m = m.filter(F.col("station_name").isin(list(station)))
    daily = m.groupBy("station_name", "date").agg(
        F.avg("arrival_delay_minutes").alias("avg_delay_that_day"))
    return daily.groupBy("station_name").agg(
        F.avg("avg_delay_that_day").alias("final_avg"),
        F.count(F.lit(1)).alias("days"))


def daily_delay_table(movements: DataFrame, station: str,
                      top: int | None = None) -> DataFrame:
    """Per-day means of one station, by date, optionally only the first
    ``top`` days (the report shows 50)."""
    m = movements.filter((F.col("station_name") == station) &
                         ~F.col("is_cancelled"))
    out = m.groupBy("date").agg(
        F.avg("arrival_delay_minutes").alias("avg_delay_that_day")) \
        .orderBy("date")
    return out.limit(top) if top is not None else out


# --------------------------------------------------------- Q33 peak hours
def peak_hour_departures(movements: DataFrame,
                         hours: Sequence[int] = PEAK_HOURS,
                         top: int | None = None) -> DataFrame:
    """Average number of planned departures in the peak hours per station
    and day (cancelled included; days without any are not counted as 0),
    rounded to 2 decimals, and the number of days observed; largest first,
    optionally only the ``top`` stations (the report shows 200)."""
    peak = movements.filter(F.col("planned_departure").isNotNull() &
                            F.col("hour").isin(list(hours)))
    daily = peak.groupBy("station_name", "date").agg(
        F.count(F.lit(1)).alias("daily_departures"))
    out = daily.groupBy("station_name").agg(
        round_ratio(F.sum("daily_departures"), F.count(F.lit(1)))
        .alias("avg_peak_departures"),
        F.count("daily_departures").alias("days_observed"),
    ).orderBy(F.col("avg_peak_departures").desc(), "station_name")
    return out.limit(top) if top is not None else out
