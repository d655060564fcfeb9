"""Lake pipeline operators: latest update per stop, plan/change merge and
the movement columns (clamped delays, stop-level cancellation, date/hour).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trainyard.functions.delay import (cancelled_stop, clamped_delay,
                                       movement_date, movement_hour)
from trainyard.schemas import MOVEMENT_COLUMNS, RAW_CHANGE_COLUMNS

# Tie-break after update_timestamp (descending): source_file, then every
# other column, so equal stamps give a reproducible winner.
LATEST_ORDER = ["update_timestamp", "source_file", "actual_arrival",
                "actual_platform_arrival", "arrival_status",
                "actual_departure", "actual_platform_departure",
                "departure_status"]


def latest_updates(changes: DataFrame) -> DataFrame:
    """Keep the newest change row per ``stop_id`` (``update_timestamp`` and
    ``source_file`` are dropped afterwards, as in the raw-to-merged step).

    Written as ``max(struct(order..., payload))`` per stop instead of a
    ``row_number`` window: it is a partial aggregate, so a stop id that
    holds a large share of all updates is reduced map-side rather than
    sorted in one task."""
    payload = [c for c in RAW_CHANGE_COLUMNS if c != "stop_id"]
    best = changes.groupBy("stop_id").agg(
        F.max(F.struct(*[F.col(c) for c in LATEST_ORDER])).alias("b"))
    cols = [F.col(f"b.{c}").alias(c) for c in payload]
    return best.select("stop_id", *cols)


def merge_movements(plan: DataFrame, latest: DataFrame) -> DataFrame:
    """Every plan row (repeats included) joined with its stop's latest
    change, then the derived movement columns."""
    latest = latest.drop("update_timestamp", "source_file")
    m = plan.join(latest, "stop_id", "left")
    return m.select(
        "stop_id", "station_name", "train_category", "train_number",
        "planned_arrival", "actual_arrival",
        clamped_delay("actual_arrival", "planned_arrival")
        .alias("arrival_delay_minutes"),
        "planned_departure", "actual_departure",
        clamped_delay("actual_departure", "planned_departure")
        .alias("departure_delay_minutes"),
        cancelled_stop("arrival_status", "departure_status")
        .alias("is_cancelled"),
        movement_date("planned_departure", "planned_arrival").alias("date"),
        movement_hour("planned_departure", "planned_arrival").alias("hour"),
    ).select(*MOVEMENT_COLUMNS)


def build_movements(plan: DataFrame, changes: DataFrame) -> DataFrame:
    return merge_movements(plan, latest_updates(changes))
