"""Lake pipeline: plan XML + change XML -> merged movement table, date/hour
partitioned, then the two analyses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trainyard.operators.analysis import (daily_mean_delay,
                                          peak_hour_departures)
from trainyard.operators.lake import build_movements
from trainyard.session import work_dir
from trainyard.sources.tables import (read_movements, write_movements,
                                      write_parquet)
from trainyard.sources.xml import read_change_raw, read_plan_raw


def run_lake_pipeline(spark: SparkSession, plan_root: str, change_root: str,
                      out_path: str, raw_plan_path: str | None = None,
                      raw_change_path: str | None = None,
                      incremental: bool = False) -> dict:
    """Parse both XML trees once into raw tables (at the given paths, else in
    the shared work folder), merge and write the movement table.  Returns the
    raw tables' row counts, taken from their files' footers: a stage that runs
    again changes none."""
    paths = [raw_plan_path or work_dir(spark, "raw-plan"),
             raw_change_path or work_dir(spark, "raw-changes")]
    write_parquet(read_plan_raw(spark, plan_root), paths[0])
    write_parquet(read_change_raw(spark, change_root), paths[1])
    plan, changes = map(spark.read.parquet, paths)
    write_movements(build_movements(plan, changes), out_path, incremental)
    return {"plan_rows": plan.count(), "change_rows": changes.count()}


def run_analyses(spark: SparkSession, movements_path: str,
                 station: str = "Berlin Hbf",
                 hours=(7, 8, 17, 18)) -> tuple[DataFrame, DataFrame]:
    mv = read_movements(spark, movements_path)
    return daily_mean_delay(mv, station), peak_hour_departures(mv, hours)
