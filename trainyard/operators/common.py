"""Helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cut_lineage(df: DataFrame, name: str = "round",
                folder: str | None = None) -> DataFrame:
    """Materialise ``df`` as a Parquet table under ``spark.checkpoint.dir``
    (shared storage on a cluster), or as ``name`` in a ``folder`` of the
    caller's, and continue from the written table.

    Used between rounds of the iterative jobs: the plan stays short, a lost
    executor only costs the current round, and the write is a single job
    (an RDD checkpoint of an unpersisted Dataset computes it twice).  Its
    shuffle files go with the job."""
    from trainyard.session import DROP_SHUFFLES, setting, work_dir
    spark = df.sparkSession
    path = f"{folder}/{name}" if folder else work_dir(spark, name)
    with setting(spark, DROP_SHUFFLES, "true"):
        df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def cut_and_count(df: DataFrame, name: str, cond, *more_conds):
    """:func:`cut_lineage` that also returns how many written rows satisfy
    ``cond`` (and each of ``more_conds``).  Returns ``(table, n)`` or
    ``(table, n, m, ...)``.  Counted are the written rows, so a stage that is
    run again after a lost executor changes no count."""
    conds = [F.expr(c) if isinstance(c, str) else c
             for c in (cond, *more_conds)]
    table = cut_lineage(df, name)
    got = table.agg(*[F.count_if(c) for c in conds]).first()
    return (table, *got)
