"""Incremental star load driven by a stream of snapshot files.

New XML files anywhere under a week folder arrive as a Structured Streaming
file source; every micro-batch goes through the same code as the batch load.
Its files replace their stored rows and the snapshots they touch are folded
again, so files may come in any order and a batch replayed after a failure
changes nothing.  The stream's own checkpoint records which files were
consumed, the tables' ledger which batches were applied.  One stream writes
to an output folder at a time: two streams (plans and changes) take turns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from trainyard.plans.star import build_star, write_star
from trainyard.schemas import TIMETABLE_XML
from trainyard.sources.xml import with_provenance


def snapshot_stream(spark: SparkSession, root: str,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """XML documents under ``root``, at any depth, as a stream, with
    provenance."""
    r = (spark.readStream.format("xml")
         .option("rowTag", "timetable")
         .option("recursiveFileLookup", "true")
         .option("pathGlobFilter", "*.[xX][mM][lL]")
         .option("mode", "PERMISSIVE")
         .option("columnNameOfCorruptRecord", "_bad")
         .schema(TIMETABLE_XML))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return with_provenance(r.load(root))


def start_snapshot_stream(spark: SparkSession, root: str, kind: str,
                          station_json: str, out_dir: str,
                          checkpoint: str, available_now: bool = True,
                          multi_line_json: bool = True,
                          max_files_per_trigger: int | None = None
                          ) -> StreamingQuery:
    """Start folding ``kind`` ('plan' or 'change') snapshot files into the
    star tables under ``out_dir``.  ``available_now`` processes what is
    there and stops; otherwise the query keeps watching the folder."""
    if kind not in ("plan", "change"):
        raise ValueError("kind must be 'plan' or 'change'")

    def fold(batch: DataFrame, epoch_id: int) -> None:
        docs = {"plan_docs": batch} if kind == "plan" else \
            {"change_docs": batch}
        t = build_star(batch.sparkSession, None, None, station_json,
                       multi_line_json, **docs)
        write_star(t, out_dir, incremental=True,
                   batch=f"{checkpoint}#{epoch_id}")

    w = (snapshot_stream(spark, root, max_files_per_trigger).writeStream
         .foreachBatch(fold)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else \
        w.trigger(processingTime="1 minute")
    return w.start()
