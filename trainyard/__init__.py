"""trainyard: rail-timetable analytics as Spark DataFrame jobs.

Layout
------
functions/  native Column expressions (time stamps, delays, name normalisers)
sources/    readers and writers (timetable XML, station JSON, Parquet layouts)
operators/  DataFrame -> DataFrame operators (dimensions, fact upsert, lake
            merge, analyses, graph search, nearest station)
plans/      end-to-end jobs composed from the operators (star load, lake ETL,
            routing) and the mapping onto the driver's test tables
streaming/  the incremental star load driven by a file stream
"""

from trainyard.session import get_session, work_dir

__all__ = ["get_session", "work_dir"]
