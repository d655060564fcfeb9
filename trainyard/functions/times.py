"""Time stamps: ``YYMMDDHHMM`` text, ``yyyyMMddHHmm`` keys, calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trainyard.functions.text import strip

STAMP_RE = r"^[0-9]{10}$"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_stamp(x) -> Column:
    """Lenient ``YYMMDDHHMM`` -> timestamp_ntz; NULL unless ten ASCII digits
    forming a real date (years are 2000 + YY)."""
    x = _c(x)

    def two(i: int) -> Column:
        return F.substring(x, i, 2).cast("int")

    return F.when(x.rlike(STAMP_RE), F.try_make_timestamp_ntz(
        two(1) + 2000, two(3), two(5), two(7), two(9), F.lit(0)))


def parse_stamp_strict(x) -> Column:
    """Plan-side parse: surrounding blanks are ignored; a present value that
    does not parse goes to the reject table."""
    return parse_stamp(strip(_c(x)))


def time_key(ts) -> Column:
    """timestamp -> ``yyyyMMddHHmm`` as bigint (e.g. 202509051116),
    computed from the calendar fields (no text formatting per row)."""
    ts = _c(ts)
    k = F.year(ts).cast("long")
    for part, width in ((F.month(ts), 100), (F.dayofmonth(ts), 100),
                        (F.hour(ts), 100), (F.minute(ts), 100)):
        k = k * width + part
    return k


def lenient_time_key(x) -> Column:
    return time_key(parse_stamp(x))


def stamp_key(stamp) -> Column:
    """Snapshot folder text ``YYMMDDHHMM`` -> key by prefixing ``20``."""
    return F.concat(F.lit("20"), _c(stamp)).cast("long")


def is_minute(key) -> Column:
    """Whether a ``yyyyMMddHHmm`` key is a minute of the calendar; NULL for
    no key."""
    key = _c(key)

    def part(width: int) -> Column:
        return F.pmod(F.floor(key / width), F.lit(100)).cast("int")

    return F.when(key.isNotNull(), F.try_make_timestamp_ntz(
        F.floor(key / 100_000_000).cast("int"), part(1_000_000),
        part(10_000), part(100), part(1), F.lit(0)).isNotNull())


def snapshot_stamp(path) -> Column:
    """Parent-folder stamp of a file path ('' when the parent is not ten
    digits)."""
    return F.regexp_extract(_c(path), r"/([0-9]{10})/[^/]+$", 1)


def calendar_columns(ts) -> list[Column]:
    """date, hour, minute, ISO day of week (Mon=1) and weekend flag."""
    ts = _c(ts)
    wd = F.weekday(ts)
    return [
        F.to_date(ts).alias("date"),
        F.hour(ts).cast("short").alias("hour"),
        F.minute(ts).cast("short").alias("minute"),
        (wd + 1).cast("short").alias("dow"),
        (wd >= 5).alias("is_weekend"),
    ]
