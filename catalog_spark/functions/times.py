"""Times of one zone, to the millisecond, whatever the session's zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZONE = "Asia/Seoul"
OFFSET = "+09:00"
LOCAL = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(\.\d+)?$"
ABSOLUTE = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$"


def parse_ts(text: Column) -> Column:
    """Local date and time or RFC 3339, cut to milliseconds; null for all else, dates alone included."""
    x = F.trim(text)
    local = F.concat(F.replace(x, F.lit(" "), F.lit("T")), F.lit(OFFSET))
    return F.date_trunc("MILLISECOND", F.when(x.rlike(LOCAL), local).when(x.rlike(ABSOLUTE), x).try_cast("timestamp"))


def format_ts(ts: Column) -> Column:
    wall = F.convert_timezone(None, F.lit(ZONE), ts.cast("timestamp_ntz"))
    return F.date_format(wall, "yyyy-MM-dd HH:mm:ss.SSS")


def epoch() -> Column:
    """1970-01-01 00:00 of the zone."""
    return F.lit(f"1970-01-01T00:00:00{OFFSET}").cast("timestamp")


def year_one() -> Column:
    return F.lit(f"1971-01-01T00:00:00{OFFSET}").cast("timestamp")
