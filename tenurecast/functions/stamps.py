"""Run names: ``<kind>_<kind>_<kind>_YYYY_MM_DD_HH:MM:SS[.ext]``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: three words, the date, then the time with or without colons.
STAMP = r"^[^_]+_[^_]+_[^_]+_(\d{4})_(\d{1,2})_(\d{1,2})_(\d{2}):?(\d{2})(?::?\d{2})?(?:\.[^_]*)?$"


def run_id(stamp: Column) -> Column:
    """Run identifier without colons, which partition paths would escape."""
    return F.date_format(stamp, "yyyy_MM_dd_HHmmss")


# What comes before the time in the name of a run's file.
PREFIXES = {
    "predictions": "part_{calendar}_pred_",
    "explanations": "part_visual_{calendar}_",
    "log": "log_file_{calendar}_",
}


def run_file(kind: str, calendar: str, run: str) -> str:
    """Name of a run's output, for example ``part_gregorian_pred_2024_01_31_101500``."""
    return PREFIXES[kind].format(calendar=calendar) + run


def parse_stamp(name: Column) -> Column:
    """Time in a run name, to the minute; NULL if the name is malformed."""
    year, month, day, hour, minute = (F.regexp_extract(name, STAMP, i) for i in range(1, 6))
    text = F.concat(
        year, F.lit("-"), F.lpad(month, 2, "0"), F.lit("-"), F.lpad(day, 2, "0"),
        F.lit(" "), hour, F.lit(":"), minute,
    )
    return F.when(name.rlike(STAMP), F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm")))


def expired(stamp: Column, as_of: Column, days: int) -> Column:
    """At least ``days`` old; unknown stamps never expire."""
    return F.coalesce(as_of - F.make_dt_interval(F.lit(days)) >= stamp, F.lit(False))
