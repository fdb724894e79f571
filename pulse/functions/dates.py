"""Date and time parsing and formatting. The session zone is UTC throughout."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# The forms ``%Y%m%d`` and ``%Y-%m-%d`` accept, short months and days included.
_MONTH = r"(1[0-2]|0[1-9]|[1-9])"
_DAY = r"(3[0-1]|[1-2]\d|0[1-9]|[1-9]| [1-9])"
COMPACT_DATE = rf"^(\d{{4}}){_MONTH}{_DAY}\z"
DASHED_DATE = rf"^(\d{{4}})-{_MONTH}-{_DAY}\z"


def _date_by(c: Column, pattern: str) -> Column:
    """Date of the matched year, month and day; null for junk and impossible days."""
    parts = [F.trim(F.regexp_extract(c, pattern, i)) for i in (1, 2, 3)]
    return F.when(c.rlike(pattern), F.concat_ws("-", *parts).try_cast("date"))


def parse_postdate(c: Column) -> Column:
    return F.coalesce(_date_by(c, COMPACT_DATE), _date_by(c, DASHED_DATE))


def clean_postdate(c: Column) -> Column:
    """Compact date as ISO text; anything else is left as it is."""
    return F.coalesce(F.date_format(_date_by(c, COMPACT_DATE), "yyyy-MM-dd"), c)


def iso_postdate(c: Column) -> Column:
    """Dashes into any eight digits, without checking the date."""
    return F.regexp_replace(c, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")


def parse_discovered_at(c: Column) -> Column:
    """ISO time with ``Z``, an offset or neither, kept as an instant; else null."""
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(c))


def local_date(c: Column, tz: str, is_utc: bool = True) -> Column:
    return F.to_date(F.from_utc_timestamp(c, tz) if is_utc else c)


def iso_z(c: Column) -> Column:
    """ISO text of a whole second in UTC."""
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def instant(at: datetime | None) -> Column:
    """A given time, taken as UTC when it names no zone, or the current one."""
    if at is None:
        return F.current_timestamp()
    return F.lit(at if at.tzinfo else at.replace(tzinfo=UTC))
