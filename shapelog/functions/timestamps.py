"""Timestamps of ten shapes as ISO 8601 in UTC with milliseconds.

A time is checked as a local timestamp and printed from its parts, so the session's zone plays no
role. Offsets are read and ignored unless `apply_offset` is set. `now` decides the year of shapes
that have none: this year's, unless the day is still to come.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shapelog.functions.text import let, let_all, strip

# Month names.
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]

# The shapes, and the groups that hold year, month, day, hour, minute, second and fraction.
ISO = r"^(\d{4})-(\d{2})-(\d{2})[T ](\d{2}):(\d{2}):(\d{2})(?:[.,](\d+))?(?:Z|([+-])(\d{2}):?(\d{2}))?$"
SHAPES = [
    (ISO, "$1 $2 $3 $4 $5 $6 $7 $8$9 $8$10"),
    (r"^([A-Z][a-z]{2})\s+(\d{1,2})\s+(\d{4})\s+(\d{2}):(\d{2}):(\d{2})$", "$3 $1 $2 $4 $5 $6 "),
    (r"^([A-Z][a-z]{2})\s+(\d{1,2})\s+(\d{2}):(\d{2}):(\d{2})$", " $1 $2 $3 $4 $5 "),
    (r"^(\d{2})-(\d{2}) (\d{2}):(\d{2}):(\d{2})\.(\d+)$", " $1 $2 $3 $4 $5 $6"),
    (r"^\[(\d{2})\.(\d{2}) (\d{2}):(\d{2}):(\d{2})\]$", " $1 $2 $3 $4 $5 "),
    (r"^(\d{2})/(\d{2})/(\d{2}) (\d{2}):(\d{2}):(\d{2})$", "20$1 $2 $3 $4 $5 $6 "),
    (r"^(\d{2})(\d{2})(\d{2}) (\d{2})(\d{2})(\d{2})$", "20$1 $2 $3 $4 $5 $6 "),
    (r"^(\d{4})(\d{2})(\d{2})-(\d{1,2}):(\d{1,2}):(\d{1,2}):(\d+)$", "$1 $2 $3 $4 $5 $6 $7"),
    (r"^(\d{4})\.(\d{2})\.(\d{2})$", "$1 $2 $3 0 0 0 "),
]
EPOCH = r"^\d{10}$"


def _from_epoch(seconds: Column) -> Column:
    day = F.date_from_unix_date(F.floor(seconds / 86400).cast("int")).cast("string")
    rest = F.pmod(seconds, F.lit(86400))
    parts = [F.floor(rest / 3600), F.floor(F.pmod(rest, F.lit(3600)) / 60), F.pmod(rest, F.lit(60))]
    return F.concat(day, F.lit("T"), F.concat_ws(":", *(F.lpad(p.cast("string"), 2, "0") for p in parts)), F.lit(".000Z"))


def _from_parts(parts: Column, now: Column, apply_offset: bool) -> Column:
    """parts: year (empty: none), month (a number or a name), day, hour, minute, second, fraction and, if there is one, the offset."""
    month = F.coalesce(parts[1].try_cast("int"), F.array_position(F.array(*map(F.lit, MONTHS)), parts[1]).cast("int"))
    day, second = parts[2].try_cast("int"), parts[5].try_cast("int")
    this = F.year(now)

    def dated(x: dict[str, Column]) -> Column:
        to_come = F.try_make_timestamp_ntz(this, x["month"], x["day"], F.lit(0), F.lit(0), F.lit(0)) > F.to_date(now).cast("timestamp_ntz")
        return let(F.when(parts[0] != "", parts[0].try_cast("int")).when(to_come, this - 1).otherwise(this), lambda year: timed(year, x))

    def timed(year: Column, x: dict[str, Column]) -> Column:
        made = F.try_make_timestamp_ntz(year, x["month"], x["day"], parts[3].try_cast("int"), parts[4].try_cast("int"), x["second"].cast("decimal(8,6)"))
        if apply_offset:
            made = made - F.make_dt_interval(hours=F.coalesce(F.get(parts, F.lit(7)).try_cast("int"), F.lit(0)), mins=F.coalesce(F.get(parts, F.lit(8)).try_cast("int"), F.lit(0)))
        return let(F.when((x["second"] < 60) & (year >= 1), made), printed)

    def printed(at: Column) -> Column:
        digits = F.rpad(F.substring(parts[6], 1, 3), 3, "0")
        return F.concat(F.replace(F.substring(at.cast("string"), 1, 19), F.lit(" "), F.lit("T")), F.lit("."), digits, F.lit("Z"))

    return let_all({"month": month, "day": day, "second": second}, dated)


def normalize_timestamp(text: Column, now: Column | None = None, apply_offset: bool = False) -> Column:
    """The shape that matches gives the time; null if none does, or if it is no real date. No two shapes match one text."""
    now = F.current_timestamp() if now is None else now

    def shapes(raw: Column) -> Column:
        found = F
        for pattern, parts in SHAPES:
            found = found.when(raw.rlike(pattern), F.regexp_replace(raw, pattern, parts))
        return let(F.split(found.otherwise(None), " ", -1), lambda parts: F.coalesce(F.when(parts.isNotNull(), _from_parts(parts, now, apply_offset)), let(F.when(raw.rlike(EPOCH), raw).cast("bigint"), _from_epoch)))

    return let(strip(text), shapes)


def epoch_to_iso(seconds: Column) -> Column:
    """Seconds since 1970 as text or number; anything else is null."""
    return let(seconds.try_cast("bigint"), lambda whole: F.when(F.abs(whole) < 100_000_000_000, _from_epoch(whole)))
