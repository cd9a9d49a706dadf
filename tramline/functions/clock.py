"""Time expressions: timetable text, epoch seconds, Paris wall clock, service days."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

PARIS = "Europe/Paris"
MICROS_PER_SECOND = 1_000_000
MICROS_PER_MINUTE = 60 * MICROS_PER_SECOND
MICROS_PER_HOUR = 60 * MICROS_PER_MINUTE

# Range of a calendar date with a four-digit year, in epoch seconds.
FIRST_EPOCH_SECOND = -62_135_596_800
LAST_EPOCH_SECOND = 253_402_300_799


def hhmmss_to_seconds(text: Column) -> Column:
    """'H:M:S' to seconds after midnight; hours may pass 24, other text gives NULL."""
    # Cut out as bytes: a split makes a list of each text and takes twice as long.
    texts = (
        F.substring_index(text, ":", 1),
        F.substring_index(F.substring_index(text, ":", 2), ":", -1),
        F.substring_index(text, ":", -1),
    )
    hours, minutes, seconds = (part.try_cast("bigint") for part in texts)
    colons = F.length(text) - F.length(F.replace(text, F.lit(":"), F.lit("")))
    total = F.try_add(
        F.try_multiply(hours, F.lit(3600)), F.try_add(F.try_multiply(minutes, F.lit(60)), seconds)
    )
    return F.when(colons == 2, total)


def epoch_to_timestamp(epoch: Column, integral: bool = False) -> Column:
    """Epoch seconds (integer, decimal or text) to an instant; anything else gives NULL.

    `integral` says the column is an integer type already and needs no parsing.
    """
    whole = epoch if integral else epoch.try_cast("double").try_cast("bigint")
    return F.when(
        whole.between(FIRST_EPOCH_SECOND, LAST_EPOCH_SECOND), F.timestamp_seconds(whole)
    )


def paris_wall_clock(instant: Column) -> Column:
    """Instant to Paris local time without zone.

    `from_utc_timestamp` looks the zone up once per task; `convert_timezone` does
    so for every row and is many times slower.
    """
    return F.from_utc_timestamp(instant, PARIS).cast("timestamp_ntz")


def paris_to_instant(wall_clock: Column) -> Column:
    """Paris local time to an instant.  The repeated hour in autumn is read as winter time."""
    local = wall_clock.cast("timestamp")
    early = F.to_utc_timestamp(local, PARIS)
    late = early + F.expr("interval 1 hour")
    return F.when(F.from_utc_timestamp(late, PARIS) == local, late).otherwise(early)


def start_of(micros: Column, unit: int) -> Column:
    """Microseconds since 1970 cut down to a whole number of units."""
    return micros - F.pmod(micros, F.lit(unit))


def plus_seconds(moment: Column, seconds: Column) -> Column:
    """Add whole seconds to an instant or a local time."""
    return F.timestamp_add("SECOND", seconds, moment)


def micros_between(later: Column, earlier: Column) -> Column:
    """Exact difference of two instants in microseconds."""
    return F.unix_micros(later) - F.unix_micros(earlier)


def as_instant(moment: dt.datetime | str | Column | None) -> Column:
    """Parameter form of "now": a Column, an ISO text or datetime in UTC, or the current time."""
    if moment is None:
        return F.current_timestamp()
    if isinstance(moment, Column):
        return moment
    if isinstance(moment, dt.datetime) and moment.tzinfo is not None:
        moment = moment.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return F.lit(str(moment)).cast("timestamp")


def stamp(moment: dt.datetime | None = None) -> str:
    """Run label YYYYMMDD_HHMMSS in Paris time; pass the moment to repeat a run."""
    from zoneinfo import ZoneInfo

    moment = moment or dt.datetime.now(dt.timezone.utc)
    return moment.astimezone(ZoneInfo(PARIS)).strftime("%Y%m%d_%H%M%S")
