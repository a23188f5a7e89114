"""Action times: event-time strings in partition-path form, ``yyyy[/MM[/dd[/HH]]]``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from logsilt.layout import TIME_KEYS, rule_depth, time_keys

# Days a late record may lag, by the depth of its action time; other depths use 3 years.
LATE_DAYS = {1: 3 * 365, 2: 3 * 31, 3: 31, 4: 7}
LATE_DAYS_OTHER = 3 * 365

_MILLIS_PER_DAY = 24 * 3600 * 1000
# What completes a path of depth 1..6 to a full date and time.
_PATH_TAILS = ("/1/1/0/0/0", "/1/0/0/0", "/0/0/0", "/0/0", "/0", "")
# One path component that needs no escaping in a folder name or a partition spec.
_COMPONENT = "[0-9A-Za-z][0-9A-Za-z_.-]*"


def action_time(millis_text: Column, pattern: str, now: Column | None = None) -> Column:
    """Epoch-millis text to an action time; empty text means now, unreadable text gives NULL."""
    now = F.unix_timestamp() if now is None else now
    seconds = F.substring(millis_text, 1, 10).try_cast("bigint")
    return F.when(millis_text == "", F.from_unixtime(now, pattern)).otherwise(
        F.from_unixtime(seconds, pattern)
    )


def format_partition(millis: Column, pattern: str) -> Column:
    """Epoch millis to an action time."""
    return F.date_format(F.timestamp_millis(millis), pattern)


def parse_partition(text: Column, pattern: str) -> Column:
    """An action time to epoch millis; NULL when it does not fit the pattern."""
    return F.unix_millis(F.try_to_timestamp(text, F.lit(pattern)))


def fits_rule(path: Column, rule: str) -> Column:
    """True when the action time has exactly the rule's depth and plain components."""
    more = rule_depth(rule) - 1
    return F.coalesce(path.rlike(f"^{_COMPONENT}(/{_COMPONENT}){{{more}}}$"), F.lit(False))


def partition_parts(path: Column, rule: str) -> Column:
    """The components of an action time as an array, NULL when it does not fit the rule."""
    return F.split(F.when(fits_rule(path, rule), path), "/")


def partition_values(path: Column, rule: str) -> dict[str, Column]:
    """The table's time keys out of an action time, all NULL when it does not fit the rule."""
    parts = partition_parts(path, rule)
    return {key: F.get(parts, i) for i, key in enumerate(time_keys(rule))}


def partition_spec(path: Column) -> Column:
    """``2016/08/09/09`` -> ``year=2016/month=08/day=09/hour=09``; levels past the hour are dropped."""
    parts = F.split(path, "/")
    named = [F.concat(F.lit(f"{key}="), F.get(parts, i)) for i, key in enumerate(TIME_KEYS)]
    return F.when(path.isNotNull(), F.concat_ws("/", *named))


def spec_to_path(spec: Column) -> Column:
    """``year=2016/month=08`` -> ``2016/08``."""
    return F.regexp_replace(spec, "[a-z]+=", "")


def _path_millis(parts: Column) -> Column:
    tail = F.get(F.array(*[F.lit(t) for t in _PATH_TAILS]), F.size(parts) - 1)
    return F.unix_millis(
        F.try_to_timestamp(F.concat(F.array_join(parts, "/"), tail), F.lit("yyyy/M/d/H/m/s"))
    )


def within_late_window(path: Column, current: Column) -> Column:
    """True when ``current`` is no further past the action time than its granularity allows.

    Both are compared at the depth of the action time. Unreadable paths give NULL.
    """
    parts = F.split(path, "/")
    depth = F.size(parts)
    days = F.lit(LATE_DAYS_OTHER)
    for level, limit in LATE_DAYS.items():
        days = F.when(depth == level, F.lit(limit)).otherwise(days)
    lag = _path_millis(F.slice(F.split(current, "/"), F.lit(1), depth)) - _path_millis(parts)
    return lag <= days.cast("bigint") * F.lit(_MILLIS_PER_DAY)
