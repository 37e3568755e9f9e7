"""Column expressions for one access-log line."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Field patterns of the log format.
HOST_PATTERN = r"^(\S+)"
TIME_PATTERN = r".* - - \[(.*)\].*"
REQUEST_PATTERN = r".*\"(.*)\".*"

# Countries reported on and their host suffixes.
COUNTRIES = {"Germany": ".de", "Canada": ".ca", "Singapore": ".sg"}

DAYS = 31
HOURS = 24


def host(line: Column) -> Column:
    return F.regexp_extract(line, HOST_PATTERN, 1)


def time_text(line: Column) -> Column:
    """The bracketed time as written; '' when there is none."""
    return F.regexp_extract(line, TIME_PATTERN, 1)


def request(line: Column) -> Column:
    """The last quoted text of the line (the pattern is greedy)."""
    return F.regexp_extract(line, REQUEST_PATTERN, 1)


def _whole_number(token: Column, kind: str) -> Column:
    # A failed cast costs as much as parsing some ten lines, so the usual sign for a
    # missing number is taken out first.
    return F.nullif(token, F.lit("-")).try_cast(kind)


def status(line: Column) -> Column:
    """The last but one space-separated token as int, null if there is none or it is no number.

    Reading the two tokens from the end of the text is cheaper than splitting all of it.
    """
    last_two = F.substring_index(line, " ", -2)
    token = F.when(F.contains(line, F.lit(" ")), F.substring_index(last_two, " ", 1))
    return _whole_number(token, "int")


def reply_bytes(line: Column) -> Column:
    """The last space-separated token as bigint, null if it is no number."""
    return _whole_number(F.substring_index(line, " ", -1), "bigint")


def top_level_domain(host_name: Column) -> Column:
    """Text after the last dot; null for a host without a dot."""
    return F.when(F.contains(host_name, F.lit(".")), F.substring_index(host_name, ".", -1))


def country(host_name: Column, suffixes: Mapping[str, str] | None = None) -> Column:
    """Name of the first suffix the host ends with, null when none fits."""
    suffixes = COUNTRIES if suffixes is None else suffixes
    if not suffixes:
        raise ValueError("at least one suffix is needed")
    chosen = F.lit(None).cast("string")
    for name, suffix in reversed(list(suffixes.items())):
        chosen = F.when(F.endswith(host_name, F.lit(suffix)), F.lit(name)).otherwise(chosen)
    return chosen


def _in_range(value: Column, low: int, high: int) -> Column:
    return F.when(value.between(low, high), value)


def day_of_month(time: Column) -> Column:
    """Day in the log's own local time (`01/Jul/1995:00:00:01 -0400` -> 1), null if unreadable."""
    return _in_range(F.split_part(time, F.lit("/"), F.lit(1)).try_cast("int"), 1, DAYS)


def local_date(time: Column) -> Column:
    """Date in the log's own local time, null if unreadable."""
    return F.try_to_date(F.split_part(time, F.lit(":"), F.lit(1)), "dd/MMM/yyyy")


def hour_of_day(time: Column) -> Column:
    """Hour in the log's own local time, null if unreadable."""
    return _in_range(F.split_part(time, F.lit(":"), F.lit(2)).try_cast("int"), 0, HOURS - 1)
