"""Column expressions: half-even rounding, tolerant numbers, timestamps, keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RECONSTRUCTED = ("interpolation", "model", "neighbor", "unresolved")


def number(c: Column) -> Column:
    """Double of a string; empty, 'null' in any case and junk give null, as do NaN texts."""
    x = F.lower(F.trim(c.cast("string")))
    d = F.when(x.isin("", "null", "none"), None).otherwise(x).try_cast("double")
    return F.when(F.isnan(d), None).otherwise(d)


def _micros(minutes: float | Column) -> Column:
    return F.round(minutes * 60_000_000, 0).cast("long") if isinstance(minutes, Column) else F.lit(round(minutes * 60_000_000))


def slot(ts: Column, minutes: float | Column) -> Column:
    """Index of the interval (a number or a column) that a timestamp rounds to, half to even."""
    return F.bround(F.unix_micros(ts.cast("timestamp")) / _micros(minutes).cast("double"), 0).cast("long")


def slot_time(s: Column, minutes: float | Column) -> Column:
    return F.timestamp_micros(s * _micros(minutes))


def parse_two_ways(c: Column) -> tuple[Column, Column]:
    """(default, day-first) timestamps of a string; null where it does not fit.

    Year first reads alike both ways. The time may be absent or lack seconds, may follow a T, may end in a fraction and a Z; / may stand for -.
    """
    text = F.translate(F.regexp_replace(F.trim(c), r"(?i)^([0-9/-]+)T|Z$", "$1 "), "/", "-")
    text, time = F.trim(text), "[ HH:mm[:ss[.SSSSSSSSS]]]"
    iso = F.try_to_timestamp(text, F.lit(f"yyyy-MM-dd{time}"))
    return tuple(F.coalesce(iso, F.try_to_timestamp(text, F.lit(f"{date}{time}"))) for date in ("MM-dd-yyyy", "dd-MM-yyyy"))


def key_parts(c: Column) -> tuple[Column, Column]:
    """(id, topic) of 'id#topic'; the first # cuts, without one the topic is empty."""
    at = F.instr(c, "#")
    return F.when(at > 0, F.substring_index(c, "#", 1)).otherwise(c), F.when(at > 0, c.substr(at + 1, F.length(c))).otherwise(F.lit(""))


def safe_name(c: Column) -> Column:
    return F.regexp_replace(c, r"[^A-Za-z0-9\-_.]", "_")


def is_original(method: Column, flag: Column) -> Column:
    """Not written by an earlier run."""
    return (F.coalesce(flag, F.lit(0)) != 1) & ~F.coalesce(method, F.lit("")).isin(*RECONSTRUCTED)


def clipped(c: Column, bounds: tuple[float, float] | None) -> Column:
    return c if bounds is None else F.when(c.isNotNull(), F.greatest(F.lit(bounds[0]), F.least(F.lit(bounds[1]), c)))
