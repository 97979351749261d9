"""Timestamp text parsing/formatting and interval arithmetic (SC-1..3, SC-9, SC-10, SC-15)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The two accepted text forms, canonical first. One-letter fields accept
# the unpadded values the lenient source format allows ("5-8-2026 3:4").
CANONICAL_PATTERN = "yyyy-MM-dd HH:mm:ss"
ACCEPTED_PATTERNS = ["yyyy-M-d H:m:s", "d-M-yyyy H:m"]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def empty_to_null(c) -> Column:
    """SRC-3: the empty string means missing. Whitespace-only text is kept."""
    return F.nullif(_col(c), F.lit(""))


def _parse_one(text: Column, pattern: str) -> Column:
    # to_timestamp_ntz reads the wall clock without any zone (no DST shift) but raises on
    # bad text under ANSI; try_to_timestamp uses the same parser and only answers "does it
    # parse", so it guards the call.
    p = F.lit(pattern)
    return F.when(F.try_to_timestamp(text, p).isNotNull(), F.to_timestamp_ntz(text, p))


def parse_ts(c) -> Column:
    """SC-1: first accepted form that parses, as TIMESTAMP_NTZ; NULL when none does.

    Runs of whitespace are collapsed to one blank first: the source format treats a
    blank as "one or more whitespace characters". Leading/trailing blanks still fail."""
    text = F.regexp_replace(_col(c), r"\s+", " ")
    return F.coalesce(*[_parse_one(text, p) for p in ACCEPTED_PATTERNS])


def parse_ts_optional(c) -> Column:
    """SC-2: missing text stays missing; otherwise SC-1."""
    return parse_ts(empty_to_null(c))


def unparseable(c) -> Column:
    """True when text is present but matches no accepted form (TS-* rules)."""
    raw = empty_to_null(c)
    return raw.isNotNull() & parse_ts(raw).isNull()


def format_ts(c) -> Column:
    """SC-3: canonical text, whole seconds (fractions are truncated). The text of the calendar
    fields themselves: formatting functions would take a TIMESTAMP_NTZ through the session zone."""
    return F.substring(_col(c).cast("string"), 1, 19)


def add_seconds(ts, seconds) -> Column:
    """SC-9: timestamp + whole seconds; TIMESTAMP_NTZ stays NTZ."""
    s = seconds if isinstance(seconds, Column) else F.lit(seconds)
    return _col(ts) + F.make_dt_interval(secs=s.cast("long"))


def not_before(candidate, floor, floor_offset_seconds: int = 0) -> Column:
    """SC-10: the later of ``candidate`` and ``floor + offset``; NULL if either is NULL
    (``greatest`` alone would skip a NULL argument)."""
    f = add_seconds(floor, floor_offset_seconds) if floor_offset_seconds else _col(floor)
    c = _col(candidate)
    return F.when(c.isNotNull() & f.isNotNull(), F.greatest(c, f))


def hour_of(ts) -> Column:
    """SC-15."""
    return F.hour(_col(ts))


def epoch_micros(ts) -> Column:
    """Microseconds since 1970-01-01 00:00:00 of a TIMESTAMP_NTZ wall clock, computed
    from its calendar fields. (``timestamp_diff``/``unix_*`` would first cast NTZ to a
    session-zone TIMESTAMP and shift by an hour across daylight-saving changes.)"""
    c = _col(ts)
    whole = F.unix_date(F.to_date(c)).cast("long") * 86400 + F.hour(c) * 3600 + F.minute(c) * 60
    return whole * 1_000_000 + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("long")


def epoch_seconds(ts) -> Column:
    """Whole seconds since the epoch of a TIMESTAMP_NTZ wall clock (fractions dropped)."""
    c = _col(ts)
    return F.unix_date(F.to_date(c)).cast("long") * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)


def seconds_between(start, end) -> Column:
    """Whole seconds from ``start`` to ``end`` (exact difference truncated toward zero,
    negative when reversed), independent of the session time zone."""
    d = epoch_micros(end) - epoch_micros(start)
    return (d / F.lit(1_000_000)).cast("long")
