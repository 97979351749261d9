"""Staffing, demand and duration arithmetic (PRJ-4..7, SC-7, SC-8, SC-11..14, SC-17, SC-18)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values of the reference's operating model.
PICK_BASE_SECONDS = 90
PICK_PER_ITEM_RANGE = (20, 40)
PICK_EXTRA_RANGE = (0, 120)
PACK_BASE_RANGE = (60, 150)
PICK_BANDS = [(0.50, 1.35), (0.75, 1.15)]   # ratio below bound -> multiplier; else 1.00
PACK_BANDS = [(0.50, 1.30), (0.75, 1.15)]
PICKERS_PER_CAPACITY, MIN_BASE_PICKERS = 35, 2
PACKERS_PER_CAPACITY, MIN_BASE_PACKERS = 60, 1
# demand multiplier by hour: [11,14) or [17,22) -> 1.20; [7,11) -> 1.05; else 0.80
PEAK_HOURS = [(11, 14), (17, 22)]
SHOULDER_HOURS = [(7, 11)]
PEAK_MULT, SHOULDER_MULT, LOW_MULT = 1.20, 1.05, 0.80
# order demand periods: [start, end) hour -> label; anything else is off-peak
DEMAND_PERIODS = [(7, 10, "MORNING"), (11, 14, "LUNCH"), (17, 22, "EVENING"), (22, 24, "LATE_NIGHT")]
# transit minutes: base 3..9; HIGH +2..5; SEVERE +5..10; RAIN +1..4
TRANSIT_BASE = (3, 9)
TRANSIT_TRAFFIC = {"HIGH": (2, 5), "SEVERE": (5, 10)}
TRANSIT_WEATHER = {"RAIN": (1, 4)}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lit(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def round_half_even(c, scale: int = 0) -> Column:
    """SC-7: banker's rounding, like the source's round()."""
    return F.bround(_col(c), scale)


def clamp(c, lo, hi) -> Column:
    """SC-8: min(hi, max(lo, x)), NULL-propagating (greatest/least skip NULLs)."""
    x = _col(c)
    return F.when(x.isNotNull(), F.least(F.greatest(x, _lit(lo)), _lit(hi)))


def staffing_ratio(available, scheduled) -> Column:
    """SC-17: available / scheduled as double; NULL when scheduled is 0."""
    return F.try_divide(_col(available).cast("double"), _col(scheduled).cast("double"))


def _band(ratio: Column, bands) -> Column:
    out = None
    for bound, mult in bands:
        cond = ratio < F.lit(bound)
        out = F.when(cond, F.lit(mult)) if out is None else out.when(cond, F.lit(mult))
    return F.when(ratio.isNotNull(), out.otherwise(F.lit(1.0)))


def pick_staffing_band(available, scheduled) -> Column:
    """PRJ-4: picking slowdown multiplier from the staffing ratio."""
    return _band(staffing_ratio(available, scheduled), PICK_BANDS)


def pack_staffing_band(available, scheduled) -> Column:
    """PRJ-5: packing slowdown multiplier."""
    return _band(staffing_ratio(available, scheduled), PACK_BANDS)


def _in_ranges(h: Column, ranges) -> Column:
    cond = None
    for lo, hi in ranges:
        c = (h >= lo) & (h < hi)
        cond = c if cond is None else (cond | c)
    return cond


def demand_multiplier(ts) -> Column:
    """PRJ-6: planned-staff multiplier by hour of day."""
    h = F.hour(_col(ts))
    return (F.when(_in_ranges(h, PEAK_HOURS), F.lit(PEAK_MULT))
            .when(_in_ranges(h, SHOULDER_HOURS), F.lit(SHOULDER_MULT))
            .when(h.isNotNull(), F.lit(LOW_MULT)))


def demand_period(ts) -> Column:
    """PRJ-7: label of the demand period an order's hour falls in."""
    h = F.hour(_col(ts))
    out = None
    for lo, hi, label in DEMAND_PERIODS:
        c = (h >= lo) & (h < hi)
        out = F.when(c, F.lit(label)) if out is None else out.when(c, F.lit(label))
    return out.when(h.isNotNull(), F.lit("OFF_PEAK"))


def scheduled_staff(baseline_capacity, ts) -> tuple[Column, Column]:
    """SC-14: (pickers, packers) scheduled for a store-hour."""
    cap = _col(baseline_capacity).cast("double")
    m = demand_multiplier(ts)
    base_pick = F.greatest(F.lit(MIN_BASE_PICKERS).cast("double"), F.bround(cap / PICKERS_PER_CAPACITY, 0))
    base_pack = F.greatest(F.lit(MIN_BASE_PACKERS).cast("double"), F.bround(cap / PACKERS_PER_CAPACITY, 0))
    pickers = F.greatest(F.lit(1.0), F.bround(base_pick * m, 0)).cast("int")
    packers = F.greatest(F.lit(1.0), F.bround(base_pack * m, 0)).cast("int")
    return pickers, packers


def available_staff(scheduled, rate) -> Column:
    """SC-18: min(scheduled, max(0, round(scheduled x rate))) with half-even rounding."""
    s = _col(scheduled)
    return F.least(s.cast("double"), F.greatest(F.lit(0.0), F.bround(s * _lit(rate), 0))).cast("int")


def pick_seconds(item_count, pickers_available, pickers_scheduled,
                 per_item_seconds=PICK_PER_ITEM_RANGE[0], extra_seconds=PICK_EXTRA_RANGE[0]) -> Column:
    """SC-11: int((90 + items x per_item + extra) x band); NULL for invalid inputs
    (no items, nobody scheduled), which the source rejects."""
    n = _col(item_count)
    normal = (F.lit(PICK_BASE_SECONDS) + n * _lit(per_item_seconds) + _lit(extra_seconds)).cast("double")
    band = pick_staffing_band(pickers_available, pickers_scheduled)
    ok = (n > 0) & (_col(pickers_scheduled) > 0)
    return F.when(ok, (normal * band).cast("long"))


def pack_seconds(packers_available, packers_scheduled, base_seconds=PACK_BASE_RANGE[0]) -> Column:
    """SC-12: int(base x band)."""
    band = pack_staffing_band(packers_available, packers_scheduled)
    ok = _col(packers_scheduled) > 0
    return F.when(ok, (_lit(base_seconds).cast("double") * band).cast("long"))


def transit_bounds(traffic, weather) -> tuple[Column, Column]:
    """SC-13: (lowest, highest) plausible transit minutes for the conditions."""
    lo, hi = F.lit(float(TRANSIT_BASE[0])), F.lit(float(TRANSIT_BASE[1]))
    t, w = _col(traffic), _col(weather)
    for name, (a, b) in TRANSIT_TRAFFIC.items():
        lo = lo + F.when(t == name, F.lit(float(a))).otherwise(F.lit(0.0))
        hi = hi + F.when(t == name, F.lit(float(b))).otherwise(F.lit(0.0))
    for name, (a, b) in TRANSIT_WEATHER.items():
        lo = lo + F.when(w == name, F.lit(float(a))).otherwise(F.lit(0.0))
        hi = hi + F.when(w == name, F.lit(float(b))).otherwise(F.lit(0.0))
    return lo, hi
