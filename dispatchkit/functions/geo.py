"""Geography helpers (SC-5, SC-6, SC-16)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Mean Earth radius in km, and the plausible road/straight-line factor range.
EARTH_RADIUS_KM = 6371.0
ROAD_FACTOR_MIN = 1.15
ROAD_FACTOR_MAX = 1.40


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """SC-5: great-circle distance in km."""
    la1, la2 = F.radians(_col(lat1)), F.radians(_col(lat2))
    dlat = F.radians(_col(lat2) - _col(lat1))
    dlon = F.radians(_col(lon2) - _col(lon1))
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(la1) * F.cos(la2) * F.pow(F.sin(dlon / 2), 2)
    c = 2 * F.atan2(F.sqrt(a), F.sqrt(1 - a))
    return F.lit(EARTH_RADIUS_KM) * c


def route_km(straight_km, road_factor) -> Column:
    """SC-6: road distance = straight line x factor, rounded to 2 dp."""
    f = road_factor if isinstance(road_factor, Column) else F.lit(float(road_factor))
    return F.round(_col(straight_km) * f, 2)


def route_plausible(distance_km, straight_km) -> Column:
    """True when a recorded route distance lies within the road-factor bounds."""
    d, s = _col(distance_km), _col(straight_km)
    return (d >= F.round(s * ROAD_FACTOR_MIN, 2)) & (d <= F.round(s * ROAD_FACTOR_MAX, 2))


def round_coord(c) -> Column:
    """SC-16: coordinate to 6 dp."""
    return F.round(_col(c), 6)
