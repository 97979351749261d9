"""Delivery-zone dimension (SRC-6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# Fixed values of the data model: the five delivery zones as
# (zone_id, center_lat, center_lon, spread), in their declared order (index 0..4).
ZONES = [
    ("BLR-CEN", 12.9716, 77.5946, 0.025),
    ("BLR-NTH", 13.05, 77.59, 0.035),
    ("BLR-STH", 12.9, 77.59, 0.035),
    ("BLR-EST", 12.97, 77.67, 0.035),
    ("BLR-WST", 12.96, 77.53, 0.035),
]

ZONE_SCHEMA = T.StructType([
    T.StructField("zone_idx", T.LongType(), False),
    T.StructField("zone_id", T.StringType(), False),
    T.StructField("center_lat", T.DoubleType(), False),
    T.StructField("center_lon", T.DoubleType(), False),
    T.StructField("spread", T.DoubleType(), False),
])


def zone_dim(spark: SparkSession) -> DataFrame:
    """The zone table, hinted for broadcast: five literal rows, a proven size bound."""
    rows = [(i, z, la, lo, s) for i, (z, la, lo, s) in enumerate(ZONES)]
    return F.broadcast(spark.createDataFrame(rows, ZONE_SCHEMA))
