"""Declared schemas of the ten operational tables.

Column order is the publication order. Identifiers are text in files (``ORD-000001``);
the derived test tables carry them as bigint, so conformance checks compare names and
order, and type only when asked.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, I, D, TS = T.StringType(), T.IntegerType(), T.DoubleType(), T.TimestampNTZType()

# name -> (key column, [(column, type), ...]) in declared order.
DECLARED: dict[str, tuple[str, list[tuple[str, T.DataType]]]] = {
    "customers": ("customer_id", [
        ("customer_id", S), ("zone_id", S), ("latitude", D), ("longitude", D)]),
    "stores": ("store_id", [
        ("store_id", S), ("store_name", S), ("zone", S), ("latitude", D), ("longitude", D),
        ("baseline_capacity", I), ("status", S), ("opened_at", TS), ("closed_at", TS)]),
    "riders": ("rider_id", [
        ("rider_id", S), ("vehicle_type", S), ("home_zone", S), ("status", S),
        ("joined_at", TS), ("deactivated_at", TS)]),
    "orders": ("order_id", [
        ("order_id", S), ("customer_id", S), ("created_at", TS), ("payment_success_at", TS),
        ("delivery_latitude", D), ("delivery_longitude", D), ("delivery_zone", S), ("status", S),
        ("cancelled_at", TS), ("cancellation_reason", S), ("failure_reason", S)]),
    "fulfilment_units": ("fulfilment_unit_id", [
        ("fulfilment_unit_id", S), ("order_id", S), ("store_id", S), ("status", S),
        ("assigned_to_store_at", TS), ("picking_started_at", TS), ("picking_completed_at", TS),
        ("packing_started_at", TS), ("packing_completed_at", TS), ("cancelled_at", TS),
        ("cancellation_reason", S), ("failed_at", TS), ("failure_reason", S), ("completed_at", TS)]),
    "order_items": ("order_item_id", [
        ("order_item_id", S), ("order_id", S), ("fulfilment_unit_id", S), ("product_id", S),
        ("quantity", I)]),
    "deliveries": ("delivery_id", [
        ("delivery_id", S), ("fulfilment_unit_id", S), ("rider_id", S), ("status", S),
        ("rider_arrived_at_store", TS), ("picked_up_at", TS), ("delivery_started_at", TS),
        ("delivered_at", TS), ("delivery_distance", D), ("traffic_condition", S),
        ("weather_condition", S), ("cancelled_at", TS), ("cancellation_reason", S),
        ("failed_at", TS), ("failure_reason", S)]),
    "rider_assignments": ("assignment_id", [
        ("assignment_id", S), ("delivery_id", S), ("rider_id", S), ("offered_at", TS),
        ("responded_at", TS), ("expired_at", TS), ("response", S), ("rejection_reason", S)]),
    "operational_events": ("event_id", [
        ("event_id", S), ("event_type", S), ("occurred_at", TS), ("order_id", S),
        ("fulfilment_unit_id", S), ("delivery_id", S), ("store_id", S), ("rider_id", S),
        ("reason", S)]),
    "store_staffing": ("staffing_snapshot_id", [
        ("staffing_snapshot_id", S), ("store_id", S), ("recorded_at", TS),
        ("pickers_scheduled", I), ("pickers_available", I), ("packers_scheduled", I),
        ("packers_available", I)]),
}

TABLES = list(DECLARED)


def columns(name: str) -> list[str]:
    return [c for c, _ in DECLARED[name][1]]


def key_of(name: str) -> str:
    return DECLARED[name][0]


def struct_type(name: str, text_timestamps: bool = False) -> T.StructType:
    """Declared StructType. ``text_timestamps`` reads timestamp columns as strings so
    both accepted text forms can be parsed leniently afterwards (see functions.timestamps)."""
    fields = []
    for c, t in DECLARED[name][1]:
        if text_timestamps and isinstance(t, T.TimestampNTZType):
            t = S
        fields.append(T.StructField(c, t, True))
    return T.StructType(fields)


def timestamp_columns(name: str) -> list[str]:
    return [c for c, t in DECLARED[name][1] if isinstance(t, T.TimestampNTZType)]


# Domains of the enumerated columns.
ORDER_STATUSES = ["CREATED", "FULFILLING", "DELIVERED", "CANCELLED", "FAILED"]
FULFILMENT_STATUSES = ["PENDING", "PICKING", "PACKING", "READY_FOR_PICKUP", "HANDED_TO_RIDER",
                       "COMPLETED", "CANCELLED", "FAILED"]
DELIVERY_STATUSES = ["REQUESTED", "ASSIGNED", "IN_TRANSIT", "DELIVERED", "CANCELLED", "FAILED"]

# Event types in lifecycle order (fixed values of the data model).
EVENT_TYPES = [
    "ORDER_CREATED", "PAYMENT_SUCCESS", "STORE_ASSIGNED", "PICKING_STARTED", "PICKING_COMPLETED",
    "FULFILMENT_CANCELLED", "PACKING_STARTED", "PACKING_COMPLETED", "FULFILMENT_FAILED",
    "DELIVERY_FAILED", "RIDER_ASSIGNED", "RIDER_ARRIVED_AT_STORE", "PICKED_UP",
    "DELIVERY_STARTED", "DELIVERED",
]
