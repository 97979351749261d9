"""Lifecycle composites, set operations and projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import lifecycle as lc
from ..operators import projection as pj
from ..sources.schemas import EVENT_TYPES, columns as declared_columns
from .fixtures import qc, raw
from .registry import query
from .q_windows import asof_sql

GRID_START = "1995-07-01 00:00:00"


def _state(spark, sf):
    return (qc(spark, sf, "orders"), qc(spark, sf, "fulfilment_units"), qc(spark, sf, "deliveries"),
            qc(spark, sf, "rider_assignments"))


def _union_sql() -> str:
    parts = []
    for tc, et in lc.ORDER_STAGES:
        parts.append(f"SELECT '{et}' AS event_type, {tc} AS occurred_at, order_id, NULL::BIGINT AS fulfilment_unit_id, "
                     f"NULL::BIGINT AS delivery_id, NULL::BIGINT AS store_id, NULL::BIGINT AS rider_id, "
                     f"NULL::VARCHAR AS reason, order_id AS source_id FROM qc_orders WHERE {tc} IS NOT NULL")
    reasons = {"FULFILMENT_CANCELLED": "cancellation_reason", "FULFILMENT_FAILED": "failure_reason"}
    for tc, et in lc.UNIT_STAGES:
        r = reasons.get(et, "NULL::VARCHAR")
        parts.append(f"SELECT '{et}', {tc}, order_id, fulfilment_unit_id, NULL, store_id, NULL, {r}, "
                     f"fulfilment_unit_id FROM qc_fulfilment_units WHERE {tc} IS NOT NULL")
    for tc, et in lc.DELIVERY_STAGES:
        rider = "NULL" if et == "DELIVERY_FAILED" else "d.rider_id"
        r = "d.failure_reason" if et == "DELIVERY_FAILED" else "NULL::VARCHAR"
        parts.append(f"SELECT '{et}', d.{tc}, u.order_id, d.fulfilment_unit_id, d.delivery_id, u.store_id, {rider}, "
                     f"{r}, d.delivery_id FROM qc_deliveries d LEFT JOIN qc_fulfilment_units u "
                     f"ON u.fulfilment_unit_id = d.fulfilment_unit_id WHERE d.{tc} IS NOT NULL")
    parts.append("SELECT 'RIDER_ASSIGNED', a.responded_at, u.order_id, d.fulfilment_unit_id, a.delivery_id, u.store_id, "
                 "a.rider_id, NULL::VARCHAR, a.assignment_id FROM qc_rider_assignments a "
                 "LEFT JOIN qc_deliveries d ON d.delivery_id = a.delivery_id "
                 "LEFT JOIN qc_fulfilment_units u ON u.fulfilment_unit_id = d.fulfilment_unit_id "
                 "WHERE a.response = 'ACCEPTED' AND a.responded_at IS NOT NULL")
    return "\nUNION ALL\n".join(parts)


_RANK_SQL = "CASE event_type " + " ".join(f"WHEN '{t}' THEN {i}" for i, t in enumerate(EVENT_TYPES)) + " END"


@query("event_union", section="ST-1", oracle=_union_sql())
def q_event_union(spark, sf):
    return lc.event_union(*_state(spark, sf))


@query("events_from_state", section="LC-1", oracle=f"""
WITH u AS ({_union_sql()})
SELECT printf('EVT-%07d', row_number() OVER (ORDER BY occurred_at, {_RANK_SQL}, source_id)) AS event_id,
       event_type, occurred_at, order_id, fulfilment_unit_id, delivery_id, store_id, rider_id, reason
FROM u
""")
def q_events_from_state(spark, sf):
    return lc.events_from_state(*_state(spark, sf))


def _state_sql(level: str) -> str:
    if level == "unit":
        key, stages, smap, default = "fulfilment_unit_id", lc.UNIT_STAGES, lc.UNIT_STATUS_AFTER, "PENDING"
    else:
        key, stages, smap, default = "delivery_id", lc.DELIVERY_STAGES, lc.DELIVERY_STATUS_AFTER, "REQUESTED"
    rel = ", ".join(f"'{t}'" for t in smap)
    ts = ",\n       ".join(f"max(occurred_at) FILTER (WHERE event_type = '{et}') AS {tc}" for tc, et in stages)
    status = "CASE l.event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in smap.items()) + f" ELSE '{default}' END"
    return f"""
WITH a AS (
  SELECT {key}, {ts}, count(*) AS n_events
  FROM qc_operational_events WHERE {key} IS NOT NULL GROUP BY {key}),
l AS (
  SELECT {key}, event_type FROM (
    SELECT {key}, event_type,
           row_number() OVER (PARTITION BY {key} ORDER BY occurred_at DESC, event_id DESC) AS rn
    FROM qc_operational_events WHERE {key} IS NOT NULL AND event_type IN ({rel})) WHERE rn = 1),
r AS (
  SELECT {key}, reason FROM (
    SELECT {key}, reason,
           row_number() OVER (PARTITION BY {key} ORDER BY occurred_at DESC, event_id DESC) AS rn
    FROM qc_operational_events WHERE {key} IS NOT NULL AND reason IS NOT NULL) WHERE rn = 1)
SELECT a.*, l.event_type AS last_event_type, r.reason, {status} AS status
FROM a LEFT JOIN l ON l.{key} = a.{key} LEFT JOIN r ON r.{key} = a.{key}
"""


@query("state_from_events", section="LC-2", oracle=_state_sql("unit"))
def q_state_from_events(spark, sf):
    return lc.state_from_events(qc(spark, sf, "operational_events"), "unit")


@query("delivery_state_from_events", section="LC-2", oracle=_state_sql("delivery"))
def q_delivery_state_from_events(spark, sf):
    return lc.state_from_events(qc(spark, sf, "operational_events"), "delivery")


_SPANS = [("pay_s", "created_at", "payment_success_at"), ("assign_s", "payment_success_at", "assigned_to_store_at"),
          ("wait_to_pick_s", "assigned_to_store_at", "picking_started_at"),
          ("pick_s", "picking_started_at", "picking_completed_at"),
          ("gap_s", "picking_completed_at", "packing_started_at"),
          ("pack_s", "packing_started_at", "packing_completed_at"),
          ("offer_s", "packing_completed_at", "first_offered_at"),
          ("arrive_s", "first_offered_at", "rider_arrived_at_store"),
          ("wait_s", "rider_arrived_at_store", "picked_up_at"),
          ("handover_s", "picked_up_at", "delivery_started_at"),
          ("transit_s", "delivery_started_at", "delivered_at")]


@query("stage_durations", section="LC-3", oracle=f"""
WITH f AS (SELECT delivery_id, min(offered_at) AS first_offered_at FROM qc_rider_assignments GROUP BY delivery_id),
j AS (
  SELECT u.fulfilment_unit_id, d.delivery_id, o.created_at, o.payment_success_at, u.assigned_to_store_at,
         u.picking_started_at, u.picking_completed_at, u.packing_started_at, u.packing_completed_at,
         f.first_offered_at, d.rider_arrived_at_store, d.picked_up_at, d.delivery_started_at, d.delivered_at
  FROM qc_fulfilment_units u LEFT JOIN qc_orders o ON o.order_id = u.order_id
  LEFT JOIN qc_deliveries d ON d.fulfilment_unit_id = u.fulfilment_unit_id
  LEFT JOIN f ON f.delivery_id = d.delivery_id)
SELECT fulfilment_unit_id, delivery_id,
       {", ".join(f"date_diff('second', {a}, {b}) AS {n}" for n, a, b in _SPANS)}
FROM j
""")
def q_stage_durations(spark, sf):
    return lc.stage_durations(*_state(spark, sf))


_MULT_SQL = ("CASE WHEN (hour(t) >= 11 AND hour(t) < 14) OR (hour(t) >= 17 AND hour(t) < 22) THEN cast(1.2 as double) "
             "WHEN hour(t) >= 7 AND hour(t) < 11 THEN cast(1.05 as double) ELSE cast(0.8 as double) END")


@query("staffing_plan", section="LC-4", oracle=f"""
WITH g AS (
  SELECT s.store_id, s.baseline_capacity, timestamp '{GRID_START}' + interval '1' hour * h AS t
  FROM qc_stores s, range(0, 24) AS r(h)),
m AS (SELECT *, {_MULT_SQL} AS mult FROM g)
SELECT store_id, t AS recorded_at, mult AS demand_multiplier,
       cast(greatest(1.0, round_even(greatest(2.0, round_even(cast(baseline_capacity as double) / 35, 0)) * mult, 0))
            as integer) AS pickers_scheduled,
       cast(greatest(1.0, round_even(greatest(1.0, round_even(cast(baseline_capacity as double) / 60, 0)) * mult, 0))
            as integer) AS packers_scheduled
FROM m
""")
def q_staffing_plan(spark, sf):
    return lc.staffing_plan(qc(spark, sf, "stores"), GRID_START, 24)


def _band_sql(a: str, s: str, lo_mult: float, mid_mult: float) -> str:
    r = f"(CASE WHEN {s} = 0 THEN NULL ELSE cast({a} as double) / cast({s} as double) END)"
    return (f"(CASE WHEN {r} IS NULL THEN NULL WHEN {r} < 0.5 THEN cast({lo_mult} as double) "
            f"WHEN {r} < 0.75 THEN cast({mid_mult} as double) ELSE cast(1.0 as double) END)")


PICK_SQL = asof_sql() + f""",
c AS (SELECT fulfilment_unit_id, count(*) AS item_count FROM qc_order_items GROUP BY fulfilment_unit_id),
b AS (
  SELECT a.*, c.item_count, u.picking_completed_at,
         {_band_sql('a.pickers_available', 'a.pickers_scheduled', 1.35, 1.15)} AS band
  FROM asof_r a LEFT JOIN c ON c.fulfilment_unit_id = a.fulfilment_unit_id
  JOIN qc_fulfilment_units u ON u.fulfilment_unit_id = a.fulfilment_unit_id)
SELECT fulfilment_unit_id, store_id, item_count, staffing_snapshot_id, asof_match,
       round(CASE WHEN pickers_scheduled = 0 THEN NULL
                  ELSE cast(pickers_available as double) / cast(pickers_scheduled as double) END, 4) AS staffing_ratio,
       band AS pick_band,
       CASE WHEN coalesce(item_count, 0) > 0 AND pickers_scheduled > 0
            THEN cast(trunc(cast(90 + coalesce(item_count, 0) * 20 + 0 as double) * band) as bigint) END AS min_pick_s,
       CASE WHEN coalesce(item_count, 0) > 0 AND pickers_scheduled > 0
            THEN cast(trunc(cast(90 + coalesce(item_count, 0) * 40 + 120 as double) * band) as bigint) END AS max_pick_s,
       date_diff('second', picking_started_at, picking_completed_at) AS actual_pick_s
FROM b
"""


@query("pick_seconds", section="SC-11", oracle=f"""
SELECT fulfilment_unit_id, item_count, min_pick_s, max_pick_s, actual_pick_s,
       (actual_pick_s < min_pick_s OR actual_pick_s > max_pick_s) AS outside_bounds
FROM ({PICK_SQL}) w WHERE item_count IS NOT NULL""")
def q_pick_seconds(spark, sf):
    """The pick time that a unit's own items and its store's staff explain, against the measured one."""
    w = lc.pick_workload(qc(spark, sf, "fulfilment_units"), qc(spark, sf, "order_items"), qc(spark, sf, "store_staffing"))
    out = (F.col("actual_pick_s") < F.col("min_pick_s")) | (F.col("actual_pick_s") > F.col("max_pick_s"))
    return w.filter("item_count is not null").select("fulfilment_unit_id", "item_count", "min_pick_s", "max_pick_s",
                                                     "actual_pick_s", out.alias("outside_bounds"))


@query("pick_workload", section="LC-5", oracle=PICK_SQL)
def q_pick_workload(spark, sf):
    return lc.pick_workload(qc(spark, sf, "fulfilment_units"), qc(spark, sf, "order_items"),
                            qc(spark, sf, "store_staffing"))


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (f"(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) "
         f"* pow(sin(radians({lon2} - {lon1}) / 2), 2))")
    return f"(6371.0 * (2 * atan2(sqrt({a}), sqrt(1 - {a}))))"


@query("delivery_requests", section="LC-6", oracle=f"""
SELECT u.fulfilment_unit_id, u.order_id, u.store_id, 'REQUESTED' AS status,
       CASE WHEN s.latitude IS NOT NULL AND o.delivery_latitude IS NOT NULL
            THEN round({haversine_sql('s.latitude', 's.longitude', 'o.delivery_latitude', 'o.delivery_longitude')}, 4)
       END AS straight_km,
       (s.latitude IS NOT NULL AND o.delivery_latitude IS NOT NULL) AS request_ok
FROM qc_fulfilment_units u
LEFT JOIN qc_stores s ON s.store_id = u.store_id
LEFT JOIN qc_orders o ON o.order_id = u.order_id
WHERE u.status IS NULL OR u.status NOT IN ('CANCELLED', 'FAILED')
""")
def q_delivery_requests(spark, sf):
    return lc.delivery_requests(qc(spark, sf, "fulfilment_units"), qc(spark, sf, "stores"), qc(spark, sf, "orders"))


@query("failed_no_rider", section="LC-7", oracle="""
SELECT d.delivery_id, (SELECT count(*) FROM qc_rider_assignments a WHERE a.delivery_id = d.delivery_id) AS n_offers,
       d.status AS recorded_status, 'FAILED' AS implied_status, 'NO_RIDER_ACCEPTED' AS implied_reason
FROM qc_deliveries d
WHERE NOT EXISTS (SELECT 1 FROM qc_rider_assignments a WHERE a.delivery_id = d.delivery_id AND a.response = 'ACCEPTED')
""")
def q_failed_no_rider(spark, sf):
    return lc.failed_no_rider(qc(spark, sf, "deliveries"), qc(spark, sf, "rider_assignments"))


_REQ_VALUES = ", ".join([f"('DELIVERED', '{t}')" for t in lc.REQUIRED_DELIVERED]
                        + [f"('FAILED', '{t}')" for t in lc.REQUIRED_FAILED])
_MISSING_SQL = f"""
WITH req(status, t) AS (VALUES {_REQ_VALUES}),
m AS (
  SELECT d.delivery_id, d.status, r.t FROM qc_deliveries d JOIN req r ON r.status = d.status
  WHERE NOT EXISTS (SELECT 1 FROM qc_operational_events e WHERE e.delivery_id = d.delivery_id AND e.event_type = r.t))
"""


@query("missing_events", section="ST-2", oracle=_MISSING_SQL + "SELECT delivery_id, status, t AS missing_event_type FROM m")
def q_missing_events(spark, sf):
    return lc.missing_events(qc(spark, sf, "deliveries"), qc(spark, sf, "operational_events"))


@query("sorted_missing", section="SO-5", oracle=_MISSING_SQL + """
SELECT delivery_id, status, string_agg(t, ',' ORDER BY t) AS missing_types FROM m GROUP BY delivery_id, status
""")
def q_sorted_missing(spark, sf):
    m = lc.missing_event_types(qc(spark, sf, "deliveries"), qc(spark, sf, "operational_events"))
    return m.withColumn("missing_types", F.array_join("missing_types", ","))


_KINDS = ["order_id", "fulfilment_unit_id", "delivery_id", "store_id", "rider_id"]


@query("id_set", section="ST-5", oracle="\nUNION\n".join(
    f"SELECT '{k}' AS kind, {k} AS id FROM qc_operational_events WHERE {k} IS NOT NULL" for k in _KINDS))
def q_id_set(spark, sf):
    e = qc(spark, sf, "operational_events")
    unp = e.select(F.inline(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("id")) for k in _KINDS])))
    return unp.filter(F.col("id").isNotNull()).distinct()


# ---- projections and filters ------------------------------------------------------

_DELIVERY_COLS = [c for c in declared_columns("deliveries")]


@query("ordered_projection", section="PRJ-1", oracle=f"SELECT {', '.join(_DELIVERY_COLS)} FROM qc_deliveries")
def q_ordered_projection(spark, sf):
    return pj.ordered_projection(qc(spark, sf, "deliveries"), _DELIVERY_COLS)


_PATCH_COLS = ["status", "assigned_to_store_at", "picking_started_at", "picking_completed_at", "packing_started_at",
               "packing_completed_at"]


@query("state_patch", section="PRJ-2", oracle=f"""
WITH p AS ({_state_sql('unit')})
SELECT u.fulfilment_unit_id, u.order_id, u.store_id,
       {", ".join(f"coalesce(p.{c}, u.{c}) AS {c}" for c in _PATCH_COLS)},
       u.cancelled_at, u.cancellation_reason, u.failed_at, u.failure_reason, u.completed_at
FROM qc_fulfilment_units u LEFT JOIN p ON p.fulfilment_unit_id = u.fulfilment_unit_id
""")
def q_state_patch(spark, sf):
    patch = lc.state_from_events(qc(spark, sf, "operational_events"), "unit")
    return pj.state_patch(qc(spark, sf, "fulfilment_units"), patch, "fulfilment_unit_id", _PATCH_COLS)


@query("active_only", section="FLT-1", oracle="SELECT * FROM qc_stores WHERE status = 'ACTIVE'")
def q_active_only(spark, sf):
    return pj.active_only(qc(spark, sf, "stores"))


@query("open_fulfilments", section="FLT-2", oracle="""
SELECT fulfilment_unit_id, order_id, store_id, status FROM qc_fulfilment_units
WHERE status IS NULL OR status NOT IN ('CANCELLED', 'FAILED')
""")
def q_open_fulfilments(spark, sf):
    return pj.open_fulfilments(qc(spark, sf, "fulfilment_units")).select("fulfilment_unit_id", "order_id", "store_id",
                                                                         "status")


# Fields required (or forbidden) per delivery status (rules DL-04..12).
DELIVERY_REQUIRED = [
    ("DELIVERED", "required", ["rider_id", "rider_arrived_at_store", "picked_up_at", "delivery_started_at",
                               "delivered_at"]),
    ("FAILED", "required", ["failed_at", "failure_reason"]),
    ("CANCELLED", "required", ["cancelled_at", "cancellation_reason"]),
]


@query("required_when", section="FLT-3", oracle="\nUNION ALL\n".join(
    f"SELECT delivery_id, status, '{c}' AS \"column\", '{k}' AS rule FROM qc_deliveries "
    f"WHERE status = '{s}' AND {c} IS NULL" for s, k, cols in DELIVERY_REQUIRED for c in cols))
def q_required_when(spark, sf):
    return pj.required_when(qc(spark, sf, "deliveries"), "delivery_id", DELIVERY_REQUIRED)


@query("events_of_type", section="FLT-4", oracle="""
SELECT event_id, ts, user_id, event_type, value FROM events WHERE event_type IN ('purchase', 'signup')
""")
def q_events_of_type(spark, sf):
    e = raw(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return pj.events_of_type(e, ["purchase", "signup"])
