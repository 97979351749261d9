"""Window, ordering and as-of queries bound to the derived tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggs, windows
from ..operators.ordered import asof_latest
from .fixtures import qc, raw
from .registry import query

STAGES = ["assigned_to_store_at", "picking_started_at", "picking_completed_at", "packing_started_at",
          "packing_completed_at", "completed_at"]


@query("rider_overlap", section="WN-1", oracle="""
WITH d AS (
  SELECT rider_id, delivery_id, delivery_started_at AS s, delivered_at AS e,
         lag(delivery_id) OVER w AS prev_id, lag(delivered_at) OVER w AS prev_end
  FROM qc_deliveries
  WHERE rider_id IS NOT NULL AND delivery_started_at IS NOT NULL AND delivered_at IS NOT NULL
  WINDOW w AS (PARTITION BY rider_id ORDER BY delivery_started_at, delivery_id))
SELECT rider_id, prev_id AS previous_id, delivery_id AS current_id, prev_end AS previous_end, s AS current_start
FROM d WHERE s < prev_end
""")
def q_rider_overlap(spark, sf):
    return windows.interval_overlaps(qc(spark, sf, "deliveries"), "rider_id", "delivery_started_at",
                                     "delivered_at", "delivery_id", mode="adjacent")


@query("rider_overlap_running_max", section="WN-1", oracle="""
WITH d AS (
  SELECT rider_id, delivery_id, delivery_started_at AS s,
         max(delivered_at) OVER (PARTITION BY rider_id ORDER BY delivery_started_at, delivery_id
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m
  FROM qc_deliveries
  WHERE rider_id IS NOT NULL AND delivery_started_at IS NOT NULL AND delivered_at IS NOT NULL)
SELECT rider_id, delivery_id AS current_id, m AS max_end_before, s AS current_start FROM d WHERE s < m
""")
def q_rider_overlap_running_max(spark, sf):
    return windows.interval_overlaps(qc(spark, sf, "deliveries"), "rider_id", "delivery_started_at",
                                     "delivered_at", "delivery_id", mode="running_max")


_STAGE_POS = " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(STAGES))


@query("timestamp_chain", section="WN-2", oracle=f"""
WITH u AS (
  UNPIVOT (SELECT fulfilment_unit_id, {', '.join(STAGES)} FROM qc_fulfilment_units)
  ON {', '.join(STAGES)} INTO NAME name VALUE value),
p AS (
  SELECT fulfilment_unit_id, name, value, CASE name {_STAGE_POS} END AS pos FROM u WHERE value IS NOT NULL),
l AS (
  SELECT fulfilment_unit_id, name, value,
         lag(name) OVER (PARTITION BY fulfilment_unit_id ORDER BY pos) AS prev_name,
         lag(value) OVER (PARTITION BY fulfilment_unit_id ORDER BY pos) AS prev_value
  FROM p)
SELECT fulfilment_unit_id, prev_name AS previous_column, prev_value AS previous_value, name AS "column", value
FROM l WHERE value < prev_value
""")
def q_timestamp_chain(spark, sf):
    return windows.timestamp_chain(qc(spark, sf, "fulfilment_units"), "fulfilment_unit_id", STAGES)


@query("duplicate_occurrence", section="WN-3", oracle="""
SELECT order_item_id, occurrence FROM (
  SELECT order_item_id, row_number() OVER (PARTITION BY order_item_id ORDER BY product_id) AS occurrence
  FROM qc_order_items WHERE order_item_id IS NOT NULL)
WHERE occurrence > 1
""")
def q_duplicate_occurrence(spark, sf):
    return windows.repeat_occurrences(qc(spark, sf, "order_items"), "order_item_id")


@query("duplicate_ids", section="AG-4", oracle="""
SELECT l_orderkey, l_linenumber, count(*) AS occurrences, count(*) - 1 AS repeats
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""")
def q_duplicate_ids(spark, sf):
    li = raw(spark, sf, "lineitem")
    return aggs.duplicate_keys(li, ["l_orderkey", "l_linenumber"])


@query("rider_available_at", section="WN-4", oracle="""
SELECT rider_id, delivery_id, delivery_started_at,
       max(delivered_at) OVER (PARTITION BY rider_id ORDER BY delivery_started_at, delivery_id
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS available_at
FROM qc_deliveries WHERE rider_id IS NOT NULL AND delivery_started_at IS NOT NULL
""")
def q_rider_available_at(spark, sf):
    d = qc(spark, sf, "deliveries").filter(F.col("rider_id").isNotNull() & F.col("delivery_started_at").isNotNull()) \
        .select("rider_id", "delivery_id", "delivery_started_at", "delivered_at")
    return windows.available_at(d, "rider_id", ["delivery_started_at", "delivery_id"], "delivered_at") \
        .drop("delivered_at")


@query("accepted_attempt", section="WN-5", oracle="""
WITH a AS (
  SELECT delivery_id, count(*) AS n_offers,
         min(assignment_id) FILTER (WHERE response = 'ACCEPTED') AS accepted_assignment_id
  FROM qc_rider_assignments GROUP BY delivery_id)
SELECT a.delivery_id, a.n_offers, a.accepted_assignment_id, r.rider_id AS accepted_rider_id,
       r.responded_at AS accepted_at,
       (SELECT count(*) FROM qc_rider_assignments x WHERE x.delivery_id = a.delivery_id
          AND x.assignment_id > a.accepted_assignment_id) AS offers_after_accept
FROM a LEFT JOIN qc_rider_assignments r ON r.assignment_id = a.accepted_assignment_id
""")
def q_accepted_attempt(spark, sf):
    return windows.accepted_attempt(qc(spark, sf, "rider_assignments"))


@query("pick_k_per_group", section="SO-2", oracle="""
SELECT fulfilment_unit_id, order_item_id, pick_no FROM (
  SELECT fulfilment_unit_id, order_item_id,
         row_number() OVER (PARTITION BY fulfilment_unit_id ORDER BY (order_item_id * 7919) % 10007, order_item_id)
           AS pick_no
  FROM qc_order_items)
WHERE pick_no <= 2
""")
def q_pick_k_per_group(spark, sf):
    items = qc(spark, sf, "order_items").select("fulfilment_unit_id", "order_item_id")
    return windows.pick_k_per_group(items, "fulfilment_unit_id", (F.col("order_item_id") * 7919) % 10007,
                                    "order_item_id", 2)


@query("latest_and_earliest_snapshot", section="SO-3", oracle="""
WITH r AS (
  SELECT s.*, row_number() OVER (PARTITION BY store_id ORDER BY recorded_at DESC, staffing_snapshot_id DESC) AS rl,
         row_number() OVER (PARTITION BY store_id ORDER BY recorded_at, staffing_snapshot_id) AS re,
         count(*) OVER (PARTITION BY store_id) AS n_rows
  FROM qc_store_staffing s WHERE recorded_at IS NOT NULL)
SELECT l.store_id, l.n_rows,
       l.staffing_snapshot_id AS latest_staffing_snapshot_id, l.recorded_at AS latest_recorded_at,
       l.pickers_available AS latest_pickers_available, l.packers_available AS latest_packers_available,
       e.staffing_snapshot_id AS earliest_staffing_snapshot_id, e.recorded_at AS earliest_recorded_at,
       e.pickers_available AS earliest_pickers_available, e.packers_available AS earliest_packers_available
FROM r l JOIN r e ON l.store_id = e.store_id AND l.rl = 1 AND e.re = 1
""")
def q_latest_and_earliest_snapshot(spark, sf):
    return windows.latest_and_earliest(qc(spark, sf, "store_staffing"), "store_id", "recorded_at",
                                       "staffing_snapshot_id", ["pickers_available", "packers_available"])


@query("intervals_by_start", section="SO-4", oracle="""
SELECT rider_id, delivery_started_at, delivered_at, delivery_id,
       row_number() OVER (PARTITION BY rider_id ORDER BY delivery_started_at, delivery_id) AS position
FROM qc_deliveries WHERE rider_id IS NOT NULL AND delivery_started_at IS NOT NULL
""")
def q_intervals_by_start(spark, sf):
    return windows.intervals_by_start(qc(spark, sf, "deliveries"), "rider_id", "delivery_started_at",
                                      "delivered_at", "delivery_id")


@query("event_timeline", section="SO-1", oracle="""
SELECT event_id, ts, user_id, event_type, row_number() OVER (ORDER BY ts, event_id) AS seq FROM events
""")
def q_event_timeline(spark, sf):
    e = raw(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")
    return windows.global_order(e, ["ts", "event_id"], out="seq")


@query("business_key", section="PRJ-3", oracle="""
SELECT event_id, event_type, occurred_at,
       printf('EVT-%07d', row_number() OVER (ORDER BY occurred_at, event_id)) AS business_key
FROM qc_operational_events
""")
def q_business_key(spark, sf):
    e = qc(spark, sf, "operational_events").select("event_id", "event_type", "occurred_at")
    s = windows.global_order(e, ["occurred_at", "event_id"], out="seq")
    return s.select("event_id", "event_type", "occurred_at",
                    F.format_string("EVT-%07d", F.col("seq")).alias("business_key"))


STAFF_FIELDS = ["pickers_scheduled", "pickers_available", "packers_scheduled", "packers_available"]


def staffing_at(spark, sf, time_col: str = "picking_started_at"):
    u = qc(spark, sf, "fulfilment_units").select("fulfilment_unit_id", "store_id", time_col)
    return asof_latest(u, qc(spark, sf, "store_staffing"), "store_id", time_col, "recorded_at",
                       "staffing_snapshot_id", ["recorded_at"] + STAFF_FIELDS)


ASOF_SQL = """
WITH m AS (
  SELECT u.fulfilment_unit_id, s.staffing_snapshot_id, s.recorded_at, {fields},
         row_number() OVER (PARTITION BY u.fulfilment_unit_id
                            ORDER BY s.recorded_at DESC, s.staffing_snapshot_id DESC) AS rn
  FROM qc_fulfilment_units u JOIN qc_store_staffing s
    ON s.store_id = u.store_id AND s.recorded_at <= u.{t}),
e AS (
  SELECT store_id, staffing_snapshot_id, recorded_at, {fields},
         row_number() OVER (PARTITION BY store_id ORDER BY recorded_at, staffing_snapshot_id) AS rn
  FROM qc_store_staffing WHERE recorded_at IS NOT NULL AND store_id IS NOT NULL),
asof_r AS (
  SELECT u.fulfilment_unit_id, u.store_id, u.{t},
         CASE WHEN m.staffing_snapshot_id IS NOT NULL THEN 'LATEST'
              WHEN u.{t} IS NOT NULL AND e.staffing_snapshot_id IS NOT NULL THEN 'EARLIEST' END AS asof_match,
         CASE WHEN m.staffing_snapshot_id IS NOT NULL THEN m.staffing_snapshot_id
              WHEN u.{t} IS NOT NULL THEN e.staffing_snapshot_id END AS staffing_snapshot_id,
         CASE WHEN m.staffing_snapshot_id IS NOT NULL THEN m.recorded_at
              WHEN u.{t} IS NOT NULL THEN e.recorded_at END AS recorded_at,
         {chosen}
  FROM qc_fulfilment_units u
  LEFT JOIN m ON m.fulfilment_unit_id = u.fulfilment_unit_id AND m.rn = 1
  LEFT JOIN e ON e.store_id = u.store_id AND e.rn = 1)
"""


def asof_sql(t: str = "picking_started_at") -> str:
    fields = ", ".join(f"s.{f}" for f in STAFF_FIELDS)
    efields = ", ".join(STAFF_FIELDS)
    chosen = ",\n         ".join(
        f"CASE WHEN m.staffing_snapshot_id IS NOT NULL THEN m.{f} WHEN u.{t} IS NOT NULL THEN e.{f} END AS {f}"
        for f in STAFF_FIELDS)
    return ASOF_SQL.format(fields=fields, t=t, chosen=chosen).replace("SELECT store_id, staffing_snapshot_id, "
                                                                      f"recorded_at, {fields}",
                                                                      f"SELECT store_id, staffing_snapshot_id, "
                                                                      f"recorded_at, {efields}")


@query("asof_staffing", section="JN-7", oracle=asof_sql() + "SELECT * FROM asof_r")
def q_asof_staffing(spark, sf):
    return staffing_at(spark, sf)
