"""Aggregation queries bound to the derived tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggs
from ..sources.schemas import EVENT_TYPES
from .fixtures import qc
from .registry import query


@query("order_status_rollup", section="AG-2", oracle="""
WITH u AS (
  SELECT order_id, count(*) AS n,
         bool_and(coalesce(status = 'COMPLETED', false)) AS allc,
         bool_or(coalesce(status = 'CANCELLED', false)) AS anyc,
         bool_or(coalesce(status = 'FAILED', false)) AS anyf,
         min(fulfilment_unit_id) FILTER (WHERE status = 'CANCELLED') AS c_fid,
         min(fulfilment_unit_id) FILTER (WHERE status = 'FAILED') AS f_fid
  FROM qc_fulfilment_units GROUP BY order_id)
SELECT o.order_id,
       CASE WHEN u.n IS NULL THEN 'FAILED' WHEN u.allc THEN 'DELIVERED' WHEN u.anyc THEN 'CANCELLED'
            WHEN u.anyf THEN 'FAILED' ELSE 'FULFILLING' END AS status,
       CASE WHEN u.n IS NOT NULL AND NOT u.allc AND u.anyc THEN c.cancelled_at ELSE o.cancelled_at END AS cancelled_at,
       CASE WHEN u.n IS NOT NULL AND NOT u.allc AND u.anyc THEN c.cancellation_reason ELSE o.cancellation_reason END
         AS cancellation_reason,
       CASE WHEN u.n IS NULL THEN 'NO_FULFILMENT'
            WHEN NOT u.allc AND NOT u.anyc AND u.anyf THEN f.failure_reason ELSE o.failure_reason END AS failure_reason
FROM qc_orders o LEFT JOIN u ON o.order_id = u.order_id
LEFT JOIN qc_fulfilment_units c ON c.fulfilment_unit_id = u.c_fid AND c.order_id = u.order_id
LEFT JOIN qc_fulfilment_units f ON f.fulfilment_unit_id = u.f_fid AND f.order_id = u.order_id
""")
def q_order_status_rollup(spark, sf):
    return aggs.order_status_rollup(qc(spark, sf, "orders"), qc(spark, sf, "fulfilment_units"))


@query("first_terminal_reason", section="AG-3", oracle="""
WITH u AS (
  SELECT order_id,
         min(fulfilment_unit_id) FILTER (WHERE status = 'CANCELLED') AS c_fid,
         min(fulfilment_unit_id) FILTER (WHERE status = 'FAILED') AS f_fid
  FROM qc_fulfilment_units GROUP BY order_id
  HAVING count(*) FILTER (WHERE status IN ('CANCELLED', 'FAILED')) > 0)
SELECT u.order_id, u.c_fid AS first_cancelled_unit, c.cancelled_at, c.cancellation_reason,
       u.f_fid AS first_failed_unit, f.failure_reason
FROM u LEFT JOIN qc_fulfilment_units c ON c.fulfilment_unit_id = u.c_fid AND c.order_id IS NOT DISTINCT FROM u.order_id
LEFT JOIN qc_fulfilment_units f ON f.fulfilment_unit_id = u.f_fid AND f.order_id IS NOT DISTINCT FROM u.order_id
""")
def q_first_terminal_reason(spark, sf):
    return aggs.first_terminal_reason(qc(spark, sf, "fulfilment_units"))


@query("item_count", section="AG-1", oracle="""
SELECT fulfilment_unit_id, count(*) AS item_count, cast(sum(quantity) as bigint) AS total_quantity
FROM qc_order_items GROUP BY fulfilment_unit_id
""")
def q_item_count(spark, sf):
    return aggs.item_count(qc(spark, sf, "order_items"))


@query("all_in_status", section="ST-3", oracle="""
SELECT order_id, NOT EXISTS (SELECT 1 FROM qc_fulfilment_units v WHERE v.order_id = u.order_id
                             AND (v.status IS NULL OR v.status <> 'COMPLETED')) AS all_in_status,
       count(*) AS n_units
FROM qc_fulfilment_units u GROUP BY order_id
""")
def q_all_in_status(spark, sf):
    return aggs.all_in_status(qc(spark, sf, "fulfilment_units"))


@query("fulfilments_by_order", section="AG-6", oracle="""
SELECT order_id, fulfilment_unit_id,
       row_number() OVER (PARTITION BY order_id ORDER BY fulfilment_unit_id) AS position,
       count(*) OVER (PARTITION BY order_id) AS n_units
FROM qc_fulfilment_units
""")
def q_fulfilments_by_order(spark, sf):
    return aggs.fulfilments_by_order(qc(spark, sf, "fulfilment_units"))


@query("split_orders", section="AG-7", oracle="""
SELECT order_id, count(*) AS n_units, count(DISTINCT store_id) AS n_stores
FROM qc_fulfilment_units GROUP BY order_id HAVING count(*) > 1
""")
def q_split_orders(spark, sf):
    return aggs.split_orders(qc(spark, sf, "fulfilment_units"))


_KNOWN_TYPES = ", ".join(f"'{t}'" for t in EVENT_TYPES)


@query("event_types_by_delivery", section="AG-5", oracle=f"""
SELECT delivery_id,
       coalesce(string_agg(DISTINCT event_type, ',' ORDER BY event_type)
                  FILTER (WHERE event_type IN ({_KNOWN_TYPES})), '') AS event_types,
       count(*) AS n_events,
       count(DISTINCT event_type) FILTER (WHERE event_type NOT IN ({_KNOWN_TYPES})) AS n_unknown_types
FROM qc_operational_events WHERE delivery_id IS NOT NULL GROUP BY delivery_id
""")
def q_event_types_by_delivery(spark, sf):
    e = aggs.event_types_by_entity(qc(spark, sf, "operational_events"), "delivery_id")
    return e.withColumn("event_types", F.array_join("event_types", ","))
