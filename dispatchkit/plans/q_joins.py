"""Join queries bound to the derived tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import joins, windows
from ..operators.free_riders import free_riders, offers_outside_zone
from ..operators.store_pools import second_store_pools
from ..quality.keys import FOREIGN_KEYS
from ..sources.schemas import key_of
from .fixtures import qc
from .registry import query


def _fk_sql(optional: bool) -> str:
    parts = []
    for rule, child, col, parent, pk, opt in FOREIGN_KEYS:
        if opt != optional:
            continue
        cid = key_of(child)
        null_clause = f"c.{col} IS NOT NULL AND " if opt else ""
        parts.append(f"SELECT '{rule}' AS fk, c.{cid} AS child_id, c.{col} AS key_value FROM qc_{child} c "
                     f"WHERE {null_clause}NOT EXISTS (SELECT 1 FROM qc_{parent} p WHERE p.{pk} = c.{col})")
    return "\nUNION ALL\n".join(parts)


@query("fk_orphans", section="JN-1", oracle=_fk_sql(False))
def q_fk_orphans(spark, sf):
    """One anti join per parent table, however many keys refer to it."""
    specs = [sp for sp in FOREIGN_KEYS if not sp[5]]
    tables = {t: qc(spark, sf, t) for sp in specs for t in (sp[1], sp[3])}
    return joins.fk_orphans_all(tables, specs, key_of).select(
        F.col("rule_id").alias("fk"), F.col("child_id").cast("long").alias("child_id"), F.col("id").alias("key_value"))


@query("fk_orphans_optional", section="JN-2", oracle=_fk_sql(True))
def q_fk_orphans_optional(spark, sf):
    # deliveries.rider_id alone, plus the five event keys in one exchange
    d = qc(spark, sf, "deliveries")
    fk07 = joins.fk_orphans(d.select("delivery_id", "rider_id"), qc(spark, sf, "riders"), "rider_id", optional=True)
    out = fk07.select(F.lit("FK-07").alias("fk"), F.col("delivery_id").alias("child_id"),
                      F.col("rider_id").alias("key_value"))
    ev = qc(spark, sf, "operational_events")
    keys = {col: qc(spark, sf, parent).select(pk) for rule, child, col, parent, pk, opt in FOREIGN_KEYS
            if child == "operational_events"}
    rules = {col: rule for rule, child, col, parent, pk, opt in FOREIGN_KEYS if child == "operational_events"}
    multi = joins.fk_orphans_multi(ev, "event_id", keys)
    rule_col = None
    for col, rule in rules.items():
        rule_col = F.when(F.col("kind") == col, rule) if rule_col is None else rule_col.when(F.col("kind") == col, rule)
    return out.unionByName(multi.select(rule_col.alias("fk"), "child_id", F.col("id").alias("key_value")))


@query("lookup_last_wins", section="JN-3", oracle="""
SELECT d.delivery_id, d.fulfilment_unit_id, i.order_item_id AS last_item_id, i.product_id AS last_product_id,
       i.quantity AS last_quantity
FROM qc_deliveries d
JOIN (SELECT *, row_number() OVER (PARTITION BY fulfilment_unit_id
                                   ORDER BY order_item_id DESC, product_id DESC, quantity DESC) AS rn
      FROM qc_order_items) i
  ON i.fulfilment_unit_id = d.fulfilment_unit_id AND i.rn = 1
""")
def q_lookup_last_wins(spark, sf):
    d = qc(spark, sf, "deliveries").select("delivery_id", "fulfilment_unit_id")
    items = qc(spark, sf, "order_items").select("fulfilment_unit_id", "order_item_id", "product_id", "quantity")
    r = joins.lookup_last_wins(d, items, "fulfilment_unit_id", ["order_item_id", "product_id", "quantity"],
                               ["order_item_id", "product_id", "quantity"], prefix="p_")
    return r.select("delivery_id", "fulfilment_unit_id", F.col("p_order_item_id").alias("last_item_id"),
                    F.col("p_product_id").alias("last_product_id"), F.col("p_quantity").alias("last_quantity"))


@query("lookup_strict", section="JN-4", oracle="""
SELECT d.delivery_id, d.fulfilment_unit_id, u.store_id, u.fulfilment_unit_id IS NOT NULL AS lookup_found
FROM qc_deliveries d LEFT JOIN qc_fulfilment_units u ON u.fulfilment_unit_id = d.fulfilment_unit_id
""")
def q_lookup_strict(spark, sf):
    d = qc(spark, sf, "deliveries").select("delivery_id", "fulfilment_unit_id")
    return joins.lookup_strict(d, qc(spark, sf, "fulfilment_units"), "fulfilment_unit_id", ["store_id"])


@query("exactly_one_match", section="JN-9", oracle="""
SELECT a.assignment_id, a.delivery_id, a.rider_id,
       (SELECT count(*) FROM qc_operational_events e WHERE e.event_type = 'RIDER_ASSIGNED'
          AND e.delivery_id IS NOT DISTINCT FROM a.delivery_id AND e.rider_id IS NOT DISTINCT FROM a.rider_id)
         AS n_matches
FROM qc_rider_assignments a WHERE a.response = 'ACCEPTED' AND n_matches <> 1
""")
def q_exactly_one_match(spark, sf):
    acc = qc(spark, sf, "rider_assignments").filter(F.col("response") == "ACCEPTED")
    ev = qc(spark, sf, "operational_events").filter(F.col("event_type") == "RIDER_ASSIGNED")
    return joins.exactly_one_match(acc, ev, ["delivery_id", "rider_id"], "assignment_id")


@query("accepted_rider_check", section="JN-10", oracle="""
SELECT d.delivery_id, d.rider_id FROM qc_deliveries d
WHERE d.rider_id IS NOT NULL
  AND EXISTS (SELECT 1 FROM qc_fulfilment_units u WHERE u.fulfilment_unit_id = d.fulfilment_unit_id)
  AND NOT EXISTS (SELECT 1 FROM qc_rider_assignments a WHERE a.response = 'ACCEPTED'
                  AND a.delivery_id = d.delivery_id AND a.rider_id = d.rider_id)
""")
def q_accepted_rider_check(spark, sf):
    # SM-04 is only checked for deliveries whose unit exists
    units = qc(spark, sf, "fulfilment_units").select("fulfilment_unit_id").distinct()
    d = qc(spark, sf, "deliveries").join(units, "fulfilment_unit_id", "left_semi")
    return joins.accepted_rider_check(d, qc(spark, sf, "rider_assignments")).select("delivery_id", "rider_id")


@query("ownership_mismatch", section="JN-12", oracle="""
SELECT i.order_item_id, i.fulfilment_unit_id, i.order_id, u.order_id AS unit_order_id
FROM qc_order_items i JOIN qc_fulfilment_units u ON u.fulfilment_unit_id = i.fulfilment_unit_id
WHERE i.order_id IS DISTINCT FROM u.order_id
""")
def q_ownership_mismatch(spark, sf):
    return joins.ownership_mismatch(qc(spark, sf, "order_items"), qc(spark, sf, "fulfilment_units"))


@query("state_mismatch", section="JN-13", oracle="""
SELECT d.delivery_id, d.fulfilment_unit_id, d.status,
       CASE d.status WHEN 'DELIVERED' THEN 'COMPLETED' ELSE d.status END AS expected_unit_status,
       u.status AS unit_status
FROM qc_deliveries d JOIN qc_fulfilment_units u ON u.fulfilment_unit_id = d.fulfilment_unit_id
WHERE (d.status = 'DELIVERED' AND u.status IS DISTINCT FROM 'COMPLETED')
   OR (d.status = 'CANCELLED' AND u.status IS DISTINCT FROM 'CANCELLED')
   OR (d.status = 'FAILED' AND u.status IS DISTINCT FROM 'FAILED')
""")
def q_state_mismatch(spark, sf):
    return joins.state_mismatch(qc(spark, sf, "deliveries"), qc(spark, sf, "fulfilment_units"))


@query("coverage_gap", section="JN-14", oracle="""
SELECT 'unit_without_items' AS gap, u.fulfilment_unit_id AS parent_id FROM qc_fulfilment_units u
WHERE NOT EXISTS (SELECT 1 FROM qc_order_items i WHERE i.fulfilment_unit_id = u.fulfilment_unit_id)
UNION ALL
SELECT 'order_without_units', o.order_id FROM qc_orders o
WHERE NOT EXISTS (SELECT 1 FROM qc_fulfilment_units u WHERE u.order_id = o.order_id)
""")
def q_coverage_gap(spark, sf):
    u = qc(spark, sf, "fulfilment_units")
    a = joins.coverage_gap(u.select("fulfilment_unit_id"), qc(spark, sf, "order_items"), "fulfilment_unit_id")
    b = joins.coverage_gap(qc(spark, sf, "orders").select("order_id"), u, "order_id")
    return a.select(F.lit("unit_without_items").alias("gap"), F.col("fulfilment_unit_id").alias("parent_id")) \
        .unionByName(b.select(F.lit("order_without_units").alias("gap"), F.col("order_id").alias("parent_id")))


@query("zone_of_point", section="JN-15", oracle="""
WITH m AS (
  SELECT c.customer_id, z.zone_id, (c.latitude - z.center_lat)^2 + (c.longitude - z.center_lon)^2 AS d
  FROM qc_customers c JOIN qc_zones z
    ON c.latitude BETWEEN z.center_lat - z.spread AND z.center_lat + z.spread
   AND c.longitude BETWEEN z.center_lon - z.spread AND z.center_lon + z.spread)
SELECT c.customer_id, c.zone_id AS registered_zone,
       (SELECT m.zone_id FROM m WHERE m.customer_id = c.customer_id ORDER BY m.d, m.zone_id LIMIT 1) AS zone_of_point,
       (SELECT count(*) FROM m WHERE m.customer_id = c.customer_id) AS n_zone_boxes
FROM qc_customers c
""")
def q_zone_of_point(spark, sf):
    c = qc(spark, sf, "customers").select("customer_id", F.col("zone_id").alias("registered_zone"),
                                           "latitude", "longitude")
    return joins.zone_of_point(c, "latitude", "longitude").drop("latitude", "longitude")


@query("alternate_address", section="JN-16", oracle="""
SELECT o.order_id, o.customer_id, o.delivery_zone, c.zone_id AS customer_zone
FROM qc_orders o JOIN qc_customers c ON c.customer_id = o.customer_id
WHERE o.delivery_zone IS DISTINCT FROM c.zone_id
""")
def q_alternate_address(spark, sf):
    return joins.alternate_address(qc(spark, sf, "orders"), qc(spark, sf, "customers"))


GRID_START = "1995-07-01 00:00:00"


@query("store_hour_grid", section="JN-11", oracle=f"""
SELECT s.store_id, timestamp '{GRID_START}' + interval '1' hour * g.h AS recorded_at
FROM qc_stores s, range(0, 24) AS g(h)
""")
def q_store_hour_grid(spark, sf):
    return joins.store_hour_grid(qc(spark, sf, "stores").select("store_id"), GRID_START, 24)


# ---- candidate picks -------------------------------------------------------------

def _active_store_index(spark, sf):
    st = qc(spark, sf, "stores").filter(F.col("status") == "ACTIVE").select("store_id", "zone")
    zoned = joins.indexed_candidates(st, "zone", "store_id")
    everywhere = joins.indexed_candidates(st.withColumn("zone", F.lit("*")), "zone", "store_id")
    return zoned, everywhere


def store_choice(spark, sf):
    """JN-5: one store per order among the active stores of its zone, or among all
    active stores when its zone has none. Returns order_id, store_id, cand_zone."""
    zoned, everywhere = _active_store_index(spark, sf)
    o = qc(spark, sf, "orders").select("order_id", "delivery_zone")
    zones_with = zoned.select(F.col("zone").alias("_z")).distinct()
    o = o.join(zones_with, o.delivery_zone == zones_with._z, "left") \
        .withColumn("cand_zone", F.when(F.col("_z").isNotNull(), F.col("delivery_zone")).otherwise(F.lit("*"))) \
        .drop("_z")
    allc = zoned.unionByName(everywhere)
    return joins.pick_from_groups(o, "order_id", "cand_zone", allc, "zone", k=1, seed=17)


_STORE_IDX_SQL = """
act AS (SELECT store_id, zone FROM qc_stores WHERE status = 'ACTIVE'),
idx AS (
  SELECT zone, store_id, row_number() OVER (PARTITION BY zone ORDER BY store_id % 64, store_id) - 1 AS ci,
         count(*) OVER (PARTITION BY zone) AS n FROM act
  UNION ALL
  SELECT '*', store_id, row_number() OVER (ORDER BY store_id % 64, store_id) - 1, count(*) OVER () FROM act),
req AS (
  SELECT o.order_id, o.delivery_zone,
         CASE WHEN EXISTS (SELECT 1 FROM act WHERE act.zone = o.delivery_zone) THEN o.delivery_zone ELSE '*' END
           AS cand_zone
  FROM qc_orders o),
sz AS (SELECT zone, max(n) AS n FROM idx GROUP BY zone)"""


@query("store_candidates", section="JN-5", oracle=f"""
WITH {_STORE_IDX_SQL}
SELECT r.order_id, r.delivery_zone, r.cand_zone, 1 AS pick_no, i.store_id
FROM req r JOIN sz ON sz.zone = r.cand_zone
JOIN idx i ON i.zone = r.cand_zone AND i.ci = (((r.order_id % 2147483647) * 48271 + 17) % 2147483647) % sz.n
""")
def q_store_candidates(spark, sf):
    return store_choice(spark, sf).select("order_id", "delivery_zone", "cand_zone", "pick_no", "store_id")


@query("split_store_candidates", section="JN-6", oracle="""
SELECT u.fulfilment_unit_id, u.order_id, u.store_id, o.delivery_zone,
       (SELECT count(*) FROM qc_stores s WHERE s.status = 'ACTIVE' AND s.zone = o.delivery_zone AND s.store_id <> u.store_id)
         AS n_alternatives
FROM qc_fulfilment_units u JOIN qc_orders o ON o.order_id = u.order_id
WHERE u.store_id IS NOT NULL
""")
def q_split_store_candidates(spark, sf):
    """JN-6: how many other active stores of the order's zone each unit's store has."""
    return second_store_pools(qc(spark, sf, "fulfilment_units"), qc(spark, sf, "orders"), qc(spark, sf, "stores"))


# ---- JN-8: rider candidates -------------------------------------------------------

def _delivery_zones(spark, sf):
    """Zone of the store that serves each delivery (NULL where the unit or the store is unknown)."""
    d = joins.last_rows(qc(spark, sf, "deliveries"), "delivery_id", joins.LAST_ORDER["deliveries"], ["fulfilment_unit_id"])
    u = joins.last_rows(qc(spark, sf, "fulfilment_units"), "fulfilment_unit_id", joins.LAST_ORDER["fulfilment_units"], ["store_id"])
    s = joins.last_rows(qc(spark, sf, "stores"), "store_id", joins.LAST_ORDER["stores"], ["zone"])
    return d.join(u, "fulfilment_unit_id", "left").join(s, "store_id", "left").select("delivery_id", "zone")


_DELIVERY_ZONE_SQL = """
dz AS (
  SELECT d.delivery_id, any_value(s.zone) AS zone
  FROM qc_deliveries d LEFT JOIN qc_fulfilment_units u ON u.fulfilment_unit_id = d.fulfilment_unit_id
  LEFT JOIN qc_stores s ON s.store_id = u.store_id
  GROUP BY d.delivery_id),
act AS (SELECT rider_id, home_zone FROM qc_riders WHERE status = 'ACTIVE'),
busy AS (
  SELECT a.rider_id, a.home_zone, d.delivery_started_at AS s, d.delivered_at AS e,
         unnest(generate_series(date_trunc('hour', d.delivery_started_at), d.delivered_at, INTERVAL 1 HOUR)) AS h
  FROM qc_deliveries d JOIN act a ON a.rider_id = d.rider_id WHERE d.delivered_at > d.delivery_started_at)"""


@query("rider_candidates", section="JN-8", oracle=f"""
WITH {_DELIVERY_ZONE_SQL},
req AS (
  SELECT dz.delivery_id, dz.zone, (SELECT min(a.offered_at) FROM qc_rider_assignments a WHERE a.delivery_id = dz.delivery_id) AS offered_at
  FROM dz),
taken AS (
  SELECT q.delivery_id, count(DISTINCT b.rider_id) FILTER (WHERE b.home_zone = q.zone) AS bz, count(DISTINCT b.rider_id) AS ba
  FROM req q LEFT JOIN busy b ON b.h = date_trunc('hour', q.offered_at) AND b.s <= q.offered_at AND b.e > q.offered_at
  GROUP BY q.delivery_id),
cnt AS (
  SELECT q.*, (SELECT count(*) FROM act WHERE act.home_zone = q.zone) - t.bz AS nz, (SELECT count(*) FROM act) - t.ba AS na
  FROM req q JOIN taken t ON t.delivery_id = q.delivery_id)
SELECT delivery_id, zone, offered_at, CASE WHEN offered_at IS NOT NULL THEN nz END AS n_zone,
       CASE WHEN offered_at IS NULL THEN NULL WHEN nz > 0 THEN zone WHEN na > 0 THEN '*' END AS cand_zone,
       CASE WHEN offered_at IS NULL THEN NULL WHEN nz > 0 THEN nz ELSE na END AS n_candidates
FROM cnt
""")
def q_rider_candidates(spark, sf):
    """JN-8: the candidate pool of every delivery at its first offer: free active riders of the store's
    zone, if there are none, free riders of any zone. Every delivery has a row, also one without an offer
    (NULL) or without a free rider (0)."""
    first = qc(spark, sf, "rider_assignments").groupBy("delivery_id").agg(F.min("offered_at").alias("offered_at"))
    requests = _delivery_zones(spark, sf).join(first, "delivery_id", "left")
    return free_riders(requests, qc(spark, sf, "riders"), qc(spark, sf, "deliveries"))


@query("offers_outside_zone", section="JN-8", oracle=f"""
WITH {_DELIVERY_ZONE_SQL},
asked AS (
  SELECT a.assignment_id, a.delivery_id, a.rider_id, r.home_zone, dz.zone, a.offered_at
  FROM qc_rider_assignments a JOIN act r ON r.rider_id = a.rider_id JOIN dz ON dz.delivery_id = a.delivery_id
  WHERE r.home_zone IS DISTINCT FROM dz.zone),
cnt AS (
  SELECT q.*, (SELECT count(*) FROM act WHERE act.home_zone = q.zone) - t.bz AS n_zone
  FROM asked q JOIN (
    SELECT q.assignment_id, count(DISTINCT b.rider_id) AS bz
    FROM asked q LEFT JOIN busy b ON b.home_zone = q.zone AND b.h = date_trunc('hour', q.offered_at)
      AND b.s <= q.offered_at AND b.e > q.offered_at
    GROUP BY q.assignment_id) t ON t.assignment_id = q.assignment_id)
SELECT assignment_id, delivery_id, rider_id, home_zone, zone, offered_at, n_zone FROM cnt WHERE n_zone > 0
""")
def q_offers_outside_zone(spark, sf):
    """Recorded offers to riders of another zone although a rider of the store's zone was free."""
    return offers_outside_zone(qc(spark, sf, "rider_assignments"), qc(spark, sf, "riders"), qc(spark, sf, "deliveries"),
                               _delivery_zones(spark, sf))


@query("units_outside_store_candidates", section="JN-5", oracle="""
WITH act AS (SELECT DISTINCT zone FROM qc_stores WHERE status = 'ACTIVE' AND zone IS NOT NULL)
SELECT u.fulfilment_unit_id, u.order_id, u.store_id, o.delivery_zone, s.zone AS store_zone,
       CASE WHEN s.store_id IS NULL THEN 'UNKNOWN_STORE' WHEN s.status IS DISTINCT FROM 'ACTIVE' THEN 'INACTIVE_STORE'
            ELSE 'OTHER_ZONE' END AS reason
FROM qc_fulfilment_units u JOIN qc_orders o ON o.order_id = u.order_id
LEFT JOIN qc_stores s ON s.store_id = u.store_id
WHERE u.store_id IS NOT NULL AND (s.store_id IS NULL OR s.status IS DISTINCT FROM 'ACTIVE'
   OR (s.zone IS DISTINCT FROM o.delivery_zone AND EXISTS (SELECT 1 FROM act WHERE act.zone = o.delivery_zone)))
""")
def q_units_outside_store_candidates(spark, sf):
    """Units whose recorded store was no candidate of their order (unknown, inactive, or of another zone
    although the order's zone has an active store)."""
    return joins.units_outside_store_candidates(qc(spark, sf, "fulfilment_units"), qc(spark, sf, "orders"), qc(spark, sf, "stores"))


@query("offers_outside_candidates", section="JN-8", oracle="""
SELECT a.assignment_id, a.delivery_id, a.rider_id, a.offered_at,
       CASE WHEN r.rider_id IS NULL THEN 'UNKNOWN_RIDER' WHEN r.status IS DISTINCT FROM 'ACTIVE' THEN 'INACTIVE_RIDER'
            ELSE 'BUSY' END AS reason
FROM qc_rider_assignments a LEFT JOIN qc_riders r ON r.rider_id = a.rider_id
WHERE r.rider_id IS NULL OR r.status IS DISTINCT FROM 'ACTIVE'
   OR (SELECT max(d.delivered_at) FROM qc_deliveries d
       WHERE d.rider_id = a.rider_id AND d.delivery_started_at <= a.offered_at) > a.offered_at
""")
def q_offers_outside_candidates(spark, sf):
    """Recorded offers to riders outside the candidate set (unknown, inactive or mid-delivery)."""
    return windows.offers_outside_candidates(qc(spark, sf, "rider_assignments"), qc(spark, sf, "deliveries"),
                                             qc(spark, sf, "riders"))
