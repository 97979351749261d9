"""Scalar-function queries over the derived tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geo, staffing as stf, timestamps as tsf
from ..functions.numeric import parse_float
from ..sources.zones import zone_dim
from .fixtures import qc, raw
from .registry import query
from .q_lifecycle import _MULT_SQL, _band_sql, haversine_sql


def _event_text(kinds: dict[int, object]):
    """Text rendering of raw event times in several forms, chosen by event_id % 4."""
    k = F.col("event_id") % 4
    out = None
    for i, expr in kinds.items():
        out = F.when(k == i, expr) if out is None else out.when(k == i, expr)
    return out


@query("parse_ts", section="SC-1", oracle="""
SELECT event_id,
       CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') WHEN 1 THEN strftime(ts, '%d-%m-%Y %H:%M')
            WHEN 2 THEN strftime(ts, '%Y-%m-%d  %H:%M:%S') ELSE 'x' || strftime(ts, '%Y-%m-%d %H:%M:%S') END AS ts_text,
       CASE event_id % 4 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('minute', ts)
            WHEN 2 THEN date_trunc('second', ts) END AS parsed
FROM events
""")
def q_parse_ts(spark, sf):
    e = raw(spark, sf, "events").select("event_id", "ts")
    text = _event_text({0: F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), 1: F.date_format("ts", "dd-MM-yyyy HH:mm"),
                        2: F.date_format("ts", "yyyy-MM-dd  HH:mm:ss"),
                        3: F.concat(F.lit("x"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))})
    return e.select("event_id", text.alias("ts_text")).withColumn("parsed", tsf.parse_ts("ts_text"))


@query("parse_ts_optional", section="SC-2", oracle="""
SELECT event_id,
       CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') WHEN 1 THEN strftime(ts, '%-d-%-m-%Y %-H:%-M')
            WHEN 2 THEN '' ELSE 'bad' END AS ts_text,
       CASE event_id % 4 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('minute', ts) END AS parsed,
       (event_id % 4 = 3) AS unparseable
FROM events
""")
def q_parse_ts_optional(spark, sf):
    e = raw(spark, sf, "events").select("event_id", "ts")
    text = _event_text({0: F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), 1: F.date_format("ts", "d-M-yyyy H:m"),
                        2: F.lit(""), 3: F.lit("bad")})
    d = e.select("event_id", text.alias("ts_text"))
    return d.select("event_id", "ts_text", tsf.parse_ts_optional("ts_text").alias("parsed"),
                    tsf.unparseable("ts_text").alias("unparseable"))


@query("format_ts", section="SC-3", oracle="""
SELECT fulfilment_unit_id, strftime(picking_started_at, '%Y-%m-%d %H:%M:%S') AS picking_started_text
FROM qc_fulfilment_units
""")
def q_format_ts(spark, sf):
    u = qc(spark, sf, "fulfilment_units")
    return u.select("fulfilment_unit_id", tsf.format_ts("picking_started_at").alias("picking_started_text"))


@query("parse_float", section="SC-4", oracle="""
SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS parsed_value,
       event_id % 7 <> 0 AS is_number
FROM events
""")
def q_parse_float(spark, sf):
    e = raw(spark, sf, "events").select("event_id", "value")
    text = F.when(F.col("event_id") % 7 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string"))
    p = parse_float(text)
    return e.select("event_id", p.alias("parsed_value"), p.isNotNull().alias("is_number"))


@query("haversine_km", section="SC-5", oracle=f"""
SELECT c.customer_id, round({haversine_sql('c.latitude', 'c.longitude', 'z.center_lat', 'z.center_lon')}, 4) AS km_to_centre
FROM qc_customers c JOIN qc_zones z ON z.zone_id = c.zone_id
""")
def q_haversine_km(spark, sf):
    c = qc(spark, sf, "customers").join(zone_dim(spark), "zone_id")
    return c.select("customer_id", F.round(geo.haversine_km("latitude", "longitude", "center_lat", "center_lon"), 4)
                    .alias("km_to_centre"))


@query("route_km", section="SC-6", oracle=f"""
WITH j AS (
  SELECT d.delivery_id, d.delivery_distance,
         {haversine_sql('s.latitude', 's.longitude', 'o.delivery_latitude', 'o.delivery_longitude')} AS km,
         cast(1.15 as double) + cast(d.delivery_id % 26 as double) / 100 AS factor
  FROM qc_deliveries d JOIN qc_fulfilment_units u ON u.fulfilment_unit_id = d.fulfilment_unit_id
  JOIN qc_stores s ON s.store_id = u.store_id JOIN qc_orders o ON o.order_id = u.order_id)
SELECT delivery_id, round(km, 4) AS straight_km, round(km * factor, 2) AS route_km,
       (delivery_distance >= round(km * cast(1.15 as double), 2)
        AND delivery_distance <= round(km * cast(1.4 as double), 2)) AS distance_plausible
FROM j
""")
def q_route_km(spark, sf):
    d = qc(spark, sf, "deliveries").select("delivery_id", "fulfilment_unit_id", "delivery_distance")
    u = qc(spark, sf, "fulfilment_units").select("fulfilment_unit_id", "store_id", "order_id")
    s = qc(spark, sf, "stores").select("store_id", "latitude", "longitude")
    o = qc(spark, sf, "orders").select("order_id", "delivery_latitude", "delivery_longitude")
    j = d.join(u, "fulfilment_unit_id").join(s, "store_id").join(o, "order_id")
    km = geo.haversine_km("latitude", "longitude", "delivery_latitude", "delivery_longitude")
    factor = F.lit(1.15) + (F.col("delivery_id") % 26).cast("double") / 100
    return j.select("delivery_id", F.round(km, 4).alias("straight_km"), geo.route_km(km, factor).alias("route_km"),
                    geo.route_plausible("delivery_distance", km).alias("distance_plausible"))


@query("round_half_even", section="SC-7", oracle="""
SELECT store_id, round_even(cast(baseline_capacity as double) / 35, 0) AS per_35,
       round_even(cast(baseline_capacity as double) / 60, 0) AS per_60,
       round_even(cast(baseline_capacity as double) / 20, 0) AS per_20
FROM qc_stores
""")
def q_round_half_even(spark, sf):
    cap = F.col("baseline_capacity").cast("double")
    return qc(spark, sf, "stores").select("store_id", stf.round_half_even(cap / 35).alias("per_35"),
                                          stf.round_half_even(cap / 60).alias("per_60"),
                                          stf.round_half_even(cap / 20).alias("per_20"))


@query("clamp", section="SC-8", oracle="""
SELECT staffing_snapshot_id, least(greatest(pickers_available - 2, 0), pickers_scheduled - 1) AS clamped
FROM qc_store_staffing
""")
def q_clamp(spark, sf):
    s = qc(spark, sf, "store_staffing")
    return s.select("staffing_snapshot_id",
                    stf.clamp(F.col("pickers_available") - 2, F.lit(0), F.col("pickers_scheduled") - 1).alias("clamped"))


@query("add_seconds", section="SC-9", oracle="""
SELECT fulfilment_unit_id, picking_started_at + interval '1' second * (fulfilment_unit_id % 600) AS shifted_at
FROM qc_fulfilment_units
""")
def q_add_seconds(spark, sf):
    u = qc(spark, sf, "fulfilment_units")
    return u.select("fulfilment_unit_id",
                    tsf.add_seconds("picking_started_at", F.col("fulfilment_unit_id") % 600).alias("shifted_at"))


@query("not_before", section="SC-10", oracle="""
SELECT u.fulfilment_unit_id,
       CASE WHEN u.assigned_to_store_at IS NULL OR o.payment_success_at IS NULL THEN NULL
            ELSE greatest(u.assigned_to_store_at, o.payment_success_at + interval 30 second) END AS earliest_assign_at
FROM qc_fulfilment_units u JOIN qc_orders o ON o.order_id = u.order_id
""")
def q_not_before(spark, sf):
    u = qc(spark, sf, "fulfilment_units").select("fulfilment_unit_id", "order_id", "assigned_to_store_at")
    o = qc(spark, sf, "orders").select("order_id", "payment_success_at")
    j = u.join(o, "order_id")
    return j.select("fulfilment_unit_id",
                    tsf.not_before("assigned_to_store_at", "payment_success_at", 30).alias("earliest_assign_at"))


@query("pack_seconds", section="SC-12", oracle=f"""
SELECT staffing_snapshot_id,
       cast(trunc(cast(60 as double) * {_band_sql('packers_available', 'packers_scheduled', 1.3, 1.15)}) as bigint)
         AS min_pack_s,
       cast(trunc(cast(150 as double) * {_band_sql('packers_available', 'packers_scheduled', 1.3, 1.15)}) as bigint)
         AS max_pack_s
FROM qc_store_staffing
""")
def q_pack_seconds(spark, sf):
    s = qc(spark, sf, "store_staffing")
    return s.select("staffing_snapshot_id", stf.pack_seconds("packers_available", "packers_scheduled", 60).alias("min_pack_s"),
                    stf.pack_seconds("packers_available", "packers_scheduled", 150).alias("max_pack_s"))


@query("transit_bounds", section="SC-13", oracle="""
WITH b AS (
  SELECT delivery_id,
         3.0 + CASE traffic_condition WHEN 'HIGH' THEN 2.0 WHEN 'SEVERE' THEN 5.0 ELSE 0.0 END
             + CASE weather_condition WHEN 'RAIN' THEN 1.0 ELSE 0.0 END AS lo,
         9.0 + CASE traffic_condition WHEN 'HIGH' THEN 5.0 WHEN 'SEVERE' THEN 10.0 ELSE 0.0 END
             + CASE weather_condition WHEN 'RAIN' THEN 4.0 ELSE 0.0 END AS hi,
         date_diff('second', delivery_started_at, delivered_at) AS secs
  FROM qc_deliveries)
SELECT delivery_id, cast(lo as double) AS min_transit_min, cast(hi as double) AS max_transit_min,
       round(cast(secs as double) / 60, 2) AS transit_min,
       (cast(secs as double) / 60 < lo OR cast(secs as double) / 60 > hi) AS outside_bounds
FROM b
""")
def q_transit_bounds(spark, sf):
    d = qc(spark, sf, "deliveries")
    lo, hi = stf.transit_bounds("traffic_condition", "weather_condition")
    mins = tsf.seconds_between("delivery_started_at", "delivered_at").cast("double") / 60
    return d.select("delivery_id", lo.alias("min_transit_min"), hi.alias("max_transit_min"),
                    F.round(mins, 2).alias("transit_min"), ((mins < lo) | (mins > hi)).alias("outside_bounds"))


@query("scheduled_staff", section="SC-14", oracle=f"""
WITH j AS (SELECT s.staffing_snapshot_id, s.recorded_at AS t, st.baseline_capacity, s.pickers_scheduled, s.packers_scheduled
           FROM qc_store_staffing s JOIN qc_stores st ON st.store_id = s.store_id),
m AS (SELECT *, {_MULT_SQL} AS mult FROM j)
SELECT staffing_snapshot_id,
       cast(greatest(1.0, round_even(greatest(2.0, round_even(cast(baseline_capacity as double) / 35, 0)) * mult, 0))
            as integer) AS planned_pickers,
       cast(greatest(1.0, round_even(greatest(1.0, round_even(cast(baseline_capacity as double) / 60, 0)) * mult, 0))
            as integer) AS planned_packers,
       pickers_scheduled AS recorded_pickers, packers_scheduled AS recorded_packers
FROM m
""")
def q_scheduled_staff(spark, sf):
    s = qc(spark, sf, "store_staffing").join(qc(spark, sf, "stores").select("store_id", "baseline_capacity"), "store_id")
    p, k = stf.scheduled_staff("baseline_capacity", "recorded_at")
    return s.select("staffing_snapshot_id", p.alias("planned_pickers"), k.alias("planned_packers"),
                    F.col("pickers_scheduled").alias("recorded_pickers"), F.col("packers_scheduled").alias("recorded_packers"))


@query("hour_of", section="SC-15", oracle="""
SELECT cast(hour(created_at) as integer) AS hour, count(*) AS n_orders FROM qc_orders GROUP BY hour(created_at)
""")
def q_hour_of(spark, sf):
    return qc(spark, sf, "orders").groupBy(tsf.hour_of("created_at").alias("hour")).agg(
        F.count(F.lit(1)).alias("n_orders"))


@query("round_coord", section="SC-16", oracle="""
SELECT customer_id, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude FROM qc_customers
""")
def q_round_coord(spark, sf):
    c = qc(spark, sf, "customers")
    return c.select("customer_id", geo.round_coord("latitude").alias("latitude"),
                    geo.round_coord("longitude").alias("longitude"))


@query("staffing_ratio", section="SC-17", oracle="""
SELECT staffing_snapshot_id,
       round(CASE WHEN pickers_scheduled = 0 THEN NULL ELSE cast(pickers_available as double) / pickers_scheduled END, 4)
         AS picker_ratio,
       round(CASE WHEN packers_scheduled = 0 THEN NULL ELSE cast(packers_available as double) / packers_scheduled END, 4)
         AS packer_ratio
FROM qc_store_staffing
""")
def q_staffing_ratio(spark, sf):
    s = qc(spark, sf, "store_staffing")
    return s.select("staffing_snapshot_id",
                    F.round(stf.staffing_ratio("pickers_available", "pickers_scheduled"), 4).alias("picker_ratio"),
                    F.round(stf.staffing_ratio("packers_available", "packers_scheduled"), 4).alias("packer_ratio"))


@query("available_staff", section="SC-18", oracle="""
WITH r AS (
  SELECT store_id, cast(sum(pickers_available) as double) / sum(pickers_scheduled) AS rate
  FROM qc_store_staffing GROUP BY store_id HAVING sum(pickers_scheduled) > 0)
SELECT s.staffing_snapshot_id, s.store_id,
       cast(least(cast(pickers_scheduled as double), greatest(0.0, round_even(pickers_scheduled * r.rate, 0))) as integer)
         AS expected_available,
       pickers_available - cast(least(cast(pickers_scheduled as double),
                                      greatest(0.0, round_even(pickers_scheduled * r.rate, 0))) as integer) AS deviation
FROM qc_store_staffing s LEFT JOIN r ON r.store_id = s.store_id
""")
def q_available_staff(spark, sf):
    """Recorded pickers against those expected at the store's own attendance rate."""
    s = qc(spark, sf, "store_staffing")
    rates = s.groupBy("store_id").agg(F.sum("pickers_available").alias("a"), F.sum("pickers_scheduled").alias("n")) \
        .filter("n > 0").select("store_id", (F.col("a").cast("double") / F.col("n")).alias("rate"))
    expected = stf.available_staff("pickers_scheduled", F.col("rate"))
    return s.join(rates, "store_id", "left").select("staffing_snapshot_id", "store_id", expected.alias("expected_available"),
                                                    (F.col("pickers_available") - expected).alias("deviation"))


@query("pick_staffing_band", section="PRJ-4", oracle=f"""
SELECT staffing_snapshot_id, {_band_sql('pickers_available', 'pickers_scheduled', 1.35, 1.15)} AS pick_band
FROM qc_store_staffing
""")
def q_pick_staffing_band(spark, sf):
    s = qc(spark, sf, "store_staffing")
    return s.select("staffing_snapshot_id", stf.pick_staffing_band("pickers_available", "pickers_scheduled")
                    .alias("pick_band"))


@query("pack_staffing_band", section="PRJ-5", oracle=f"""
SELECT staffing_snapshot_id, {_band_sql('packers_available', 'packers_scheduled', 1.3, 1.15)} AS pack_band
FROM qc_store_staffing
""")
def q_pack_staffing_band(spark, sf):
    s = qc(spark, sf, "store_staffing")
    return s.select("staffing_snapshot_id", stf.pack_staffing_band("packers_available", "packers_scheduled")
                    .alias("pack_band"))


@query("demand_multiplier", section="PRJ-6", oracle=f"""
SELECT order_id, {_MULT_SQL.replace('(t)', '(created_at)')} AS demand_multiplier FROM qc_orders
""")
def q_demand_multiplier(spark, sf):
    return qc(spark, sf, "orders").select("order_id", stf.demand_multiplier("created_at").alias("demand_multiplier"))


@query("demand_period", section="PRJ-7", oracle="""
SELECT order_id, CASE WHEN hour(created_at) BETWEEN 7 AND 9 THEN 'MORNING'
                      WHEN hour(created_at) BETWEEN 11 AND 13 THEN 'LUNCH'
                      WHEN hour(created_at) BETWEEN 17 AND 21 THEN 'EVENING'
                      WHEN hour(created_at) BETWEEN 22 AND 23 THEN 'LATE_NIGHT' ELSE 'OFF_PEAK' END AS demand_period
FROM qc_orders
""")
def q_demand_period(spark, sf):
    return qc(spark, sf, "orders").select("order_id", stf.demand_period("created_at").alias("demand_period"))


@query("empty_to_null", section="SRC-3", oracle="""
SELECT order_id,
       CASE WHEN order_id % 13 = 0 THEN ' ' ELSE cancellation_reason END AS cancellation_reason,
       failure_reason
FROM qc_orders
""")
def q_empty_to_null(spark, sf):
    # the text form a CSV carries: '' for missing, and some whitespace-only values (kept)
    o = qc(spark, sf, "orders")
    text = o.select("order_id",
                    F.when(F.col("order_id") % 13 == 0, F.lit(" ")).otherwise(F.coalesce("cancellation_reason", F.lit("")))
                    .alias("cancellation_reason"),
                    F.coalesce("failure_reason", F.lit("")).alias("failure_reason"))
    return text.select("order_id", tsf.empty_to_null("cancellation_reason").alias("cancellation_reason"),
                       tsf.empty_to_null("failure_reason").alias("failure_reason"))
