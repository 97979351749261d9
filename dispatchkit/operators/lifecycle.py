"""Lifecycle composites and event-set operators (2.7).

State tables -> event log (unpivot, one pass per table), event log -> state (one
aggregate per entity), stage durations, staffing plan, pick workload, delivery requests,
deliveries that found no rider.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import staffing as stf
from ..functions.geo import haversine_km
from ..functions.timestamps import seconds_between
from ..sources.schemas import EVENT_TYPES
from .joins import LAST_ORDER, is_number, last_rows, store_hour_grid
from .ordered import asof_latest, sequential_number

EVENT_RANK = {t: i for i, t in enumerate(EVENT_TYPES)}

# Stage timestamp -> event type, per state table (fixed lifecycle mapping).
ORDER_STAGES = [("created_at", "ORDER_CREATED"), ("payment_success_at", "PAYMENT_SUCCESS")]
UNIT_STAGES = [("assigned_to_store_at", "STORE_ASSIGNED"), ("picking_started_at", "PICKING_STARTED"),
               ("picking_completed_at", "PICKING_COMPLETED"), ("cancelled_at", "FULFILMENT_CANCELLED"),
               ("packing_started_at", "PACKING_STARTED"), ("packing_completed_at", "PACKING_COMPLETED"),
               ("failed_at", "FULFILMENT_FAILED")]
DELIVERY_STAGES = [("failed_at", "DELIVERY_FAILED"), ("rider_arrived_at_store", "RIDER_ARRIVED_AT_STORE"),
                   ("picked_up_at", "PICKED_UP"), ("delivery_started_at", "DELIVERY_STARTED"),
                   ("delivered_at", "DELIVERED")]
# Latest event -> status it leaves the unit / delivery in.
UNIT_STATUS_AFTER = {
    "STORE_ASSIGNED": "PICKING", "PICKING_STARTED": "PICKING", "PICKING_COMPLETED": "PICKING",
    "PACKING_STARTED": "PACKING", "PACKING_COMPLETED": "PACKING", "FULFILMENT_CANCELLED": "CANCELLED",
    "FULFILMENT_FAILED": "FAILED", "DELIVERY_FAILED": "FAILED", "RIDER_ASSIGNED": "READY_FOR_PICKUP",
    "RIDER_ARRIVED_AT_STORE": "READY_FOR_PICKUP", "PICKED_UP": "HANDED_TO_RIDER",
    "DELIVERY_STARTED": "HANDED_TO_RIDER", "DELIVERED": "COMPLETED",
}
DELIVERY_STATUS_AFTER = {
    "RIDER_ASSIGNED": "ASSIGNED", "RIDER_ARRIVED_AT_STORE": "ASSIGNED", "PICKED_UP": "ASSIGNED",
    "DELIVERY_STARTED": "IN_TRANSIT", "DELIVERED": "DELIVERED", "DELIVERY_FAILED": "FAILED",
    "FULFILMENT_FAILED": "FAILED", "FULFILMENT_CANCELLED": "CANCELLED",
}
EVENT_COLUMNS = ["event_type", "occurred_at", "order_id", "fulfilment_unit_id", "delivery_id", "store_id",
                 "rider_id", "reason"]


EVENT_IDS = ["order_id", "fulfilment_unit_id", "delivery_id", "store_id", "rider_id"]


def _unpivot(df: DataFrame, stages: list[tuple[str, str]], ids: dict[str, Column], source_id: Column,
             types: dict[str, str], reasons: dict[str, Column] | None = None,
             only: dict[str, dict[str, Column]] | None = None) -> DataFrame:
    """One event per non-NULL stage timestamp of each row (``inline`` of an array of structs: a
    single projection, no rescan per stage). ``types``: the type of each id column, kept as the
    tables have it. ``only``: id columns that just these event types carry."""
    reasons, only = reasons or {}, only or {}
    structs = [F.struct(F.lit(et).alias("event_type"), F.col(tc).alias("occurred_at"),
                        (reasons.get(et, F.lit(None).cast("string"))).alias("reason"),
                        *[(cols[et] if et in cols else F.lit(None)).cast(types[c]).alias(c) for c, cols in only.items()])
               for tc, et in stages]
    idcols = [(ids[c] if c in ids else F.lit(None)).cast(types[c]).alias(c) for c in EVENT_IDS if c not in only]
    u = df.select(*idcols, source_id.cast(types["source_id"]).alias("source_id"), F.inline(F.array(*structs)))
    u = u.select(*EVENT_IDS, "source_id", "event_type", "occurred_at", "reason")
    return u.filter(F.col("occurred_at").isNotNull())


def event_union(orders: DataFrame, units: DataFrame, deliveries: DataFrame, assignments: DataFrame) -> DataFrame:
    """ST-1: the event log implied by the state tables, one uniform shape.

    Order events carry the order; unit events add unit and store; delivery events add the
    delivery and, once assigned, the rider (DELIVERY_FAILED has none). RIDER_ASSIGNED
    comes from accepted offers. Deliveries get order and store from their unit (of repeated ids
    the last). Ids keep the type of their tables; ``source_id`` is text if any of them is."""
    types = {"order_id": orders, "fulfilment_unit_id": units, "delivery_id": deliveries, "store_id": units, "rider_id": assignments}
    types = {c: df.schema[c].dataType.simpleString() for c, df in types.items()}
    numbers = all(is_number(df, c) for df, c in ((orders, "order_id"), (units, "fulfilment_unit_id"),
                                                 (deliveries, "delivery_id"), (assignments, "assignment_id")))
    types["source_id"] = "bigint" if numbers else "string"
    o = _unpivot(orders, ORDER_STAGES, {"order_id": F.col("order_id")}, F.col("order_id"), types)
    u = _unpivot(units, UNIT_STAGES, {"order_id": F.col("order_id"), "fulfilment_unit_id": F.col("fulfilment_unit_id"),
                                      "store_id": F.col("store_id")}, F.col("fulfilment_unit_id"), types,
                 {"FULFILMENT_CANCELLED": F.col("cancellation_reason"), "FULFILMENT_FAILED": F.col("failure_reason")})
    uk = last_rows(units, "fulfilment_unit_id", LAST_ORDER["fulfilment_units"], ["order_id", "store_id"]).select(
        "fulfilment_unit_id", F.col("order_id").alias("_u_order"), F.col("store_id").alias("_u_store"))
    dj = deliveries.join(uk, "fulfilment_unit_id", "left")
    dids = {"order_id": F.col("_u_order"), "fulfilment_unit_id": F.col("fulfilment_unit_id"),
            "delivery_id": F.col("delivery_id"), "store_id": F.col("_u_store")}
    moving = {et: F.col("rider_id") for _, et in DELIVERY_STAGES if et != "DELIVERY_FAILED"}
    d = _unpivot(dj, DELIVERY_STAGES, dids, F.col("delivery_id"), types, {"DELIVERY_FAILED": F.col("failure_reason")},
                 only={"rider_id": moving})
    acc = assignments.filter(F.col("response") == "ACCEPTED")
    dk = last_rows(dj, "delivery_id", LAST_ORDER["deliveries"], ["fulfilment_unit_id", "_u_order", "_u_store"]).select(
        F.col("delivery_id").alias("_d"), "fulfilment_unit_id", "_u_order", "_u_store")
    aj = acc.join(dk, acc.delivery_id == dk._d, "left")
    a = _unpivot(aj, [("responded_at", "RIDER_ASSIGNED")],
                 {"order_id": F.col("_u_order"), "fulfilment_unit_id": F.col("fulfilment_unit_id"),
                  "delivery_id": F.col("delivery_id"), "store_id": F.col("_u_store"), "rider_id": F.col("rider_id")},
                 F.col("assignment_id"), types)
    return reduce(DataFrame.unionByName, [o, u, d, a])


def event_rank(col: str = "event_type") -> Column:
    out = None
    for t, r in EVENT_RANK.items():
        out = F.when(F.col(col) == t, F.lit(r)) if out is None else out.when(F.col(col) == t, F.lit(r))
    return out


def events_from_state(orders: DataFrame, units: DataFrame, deliveries: DataFrame, assignments: DataFrame,
                      prefix: str = "EVT-", width: int = 7) -> DataFrame:
    """LC-1: event log with sequential business keys in (occurred_at, lifecycle rank,
    source id) order - the order the lifecycle emits them. Types are shuffled as their rank."""
    e = event_union(orders, units, deliveries, assignments).withColumn("_rank", event_rank()).drop("event_type")
    s = sequential_number(e, ["occurred_at", "_rank", "source_id"], out="_seq").withColumn(
        "event_type", F.element_at(F.array(*[F.lit(t) for t in EVENT_TYPES]), F.col("_rank") + 1))
    return s.select(F.format_string(f"{prefix}%0{width}d", F.col("_seq")).alias("event_id"), *EVENT_COLUMNS)


def event_order(event_id: str = "event_id") -> Column:
    """Time, then the number in the event id (the order of emission: ``EVT-10000000`` comes after
    ``EVT-9999999``, which text order would not say), then the id itself."""
    number = F.expr(f"try_cast(regexp_extract(cast({event_id} as string), '([0-9]+)$', 1) as decimal(38, 0))")
    return F.struct(F.col("occurred_at"), number.alias("number"), F.col(event_id).alias("id"))


def _map(col: Column, mapping: dict[str, str], default: str | None) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(col == k, F.lit(v)) if out is None else out.when(col == k, F.lit(v))
    return out.otherwise(F.lit(default)) if default is not None else out


def _level(level: str):
    if level == "unit":
        return "fulfilment_unit_id", UNIT_STAGES, UNIT_STATUS_AFTER, "PENDING"
    if level == "delivery":
        return "delivery_id", DELIVERY_STAGES, DELIVERY_STATUS_AFTER, "REQUESTED"
    raise ValueError(level)


def state_from_events(events: DataFrame, level: str = "unit") -> DataFrame:
    """LC-2: latest state per unit (or delivery) from its events, in one aggregate: each
    stage timestamp is the latest event of its type, the status follows the latest event
    by ``event_order``, the reason is the latest terminal event's reason.

    The aggregate is commutative (max / max_by), so late or reordered events give the
    same state - the property the streaming version relies on."""
    key, stages, status_map, default = _level(level)
    relevant = list(status_map)
    e = events.filter(F.col(key).isNotNull())
    aggs = [F.max(F.when(F.col("event_type") == et, F.col("occurred_at"))).alias(tc) for tc, et in stages]
    aggs += [F.max_by(F.when(F.col("event_type").isin(relevant), F.col("event_type")),
                      F.when(F.col("event_type").isin(relevant), event_order())).alias("last_event_type"),
             F.max_by(F.col("reason"), F.when(F.col("reason").isNotNull(), event_order())).alias("reason"),
             F.count(F.lit(1)).alias("n_events")]
    s = e.groupBy(key).agg(*aggs)
    return s.withColumn("status", _map(F.col("last_event_type"), status_map, default))


def partial_state(events: DataFrame, level: str = "unit") -> DataFrame:
    """What some events of a key say about its state, kept so that ``merged_states`` can combine it with
    what other events say: stage maxima, the latest status and reason with their place in the event
    order, the number of events and the latest time of any event."""
    key, stages, status_map, _ = _level(level)
    e = events.filter(F.col(key).isNotNull())
    status = F.struct(event_order().alias("at"), F.col("event_type").alias("value"))
    reason = F.struct(event_order().alias("at"), F.col("reason").alias("value"))
    return e.groupBy(key).agg(
        *[F.max(F.when(F.col("event_type") == et, F.col("occurred_at"))).alias(tc) for tc, et in stages],
        F.max(F.when(F.col("event_type").isin(list(status_map)), status)).alias("last_status"),
        F.max(F.when(F.col("reason").isNotNull(), reason)).alias("last_reason"),
        F.count(F.lit(1)).alias("n_events"), F.max("occurred_at").alias("last_at"))


def merged_states(partials: DataFrame, level: str = "unit") -> DataFrame:
    """Partial states of any number of event sets as one per key."""
    key = _level(level)[0]
    return partials.groupBy(key).agg(*[(F.sum(c) if c == "n_events" else F.max(c)).alias(c) for c in partials.columns if c != key])


def status_of(level: str = "unit") -> Column:
    """Status of a partial state."""
    _, _, status_map, default = _level(level)
    return _map(F.col("last_status.value"), status_map, default)


def state_of(partials: DataFrame, level: str = "unit") -> DataFrame:
    """The rows of ``state_from_events`` from one partial state per key."""
    key, stages, _, _ = _level(level)
    return partials.select(key, *[tc for tc, _ in stages], F.col("last_status.value").alias("last_event_type"),
                           F.col("last_reason.value").alias("reason"), "n_events", status_of(level).alias("status"))


def stage_durations(orders: DataFrame, units: DataFrame, deliveries: DataFrame, assignments: DataFrame) -> DataFrame:
    """LC-3: seconds spent in each lifecycle stage, per unit (NULL where a bound is
    missing). First offer per delivery is an aggregate, joined once."""
    first_offer = assignments.groupBy("delivery_id").agg(F.min("offered_at").alias("first_offered_at"))
    o = last_rows(orders, "order_id", LAST_ORDER["orders"], ["created_at", "payment_success_at"])
    d = last_rows(deliveries, ["delivery_id", "fulfilment_unit_id"], LAST_ORDER["deliveries"],
                  ["rider_arrived_at_store", "picked_up_at", "delivery_started_at", "delivered_at"])
    d = d.join(first_offer, "delivery_id", "left")
    u = units.select("fulfilment_unit_id", "order_id", "assigned_to_store_at", "picking_started_at",
                     "picking_completed_at", "packing_started_at", "packing_completed_at")
    j = u.join(o, "order_id", "left").join(d, "fulfilment_unit_id", "left")
    spans = [("pay_s", "created_at", "payment_success_at"), ("assign_s", "payment_success_at", "assigned_to_store_at"),
             ("wait_to_pick_s", "assigned_to_store_at", "picking_started_at"),
             ("pick_s", "picking_started_at", "picking_completed_at"),
             ("gap_s", "picking_completed_at", "packing_started_at"),
             ("pack_s", "packing_started_at", "packing_completed_at"),
             ("offer_s", "packing_completed_at", "first_offered_at"),
             ("arrive_s", "first_offered_at", "rider_arrived_at_store"),
             ("wait_s", "rider_arrived_at_store", "picked_up_at"),
             ("handover_s", "picked_up_at", "delivery_started_at"),
             ("transit_s", "delivery_started_at", "delivered_at")]
    return j.select("fulfilment_unit_id", "delivery_id", *[seconds_between(a, b).alias(n) for n, a, b in spans])


def staffing_plan(stores: DataFrame, start: str, hours: int = 24) -> DataFrame:
    """LC-4: scheduled pickers and packers per store-hour (deterministic part)."""
    g = store_hour_grid(stores.select("store_id", "baseline_capacity"), start, hours)
    pickers, packers = stf.scheduled_staff("baseline_capacity", "recorded_at")
    return g.select("store_id", "recorded_at", stf.demand_multiplier("recorded_at").alias("demand_multiplier"),
                    pickers.alias("pickers_scheduled"), packers.alias("packers_scheduled"))


def pick_workload(units: DataFrame, items: DataFrame, staffing: DataFrame) -> DataFrame:
    """LC-5: per unit, item count, as-of staffing at picking start, ratio, band and the
    plausible pick-time range next to the measured pick time."""
    counts = items.groupBy("fulfilment_unit_id").agg(F.count(F.lit(1)).alias("item_count"))
    u = units.select("fulfilment_unit_id", "store_id", "picking_started_at", "picking_completed_at") \
        .join(counts, "fulfilment_unit_id", "left")
    a = asof_latest(u, staffing, "store_id", "picking_started_at", "recorded_at", "staffing_snapshot_id",
                    ["pickers_available", "pickers_scheduled"])
    ratio = stf.staffing_ratio("pickers_available", "pickers_scheduled")
    band = stf.pick_staffing_band("pickers_available", "pickers_scheduled")
    lo = stf.pick_seconds(F.coalesce(F.col("item_count"), F.lit(0)), "pickers_available", "pickers_scheduled",
                          stf.PICK_PER_ITEM_RANGE[0], stf.PICK_EXTRA_RANGE[0])
    hi = stf.pick_seconds(F.coalesce(F.col("item_count"), F.lit(0)), "pickers_available", "pickers_scheduled",
                          stf.PICK_PER_ITEM_RANGE[1], stf.PICK_EXTRA_RANGE[1])
    actual = seconds_between("picking_started_at", "picking_completed_at")
    return a.select("fulfilment_unit_id", "store_id", "item_count", "staffing_snapshot_id", "asof_match",
                    F.round(ratio, 4).alias("staffing_ratio"), band.alias("pick_band"),
                    lo.alias("min_pick_s"), hi.alias("max_pick_s"), actual.alias("actual_pick_s"))


def delivery_requests(units: DataFrame, stores: DataFrame, orders: DataFrame) -> DataFrame:
    """LC-6: one REQUESTED delivery per open unit (status not CANCELLED/FAILED; a missing
    status is open), with the straight-line store-to-address distance. A unit whose store
    or order is not found is kept with ``request_ok`` false (strict lookup, no raise)."""
    open_u = units.filter(~F.coalesce(F.col("status").isin("CANCELLED", "FAILED"), F.lit(False)))
    s = last_rows(stores, "store_id", LAST_ORDER["stores"], ["latitude", "longitude"]).select(
        "store_id", F.col("latitude").alias("s_lat"), F.col("longitude").alias("s_lon"))
    o = last_rows(orders, "order_id", LAST_ORDER["orders"], ["delivery_latitude", "delivery_longitude"]).select(
        "order_id", F.col("delivery_latitude").alias("o_lat"), F.col("delivery_longitude").alias("o_lon"))
    j = open_u.select("fulfilment_unit_id", "order_id", "store_id").join(s, "store_id", "left").join(o, "order_id", "left")
    ok = F.col("s_lat").isNotNull() & F.col("o_lat").isNotNull()
    return j.select("fulfilment_unit_id", "order_id", "store_id", F.lit("REQUESTED").alias("status"),
                    F.when(ok, F.round(haversine_km("s_lat", "s_lon", "o_lat", "o_lon"), 4)).alias("straight_km"),
                    ok.alias("request_ok"))


def failed_no_rider(deliveries: DataFrame, assignments: DataFrame) -> DataFrame:
    """LC-7: deliveries with no ACCEPTED offer (all rejected/expired, or none made):
    the lifecycle ends them FAILED / NO_RIDER_ACCEPTED."""
    acc = assignments.filter(F.col("response") == "ACCEPTED").select("delivery_id").distinct()
    offers = assignments.groupBy("delivery_id").agg(F.count(F.lit(1)).alias("n_offers"))
    d = deliveries.select("delivery_id", "status").join(acc, "delivery_id", "left_anti") \
        .join(offers, "delivery_id", "left")
    return d.select("delivery_id", F.coalesce(F.col("n_offers"), F.lit(0)).alias("n_offers"),
                    F.col("status").alias("recorded_status"), F.lit("FAILED").alias("implied_status"),
                    F.lit("NO_RIDER_ACCEPTED").alias("implied_reason"))


# ---- ST-2 / SO-5 -------------------------------------------------------------------

# Events a DELIVERED delivery must have (rules EV-01..05, in this order)
# and the one a FAILED delivery must have (EV-06).
REQUIRED_DELIVERED = ["RIDER_ASSIGNED", "RIDER_ARRIVED_AT_STORE", "PICKED_UP", "DELIVERY_STARTED", "DELIVERED"]
REQUIRED_FAILED = ["DELIVERY_FAILED"]


def missing_event_types(deliveries: DataFrame, events: DataFrame) -> DataFrame:
    """Per DELIVERED/FAILED delivery: the required event types it lacks, sorted (SO-5).
    Left join: a delivery with no event at all lacks every required type."""
    required = sorted(set(REQUIRED_DELIVERED) | set(REQUIRED_FAILED))
    # one fixed-width flag per required type (not a collected set): bounded state per key
    present = events.filter(F.col("delivery_id").isNotNull() & F.col("event_type").isin(*required)) \
        .groupBy("delivery_id").agg(*[F.max(F.col("event_type") == t).alias("_has_" + t) for t in required])
    d = deliveries.filter(F.col("status").isin("DELIVERED", "FAILED")).select("delivery_id", "status")
    j = d.join(present, "delivery_id", "left")
    lacks = []
    for t in sorted(required):
        need = F.col("status") == ("DELIVERED" if t in REQUIRED_DELIVERED else "FAILED")
        lacks.append(F.when(need & ~F.coalesce(F.col("_has_" + t), F.lit(False)), F.lit(t)))
    missing = F.filter(F.array(*lacks), lambda x: x.isNotNull())     # already in name order
    return j.select("delivery_id", "status", missing.alias("missing_types")).filter(F.size("missing_types") > 0)


def missing_events(deliveries: DataFrame, events: DataFrame) -> DataFrame:
    """ST-2: one row per (delivery, required-but-absent event type)."""
    m = missing_event_types(deliveries, events)
    return m.select("delivery_id", "status", F.explode("missing_types").alias("missing_event_type"))
