"""Aggregations (AG-1..7) and the order status roll-up.

All of these are aggregates with a partial (map-side) step, so a hot key costs one partial row
per input partition before the exchange, not one row per input row. Those that keep a struct
(the first cancelled unit) are sort aggregates, the others hash aggregates.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .. import functions as _  # noqa: F401  (package import order)


def item_count(items: DataFrame, key: str = "fulfilment_unit_id") -> DataFrame:
    """AG-1: item lines and total quantity per parent key."""
    return items.groupBy(key).agg(F.count(F.lit(1)).alias("item_count"),
                                  F.sum(F.col("quantity").cast("long")).alias("total_quantity"))


def _first_where(cond: Column, order: Column, *fields: str) -> Column:
    """Fields of the first row (smallest ``order``) satisfying ``cond``, as a struct.
    ``min`` over a struct compares field by field, so ``order`` goes first."""
    return F.min(F.when(cond, F.struct(order.alias("_o"), *[F.col(f) for f in fields])))


def unit_status_summary(units: DataFrame, order_key: str = "order_id",
                        unit_key: str = "fulfilment_unit_id") -> DataFrame:
    """Per order: unit count, status flags and the first cancelled / failed unit."""
    st = F.col("status")
    return units.groupBy(order_key).agg(
        F.count(F.lit(1)).alias("n_units"),
        F.bool_and(F.coalesce(st == "COMPLETED", F.lit(False))).alias("all_completed"),
        F.bool_or(F.coalesce(st == "CANCELLED", F.lit(False))).alias("any_cancelled"),
        F.bool_or(F.coalesce(st == "FAILED", F.lit(False))).alias("any_failed"),
        _first_where(st == "CANCELLED", F.col(unit_key), "cancelled_at", "cancellation_reason").alias("first_cancel"),
        _first_where(st == "FAILED", F.col(unit_key), "failure_reason").alias("first_fail"),
    )


def order_status_rollup(orders: DataFrame, units: DataFrame, order_key: str = "order_id") -> DataFrame:
    """AG-2 + AG-3: order status from its units, patched onto the order row.

    No unit -> FAILED / NO_FULFILMENT; all COMPLETED -> DELIVERED; any CANCELLED ->
    CANCELLED with the first cancelled unit's time and reason; any FAILED -> FAILED with
    the first failed unit's reason; otherwise FULFILLING. Other fields keep the order's
    values."""
    s = unit_status_summary(units, order_key)
    j = orders.join(s, order_key, "left")
    none = F.col("n_units").isNull()
    status = (F.when(none, "FAILED").when(F.col("all_completed"), "DELIVERED")
              .when(F.col("any_cancelled"), "CANCELLED").when(F.col("any_failed"), "FAILED")
              .otherwise("FULFILLING"))
    canc = ~none & ~F.col("all_completed") & F.col("any_cancelled")
    fail = ~none & ~F.col("all_completed") & ~F.col("any_cancelled") & F.col("any_failed")
    return j.select(
        F.col(order_key),
        status.alias("status"),
        F.when(canc, F.col("first_cancel.cancelled_at")).otherwise(F.col("cancelled_at")).alias("cancelled_at"),
        F.when(canc, F.col("first_cancel.cancellation_reason")).otherwise(F.col("cancellation_reason"))
         .alias("cancellation_reason"),
        F.when(none, F.lit("NO_FULFILMENT")).when(fail, F.col("first_fail.failure_reason"))
         .otherwise(F.col("failure_reason")).alias("failure_reason"),
    )


def first_terminal_reason(units: DataFrame, order_key: str = "order_id") -> DataFrame:
    """AG-3: per order, time and reason of the first cancelled unit and the first failed
    unit's reason (orders with neither are omitted)."""
    s = unit_status_summary(units, order_key)
    return (s.filter(F.col("any_cancelled") | F.col("any_failed"))
            .select(order_key,
                    F.col("first_cancel._o").alias("first_cancelled_unit"),
                    F.col("first_cancel.cancelled_at").alias("cancelled_at"),
                    F.col("first_cancel.cancellation_reason").alias("cancellation_reason"),
                    F.col("first_fail._o").alias("first_failed_unit"),
                    F.col("first_fail.failure_reason").alias("failure_reason")))


def all_in_status(units: DataFrame, status: str = "COMPLETED", order_key: str = "order_id") -> DataFrame:
    """ST-3: per order, whether every unit is in ``status`` (set equality {status})."""
    return units.groupBy(order_key).agg(
        F.bool_and(F.coalesce(F.col("status") == status, F.lit(False))).alias("all_in_status"),
        F.count(F.lit(1)).alias("n_units"))


def fulfilments_by_order(units: DataFrame, order_key: str = "order_id",
                         unit_key: str = "fulfilment_unit_id", bucket_width: int = 4096,
                         prefix_length: int = 10) -> DataFrame:
    """AG-6: each order's units in unit order, in relational form: one row per unit with
    its 1-based position and the order's unit count. No list is collected, so an order
    key holding a large share of the units (a placeholder id) is still spread over tasks
    (bucketed dense index, see ``ordered.dense_rank_index``). Buckets follow the unit order:
    ranges of ``bucket_width`` for number ids, the first ``prefix_length`` letters for text ids."""
    from .joins import is_number
    from .ordered import dense_rank_index
    u = units.select(order_key, unit_key)
    bucket = (F.floor(F.col(unit_key) / F.lit(bucket_width)) if is_number(units, unit_key)
              else F.substring(F.col(unit_key), 1, prefix_length))
    r = dense_rank_index(u, order_key, [unit_key], bucket, out="_pos")
    return r.select(order_key, unit_key, (F.col("_pos") + 1).alias("position"), F.col("_pos_group_size").alias("n_units"))


def split_orders(units: DataFrame, order_key: str = "order_id", store_key: str = "store_id") -> DataFrame:
    """AG-7: orders served by more than one unit, with unit and store counts."""
    return (units.groupBy(order_key)
            .agg(F.count(F.lit(1)).alias("n_units"), F.countDistinct(store_key).alias("n_stores"))
            .filter(F.col("n_units") > 1))


def event_types_by_entity(events: DataFrame, key: str = "delivery_id") -> DataFrame:
    """AG-5: the set of event types seen per entity, as a name-ordered array built from
    one presence flag per known type (fixed-width state, whatever the group size), plus
    the number of events and of distinct types outside the known domain."""
    from ..sources.schemas import EVENT_TYPES
    known = sorted(EVENT_TYPES)
    et = F.col("event_type")
    g = events.filter(F.col(key).isNotNull()).groupBy(key).agg(
        *[F.max(et == t).alias("_has_" + t) for t in known],
        F.count(F.lit(1)).alias("n_events"),
        F.countDistinct(F.when(~et.isin(*known), et)).alias("n_unknown_types"))
    types = F.filter(F.array(*[F.when(F.col("_has_" + t), F.lit(t)) for t in known]), lambda x: x.isNotNull())
    return g.select(key, types.alias("event_types"), "n_events", "n_unknown_types")


def duplicate_keys(df: DataFrame, key) -> DataFrame:
    """AG-4: keys that occur more than once, with their repeat count (occurrences - 1).
    Missing keys are grouped apart and reported by the caller as "missing"."""
    keys = [key] if isinstance(key, str) else list(key)
    return (df.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
            .groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences"))
            .filter(F.col("occurrences") > 1)
            .withColumn("repeats", F.col("occurrences") - 1))
