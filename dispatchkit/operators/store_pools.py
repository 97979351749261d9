"""Candidate stores of an order (JN-5, JN-6) as pools: which pool an order draws from and how many
stores it holds. The members of a pool are listed once per pool (``pool_members``), not once per order, so
no order x store pairs are formed; whoever needs the stores of an order joins on its ``cand_zone``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .joins import LAST_ORDER, last_rows

ANY_ZONE = "*"


def active_stores(stores: DataFrame) -> DataFrame:
    """Active stores with their zone, one row per id."""
    return last_rows(stores, "store_id", LAST_ORDER["stores"], ["zone", "status"]).filter("status = 'ACTIVE'").select("store_id", "zone")


def pool_members(stores: DataFrame) -> DataFrame:
    """(cand_zone, store_id): the active stores of every zone, and all of them as '*'."""
    act = active_stores(stores)
    return act.filter("zone is not null").select(F.col("zone").alias("cand_zone"), "store_id").unionByName(
        act.select(F.lit(ANY_ZONE).alias("cand_zone"), "store_id"))


def pool_sizes(stores: DataFrame) -> DataFrame:
    """One row per pool: its number of stores."""
    return pool_members(stores).groupBy("cand_zone").agg(F.count(F.lit(1)).alias("n_candidates"))


def store_pools(orders: DataFrame, stores: DataFrame) -> DataFrame:
    """JN-5: per order the pool of its store: the active stores of its delivery zone, or all active stores
    ('*') if it has none; NULL and 0 if no store is active. Orders without a zone take any store."""
    sizes = pool_sizes(stores)
    here = sizes.filter(F.col("cand_zone") != ANY_ZONE).select(F.col("cand_zone").alias("_zone"), F.col("n_candidates").alias("_here"))
    # the size of '*' is one row; it travels on a constant key, which only orders without a zone pool have
    anywhere = sizes.filter(F.col("cand_zone") == ANY_ZONE).select(F.col("cand_zone").alias("_any"), F.col("n_candidates").alias("_all"))
    o = orders.join(here, F.col("delivery_zone") == F.col("_zone"), "left")
    o = o.withColumn("_wide", F.when(F.col("_zone").isNull(), F.lit(ANY_ZONE))).join(anywhere, F.col("_wide") == F.col("_any"), "left")
    return o.select("order_id", "delivery_zone", F.coalesce("_zone", "_any").alias("cand_zone"),
                    F.coalesce("_here", "_all", F.lit(0)).cast("long").alias("n_candidates"))


def second_store_pools(units: DataFrame, orders: DataFrame, stores: DataFrame) -> DataFrame:
    """JN-6: per unit with a store, how many other active stores its order's delivery zone has: the pool a
    second store of a split order comes from (0: the order cannot be split). Units without their order
    are left to the foreign-key rules."""
    sizes = pool_sizes(stores).filter(F.col("cand_zone") != ANY_ZONE).select(F.col("cand_zone").alias("_zone"), F.col("n_candidates").alias("_n"))
    act = active_stores(stores).select("store_id", F.col("zone").alias("_home"))
    o = last_rows(orders, "order_id", LAST_ORDER["orders"], ["delivery_zone"])
    u = units.filter(F.col("store_id").isNotNull()).select("fulfilment_unit_id", "order_id", "store_id").join(o, "order_id")
    u = u.join(sizes, F.col("delivery_zone") == F.col("_zone"), "left").join(act, "store_id", "left")
    own = F.coalesce((F.col("_home") == F.col("delivery_zone")).cast("long"), F.lit(0))
    return u.select("fulfilment_unit_id", "order_id", "store_id", "delivery_zone",
                    (F.coalesce("_n", F.lit(0)) - F.when(F.col("_n").isNotNull(), own).otherwise(0)).cast("long").alias("n_alternatives"))
