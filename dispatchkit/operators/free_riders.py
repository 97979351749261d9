"""Free riders as of a request (JN-8): a sweep over the times at which riders become busy and free.

A rider is busy from the start of a delivery until the latest ``delivered_at`` of the deliveries started
so far, and free otherwise; a rider who never delivered is free all the time, and a delivery without an
end keeps nobody busy. The free riders of a zone at a time are therefore a running total of changes: the
zone's active riders, less one at every start of a busy stretch, plus one at its end. Requests and
changes meet in one bucketed pass (``running_total``); no rider x request pairs are formed, and no
group is larger than one time bucket of one zone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import kept
from .joins import last_rows
from .ordered import running_max_before, running_total, time_bucket

ANY_ZONE = "*"
#: Time buckets of the sweep: all zones together share them, so they are narrower than a day.
SWEEP_SECONDS = 3600
#: Time at which every active rider is first counted as free.
BEGINNING = "0001-01-01 00:00:00"


def active_riders(riders: DataFrame) -> DataFrame:
    """Active riders with their home zone, one row per id."""
    return last_rows(riders, "rider_id", [], ["status", "home_zone"]).filter("status = 'ACTIVE'").select(
        "rider_id", F.col("home_zone").alias("zone"))


def busy_stretches(deliveries: DataFrame) -> DataFrame:
    """(rider_id, at, change): -1 where a rider becomes busy, +1 where the rider is free again. Deliveries
    of one rider that overlap are one stretch. A stretch opens at a delivery that starts when no earlier
    one lasts; the one before it ended at the running maximum, the last one at the rider's maximum."""
    d = kept(deliveries.select("rider_id", "delivery_id", "delivery_started_at", "delivered_at").filter(
        "rider_id is not null and delivered_at > delivery_started_at"), "busy")
    before = running_max_before(d, "rider_id", ["delivery_started_at", "delivery_id"], "delivered_at",
                                time_bucket("delivery_started_at"), out="before")
    opening = before.filter("before is null or before <= delivery_started_at")
    inner = opening.select("rider_id", F.inline(F.array(
        F.struct(F.col("delivery_started_at").alias("at"), F.lit(-1).alias("change")),
        F.struct(F.col("before").alias("at"), F.lit(1).alias("change"))))).filter("at is not null")
    last = d.groupBy("rider_id").agg(F.max("delivered_at").alias("at")).select("rider_id", "at", F.lit(1).alias("change"))
    return inner.unionByName(last)


def free_changes(riders: DataFrame, deliveries: DataFrame) -> DataFrame:
    """(zone, at, change): changes of the number of free active riders per home zone."""
    active = active_riders(riders)
    moves = busy_stretches(deliveries).join(active, "rider_id").select("zone", "at", "change")
    first = active.select("zone", F.lit(BEGINNING).cast("timestamp_ntz").alias("at"), F.lit(1).alias("change"))
    return moves.unionByName(first).groupBy("zone", "at").agg(F.sum("change").alias("change"))


def free_riders(requests: DataFrame, riders: DataFrame, deliveries: DataFrame, zone: str = "zone",
                time: str = "offered_at", width_seconds: int = SWEEP_SECONDS) -> DataFrame:
    """Adds to every request ``n_zone`` (free active riders of its zone at its time), ``cand_zone`` (its
    zone if one is free there, '*' if only others are, else NULL) and ``n_candidates`` (free riders of
    that pool, 0 if nobody is free). Only requests without a free rider of their zone are counted
    over all zones. A request without a time has NULL in all three; one without a zone takes riders of
    any zone; riders without a zone count for '*' only."""
    # a running total reads both of its sides twice: each is computed once and kept
    asked, changes = kept(requests, "requests"), kept(free_changes(riders, deliveries), "changes")
    here = running_total(asked, changes.withColumnRenamed("zone", zone), zone, time, "at", "change", width_seconds, "n_zone")
    known = F.col(time).isNotNull()
    here = kept(here.withColumn("n_zone", F.when(known, F.col("n_zone"))).withColumn(
        "_pool", F.when(known & (F.col("n_zone") == 0), F.lit(ANY_ZONE))), "requests-here")
    everywhere = changes.groupBy("at").agg(F.sum("change").alias("change")).withColumn("_pool", F.lit(ANY_ZONE))
    none_here = running_total(here.filter("_pool is not null"), everywhere, "_pool", time, "at", "change", width_seconds, "_n_any")
    both = none_here.unionByName(here.filter("_pool is null").withColumn("_n_any", F.lit(0).cast("long")))
    pool = F.when(F.col("n_zone") > 0, F.col(zone)).when(F.col("_n_any") > 0, F.col("_pool"))
    return both.select(*requests.columns, "n_zone", pool.alias("cand_zone"),
                       F.when(F.col("n_zone") > 0, F.col("n_zone")).when(known, F.col("_n_any")).alias("n_candidates"))


def offers_outside_zone(offers: DataFrame, riders: DataFrame, deliveries: DataFrame, store_zone: DataFrame,
                        width_seconds: int = SWEEP_SECONDS) -> DataFrame:
    """Recorded offers to an active rider of another zone although a rider of the store's zone was free.
    ``store_zone`` has one row per ``delivery_id`` with its ``zone``."""
    abroad = offers.join(active_riders(riders).withColumnRenamed("zone", "home_zone"), "rider_id").join(
        store_zone, "delivery_id").filter(~F.col("home_zone").eqNullSafe(F.col("zone")))
    asked = abroad.select("assignment_id", "delivery_id", "rider_id", "home_zone", "zone", "offered_at")
    return free_riders(asked, riders, deliveries, width_seconds=width_seconds).filter("n_zone > 0").drop(
        "cand_zone", "n_candidates")
