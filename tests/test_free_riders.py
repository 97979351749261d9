"""The free-rider sweep against a scan of every rider's deliveries."""

import datetime as dt
import random

from pyspark.sql import functions as F

from dispatchkit.operators.free_riders import busy_stretches, free_riders, offers_outside_zone

T0 = dt.datetime(2024, 3, 1)
RIDERS = "rider_id int, status string, home_zone string"
DELIVERIES = "delivery_id int, rider_id int, delivery_started_at timestamp_ntz, delivered_at timestamp_ntz"
REQUESTS = "request int, zone string, offered_at timestamp_ntz"


def at(minutes):
    return None if minutes is None else T0 + dt.timedelta(minutes=minutes)


def tables(spark, riders, deliveries, requests):
    return (spark.createDataFrame(riders, RIDERS),
            spark.createDataFrame([(d, r, at(s), at(e)) for d, r, s, e in deliveries], DELIVERIES),
            spark.createDataFrame([(q, z, at(t)) for q, z, t in requests], REQUESTS))


def is_free(rider, deliveries, t):
    ends = [e for _, r, s, e in deliveries if r == rider and s is not None and e is not None and s <= t]
    return max(ends, default=t) <= t


def brute(riders, deliveries, requests):
    out = {}
    for q, z, t in requests:
        if t is None:
            out[q] = (None, None, None)
            continue
        free = [home for r, status, home in riders if status == "ACTIVE" and is_free(r, deliveries, t)]
        here = sum(home == z for home in free) if z is not None else 0
        out[q] = (here, z if here else "*" if free else None, here or len(free))
    return out


def answers(df):
    return {r.request: (r.n_zone, r.cand_zone, r.n_candidates) for r in df.collect()}


def cases(seed):
    """Half of the riders live in one zone, some deliveries overlap, repeat or have no end."""
    rng = random.Random(seed)
    riders = [(i, "ACTIVE" if rng.random() < 0.8 else "INACTIVE", rng.choice(["A", "A", "B", "C", None])) for i in range(14)]
    deliveries = []
    for d in range(160):
        s = rng.randrange(0, 3 * 24 * 60)
        e = rng.choice([None, s, s - 5] + [s + rng.choice([1, 30, 60, 400])] * 9)
        deliveries.append((d, rng.choice([None, 99] + [0] * 5 + list(range(14))), rng.choice([s] * 15 + [None]), e))
    deliveries += deliveries[:9]
    times = [None, *range(0, 3 * 24 * 60, 37), *[e for *_, e in deliveries if e is not None][:60], *[s for _, _, s, _ in deliveries if s][:60]]
    return riders, deliveries, [(i, rng.choice(["A", "B", "C", "D", None]), t) for i, t in enumerate(times)]


def test_counts_equal_a_scan_of_all_riders(spark):
    for seed in (1, 2, 3):
        r, d, q = cases(seed)
        for width in (600, 3600, 10 ** 6):
            t = tables(spark, r, d, q)
            assert answers(free_riders(t[2], t[0], t[1], width_seconds=width)) == brute(r, d, q)


def test_nobody_free_and_riders_without_deliveries(spark):
    riders = [(1, "ACTIVE", "A"), (2, "ACTIVE", "B"), (3, "INACTIVE", "A")]
    deliveries = [(1, 1, 10, 30), (2, 1, 30, 40), (3, 2, 20, 40)]
    requests = [(0, "A", 5), (1, "A", 10), (2, "A", 20), (3, "A", 30), (4, "A", 40), (5, "A", None), (6, None, 5)]
    r, d, q = tables(spark, riders, deliveries, requests)
    assert answers(free_riders(q, r, d)) == {
        0: (1, "A", 1), 1: (0, "*", 1), 2: (0, None, 0), 3: (0, None, 0), 4: (1, "A", 1), 5: (None, None, None), 6: (0, "*", 2)}
    assert answers(free_riders(q, r, d.limit(0)))[2] == (1, "A", 1)
    assert answers(free_riders(q, r.limit(0), d))[2] == (0, None, 0)
    assert free_riders(q.limit(0), r, d).count() == 0


def test_stretches_of_a_rider_alternate(spark):
    r, d, _ = cases(5)
    rows = busy_stretches(tables(spark, r, d, [])[1]).collect()
    for rider in {x.rider_id for x in rows}:
        # at one time the end of a stretch comes before the start of the next
        changes = [x.change for x in sorted((x for x in rows if x.rider_id == rider), key=lambda x: (x.at, -x.change))]
        assert changes == [-1, 1] * (len(changes) // 2)


def test_one_zone_and_one_hour_hold_all_rows(spark):
    riders = spark.range(300).select(F.col("id").cast("int").alias("rider_id"), F.lit("ACTIVE").alias("status"), F.lit("A").alias("home_zone"))
    start = F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id") % 3000)
    deliveries = spark.range(6000).select(
        F.col("id").cast("int").alias("delivery_id"), (F.col("id") % 300).cast("int").alias("rider_id"),
        start.alias("delivery_started_at"), (start + F.expr("interval 5 minutes")).alias("delivered_at"))
    requests = spark.range(3000).select(F.col("id").cast("int").alias("request"), F.lit("A").alias("zone"), start.alias("offered_at"))
    got = {r.request: r.n_zone for r in free_riders(requests, riders, deliveries, width_seconds=60).collect()}
    ends = {}
    for i in range(6000):
        ends.setdefault(i % 300, []).append(i % 3000)
    for q in range(0, 3000, 251):
        assert got[q] == sum(not any(s <= q < s + 300 for s in starts) for starts in ends.values())


def test_offers_to_riders_of_other_zones(spark):
    riders = [(1, "ACTIVE", "A"), (2, "ACTIVE", "B"), (3, "INACTIVE", "B")]
    r, d, _ = tables(spark, riders, [(7, 1, 10, 30)], [])
    offers = spark.createDataFrame([(1, 70, 2, at(5)), (2, 70, 2, at(15)), (3, 70, 1, at(5)), (4, 70, 3, at(5)), (5, 71, 2, at(5))],
                                   "assignment_id int, delivery_id int, rider_id int, offered_at timestamp_ntz")
    zones = spark.createDataFrame([(70, "A"), (71, None)], "delivery_id int, zone string")
    assert [(x.assignment_id, x.n_zone) for x in offers_outside_zone(offers, r, d, zones).collect()] == [(1, 1)]


def test_sides_of_the_sweep_are_computed_once(spark):
    """The answer reads kept rows: no delivery is joined or ordered again by it."""
    t = tables(spark, *cases(4))
    calls = spark.sparkContext.accumulator(0)
    seen = F.udf(lambda x: (calls.add(1), x)[1], "int").asNondeterministic()
    deliveries, requests = t[1].withColumn("rider_id", seen("rider_id")), t[2].withColumn("request", seen("request"))
    answers(free_riders(requests, t[0], deliveries))
    assert calls.value == t[1].count() + t[2].count()
