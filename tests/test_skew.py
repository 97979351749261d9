"""A hot key (every row on one rider): the bucketed operators must equal a plain
single-partition window, with time buckets and with per-key quantile buckets."""

import pytest
from pyspark.sql import Window, functions as F

from dispatchkit.operators import windows
from dispatchkit.plans import fixtures

from conftest import SF_SMALL


def _hot(spark):
    d = fixtures.qc(spark, SF_SMALL, "deliveries")
    return d.withColumn("rider_id", F.when(F.col("rider_id").isNotNull(), F.lit(1).cast("long")))


def test_overlaps_on_one_hot_key(spark):
    d = _hot(spark).filter(F.col("rider_id").isNotNull() & F.col("delivery_started_at").isNotNull()
                           & F.col("delivered_at").isNotNull())
    w = Window.partitionBy("rider_id").orderBy("delivery_started_at", "delivery_id")
    ref_adj = d.withColumn("pe", F.lag("delivered_at").over(w)).filter(F.col("delivery_started_at") < F.col("pe"))
    ref_run = d.withColumn("m", F.max("delivered_at").over(w.rowsBetween(Window.unboundedPreceding, -1))) \
        .filter(F.col("delivery_started_at") < F.col("m"))
    want_adj = {r.delivery_id for r in ref_adj.collect()}
    want_run = {r.delivery_id for r in ref_run.collect()}
    assert want_adj and want_run
    for bucketing in ("time", "quantile"):
        adj = windows.interval_overlaps(d, "rider_id", "delivery_started_at", "delivered_at", "delivery_id",
                                        "adjacent", bucketing=bucketing)
        run = windows.interval_overlaps(d, "rider_id", "delivery_started_at", "delivered_at", "delivery_id",
                                        "running_max", bucketing=bucketing)
        assert {r.current_id for r in adj.collect()} == want_adj, bucketing
        assert {r.current_id for r in run.collect()} == want_run, bucketing


def test_available_at_on_one_hot_key(spark):
    d = _hot(spark).filter(F.col("rider_id").isNotNull() & F.col("delivery_started_at").isNotNull()) \
        .select("rider_id", "delivery_id", "delivery_started_at", "delivered_at")
    w = Window.partitionBy("rider_id").orderBy("delivery_started_at", "delivery_id") \
        .rowsBetween(Window.unboundedPreceding, -1)
    want = d.withColumn("available_at", F.max("delivered_at").over(w))
    for bucketing in ("time", "quantile"):
        got = windows.available_at(d, "rider_id", ["delivery_started_at", "delivery_id"], "delivered_at",
                                   bucketing=bucketing)
        assert got.exceptAll(want.select(*got.columns)).count() == 0, bucketing
        assert want.select(*got.columns).exceptAll(got).count() == 0, bucketing


def test_quantile_buckets_split_the_hot_key(spark):
    from dispatchkit.operators.ordered import quantile_bucket
    d = _hot(spark).filter(F.col("rider_id").isNotNull() & F.col("delivery_started_at").isNotNull())
    b = quantile_bucket(d, "rider_id", "delivery_started_at", n=8)
    sizes = [r["count"] for r in b.groupBy("_qbucket").count().collect()]
    assert len(sizes) >= 6 and max(sizes) <= 2 * d.count() / 8


def test_asof_splits_one_dense_day_of_one_key(spark):
    """Every row on one key and one day: the answer is that of the plain day bucket and of brute force."""
    from dispatchkit.operators.ordered import adaptive_bucket, asof_latest
    at = lambda c: (F.lit("2024-03-01").cast("timestamp_ntz") + F.make_dt_interval(secs=c.cast("decimal(18,6)")))
    probe = spark.range(4000).select(F.col("id").alias("probe_id"), F.lit(1).alias("k"), at(F.col("id") * 7919 % 86400).alias("pt"))
    probe = probe.unionByName(spark.createDataFrame([(9000, 1, None), (9001, None, None), (9002, 2, None)],
                                                    "probe_id long, k int, pt timestamp_ntz"))
    build = spark.range(500).select(F.col("id").alias("bid"), F.lit(1).alias("k"), at(F.col("id") * 104729 % 80000 + 3000).alias("bt"),
                                    (F.col("id") * 3).alias("v"))
    plain = asof_latest(probe, build, "k", "pt", "bt", "bid", ["v"])
    split = asof_latest(probe, build, "k", "pt", "bt", "bid", ["v"], most_per_bucket=200)
    got = {r.probe_id: (r.bid, r.v, r.asof_match) for r in split.collect()}
    assert got == {r.probe_id: (r.bid, r.v, r.asof_match) for r in plain.collect()} and len(got) == 4003
    rows = sorted((r.bt, r.bid, r.v) for r in build.collect())
    for r in probe.filter("pt is not null").collect():
        before = [x for x in rows if x[0] <= r.pt]
        want = before[-1] if before else rows[0]
        assert got[r.probe_id] == (want[1], want[2], "LATEST" if before else "EARLIEST")
    both = probe.select("k", F.col("pt").alias("t")).unionByName(build.select("k", F.col("bt").alias("t")))
    sizes = [r["count"] for r in adaptive_bucket(both, "k", "t", 86400, 200, "b").filter("b is not null").groupBy("k", "b").count().collect()]
    assert len(sizes) >= 20 and max(sizes) <= 400
    assert adaptive_bucket(both, "k", "t", 86400, 10_000, "b").filter("b is not null").select("b").distinct().count() == 1


@pytest.mark.parametrize("text", [False, True])
def test_first_accepted_offer_of_hot_keys(spark, text):
    """A third of the offers on NULL, a third on -1; repeated and missing sequence ids."""
    import random
    from dispatchkit.operators.windows import accepted_attempt
    rng = random.Random(4)
    seqs = [(f"AS-{i:07d}" if text else i) for i in range(900)]
    rows = [(rng.choice([None, None, -1, -1, *range(8)]), rng.choice([s, s, s, seqs[max(0, i - 1)]]), i % 7,
             rng.choice(["ACCEPTED"] + ["REJECTED"] * 30), None) for i, s in enumerate(seqs)]
    rows += [(-1, None, 3, "ACCEPTED", None), (77, None, 3, "ACCEPTED", None), (78, seqs[5], 3, None, None)]
    df = spark.createDataFrame(rows, f"delivery_id long, assignment_id {'string' if text else 'long'}, rider_id long, response string, responded_at timestamp_ntz")
    got = {r.delivery_id: (r.n_offers, r.accepted_assignment_id, r.accepted_rider_id, r.offers_after_accept)
           for r in accepted_attempt(df.repartition(5), width=16, prefix=9).collect()}
    want = {}
    for key in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == key]
        first = min(((s, rider) for _, s, rider, how, _ in mine if how == "ACCEPTED" and s is not None), default=(None, None))
        after = 0 if first[0] is None else sum(s is not None and s > first[0] for _, s, *_ in mine)
        want[key] = (len(mine), *first, after)
    assert got == want


def test_offers_and_keys_are_shuffled_once(spark):
    import __spark_entry__ as E
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        # accepted_attempt: offers on (key, range), partial rows on key; fk_orphans: two per parent table
        for key, most in (("accepted_attempt", 2), ("fk_orphans", 12)):
            plan = E.queries()[key](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning") <= most, key
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
