"""Operators on text ids, repeated parents and event numbers past the key width."""

import datetime as dt

from pyspark.sql import functions as F

from dispatchkit.operators import aggs, joins, lifecycle
from dispatchkit.operators.ordered import asof_latest
from dispatchkit.plans import fixtures

from conftest import SF_SMALL

TEXT = {"order_id": "ORD", "fulfilment_unit_id": "FU", "delivery_id": "DEL", "store_id": "STO", "rider_id": "RID",
        "assignment_id": "ASG", "customer_id": "CUS", "order_item_id": "ITM", "staffing_snapshot_id": "STF", "event_id": "EVT"}


def as_text(df):
    """Every id as text that sorts like its number."""
    return df.select(*[F.when(F.col(c) >= 0, F.concat(F.lit(TEXT[c] + "-"), F.lpad(F.col(c).cast("string"), 12, "0")))
                       .when(F.col(c).isNotNull(), F.concat(F.lit(TEXT[c] + "!"), F.col(c).cast("string"))).alias(c)
                       if c in TEXT else F.col(c) for c in df.columns])


def rows(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


def tables(spark):
    return {t: fixtures.qc(spark, SF_SMALL, t) for t in ("orders", "fulfilment_units", "deliveries", "rider_assignments",
                                                         "store_staffing", "operational_events", "stores", "riders")}


def test_operators_give_the_same_answer_on_text_ids(spark):
    t = tables(spark)
    x = {k: as_text(v) for k, v in t.items()}
    state = ("orders", "fulfilment_units", "deliveries", "rider_assignments")
    a, b = (lifecycle.event_union(*[s[k] for k in state]).drop("source_id") for s in (t, x))
    assert rows(as_text(a)) == rows(b)
    a, b = (lifecycle.events_from_state(*[s[k] for k in state]).filter("occurred_at is not null").groupBy("event_type")
            .agg(F.count("*"), F.min("event_id")) for s in (t, x))
    assert a.count() == b.count() > 10
    pick = ["pickers_available", "pickers_scheduled"]
    a, b = (asof_latest(s["fulfilment_units"].select("fulfilment_unit_id", "store_id", "picking_started_at"), s["store_staffing"],
                        "store_id", "picking_started_at", "recorded_at", "staffing_snapshot_id", pick) for s in (t, x))
    assert rows(as_text(a)) == rows(b)
    a, b = (aggs.fulfilments_by_order(s["fulfilment_units"]) for s in (t, x))
    assert rows(as_text(a)) == rows(b)
    keys = {"order_id": "orders", "store_id": "stores", "rider_id": "riders"}
    a, b = (joins.fk_orphans_multi(s["operational_events"], "event_id", {c: s[p].select(c) for c, p in keys.items()}) for s in (t, x))
    assert a.count() == b.count() > 0
    got = joins.pick_from_groups(x["orders"].select("order_id", F.lit("z").alias("zone")), "order_id", "zone",
                                 joins.indexed_candidates(x["stores"].select("store_id", F.lit("z").alias("g")), "g", "store_id"), "g", k=2)
    per = got.groupBy("order_id").agg(F.count("*").alias("n"), F.countDistinct("store_id").alias("d")).collect()
    assert len(per) == x["orders"].select("order_id").distinct().count() and all(r.n >= r.d >= 2 for r in per)


def test_latest_state_past_the_key_width(spark):
    t = dt.datetime(2024, 1, 1)
    ev = spark.createDataFrame([("EVT-9999999", "PICKED_UP", t, "D"), ("EVT-10000000", "DELIVERY_STARTED", t, "D")],
                               "event_id string, event_type string, occurred_at timestamp_ntz, delivery_id string") \
        .withColumn("reason", F.lit(None).cast("string"))
    assert lifecycle.state_from_events(ev, "delivery").first().status == "IN_TRANSIT"


def test_repeated_parents_do_not_multiply_rows(spark):
    t = [dt.datetime(2024, 1, 1, h) for h in range(3)]
    units = spark.createDataFrame([("U", "O1", "PICKING", t[0]), ("U", "O1", "PACKING", t[1]), ("U", "O2", "COMPLETED", t[2])],
                                  "fulfilment_unit_id string, order_id string, status string, assigned_to_store_at timestamp_ntz")
    items = spark.createDataFrame([("I", "U", "O2")], "order_item_id string, fulfilment_unit_id string, order_id string")
    deliveries = spark.createDataFrame([("D", "U", "DELIVERED")], "delivery_id string, fulfilment_unit_id string, status string")
    assert joins.ownership_mismatch(items, units).count() == 0
    assert joins.state_mismatch(deliveries, units).count() == 0
    assert joins.lookup_strict(deliveries, units, "fulfilment_unit_id", ["order_id"]).count() == 1


def test_null_groups_have_positions(spark):
    units = spark.createDataFrame([(None, 1), (None, 2), (5, 3)], "order_id long, fulfilment_unit_id long")
    got = {r.fulfilment_unit_id: (r.position, r.n_units) for r in aggs.fulfilments_by_order(units).collect()}
    assert got == {1: (1, 2), 2: (2, 2), 3: (1, 1)}
    assert aggs.duplicate_keys(spark.createDataFrame([(None, 1), (None, 1), (1, 1), (1, 1)], "a int, b int"), ["a", "b"]).collect() == [(1, 1, 2, 1)]


def test_canonical_text_in_a_zone_with_clock_changes(spark):
    from dispatchkit.functions.timestamps import format_ts
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("SELECT timestamp_ntz'2024-03-10 02:30:00.123' AS t")
        assert df.select(format_ts("t")).first()[0] == "2024-03-10 02:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
