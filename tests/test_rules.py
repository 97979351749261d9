"""Rule semantics on hand-made rows (FIXTURES part A, "cases that need care")."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from dispatchkit.operators import aggs, joins, lifecycle, windows
from dispatchkit.operators.ordered import asof_latest
from dispatchkit.plans import fixtures
from dispatchkit.quality import suite
from dispatchkit.quality.rules import RULES
from dispatchkit.sources import io

from conftest import SF_SMALL

T = dt.datetime


@pytest.fixture(scope="module")
def schemas(spark):
    from pyspark.sql import types as TT
    out = {}
    for n in fixtures.BUILDERS:
        if n != "zones":
            sch = fixtures.qc_plan(spark, SF_SMALL, n).schema
            out[n] = TT.StructType([TT.StructField(f.name, f.dataType, True) for f in sch.fields])
    return out


def table(spark, schemas, name, rows: list[dict]):
    sch = schemas[name]
    data = [tuple(r.get(f.name) for f in sch.fields) for r in rows]
    return spark.createDataFrame(data, sch)


def state(spark, schemas, **rows):
    return {n: table(spark, schemas, n, rows.get(n, [])) for n in schemas}


def counts(v):
    return {r["rule_id"]: r["n"] for r in v.groupBy("rule_id").agg(F.count(F.lit(1)).alias("n")).collect()}


def test_hundred_rules():
    assert len(RULES) == 100 and len({r.rule_id for r in RULES}) == 100


def test_missing_and_repeated_keys(spark, schemas):
    st = state(spark, schemas, customers=[{"customer_id": None}, {"customer_id": None}, {"customer_id": 7},
                                          {"customer_id": 7}, {"customer_id": 7}])
    c = counts(suite.validate(st))
    assert c.get("UQ-01") == 2 and c.get("UQ-11") == 2


def test_mandatory_vs_optional_fk(spark, schemas):
    st = state(spark, schemas,
               orders=[{"order_id": 1, "customer_id": None, "status": "CREATED"}],
               deliveries=[{"delivery_id": 5, "fulfilment_unit_id": None, "rider_id": None, "status": "REQUESTED"}])
    c = counts(suite.validate(st))
    assert c.get("FK-01") == 1            # mandatory empty key is reported
    assert c.get("FK-06") == 1
    assert "FK-07" not in c               # optional empty key is not


def test_chain_skips_missing_and_allows_equal(spark, schemas):
    st = state(spark, schemas, fulfilment_units=[
        {"fulfilment_unit_id": 1, "status": "PICKING", "assigned_to_store_at": T(2026, 1, 1, 11, 0),
         "picking_completed_at": T(2026, 1, 1, 10, 59)},
        {"fulfilment_unit_id": 2, "status": "PICKING", "assigned_to_store_at": T(2026, 1, 1, 11, 0),
         "picking_started_at": T(2026, 1, 1, 11, 0)}])
    v = suite.validate(st).filter(F.col("rule_id") == "FU-01").collect()
    assert [(r.entity_id, r.column) for r in v] == [("1", "assigned_to_store_at>picking_completed_at")]


def test_overlap_modes(spark):
    base = T(2026, 1, 1)
    rows = [(1, 10, base, base + dt.timedelta(seconds=100)),
            (1, 11, base + dt.timedelta(seconds=10), base + dt.timedelta(seconds=20)),
            (1, 12, base + dt.timedelta(seconds=30), base + dt.timedelta(seconds=40)),
            (2, 20, base, base + dt.timedelta(seconds=10)),
            (2, 21, base + dt.timedelta(seconds=10), base + dt.timedelta(seconds=20))]   # start = previous end: fine
    df = spark.createDataFrame(rows, "rider_id long, delivery_id long, s timestamp_ntz, e timestamp_ntz")
    assert windows.interval_overlaps(df, "rider_id", "s", "e", "delivery_id", "adjacent").count() == 1
    assert windows.interval_overlaps(df, "rider_id", "s", "e", "delivery_id", "running_max").count() == 2


def test_overlap_across_day_buckets(spark):
    # a long interval carries over into later buckets through the per-bucket summary
    rows = [(1, 1, T(2026, 1, 1, 23, 0), T(2026, 1, 3, 1, 0)), (1, 2, T(2026, 1, 2, 5, 0), T(2026, 1, 2, 6, 0)),
            (1, 3, T(2026, 1, 3, 0, 30), T(2026, 1, 3, 0, 45))]
    df = spark.createDataFrame(rows, "rider_id long, delivery_id long, s timestamp_ntz, e timestamp_ntz")
    adj = {r.current_id for r in windows.interval_overlaps(df, "rider_id", "s", "e", "delivery_id", "adjacent").collect()}
    run = {r.current_id for r in windows.interval_overlaps(df, "rider_id", "s", "e", "delivery_id", "running_max").collect()}
    assert adj == {2} and run == {2, 3}


@pytest.mark.parametrize("n_events,violation", [(0, True), (1, False), (2, True)])
def test_accepted_exactly_one_event(spark, schemas, n_events, violation):
    st = state(spark, schemas,
               rider_assignments=[{"assignment_id": 1, "delivery_id": 5, "rider_id": 9, "response": "ACCEPTED",
                                   "offered_at": T(2026, 1, 1), "responded_at": T(2026, 1, 1, 0, 1)}],
               operational_events=[{"event_id": 100 + i, "event_type": "RIDER_ASSIGNED", "occurred_at": T(2026, 1, 1),
                                    "delivery_id": 5, "rider_id": 9} for i in range(n_events)])
    assert ("AE-01" in counts(suite.validate(st))) == violation


def test_null_safe_match(spark):
    acc = spark.createDataFrame([(1, None, None)], "assignment_id long, delivery_id long, rider_id long")
    ev = spark.createDataFrame([(None, None)], "delivery_id long, rider_id long")
    assert joins.exactly_one_match(acc, ev, ["delivery_id", "rider_id"], "assignment_id").count() == 0


@pytest.mark.parametrize("statuses,expected", [
    (["COMPLETED", "CANCELLED", "FAILED"], ("CANCELLED", "NO_STOCK")),
    (["COMPLETED", "PICKING"], ("FULFILLING", None)),
    (["COMPLETED", "COMPLETED"], ("DELIVERED", None)),
    (["COMPLETED", "FAILED"], ("FAILED", "F2")),
    ([], ("FAILED", "NO_FULFILMENT")),
])
def test_order_rollup(spark, schemas, statuses, expected):
    units = [{"fulfilment_unit_id": i + 1, "order_id": 1, "status": s,
              "cancellation_reason": "NO_STOCK" if s == "CANCELLED" else None,
              "failure_reason": f"F{i + 1}" if s == "FAILED" else None} for i, s in enumerate(statuses)]
    o = table(spark, schemas, "orders", [{"order_id": 1, "status": "CREATED"}])
    u = table(spark, schemas, "fulfilment_units", units)
    r = aggs.order_status_rollup(o, u).first()
    reason = r.cancellation_reason if expected[0] == "CANCELLED" else r.failure_reason
    assert (r.status, reason) == expected


def test_asof_latest_earliest_and_exact(spark):
    snaps = spark.createDataFrame([(1, 10, T(2026, 1, 1, 10)), (1, 11, T(2026, 1, 1, 12)), (1, 12, T(2026, 1, 1, 12))],
                                  "store_id long, sid long, recorded_at timestamp_ntz")
    probe = spark.createDataFrame([(100, 1, T(2026, 1, 1, 9)), (101, 1, T(2026, 1, 1, 12)), (102, 1, T(2026, 1, 5)),
                                   (103, 2, T(2026, 1, 1)), (104, 1, None)],
                                  "uid long, store_id long, t timestamp_ntz")
    got = {r.uid: (r.sid, r.asof_match) for r in
           asof_latest(probe, snaps, "store_id", "t", "recorded_at", "sid", ["recorded_at"]).collect()}
    assert got == {100: (10, "EARLIEST"), 101: (12, "LATEST"), 102: (12, "LATEST"), 103: (None, None),
                   104: (None, None)}


def test_delivered_without_events_misses_five(spark, schemas):
    st = state(spark, schemas, deliveries=[{"delivery_id": 5, "fulfilment_unit_id": 1, "status": "DELIVERED",
                                            "rider_id": 9}])
    c = counts(suite.validate(st))
    assert all(c.get(f"EV-0{i}") == 1 for i in range(1, 6)) and "EV-06" not in c


def test_clean_state_has_no_violation(spark, schemas):
    t0 = T(2026, 8, 15, 11, 0)
    s = lambda n: t0 + dt.timedelta(seconds=n)
    st = state(spark, schemas,
               customers=[{"customer_id": 1, "zone_id": "BLR-CEN"}],
               stores=[{"store_id": 1, "zone": "BLR-CEN", "status": "ACTIVE", "baseline_capacity": 120}],
               riders=[{"rider_id": 1, "home_zone": "BLR-CEN", "status": "ACTIVE"}],
               orders=[{"order_id": 1, "customer_id": 1, "created_at": t0, "payment_success_at": s(20),
                        "status": "DELIVERED"}],
               fulfilment_units=[{"fulfilment_unit_id": 1, "order_id": 1, "store_id": 1, "status": "COMPLETED",
                                  "assigned_to_store_at": s(80), "picking_started_at": s(180),
                                  "picking_completed_at": s(360), "packing_started_at": s(390),
                                  "packing_completed_at": s(480), "completed_at": s(1500)}],
               order_items=[{"order_item_id": 1, "order_id": 1, "fulfilment_unit_id": 1, "product_id": 1, "quantity": 2}],
               deliveries=[{"delivery_id": 1, "fulfilment_unit_id": 1, "rider_id": 1, "status": "DELIVERED",
                            "rider_arrived_at_store": s(780), "picked_up_at": s(810), "delivery_started_at": s(840),
                            "delivered_at": s(1500)}],
               rider_assignments=[{"assignment_id": 1, "delivery_id": 1, "rider_id": 1, "offered_at": s(540),
                                   "responded_at": s(580), "response": "ACCEPTED"}],
               store_staffing=[{"staffing_snapshot_id": 1, "store_id": 1, "recorded_at": t0, "pickers_scheduled": 4,
                                "pickers_available": 4, "packers_scheduled": 2, "packers_available": 2}])
    ev = lifecycle.events_from_state(st["orders"], st["fulfilment_units"], st["deliveries"], st["rider_assignments"])
    st["operational_events"] = ev.select(*schemas["operational_events"].fieldNames())
    assert suite.validate(st).count() == 0


def test_csv_text_timestamps_are_checked(spark, schemas, tmp_path):
    p = str(tmp_path / "orders.csv")
    with open(p, "w") as f:
        f.write("order_id,customer_id,created_at,payment_success_at,delivery_latitude,delivery_longitude,"
                "delivery_zone,status,cancelled_at,cancellation_reason,failure_reason\n")
        f.write("ORD-1,CUS-1,2026-08-15 11:00:00,15-08-2026 11:01,12.9,77.5,BLR-CEN,DELIVERED,,,\n")
        f.write("ORD-2,CUS-1,2026-08-15 11:00:00,not a time,12.9,77.5,BLR-CEN,CREATED,,,\n")
    text = io.scan_csv_text(spark, p, "orders")
    v = suite.row_local(text, "orders").collect()
    assert [(r.rule_id, r.entity_id) for r in v] == [("TS-02", "ORD-2")]
    typed = io.scan_csv_typed(spark, p, "orders", keep_raw=True).collect()
    assert typed[0].payment_success_at == T(2026, 8, 15, 11, 1) and typed[1].payment_success_at is None
    assert [(u.column, u.text) for u in typed[1]._unconverted] == [("payment_success_at", "not a time")]


def exchanges(df) -> int:
    """Shuffles of a plan, reused ones not counted."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum("Exchange " in line and "ReusedExchange" not in line and "BroadcastExchange" not in line for line in plan.splitlines())


@pytest.fixture()
def shuffled_only(spark):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


def test_the_suite_shuffles_twice_per_key(spark, shuffled_only):
    assert exchanges(suite.validate(fixtures.registry(spark, SF_SMALL))) <= 20


def test_keyed_rules_equal_their_operators(spark):
    """The co-partitioned passes against the one-rule operators, per rule."""
    t = fixtures.registry(spark, SF_SMALL)
    got = {k: v for k, v in counts(suite.validate(t)).items()}
    for rid, child, column, parent, key, optional in suite.FOREIGN_KEYS:
        assert got.get(rid, 0) == joins.fk_orphans(t[child], t[parent], column, key, optional).count(), rid
    assert got.get("OWN-01", 0) == joins.ownership_mismatch(t["order_items"], t["fulfilment_units"]).count()
    assert got.get("COV-01", 0) == joins.coverage_gap(t["fulfilment_units"], t["order_items"], "fulfilment_unit_id").count()
    mismatch = joins.state_mismatch(t["deliveries"], t["fulfilment_units"]).count()
    assert sum(got.get(f"SM-0{i}", 0) for i in (1, 2, 3)) == mismatch
    found = t["deliveries"].join(t["fulfilment_units"].select("fulfilment_unit_id"), "fulfilment_unit_id", "left_semi")
    assert got.get("SM-04", 0) == joins.accepted_rider_check(found, t["rider_assignments"]).count()
    missing = lifecycle.missing_events(t["deliveries"], t["operational_events"]).count()
    assert sum(got.get(f"EV-0{i}", 0) for i in range(1, 7)) == missing


def test_keyed_rules_on_missing_keys_repeated_parents_and_hot_keys(spark, schemas):
    """Rows without a key, repeated parents (the last one counts) and one key with most of the rows."""
    t0 = T(2024, 1, 1)
    units = [{"fulfilment_unit_id": 1, "order_id": 7, "status": "FAILED", "assigned_to_store_at": t0},
             {"fulfilment_unit_id": 1, "order_id": 8, "status": "COMPLETED", "assigned_to_store_at": T(2024, 1, 2)},
             {"fulfilment_unit_id": None, "order_id": 8, "status": "CREATED"}, {"fulfilment_unit_id": 2, "order_id": 8}]
    st = state(spark, schemas, fulfilment_units=units,
               order_items=[{"order_item_id": i, "fulfilment_unit_id": 1, "order_id": 8} for i in range(500)]
               + [{"order_item_id": 900, "fulfilment_unit_id": None, "order_id": 8}, {"order_item_id": 901, "fulfilment_unit_id": 1, "order_id": None},
                  {"order_item_id": 902, "fulfilment_unit_id": 1, "order_id": 7}, {"order_item_id": 903, "fulfilment_unit_id": 99, "order_id": 7}],
               deliveries=[{"delivery_id": 5, "fulfilment_unit_id": 1, "rider_id": 3, "status": "DELIVERED"},
                           {"delivery_id": None, "fulfilment_unit_id": 1, "rider_id": 3, "status": "FAILED"},
                           {"delivery_id": 6, "fulfilment_unit_id": None, "rider_id": 3, "status": "DELIVERED"}],
               rider_assignments=[{"assignment_id": 1, "delivery_id": 5, "rider_id": 3, "response": "ACCEPTED"},
                                  {"assignment_id": 2, "delivery_id": None, "rider_id": 3, "response": "ACCEPTED"},
                                  {"assignment_id": 3, "delivery_id": None, "rider_id": None, "response": "ACCEPTED"}],
               operational_events=[{"event_id": 1, "event_type": "RIDER_ASSIGNED", "delivery_id": 5, "rider_id": 3},
                                   {"event_id": 2, "event_type": "RIDER_ASSIGNED", "delivery_id": None, "rider_id": 3}])
    c = counts(suite.validate(st))
    assert (c["FK-05"], c["OWN-01"], c["COV-01"], c["FK-06"]) == (2, 2, 2, 1)
    assert (c["SM-03"], c["SM-04"], c["AE-01"]) == (1, 1, 1) and "SM-01" not in c
    assert (c["EV-01"], c["EV-05"], c["EV-06"], c["FK-08"]) == (1, 2, 1, 2)
