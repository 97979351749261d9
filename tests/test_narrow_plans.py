"""Plans of the rule suite over dear columns: no copies of them in filters at the scan, narrow probes (own rows)."""

import datetime

import pytest
from pyspark.sql import functions as F

from dispatchkit.operators import windows
from dispatchkit.quality import keyed, suite

T0 = datetime.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def deliveries(spark, tmp_path_factory):
    """Deliveries whose stage times are computed from a stored number (``n``: seconds, NULL for none)."""
    at = str(tmp_path_factory.mktemp("plans"))
    spark.createDataFrame([(1, 7, 0, 50), (2, 7, 40, 90), (3, 7, None, 95), (4, None, 41, 99), (None, 7, 90, 80)],
                          "delivery_id long, rider_id long, a long, b long").write.parquet(f"{at}/d")
    t0 = F.lit(T0).cast("timestamp_ntz")
    return spark.read.parquet(f"{at}/d").select(
        "delivery_id", "rider_id", F.lit(5).cast("long").alias("fulfilment_unit_id"), F.lit("DELIVERED").alias("status"),
        (t0 + F.make_dt_interval(secs="a")).alias("delivery_started_at"), (t0 + F.make_dt_interval(secs="b")).alias("delivered_at"))


def filters(df) -> list[str]:
    return [x for x in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter " in x]


def test_row_rules_put_no_filter_on_the_rules_at_the_scan(deliveries):
    out = suite.row_local(deliveries, "deliveries")
    assert not [x for x in filters(out) if "make_dt_interval" in x or "size(" in x]
    assert {(r.rule_id, r.entity_id, r.column) for r in out.collect()} == {
        ("UQ-07", None, "delivery_id"), ("DL-03", None, "delivered_at"), ("DL-04", "4", "rider_id"), ("DL-07", "3", "delivery_started_at")}


def test_overlaps_put_no_filter_on_the_times_at_the_scan(deliveries):
    out = windows.interval_overlaps(deliveries, "rider_id", "delivery_started_at", "delivered_at", "delivery_id")
    assert not [x for x in filters(out) if "make_dt_interval" in x]
    assert [(r.rider_id, r.previous_id, r.current_id) for r in out.collect()] == [(7, 1, 2)]


def test_chain_names_the_previous_present_stage(spark):
    cols = ["assigned_to_store_at", "picking_started_at", "picking_completed_at", "packing_started_at", "packing_completed_at", "completed_at"]
    rows = [(1, 0, None, 5, 3, None, 2), (2, None, None, None, None, None, None), (3, None, 9, None, None, 9, 8)]
    df = spark.createDataFrame(rows, "fulfilment_unit_id long, " + ", ".join(f"{c} int" for c in cols)).withColumn("status", F.lit("x"))
    df = df.select("fulfilment_unit_id", "status", *[(F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(secs=c)).alias(c) for c in cols])
    found = [(r.entity_id, r.column) for r in suite.row_local(df, "fulfilment_units").collect() if r.rule_id == "FU-01"]
    assert sorted(found) == [("1", "packing_started_at>completed_at"), ("1", "picking_completed_at>packing_started_at"),
                             ("3", "packing_completed_at>completed_at")]


def test_probes_are_shuffled_with_numbers(spark, deliveries):
    """Ids of probes travel as they are; only rows that break a rule are written as text."""
    offers = spark.createDataFrame([(1, 1), (2, 9), (3, None)], "assignment_id long, delivery_id long")
    out, = keyed.delivery_pass({"deliveries": deliveries, "rider_assignments": offers},
                               {"FK-12", "EV-01", "EV-02", "EV-03", "EV-04", "EV-05", "EV-06"})
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "assignment_id" in plan and plan.index("as string) AS entity_id") < plan.index("Join")
    assert plan.count("as string)") == 1
    assert sorted((r.rule_id, r.entity_id) for r in out.collect()) == [("FK-08", "2"), ("FK-08", "3")]


def test_text_timestamps_are_parsed_once(spark):
    rows = [(1, "2024-01-01 10:00:00", "5-8-2026 3:4"), (2, "soon", ""), (3, None, " "), (4, "2024-13-01 10:00:00", None)]
    df = spark.createDataFrame([(i, 1, "CREATED", a, b) for i, a, b in rows],
                               "order_id long, customer_id long, status string, created_at string, payment_success_at string")
    checked = suite.row_violations(df, "orders")
    plan = checked._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == suite.prepare(df, "orders")._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace")
    assert {(r.order_id, v.rule_id) for r in checked.collect() for v in r._violations if v.rule_id.startswith("TS")} == {
        (2, "TS-01"), (4, "TS-01"), (3, "TS-02")}
