"""Sources and sinks: CSV round trip, publication gate, input checks, conformance."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from dispatchkit.plans import fixtures
from dispatchkit.quality import rules, suite
from dispatchkit.quality.keys import UNIQUE_ORDER
from dispatchkit.session import scratch_path
from dispatchkit.sources import io

from conftest import SF_SMALL


def test_csv_round_trip_keeps_values(spark):
    d = fixtures.qc(spark, SF_SMALL, "deliveries")
    path = scratch_path(spark, "t-csv")
    io.write_csv_ordered(d, path, "deliveries")
    back = io.scan_csv_typed(spark, path, "deliveries")
    assert back.columns == io.columns("deliveries")
    want = d.select(*[F.col(c).cast("string").alias(c) if c in ("delivery_id", "fulfilment_unit_id", "rider_id")
                      else F.col(c) for c in io.columns("deliveries")])
    assert back.exceptAll(want).count() == 0 and want.exceptAll(back).count() == 0
    # missing values are written as empty fields, not as ""
    text = spark.read.text(path).filter(F.col("value").contains('""')).count()
    assert text == 0


def clean_tables(spark):
    """Ten tables with one delivered order that breaks no rule, in declared columns."""
    t0 = dt.datetime(2024, 3, 1, 10)
    at = lambda m: t0 + dt.timedelta(minutes=m)
    ids = {"customer_id": "CUS-1", "store_id": "STO-1", "rider_id": "RID-1", "order_id": "ORD-1", "fulfilment_unit_id": "FU-1",
           "order_item_id": "ITM-1", "delivery_id": "DEL-1", "assignment_id": "ASG-1", "staffing_snapshot_id": "STF-1"}
    values = {
        "orders": {"created_at": at(0), "payment_success_at": at(1), "status": "DELIVERED"},
        "fulfilment_units": {"status": "COMPLETED", "assigned_to_store_at": at(2), "picking_started_at": at(3), "completed_at": at(30)},
        "order_items": {"quantity": 2},
        "deliveries": {"status": "DELIVERED", "rider_arrived_at_store": at(10), "picked_up_at": at(11), "delivery_started_at": at(12),
                       "delivered_at": at(29)},
        "rider_assignments": {"response": "ACCEPTED", "offered_at": at(5), "responded_at": at(6)},
        "store_staffing": {"recorded_at": at(0), "pickers_scheduled": 3, "pickers_available": 2}}
    out = {}
    for t in UNIQUE_ORDER:
        row = {**{c: ids[c] for c in io.columns(t) if c in ids}, **values.get(t, {})}
        rows = [row]
        if t == "operational_events":
            rows = [{**row, "event_id": f"EVT-{i}", "event_type": e, "occurred_at": at(i)} for i, e in enumerate(rules.DELIVERED_EVENTS)]
        out[t] = spark.createDataFrame([tuple(r.get(c) for c in io.columns(t)) for r in rows], io.struct_type(t))
    return out


def test_publish_needs_all_rules_all_tables_and_no_error(spark):
    t = fixtures.registry(spark, SF_SMALL)
    target = scratch_path(spark, "t-pub")
    res = io.publish_gated(spark, t, suite.validate(t), target)
    assert res["passed"] is False and res["published"] is False and res["n_errors"] > 0
    clean = clean_tables(spark)
    broken = [{"stores": clean["stores"]},                                                 # tables missing
              {**clean, "deliveries": clean["deliveries"].drop("picked_up_at")},           # a column missing
              {**clean, "stores": clean["stores"].withColumn("note", F.lit("x"))}]         # an undeclared column
    for tables in broken:
        res = io.publish_gated(spark, tables, suite.validate(tables), target)
        assert res["n_errors"] == 0 and res["passed"] is False and res["published"] is False
        assert res["not_evaluated"] or res["schema_issues"]
    assert not io.path_exists(spark, f"{target}/_CURRENT")
    lacking = suite.not_evaluated(broken[1])
    assert "DL-01" in lacking and "DL-02" in lacking and "DL-06" in lacking and "DL-04" not in lacking
    shown = {r.rule_id: (r.evaluated, r.n_violations) for r in suite.summary(suite.validate(broken[1]), broken[1]).collect()}
    assert shown["DL-01"] == (False, None) and shown["DL-04"] == (True, 0)


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_clean_tables_are_published_in_declared_columns(spark, fmt):
    clean = clean_tables(spark)
    shuffled = {t: df.select(*reversed(df.columns)) for t, df in clean.items()}
    target = scratch_path(spark, "t-pub-clean")
    paths = []
    for _ in range(2):                                         # a second run switches the pointer
        res = io.publish_gated(spark, shuffled, suite.validate(shuffled), target, fmt, {"deliveries": ["status"]})
        assert res["published"], res
        paths.append(io.read_pointer(spark, f"{target}/_CURRENT"))
    assert paths[0] != paths[1] == res["run_path"]
    for t, df in clean.items():
        back = io.scan_csv_typed(spark, f"{paths[1]}/{t}", t) if fmt == "csv" else spark.read.parquet(f"{paths[1]}/{t}")
        assert sorted(map(str, back.select(*df.columns).collect())) == sorted(map(str, df.collect())), t


def test_csv_is_bound_by_header_and_bad_text_is_kept(spark):
    path = scratch_path(spark, "t-header")
    spark.createDataFrame([("x", "7", "ORD-1"), ("y", "abc", "ORD-2"), ("", "", "ORD-3")], "product_id string, quantity string, order_id string") \
        .write.option("header", "true").csv(path)
    assert io.header_issues(spark, path, "order_items") == [("order_items", "order_item_id", "missing"),
                                                            ("order_items", "fulfilment_unit_id", "missing")]
    got = {r.order_id: r for r in io.scan_csv_typed(spark, path, "order_items", keep_raw=True).collect()}
    assert (got["ORD-1"].quantity, got["ORD-1"].product_id, got["ORD-1"].order_item_id) == (7, "x", None)
    assert got["ORD-2"].quantity is None and [(u.column, u.text) for u in got["ORD-2"]._unconverted] == [("quantity", "abc")]
    assert got["ORD-3"].product_id is None and got["ORD-3"]._unconverted == []
    with pytest.raises(Exception, match="quantity does not convert"):
        io.scan_csv_typed(spark, path, "order_items").collect()


def test_require_datasets_names_every_missing_input(spark):
    paths = {"orders": f"{SF_SMALL}/orders.parquet", "nope1": "/nonexistent/a", "nope2": "/nonexistent/b"}
    with pytest.raises(FileNotFoundError) as e:
        io.require_datasets(spark, paths)
    assert "nope1" in str(e.value) and "nope2" in str(e.value) and "orders" not in str(e.value)


def test_schema_conformance(spark):
    df = spark.createDataFrame([("1", "x", "BLR-CEN", 1.0)], "store_id string, extra string, zone string, latitude double")
    issues = {(c, i) for _, c, i, _, _ in io.schema_conformance(df, "stores")}
    assert ("extra", "extra") in issues and ("store_name", "missing") in issues
    assert ("longitude", "missing") in issues
    ok = spark.createDataFrame([], io.struct_type("stores"))
    assert io.schema_conformance(ok, "stores", check_types=True) == []


def write_lines(folder, **files):
    os.makedirs(folder)
    for name, lines in files.items():
        with open(os.path.join(folder, f"{name}.csv"), "w") as f:
            f.write("".join(line + "\n" for line in lines))


def test_every_file_is_bound_by_its_own_header(spark):
    folder = scratch_path(spark, "t-headers").removeprefix("file:")
    write_lines(folder, a=["store_id,store_name,latitude,longitude,status", "1,one,1.5,2.5,OPEN", '2,"t,w""o",,,'],
                b=["status,longitude,latitude,store_name,store_id", "SHUT,8.5,9.5,seven,7"],
                c=["store_id,note,store_id", "3,x,4"], d=["store_id,store_name"], e=[])
    names = io.columns("stores")
    got = {r.store_id: r for r in io.scan_csv_typed(spark, folder, "stores", keep_raw=True).collect()}
    assert set(got) == {"1", "2", "3", "7"} and all(r["_malformed"] is None and not r["_unconverted"] for r in got.values())
    assert (got["7"].store_name, got["7"].status) == ("seven", "SHUT") and (got["1"].store_name, got["1"].status) == ("one", "OPEN")
    if "latitude" in names:
        assert (got["7"].latitude, got["7"].longitude) == (9.5, 8.5) and got["2"].latitude is None
    assert got["3"].store_name is None and got["3"].status is None
    issues = io.header_issues(spark, folder, "stores")
    assert ("stores", "note", "extra") in issues and ("stores", "store_id", "repeated") in issues and ("stores", "status", "missing") in issues
    assert len(io.csv_headers(spark, folder)) == 4


def test_rows_with_too_few_or_too_many_fields_are_reported(spark):
    folder = scratch_path(spark, "t-odd").removeprefix("file:")
    head = ",".join(io.columns("stores"))
    full = ["1", *[""] * (len(io.columns("stores")) - 1)]
    write_lines(folder, a=[head, ",".join(full), "2", ",".join(["3", *full[1:], "more"])],
                b=[",".join(reversed(io.columns("stores"))), ",".join(reversed(full))])
    odd = sorted((r.line, os.path.basename(r.file)) for r in io.malformed_rows(spark, folder, "stores").collect())
    assert odd == [("2", "a.csv"), (",".join(["3", *full[1:], "more"]), "a.csv")]
    kept = io.scan_csv_typed(spark, folder, "stores", keep_raw=True)
    assert sorted(r.store_id for r in kept.collect()) == ["1", "1", "2", "3"]
    assert kept.filter("_malformed is not null").count() == 2
    with pytest.raises(Exception, match="do not fit the header"):
        io.scan_csv_typed(spark, folder, "stores").count()
    empty = scratch_path(spark, "t-none").removeprefix("file:")
    write_lines(empty, a=[])
    assert io.scan_csv_typed(spark, empty, "stores").count() == 0


def test_only_touched_partitions_are_replaced_and_reads_are_pruned(spark):
    rows = [(i, d) for i, d in enumerate(["2024-01-01", "2024-01-01", "2024-01-02", "2024-01-03"])]
    df = spark.createDataFrame(rows, "id long, day string")
    path = scratch_path(spark, "t-days")
    io.publish_partitions(df, path, "day")
    before = {r.f for r in spark.read.parquet(path).filter("day = '2024-01-01'").select(F.input_file_name().alias("f")).collect()}
    io.publish_partitions(spark.createDataFrame([(9, "2024-01-02")], "id long, day string"), path, "day", ["2024-01-02", "2024-01-03"])
    back = spark.read.parquet(path)
    assert sorted(r.id for r in back.collect()) == [0, 1, 9]
    assert {r.f for r in back.filter("day = '2024-01-01'").select(F.input_file_name().alias("f")).collect()} == before
    plan = back.filter("day = '2024-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_readers_keep_their_snapshot_and_old_runs_are_retired(spark):
    clean = clean_tables(spark)
    target = scratch_path(spark, "t-snap")
    assert io.read_published(spark, target, "stores") is None
    first = io.publish_gated(spark, clean, suite.validate(clean), target, "parquet")
    reader = io.read_published(spark, target, "order_items", "parquet")
    more = {**clean, "order_items": clean["order_items"].withColumn("quantity", F.lit(5).cast(clean["order_items"].schema["quantity"].dataType))}
    second = io.publish_gated(spark, more, suite.validate(more), target, "parquet")
    assert [r.quantity for r in reader.collect()] == [2]
    assert [r.quantity for r in io.read_published(spark, target, "order_items", "parquet").collect()] == [5]
    gone = io.retire_runs(spark, target, 1)
    assert len(gone) == 1 and gone[0].endswith(first["run_path"].rsplit("/", 1)[-1])
    assert io.path_exists(spark, second["run_path"]) and not io.path_exists(spark, first["run_path"])
