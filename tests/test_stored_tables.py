"""What the derived tables write, how events are numbered, and one store per order (own rows)."""

import datetime

import pytest
from pyspark.sql import functions as F

from dispatchkit.operators.ordered import range_partitions, sequential_number
from dispatchkit.plans import catalog, fixtures


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A small set of supplied tables with a repeated line and an order without lines."""
    at = str(tmp_path_factory.mktemp("raw"))
    day = datetime.datetime(1995, 3, 1)
    rows = {
        "customer": ([(i, i % 25, float(i - 20)) for i in range(60)], "c_custkey long, c_nationkey int, c_acctbal double"),
        "supplier": ([(i, i % 7, float(i - 3)) for i in range(40)], "s_suppkey long, s_nationkey int, s_acctbal double"),
        "orders": ([(i, i % 60, day + datetime.timedelta(days=i % 9)) for i in range(300)],
                   "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz"),
        "lineitem": ([(i, i * 7 % 50, (i * n) % 40, n, 3.0) for i in range(299) for n in (1, 2, 3, 3)],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double"),
    }
    for name, (data, schema) in rows.items():
        spark.createDataFrame(data, schema).write.parquet(f"{at}/{name}.parquet")
    return at


def counted(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("name", ["fulfilment_units", "deliveries", "rider_assignments", "operational_events", "order_items"])
def test_projected_tables_have_the_rows_of_the_inline_plan(spark, tables, name):
    stored = counted(fixtures.qc(spark, tables, name))
    spark.conf.set(fixtures.MATERIALIZE_CONF, "false")
    try:
        assert stored and stored == counted(fixtures.qc(spark, tables, name))
    finally:
        spark.conf.unset(fixtures.MATERIALIZE_CONF)
    names = {n for sf, n, _ in fixtures._MATERIALIZED if sf == tables}
    assert name not in names and names <= {"unit-keys"}


def test_numbered_rows_are_kept_as_columns(spark):
    df = spark.range(500).select(F.pmod(F.col("id") * 37, F.lit(500)).alias("t"), "id")
    numbered = sequential_number(df, ["t"], n_partitions=5)
    assert "ExistingRDD" not in numbered._jdf.queryExecution().executedPlan().toString()
    assert [(r.t + 1, r.seq) for r in numbered.collect() if r.t + 1 != r.seq] == []


def test_partitions_count_the_rows_of_an_unpivot(spark, tmp_path):
    spark.range(20000).write.parquet(f"{tmp_path}/ids")
    df = spark.read.parquet(f"{tmp_path}/ids")
    wide = df.select(F.inline(F.array(*[F.struct((F.col("id") + i).alias("id")) for i in range(10)])))
    one, ten = range_partitions(df, 1024), range_partitions(wide, 1024)
    assert one > int(spark.conf.get("spark.sql.shuffle.partitions")) and 10 * one - 10 <= ten <= 10 * one


def test_store_candidates_name_a_store_for_every_order(spark, tables):
    got = catalog.queries()["store_candidates"](spark, tables).collect()
    active = {r.store_id: r.zone for r in fixtures.qc(spark, tables, "stores").filter("status = 'ACTIVE'").collect()}
    assert len(got) == 300 and {r.pick_no for r in got} == {1}
    for r in got:
        here = [s for s, z in active.items() if z == r.delivery_zone]
        assert r.cand_zone == (r.delivery_zone if here else "*") and r.store_id in (here or active)
    assert len({r.store_id for r in got}) > 5


def test_clean_tables_are_computed_once(spark, tables):
    from dispatchkit.plans import q_sources
    clean = q_sources.clean_part(fixtures.registry(spark, tables))
    for name in ("customers", "stores", "riders", "orders", "store_staffing"):
        plan = clean[name]._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "Aggregate" not in plan, name
    assert clean["orders"].count() > 0


def test_a_unit_is_unpivoted_once(spark, tables):
    plan = fixtures.qc(spark, tables, "operational_events")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate inline") == 2          # one for orders, one for all stages of a unit


def test_last_row_of_one_number_is_a_hash_aggregate(spark):
    from dispatchkit.operators.joins import last_rows
    df = spark.createDataFrame([(1, 5), (1, 7), (1, None), (2, None), (None, 3)], "k long, v long")
    one = last_rows(df, "k", ["v"], ["v"])
    assert "SortAggregate" not in one._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, one.collect()), key=str) == [(1, 7), (2, None), (None, 3)]
    named = spark.createDataFrame([(1, 5, "b"), (1, 7, "a"), (2, None, "c")], "k long, at long, v string")
    two = last_rows(named, "k", ["at", "missing"], ["v"])
    assert "max_by" not in two._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, two.collect())) == [(1, "a"), (2, "c")]


def test_orphans_are_found_among_distinct_ids(spark):
    from dispatchkit.operators.joins import fk_orphans_multi
    child = spark.createDataFrame([(1, 10, 20), (2, 10, 99), (2, 10, 99), (3, None, 20), (4, 98, None)], "id long, a long, b long")
    keys = {"a": spark.createDataFrame([(10,), (10,)], "a long"), "b": spark.createDataFrame([(20,), (None,)], "b long")}
    out = fk_orphans_multi(child, "id", keys)
    assert "Aggregate" in out._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, out.collect())) == [("a", 98, 4), ("b", 99, 2), ("b", 99, 2)]


def test_events_are_shuffled_as_keys_and_unpivoted_in_their_time_slice(spark, tables):
    log = fixtures.qc(spark, tables, "operational_events")
    for n in (1, 6):
        sliced = fixtures.events_in_time_slices(spark, tables, n)
        plan = sliced._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Generate inline") == 1 and plan.index("Generate inline") < plan.index("Repartition")
        assert sliced.schema.simpleString() == log.schema.simpleString() and counted(sliced) == counted(log)
        at = sliced.groupBy(F.spark_partition_id().alias("p")).agg(F.min("occurred_at").alias("a"), F.max("occurred_at").alias("b")).orderBy("p").collect()
        assert len(at) == n and all(x.b < y.a for x, y in zip(at, at[1:]))


def test_key_joins_take_as_many_partitions_as_their_tables_ask_for(spark, tables, tmp_path, monkeypatch):
    from dispatchkit.operators import joins
    spark.range(20000).select("id", (F.col("id") * 2).alias("up")).write.parquet(f"{tmp_path}/ids")
    ids = spark.read.parquet(f"{tmp_path}/ids")
    monkeypatch.setattr(joins, "KEY_PARTITION_BYTES", 4096)
    gap = joins.coverage_gap(ids.select("id"), ids.select("up"), "id", "up")
    assert gap.count() == 10000
    n = range_partitions(ids.select("id").unionByName(ids.select(F.col("up").alias("id"))), 4096)
    assert n > 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert gap._jdf.queryExecution().optimizedPlan().toString().count("RepartitionByExpression [") == 2
    assert f", {n}" in gap._jdf.queryExecution().optimizedPlan().toString()
    # the unit keys are grouped and joined by one shuffle of the lines
    plan = fixtures.unit_keys(spark, tables)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression [l_orderkey") == 1
