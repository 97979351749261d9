"""Global numbers without written rows (own rows)."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from dispatchkit.operators import lifecycle
from dispatchkit.operators.ordered import sequential_number
from dispatchkit.session import ensure_checkpoint_dir

T0 = datetime.datetime(2024, 1, 1)


def folders(spark) -> set[str]:
    return {x for x in os.listdir(ensure_checkpoint_dir(spark).removeprefix("file:")) if x.startswith("numbered-")}


def expected(df, order):
    rows = sorted((tuple((x is not None, x) for x in r) for r in df.select(*order).collect()))
    return [(tuple(x for _, x in r), i) for i, r in enumerate(rows, 1)]


def given(df, order):
    return sorted((((tuple(r[c] for c in order)), r.seq) for r in df.collect()), key=lambda x: x[1])


@pytest.mark.parametrize("n", [1, 5])
def test_rows_are_numbered_by_slices_of_the_first_column_without_a_write(spark, n):
    at = F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id") * 7919 % 2003)
    df = spark.range(3000).select(F.when(F.col("id") % 97 != 0, at).alias("at"), (F.col("id") * 31 % 3000).alias("k"), F.lit("x").alias("text"))
    before = folders(spark)
    numbered = sequential_number(df, ["at", "k"], n_partitions=n)
    assert given(numbered, ["at", "k"]) == expected(df, ["at", "k"]) and numbered.columns == ["at", "k", "text", "seq"]
    assert folders(spark) == before
    assert numbered.rdd.getNumPartitions() == n and max(numbered.rdd.glom().map(len).collect()) < 2 * 3000 / n + 1


@pytest.mark.parametrize("first", ["'same'", "7", "if(id % 3 = 0, null, id)", "concat('t', id % 50)"])
def test_a_first_column_that_does_not_part_the_rows_falls_back_to_all_columns(spark, first):
    df = spark.range(2000).select(F.expr(first).alias("a"), (F.col("id") * 7 % 2000).alias("b"))
    numbered = sequential_number(df, ["a", "b"], n_partitions=4)
    assert given(numbered, ["a", "b"]) == expected(df, ["a", "b"])
    assert max(numbered.rdd.glom().map(len).collect()) < 1500


def test_few_or_no_rows_are_numbered(spark):
    for k in (0, 1, 3):
        df = spark.range(k).select(F.lit(None).cast("long").alias("a"), "id")
        assert [r.seq for r in sequential_number(df, ["a", "id"], n_partitions=6).orderBy("seq").collect()] == list(range(1, k + 1))


def test_events_are_numbered_without_a_write_and_shuffled_without_their_types(spark):
    stages = {"orders": ("order_id", lifecycle.ORDER_STAGES), "units": ("fulfilment_unit_id", lifecycle.UNIT_STAGES),
              "deliveries": ("delivery_id", lifecycle.DELIVERY_STAGES)}
    ids, t = ["order_id", "fulfilment_unit_id", "delivery_id", "store_id", "rider_id"], {}
    for name, (_, times) in stages.items():
        t[name] = spark.range(1, 60).select(*[F.col("id").alias(c) for c in ids], F.lit("r").alias("failure_reason"), F.lit("c").alias("cancellation_reason"),
            F.lit("DELIVERED").alias("status"), *[(F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id") * (i + 3) % 11)).alias(c)
                                                  for i, (c, _) in enumerate(times)])
    offers = spark.range(1, 60).select(F.col("id").alias("assignment_id"), F.col("id").alias("delivery_id"), F.col("id").alias("rider_id"),
                                       F.lit("ACCEPTED").alias("response"), F.lit(T0).cast("timestamp_ntz").alias("responded_at"))
    before = folders(spark)
    got = lifecycle.events_from_state(*t.values(), offers)
    union = lifecycle.event_union(*t.values(), offers).collect()
    union.sort(key=lambda r: (r.occurred_at, lifecycle.EVENT_RANK[r.event_type], r.source_id))
    rows = sorted(got.collect(), key=lambda r: r.event_id)
    assert [tuple(r[1:]) for r in rows] == [tuple(r[c] for c in lifecycle.EVENT_COLUMNS) for r in union] and folders(spark) == before
    assert [r.event_id for r in rows] == [f"EVT-{i:07d}" for i in range(1, len(union) + 1)]
    assert "event_type" not in str(got._jdf.queryExecution().optimizedPlan().toString()).split("RepartitionByExpression")[-1].splitlines()[0]
