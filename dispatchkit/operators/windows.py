"""Window operators and ordered picks (2.6).

Ordered per-key work goes through ``ordered`` (bucketed two-level windows) so a hot key
is split across tasks. Row-local checks (the stage chain) need no window at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .joins import is_number, last_rows
from .ordered import (DEFAULT_BUCKET_SECONDS, asof_latest, dense_rank_index, previous_row, quantile_bucket,
                      running_max_before, sequential_number, time_bucket)


def _bucketed(d: DataFrame, key: str, ts: str, bucketing: str, bucket_seconds: int) -> tuple[DataFrame, Column]:
    """Time buckets (default), or per-key quantile buckets for extreme skew."""
    if bucketing == "quantile":
        return quantile_bucket(d, key, ts), F.col("_qbucket")
    if bucketing == "time":
        return d, time_bucket(ts, bucket_seconds)
    raise ValueError(bucketing)


def interval_overlaps(df: DataFrame, key: str, start: str, end: str, id_col: str, mode: str = "adjacent",
                      bucket_seconds: int = DEFAULT_BUCKET_SECONDS, bucketing: str = "time") -> DataFrame:
    """WN-1: per key, intervals sorted by (start, id); report a row whose start is before
    the previous row's end (``adjacent``, the reference check) or before the latest end
    of all earlier rows (``running_max``, also finds intervals nested in a long one).
    Rows with a missing key, start or end are skipped."""
    # a slot that is empty where something is missing, dropped after ``inline``: a plain filter would be pushed
    # to the scan with a copy of the expressions of all three columns, far dearer than the columns themselves
    whole = F.col(key).isNotNull() & F.col(start).isNotNull() & F.col(end).isNotNull()
    d = df.select(F.inline(F.array(F.when(whole, F.struct(key, start, end, id_col))))).filter(F.col(key).isNotNull())
    d, b = _bucketed(d, key, start, bucketing, bucket_seconds)
    if mode == "adjacent":
        p = previous_row(d, key, [start, id_col], [id_col, end], b, prefix="prev_")
        return p.filter(F.col(start) < F.col("prev_" + end)) \
            .select(key, F.col("prev_" + id_col).alias("previous_id"), F.col(id_col).alias("current_id"),
                    F.col("prev_" + end).alias("previous_end"), F.col(start).alias("current_start"))
    if mode == "running_max":
        r = running_max_before(d, key, [start, id_col], end, b, out="max_end_before")
        return r.filter(F.col(start) < F.col("max_end_before")) \
            .select(key, F.col(id_col).alias("current_id"), F.col("max_end_before"), F.col(start).alias("current_start"))
    raise ValueError(mode)


def timestamp_chain(df: DataFrame, id_col: str, columns: list[str]) -> DataFrame:
    """WN-2: each stage timestamp must not be earlier than the previous present one.

    Row-local, no shuffle: keep the present (name, value) pairs in stage order, pair each
    with its predecessor (``zip_with`` of two slices) and emit the decreasing pairs."""
    arr = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in columns])
    present = F.filter(arr, lambda s: s["value"].isNotNull())
    d = df.select(id_col, present.alias("_p"))
    n = F.size("_p")
    pairs = F.zip_with(F.slice("_p", 1, F.greatest(n - 1, F.lit(0))),
                       F.slice("_p", F.lit(2), F.greatest(n - 1, F.lit(0))),
                       lambda a, b: F.struct(a["name"].alias("previous_column"), a["value"].alias("previous_value"),
                                             b["name"].alias("column"), b["value"].alias("value")))
    bad = F.filter(pairs, lambda p: p["value"] < p["previous_value"])
    return d.select(id_col, F.inline(bad))


REPEAT_CHUNK = 1_000_000


def repeat_occurrences(df: DataFrame, key) -> DataFrame:
    """WN-3 / AG-4: one row per repeat of a key - occurrences 2..n of every key seen n>1
    times (a missing key is never a repeat; it is reported as missing). Exact even for
    byte-identical duplicate rows, and skew-safe: a partial+final count per key, then a
    bounded explode, instead of a window that would hold a hot key in one task."""
    keys = [key] if isinstance(key, str) else list(key)
    present = None
    for k in keys:
        c = F.col(k).isNotNull()
        present = c if present is None else (present & c)
    counts = df.filter(present).groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences"))
    # a key repeated n times yields n-1 rows: explode in chunks of at most CHUNK repeats and
    # spread the chunks over tasks, so one hot key does not emit all its rows from one task
    chunk = REPEAT_CHUNK
    starts = counts.filter(F.col("occurrences") > 1).select(
        *keys, "occurrences",
        F.explode(F.sequence(F.lit(2).cast("long"), F.col("occurrences"), F.lit(chunk).cast("long"))).alias("_c"))
    starts = starts.repartition(*[F.col(k) for k in keys], F.col("_c"))
    return starts.select(*keys, F.explode(F.sequence(
        F.col("_c"), F.least(F.col("_c") + F.lit(chunk - 1), F.col("occurrences")))).alias("occurrence"))


def available_at(df: DataFrame, key: str, order: list[str], value: str,
                 bucket_seconds: int = DEFAULT_BUCKET_SECONDS, out: str = "available_at",
                 bucketing: str = "time") -> DataFrame:
    """WN-4: when each key (rider) is next free at each row: the latest ``value``
    (delivered_at) among earlier rows in ``order``; NULL (free since ever) at the first."""
    d, b = _bucketed(df, key, order[0], bucketing, bucket_seconds)
    return running_max_before(d, key, order, value, b, out=out).select(*df.columns, out)


#: Sequence ids of one bucket: numbers are divided by the width, of text ids the prefix counts.
SEQUENCE_WIDTH = 4096
SEQUENCE_PREFIX = 8


def accepted_attempt(offers: DataFrame, key: str = "delivery_id", seq: str = "assignment_id",
                     width: int = SEQUENCE_WIDTH, prefix: int = SEQUENCE_PREFIX) -> DataFrame:
    """WN-5: offers are made in sequence until the first ACCEPTED one. Per key: the first
    accepted offer (seq, rider, responded_at), the number of offers, and how many offers
    came after the accepted one (which a sequential offer loop never makes).

    The offers are shuffled once, on (key, range of sequence ids), so a key with any share of the rows
    (NULL is a key too) is spread over tasks. A range gives one partial row: its offers, its first
    accepted one and the offers after that. In a key's first range with an accepted offer that count
    holds, later ranges come after it as a whole. Only partial rows are shuffled by key. An accepted
    offer without a sequence id is no first one."""
    taken = F.struct(F.col(seq).alias("s"), F.col("rider_id").alias("r"), F.col("responded_at").alias("t"))
    span = F.floor(F.col(seq) / F.lit(width)) if is_number(offers, seq) else F.substring(F.col(seq), 1, prefix)
    d = offers.select(F.col(key).alias("_key"), F.col(seq).alias("_seq"), span.alias("_span"),
                      F.when((F.col("response") == "ACCEPTED") & F.col(seq).isNotNull(), taken).alias("_taken"))
    d = d.withColumn("_a", F.min("_taken").over(Window.partitionBy("_key", "_span")))
    parts = d.groupBy("_key", "_span").agg(F.count(F.lit(1)).alias("_n"), F.min("_taken").alias("_a"),
                                           F.count(F.when(F.col("_seq") > F.col("_a.s"), 1)).alias("_after"))
    parts = parts.withColumn("_first", F.min(F.when(F.col("_a").isNotNull(), F.col("_span"))).over(Window.partitionBy("_key")))
    after = F.when(F.col("_span") == F.col("_first"), F.col("_after")).when(F.col("_span") > F.col("_first"), F.col("_n")).otherwise(0)
    agg = parts.groupBy("_key").agg(F.sum("_n").alias("n_offers"), F.min("_a").alias("_a"), F.sum(after).alias("offers_after_accept"))
    return agg.select(F.col("_key").alias(key), "n_offers", F.col("_a.s").alias("accepted_" + seq),
                      F.col("_a.r").alias("accepted_rider_id"), F.col("_a.t").alias("accepted_at"),
                      "offers_after_accept")


def offers_outside_candidates(offers: DataFrame, deliveries: DataFrame, riders: DataFrame) -> DataFrame:
    """JN-8 on the record: offers made to a rider who was no candidate, with the reason: not a known
    rider, not active, or busy. A rider is busy until the latest ``delivered_at`` of the deliveries
    started by the time of the offer and free before the first one; that time is a running maximum
    per rider, looked up as of the offer (no rider x delivery pairs)."""
    d = deliveries.filter(F.col("rider_id").isNotNull() & F.col("delivery_started_at").isNotNull()).select(
        "rider_id", "delivery_id", "delivery_started_at", "delivered_at")
    busy = available_at(d, "rider_id", ["delivery_started_at", "delivery_id"], "delivered_at", out="before")
    busy = busy.withColumn("busy_until", F.greatest("before", "delivered_at"))
    o = asof_latest(offers.select("assignment_id", "delivery_id", "rider_id", "offered_at"), busy, "rider_id", "offered_at",
                    "delivery_started_at", "delivery_id", ["busy_until"], fallback_earliest=False, prefix="last_")
    r = last_rows(riders, "rider_id", [], ["status"]).withColumn("known", F.lit(True))
    reason = (F.when(F.col("known").isNull(), "UNKNOWN_RIDER").when(~F.col("status").eqNullSafe(F.lit("ACTIVE")), "INACTIVE_RIDER")
              .when(F.col("last_busy_until") > F.col("offered_at"), "BUSY"))
    return (o.join(r, "rider_id", "left").withColumn("reason", reason).filter("reason is not null")
            .select("assignment_id", "delivery_id", "rider_id", "offered_at", "reason"))


def pick_k_per_group(df: DataFrame, group: str, rank_expr: Column, tiebreak: str, k: int) -> DataFrame:
    """SO-2: up to k rows per group, smallest (rank_expr, tiebreak) first. Spark plans a
    WindowGroupLimit before the shuffle, so at most k rows per group leave each map task
    whatever the group size."""
    w = Window.partitionBy(group).orderBy(rank_expr, F.col(tiebreak))
    return df.withColumn("pick_no", F.row_number().over(w).cast("long")).filter(F.col("pick_no") <= k)


def latest_and_earliest(df: DataFrame, key: str, time_col: str, tiebreak: str, fields: list[str]) -> DataFrame:
    """SO-3: per key, the last and the first row by (time, tiebreak): one aggregate."""
    o = F.struct(F.col(time_col), F.col(tiebreak))
    payload = F.struct(F.col(tiebreak), F.col(time_col), *[F.col(f) for f in fields])
    a = df.filter(F.col(time_col).isNotNull()).groupBy(key).agg(
        F.max_by(payload, o).alias("_l"), F.min_by(payload, o).alias("_e"), F.count(F.lit(1)).alias("n_rows"))
    cols = [tiebreak, time_col] + fields
    return a.select(key, "n_rows", *[F.col("_l").getField(c).alias("latest_" + c) for c in cols],
                    *[F.col("_e").getField(c).alias("earliest_" + c) for c in cols])


def intervals_by_start(df: DataFrame, key: str, start: str, end: str, id_col: str,
                       bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """SO-4: per key, each interval's 1-based position in (start, id) order (bucket-split)."""
    d = df.filter(F.col(key).isNotNull() & F.col(start).isNotNull()).select(key, start, end, id_col)
    r = dense_rank_index(d, key, [start, id_col], time_bucket(start, bucket_seconds), out="pos")
    return r.withColumn("position", F.col("pos") + 1).drop("pos", "pos_group_size")


def global_order(df: DataFrame, order: list[str], out: str = "seq") -> DataFrame:
    """SO-1 / PRJ-3 helper: 1-based global position (range-partitioned, no single task)."""
    return sequential_number(df, order, out=out)


__all__ = ["interval_overlaps", "timestamp_chain", "repeat_occurrences", "available_at", "accepted_attempt",
           "offers_outside_candidates", "pick_k_per_group", "latest_and_earliest", "intervals_by_start", "global_order", "asof_latest"]
