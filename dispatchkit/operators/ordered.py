"""Skew-safe ordered computations over a key.

A window ``partitionBy(key).orderBy(t)`` sends every row of a key to one task; a key
holding a third of the table would then be a third of the job on one core. The helpers
here split each key into time buckets: the window runs per ``(key, bucket)``, and what a
bucket needs from earlier buckets (the last row, the running max, the latest build row)
comes from a summary with one row per ``(key, bucket)``, windowed per key. The summary
is as small as the number of buckets, so the answer is exact and no task sees more than
one bucket of one key.

The bucket must be monotonic in the ordering: all rows of an earlier bucket sort before
all rows of a later one. ``time_bucket`` is: floor(seconds since epoch / width).
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

EPOCH = "1970-01-01 00:00:00"
DEFAULT_BUCKET_SECONDS = 86400


def time_bucket(ts, width_seconds: int = DEFAULT_BUCKET_SECONDS) -> Column:
    """Zone-free bucket number of a TIMESTAMP_NTZ (NULL stays NULL)."""
    from ..functions.timestamps import epoch_seconds
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.floor(epoch_seconds(c) / F.lit(width_seconds)).cast("long")


def quantile_bucket(df: DataFrame, key, ts: str, n: int = 32, out: str = "_qbucket") -> DataFrame:
    """Add a per-key, count-based bucket: the number of the key's approximate time
    quantiles (1/n .. (n-1)/n) at or before the row's time. Monotonic in time within a
    key, and each bucket holds about 1/n of that key's rows, so a key with a third of the
    table is split n ways however its rows are spread in time. Costs one partial+final
    aggregate (``percentile_approx``) and a join of one row per key."""
    from ..functions.timestamps import epoch_seconds
    keys = _cols(key)
    fractions = [i / n for i in range(1, n)]
    bounds = df.filter(F.col(ts).isNotNull()).groupBy(*keys).agg(
        F.percentile_approx(epoch_seconds(ts), fractions, 10000).alias("_qbounds"))
    t = epoch_seconds(ts)
    return df.join(bounds, keys, "left").withColumn(
        out, F.size(F.filter(F.coalesce(F.col("_qbounds"), F.array().cast("array<bigint>")),
                             lambda b: b <= t)).cast("long")).drop("_qbounds")


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def previous_row(df: DataFrame, key, order: list[str], fields: list[str], bucket: Column,
                 prefix: str = "prev_") -> DataFrame:
    """Attach the fields of the previous row of the same key in ``order`` (NULL for the
    first row). Ties must be broken inside ``order`` for a deterministic answer."""
    keys = _cols(key)
    b = "_bucket"
    d = df.withColumn(b, bucket)
    w_in = Window.partitionBy(*keys, b).orderBy(*order)
    payload = F.struct(*[F.col(f).alias(f) for f in fields])
    d = d.withColumn("_prev_in", F.lag(payload).over(w_in))
    # last row of every (key, bucket); then the previous non-empty bucket's last row
    ordkey = F.struct(*[F.col(o) for o in order])
    summary = d.groupBy(*keys, b).agg(F.max_by(payload, ordkey).alias("_last"))
    w_b = Window.partitionBy(*keys).orderBy(b)
    summary = summary.select(*keys, b, F.lag("_last").over(w_b).alias("_carry"))
    j = d.join(summary, [*keys, b], "left")
    prev = F.coalesce(F.col("_prev_in"), F.col("_carry"))
    return j.select(*[F.col(c) for c in df.columns],
                    *[prev.getField(f).alias(prefix + f) for f in fields])


def running_max_before(df: DataFrame, key, order: list[str], value: str, bucket: Column,
                       out: str = "max_before") -> DataFrame:
    """max(value) over all earlier rows of the same key (strictly before, by ``order``);
    NULL when there is none. NULL values are skipped."""
    keys = _cols(key)
    b = "_bucket"
    d = df.withColumn(b, bucket)
    w_in = Window.partitionBy(*keys, b).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("_max_in", F.max(value).over(w_in))
    summary = d.groupBy(*keys, b).agg(F.max(value).alias("_bmax"))
    w_b = Window.partitionBy(*keys).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.select(*keys, b, F.max("_bmax").over(w_b).alias("_carry"))
    j = d.join(summary, [*keys, b], "left")
    return j.select(*[F.col(c) for c in df.columns],
                    F.greatest(F.col("_max_in"), F.col("_carry")).alias(out))


SPLITS = 256


def adaptive_bucket(df: DataFrame, key: str, time: str, width_seconds: int, most: int, out: str) -> DataFrame:
    """Add a two-level bucket, monotonic in time within a key: the time bucket, and within one that holds
    more than ``most`` rows of a key the number of its approximate time quantiles at or before the row's
    time, as many as its measured count asks for (at most ``SPLITS``). The counts are one aggregate over
    narrow rows; quantiles are only taken where a bucket is too full, and AQE broadcasts their table when
    it is small. Rows of one key and one exact time stay together."""
    from ..functions.timestamps import epoch_micros
    d = df.withColumn("_wide", time_bucket(time, width_seconds)).withColumn("_at", epoch_micros(F.col(time)))
    full = d.groupBy(key, "_wide").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > most).select(
        F.col(key).alias("_fk"), F.col("_wide").alias("_fw"), "_n")
    same = F.col(key).eqNullSafe(F.col("_fk")) & (F.col("_wide") == F.col("_fw"))
    cuts = d.select(key, "_wide", "_at").join(full, same).groupBy("_fk", "_fw").agg(
        F.percentile_approx("_at", [i / SPLITS for i in range(1, SPLITS)], 10000).alias("_cuts"), F.max("_n").alias("_n"))
    step = F.greatest(F.lit(1), F.floor(F.lit(SPLITS) * F.lit(most) / F.col("_n")).cast("int"))
    cuts = cuts.select("_fk", "_fw", F.filter("_cuts", lambda _, i: (i + 1) % step == 0).alias("_cuts"))
    at = F.size(F.filter(F.coalesce("_cuts", F.array().cast("array<bigint>")), lambda c: c <= F.col("_at")))
    bucket = F.when(F.col("_wide").isNotNull(), F.struct(F.col("_wide").alias("wide"), at.alias("at")))
    return d.join(cuts, same, "left").select(*df.columns, bucket.alias(out))


def asof_latest(probe: DataFrame, build: DataFrame, key: str, probe_time: str, build_time: str,
                build_tiebreak: str, payload: list[str], width_seconds: int = DEFAULT_BUCKET_SECONDS,
                fallback_earliest: bool = True, prefix: str = "", most_per_bucket: int | None = None) -> DataFrame:
    """As-of join: for each probe row, the build row of the same key with the greatest
    ``(build_time, build_tiebreak)`` such that ``build_time <= probe_time``. With
    ``fallback_earliest`` a probe before every build row takes the earliest build row
    (smallest ``(build_time, build_tiebreak)``). Adds ``asof_match`` in
    {'LATEST', 'EARLIEST', NULL (key has no build row or probe time is NULL)}.

    Plan: one union of both sides shuffled on (key, day bucket); a window per bucket;
    a per-bucket summary windowed per key for the carry-in; one per-key aggregate for the
    fallback. No pairs are formed, so cost is O(probe + build) whatever the skew. With
    ``most_per_bucket`` a day of one key with more rows is split further (``adaptive_bucket``).
    """
    pcols = probe.columns
    pl = F.struct(F.col(build_tiebreak).alias("_tb"), *[F.col(c).alias(c) for c in payload])
    null_pl = F.lit(None).cast(build.select(pl.alias("x")).schema["x"].dataType)
    p = probe.select(F.col(key).alias("_k"), F.col(probe_time).alias("_t"), F.lit(1).alias("_side"),
                     F.lit(None).cast(build.schema[build_tiebreak].dataType).alias("_ord"), null_pl.alias("_pl"),
                     F.struct(*[F.col(c) for c in pcols]).alias("_probe"))
    null_probe = F.lit(None).cast(p.schema["_probe"].dataType)
    bld = build.filter(F.col(build_time).isNotNull() & F.col(key).isNotNull())
    bb = bld.select(F.col(key).alias("_k"), F.col(build_time).alias("_t"), F.lit(0).alias("_side"),
                    F.col(build_tiebreak).alias("_ord"), pl.alias("_pl"), null_probe.alias("_probe"))
    u = p.unionByName(bb)
    u = (adaptive_bucket(u, "_k", "_t", width_seconds, most_per_bucket, "_b") if most_per_bucket
         else u.withColumn("_b", time_bucket("_t", width_seconds)))
    order = [F.col("_t"), F.col("_side"), F.col("_ord")]
    w_in = Window.partitionBy("_k", "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    u = u.withColumn("_in", F.last("_pl", ignorenulls=True).over(w_in))
    # carry-in: the last build row of each (key, bucket) - an aggregate over the build side
    # only - plus one row per (key, bucket) that holds probes (a narrow hash aggregate), so
    # a bucket with probes but no build row still receives the carry
    sides = ((u.filter("_side = 0"), u.filter("_side = 1").select("_k", "_b")) if most_per_bucket else
             (bb.withColumn("_b", time_bucket("_t", width_seconds)), p.select("_k", time_bucket("_t", width_seconds).alias("_b"))))
    bsum = (sides[0].groupBy("_k", "_b")
            .agg(F.max_by("_pl", F.struct(F.col("_t"), F.col("_ord"))).alias("_blast")))
    pkeys = (sides[1].filter(F.col("_b").isNotNull())
             .distinct().withColumn("_blast", F.lit(None).cast(bsum.schema["_blast"].dataType)))
    summ = bsum.unionByName(pkeys).groupBy("_k", "_b").agg(F.max("_blast").alias("_blast"))
    w_b = Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    summ = summ.select("_k", "_b", F.last("_blast", ignorenulls=True).over(w_b).alias("_carry"))
    probes = u.filter(F.col("_side") == 1).join(summ, ["_k", "_b"], "left")
    latest = F.coalesce(F.col("_in"), F.col("_carry"))
    probes = probes.withColumn("_latest", latest)
    if fallback_earliest:
        first = bld.groupBy(F.col(key).alias("_k")).agg(
            F.min_by(pl, F.struct(F.col(build_time), F.col(build_tiebreak))).alias("_first"))
        probes = probes.join(first, "_k", "left")
        chosen = F.when(F.col("_latest").isNotNull(), F.col("_latest")).when(F.col("_t").isNotNull(), F.col("_first"))
        match = (F.when(F.col("_latest").isNotNull(), F.lit("LATEST"))
                 .when(F.col("_t").isNotNull() & F.col("_first").isNotNull(), F.lit("EARLIEST")))
    else:
        chosen = F.col("_latest")
        match = F.when(F.col("_latest").isNotNull(), F.lit("LATEST"))
    probes = probes.withColumn("_chosen", chosen).withColumn("asof_match", match)
    return probes.select(*[F.col("_probe").getField(c).alias(c) for c in pcols],
                         F.col("_chosen._tb").alias(prefix + build_tiebreak),
                         *[F.col("_chosen").getField(c).alias(prefix + c) for c in payload],
                         "asof_match")


def running_total(probe: DataFrame, changes: DataFrame, key: str, probe_time: str, change_time: str, value: str,
                  width_seconds: int = DEFAULT_BUCKET_SECONDS, out: str = "total") -> DataFrame:
    """For each probe row the sum of ``value`` over the changes of the same key with ``change_time`` up to
    the probe's time (0 where there is none, or where key or time is NULL). Both sides are shuffled once on
    (key, time bucket); what earlier buckets add up to comes from one row per (key, bucket). No pairs."""
    pcols = probe.columns
    p = probe.select(F.col(key).alias("_k"), F.col(probe_time).alias("_t"), F.lit(1).alias("_side"),
                     F.lit(None).cast("bigint").alias("_v"), F.struct(*[F.col(c) for c in pcols]).alias("_probe"))
    c = changes.filter(F.col(key).isNotNull() & F.col(change_time).isNotNull()).select(
        F.col(key).alias("_k"), F.col(change_time).alias("_t"), F.lit(0).alias("_side"),
        F.col(value).cast("bigint").alias("_v"), F.lit(None).cast(p.schema["_probe"].dataType).alias("_probe"))
    d = p.unionByName(c).withColumn("_b", time_bucket("_t", width_seconds))
    up_to = Window.partitionBy("_k", "_b").orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.withColumn("_in", F.sum("_v").over(up_to))
    earlier = Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = d.groupBy("_k", "_b").agg(F.sum("_v").alias("_sum")).select("_k", "_b", F.sum("_sum").over(earlier).alias("_carry"))
    j = d.filter("_side = 1").join(carried, ["_k", "_b"], "left")
    total = F.coalesce("_in", F.lit(0)) + F.coalesce("_carry", F.lit(0))
    return j.select(*[F.col("_probe").getField(x).alias(x) for x in pcols], total.alias(out))


def dense_rank_index(df: DataFrame, group, order: list[str], bucket: Column, out: str = "idx") -> DataFrame:
    """0-based position of each row inside its group, in (bucket, order) order: a
    per-(group, bucket) row_number plus the row counts of earlier buckets. The bucket
    must be monotonic in ``order`` for the index to follow ``order``."""
    keys = _cols(group)
    b = "_bucket"
    d = df.withColumn(b, bucket)
    d = d.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys, b).orderBy(*order)))
    counts = d.groupBy(*keys, b).agg(F.count(F.lit(1)).alias("_n"))
    w_b = Window.partitionBy(*keys).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*keys, b, F.coalesce(F.sum("_n").over(w_b), F.lit(0)).alias("_off"),
                           F.sum("_n").over(Window.partitionBy(*keys)).alias("_group_size"))
    # NULL groups and buckets have positions like any other
    right = counts.select(*[F.col(k).alias(f"_c{i}") for i, k in enumerate([*keys, b])], "_off", "_group_size")
    on = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_c{i}")) for i, k in enumerate([*keys, b])])
    j = d.join(right, on, "left")
    return j.select(*[F.col(c) for c in df.columns], (F.col("_off") + F.col("_rn") - 1).alias(out),
                    F.col("_group_size").alias(out + "_group_size"))


TARGET_PARTITION_BYTES = 128 * 1024 * 1024
#: Of the scanned tables, for one partition of a join or a grouping by their keys alone.
KEY_PARTITION_BYTES = 8 * 1024 * 1024
UNKNOWN_BYTES = 1 << 62


def range_partitions(df: DataFrame, target_bytes: int = TARGET_PARTITION_BYTES) -> int:
    """Partition count for a range shuffle from the optimizer's size estimate (plan
    statistics, no pass over the data): about ``target_bytes`` per partition however large the
    input, at least the session's shuffle parallelism. Where the statistics cannot be read the
    error shows; callers may pass a partition count instead."""
    spark = df.sparkSession
    floor = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # sum of the leaf scans' sizes: the bytes actually read, times the rows that an unpivot makes of one.
    # (The root estimate of a join is the product of its inputs without CBO, useless for sizing.)
    sizes: list[int] = []

    def scans(plan, rows: int) -> None:
        if plan.getClass().getSimpleName() == "Generate":
            made = plan.generator().children()
            if made.size() and made.apply(0).getClass().getSimpleName() == "CreateArray":
                rows *= max(1, made.apply(0).children().size())
        below = plan.children()
        if not below.size():
            size = int(str(plan.stats().sizeInBytes()))
            sizes.append(size if size >= UNKNOWN_BYTES else size * rows)
        for i in range(below.size()):
            scans(below.apply(i), rows)

    scans(df._jdf.queryExecution().optimizedPlan(), 1)
    if any(s >= UNKNOWN_BYTES for s in sizes):      # an RDD has no statistics: its own partitioning says
        return max(floor, df.rdd.getNumPartitions())
    return max(floor, -(-sum(sizes) // target_bytes))


#: Sampled rows per partition from which the bounds of numbered slices are taken.
SAMPLES_PER_SLICE = 100


def _as_number(kind, column: str) -> Column | None:
    """An order column as a double that is monotonic in it (NULL first), None where there is none."""
    from ..functions.timestamps import epoch_seconds
    c = F.col(column)
    if isinstance(kind, T.TimestampNTZType):
        c = epoch_seconds(c)
    elif not isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return None
    return F.coalesce(c.cast("double"), F.lit(float("-inf")))


def _slices(df: DataFrame, order: list[str], n: int) -> list[float] | None:
    """Inner bounds of ``n`` ranges of the first order column with about as many rows each, from a uniform
    sample. None where ranges of that column alone do not part the rows evenly (no number or whole second of
    it, or one value with more than a range's share): then all order columns have to."""
    number = _as_number(df.schema[order[0]].dataType, order[0])
    if number is None:
        return None
    sample = sorted(r[0] for r in df.select(number.alias("_v"), F.rand(11).alias("_r")).orderBy("_r").limit(SAMPLES_PER_SLICE * n).collect())
    ends = [sample[i * len(sample) // n] for i in range(1, n)] if sample else []
    if len(set(ends)) < len(ends) or float("-inf") in ends:
        return None if len(sample) >= SAMPLES_PER_SLICE * n else []
    return ends


def sequential_number(df: DataFrame, order: list[str], n_partitions: int | None = None,
                      out: str = "seq") -> DataFrame:
    """1-based global position in ``order`` without a single-task window.

    Rows go to slices of the first order column whose bounds are fixed first (``_slices``), one partition a slice,
    are sorted there and take their position in the partition (``monotonically_increasing_id`` encodes partition
    << 33 | position) plus the rows of the slices before. These are counted ahead, in a job over the order columns
    alone, so that no row is written: ``df`` must give the same rows whenever it is computed, and equal rows in
    ``order`` have their numbers in any order. Where the first column does not part the rows, ``_numbered_rows``."""
    n = n_partitions or range_partitions(df)
    ends = _slices(df, order, n)
    if ends is None:
        return _numbered_rows(df, order, n, out)
    at = "_slice"
    rows = df.withColumn(at, F.lit(0))
    if ends:
        number = _as_number(df.schema[order[0]].dataType, order[0])
        splits = [float("-inf"), *ends, float("inf")]
        rows = Bucketizer(splits=splits, inputCol="_v", outputCol="_w").transform(df.withColumn("_v", number)).withColumn(
            at, F.col("_w").cast("int")).drop("_v", "_w")
    held = dict(map(tuple, rows.groupBy(at).agg(F.count(F.lit(1))).collect()))
    before = [sum(held.get(j, 0) for j in range(i)) for i in range(len(ends) + 1)]
    pos = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranged = rows.repartitionById(len(ends) + 1, at).sortWithinPartitions(*order).withColumn("_pos", pos)
    offset = F.element_at(F.array(*[F.lit(b).cast("long") for b in before]), F.col(at) + 1)
    return ranged.select(*[F.col(c) for c in df.columns], (offset + F.col("_pos") + 1).alias(out))


def _numbered_rows(df: DataFrame, order: list[str], n: int, out: str) -> DataFrame:
    """``sequential_number`` by ranges of all order columns, whose bounds Spark samples anew in every job: the rows
    are written to the shared folder, so that positions are fixed even if an executor is lost (compressed
    columns: an RDD checkpoint keeps plain row objects, many times the bytes), and each partition's offset is
    added: a running sum over one count row per partition, broadcast (bounded by the partition count)."""
    spark = df.sparkSession
    from ..session import scratch_path
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    path = scratch_path(spark, "numbered")
    ranged.withColumn("_mid", F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(path)
    tagged = spark.read.parquet(path)
    part = F.shiftright(F.col("_mid"), 33)
    pos = F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    counts = tagged.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_p", F.coalesce(F.sum("_n").over(
        Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    j = tagged.join(F.broadcast(offsets), part == F.col("_p"))
    return j.select(*[F.col(c) for c in df.columns], (F.col("_off") + pos + 1).alias(out))
