"""Joins: key checks, lookups, candidate picks, zone lookup.

Broadcast is only hinted for the zone dimension (five literal rows). Every other build
side is left to the planner: with AQE on, a side is broadcast only when its measured
runtime size is under ``spark.sql.autoBroadcastJoinThreshold`` - a size check done by
Spark on the real data - and shuffled otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.geo import haversine_km
from ..functions.timestamps import add_seconds
from .ordered import KEY_PARTITION_BYTES, dense_rank_index, range_partitions, time_bucket


def fk_orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str | None = None,
               optional: bool = False) -> DataFrame:
    """JN-1 / JN-2: child rows whose parent key is absent.

    Mandatory keys: a NULL child key is reported too (it is in no id set). Optional
    keys: NULL is allowed and skipped. An anti join never multiplies rows, so the parent
    keys are used as they are (no distinct aggregate, no extra shuffle)."""
    pk = parent_key or child_key
    ids = parent.select(F.col(pk).alias("_pk")).filter(F.col("_pk").isNotNull())
    c = child.filter(F.col(child_key).isNotNull()) if optional else child
    return c.join(ids, F.col(child_key) == F.col("_pk"), "left_anti")


def fk_orphans_multi(child: DataFrame, child_id: str, keys: dict[str, DataFrame]) -> DataFrame:
    """JN-2 for several optional keys of one table in a single exchange.

    ``keys`` maps a child column to the parent id DataFrame (one column). The child is
    unpivoted to (child_id, kind, id) for its non-NULL keys. Its distinct (kind, id) are anti-joined
    once against the union of tagged parent ids, instead of one join per key; the orphans found, few or many, then
    meet the children in one join (AQE broadcasts a small set, so that the children are not shuffled)."""
    kinds = list(keys)
    id_t = _common_key_type([(child, k) for k in kinds] + [(p, p.columns[0]) for p in keys.values()])
    unp = child.select(F.col(child_id).alias("child_id"), F.inline(F.array(*[
        F.struct(F.lit(k).alias("kind"), F.col(k).cast(id_t).alias("id")) for k in kinds])))
    unp = unp.filter(F.col("id").isNotNull())
    parents = None
    for k, pdf in keys.items():
        p = pdf.select(F.lit(k).alias("kind"), F.col(pdf.columns[0]).cast(id_t).alias("id"))
        parents = p if parents is None else parents.unionByName(p)
    orphans = unp.select("kind", "id").distinct().join(parents, ["kind", "id"], "left_anti")
    return unp.join(orphans, ["kind", "id"]).select("kind", "id", "child_id")


def is_number(df: DataFrame, column: str) -> bool:
    """Whether a key column is integral (ids may be numbers or text)."""
    from pyspark.sql import types as T
    return isinstance(df.schema[column].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))


def id_number(df: DataFrame, column: str) -> Column:
    """The id as a number for hashing and bucketing: itself, or 40 bits of a text id's digest."""
    if is_number(df, column):
        return F.col(column)
    return F.conv(F.substring(F.md5(F.col(column)), 1, 10), 16, 10).cast("long")


def _common_key_type(dfs_cols: list[tuple[DataFrame, str]]) -> str:
    """long when every key column is integral, else string (the union needs one type)."""
    return "long" if all(is_number(df, c) for df, c in dfs_cols) else "string"


def fk_orphans_all(tables: dict[str, DataFrame], specs: list[tuple], key_of) -> DataFrame:
    """All foreign-key checks of a set of tables: one join per parent table (a left join, since
    the optimizer would split an anti join into one per member of the union).

    ``specs`` = [(rule_id, child, column, parent, parent_key, optional)]. For each parent,
    the child key columns that reference it are projected narrow (spec tag, child id, id;
    Parquet reads only those columns) and unioned, then joined once with the parent's
    distinct keys; what finds none is an orphan. A small parent key set is broadcast by AQE (runtime size
    check); a large one is shuffled. A NULL mandatory key matches nothing and is
    reported; NULL optional keys are dropped first. Output: rule_id, child, column,
    child_id, id."""
    live = [sp for sp in specs if sp[1] in tables and sp[3] in tables]
    parents = list(dict.fromkeys((sp[3], sp[4]) for sp in live))
    id_t = _common_key_type([(tables[sp[1]], sp[2]) for sp in live] + [(tables[p], pk) for p, pk in parents])
    cid_t = _common_key_type([(tables[sp[1]], key_of(sp[1])) for sp in live])
    per_parent = []
    for p, pk in parents:
        kids = []
        for i, sp in enumerate(live):
            if (sp[3], sp[4]) != (p, pk):
                continue
            k = tables[sp[1]].select(F.lit(i).alias("spec"), F.col(key_of(sp[1])).cast(cid_t).alias("child_id"),
                                     F.col(sp[2]).cast(id_t).alias("id"))
            kids.append(k.filter(F.col("id").isNotNull()) if sp[5] else k)
        ids = tables[p].select(F.col(pk).cast(id_t).alias("id")).filter(F.col("id").isNotNull()).distinct() \
            .withColumn("_there", F.lit(True))
        per_parent.append(reduce(DataFrame.unionByName, kids).join(ids, "id", "left").filter("_there is null").drop("_there"))
    orphans = reduce(DataFrame.unionByName, per_parent)

    def name(idx: int) -> Column:
        out = None
        for i, sp in enumerate(live):
            out = F.when(F.col("spec") == i, F.lit(sp[idx])) if out is None else out.when(F.col("spec") == i, F.lit(sp[idx]))
        return out
    return orphans.select(name(0).alias("rule_id"), name(1).alias("child"), name(2).alias("column"),
                          F.col("child_id").cast("string").alias("child_id"), "id")


def last_rows(parent: DataFrame, key: str | list[str], order: list[str], fields: list[str]) -> DataFrame:
    """One row per key: the fields of its last row in ``order`` (NULLs first; columns that the table
    does not have are left out, ties go to the greatest fields). A key that repeats in a parent
    table thus never multiplies the rows that look it up."""
    keys = [key] if isinstance(key, str) else key
    by = [o for o in order if o in parent.columns] + [f for f in fields if f not in order]
    if by == fields and len(by) == 1:          # a plain maximum: narrow rows and, for numbers, no sort
        return parent.groupBy(*keys).agg(F.max(by[0]).alias(by[0]))
    last = parent.groupBy(*keys).agg(F.max(F.struct(*[F.col(o) for o in by])).alias("_last"))
    return last.select(*keys, *[F.col("_last").getField(f).alias(f) for f in fields])


#: Which row of a repeated key is the last one: the order of the reduction, per parent table.
LAST_ORDER = {
    "orders": ["created_at", "payment_success_at", "status"],
    "fulfilment_units": ["assigned_to_store_at", "order_id", "store_id", "status"],
    "deliveries": ["delivery_started_at", "picked_up_at", "rider_arrived_at_store", "status"],
    "stores": ["store_name", "latitude", "longitude"],
}


def lookup_last_wins(child: DataFrame, parent: DataFrame, key: str, order: list[str],
                     fields: list[str], prefix: str = "") -> DataFrame:
    """JN-3: attach the parent row; with repeated parent keys the last one (greatest
    ``order``) wins; children without a parent are dropped."""
    last = parent.groupBy(key).agg(
        F.max_by(F.struct(*[F.col(f) for f in fields]), F.struct(*[F.col(o) for o in order])).alias("_p"))
    j = child.join(last, key, "inner")
    return j.select(*[F.col(c) for c in child.columns], *[F.col("_p").getField(f).alias(prefix + f) for f in fields])


def lookup_strict(child: DataFrame, parent: DataFrame, key: str, fields: list[str],
                  prefix: str = "", flag: str = "lookup_found") -> DataFrame:
    """JN-4: attach the parent (of a repeated key the greatest row); unmatched rows are kept with
    ``flag`` false so they can be routed to violations (a distributed job must not raise on one row)."""
    one = last_rows(parent, key, fields, fields)
    p = one.select(F.col(key).alias("_lk"), *[F.col(f).alias(prefix + f) for f in fields],
                   F.lit(True).alias(flag))
    j = child.join(p, child[key] == p["_lk"], "left").drop("_lk")
    return j.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def exactly_one_match(accepted: DataFrame, events: DataFrame, keys: list[str], id_col: str) -> DataFrame:
    """JN-9: rows of ``accepted`` that match a number of ``events`` other than one, on
    ``keys`` with NULL-safe equality (two missing values are equal). Events are
    pre-aggregated to one count per key before the join."""
    counts = events.groupBy(*[F.col(k).alias("_e_" + k) for k in keys]).agg(F.count(F.lit(1)).alias("n_matches"))
    cond = None
    for k in keys:
        c = accepted[k].eqNullSafe(counts["_e_" + k])
        cond = c if cond is None else (cond & c)
    j = accepted.join(counts, cond, "left")
    n = F.coalesce(F.col("n_matches"), F.lit(0))
    return j.filter(n != 1).select(id_col, *keys, n.alias("n_matches"))


def accepted_rider_check(deliveries: DataFrame, assignments: DataFrame) -> DataFrame:
    """JN-10: deliveries whose rider has no ACCEPTED assignment for that delivery."""
    acc = (assignments.filter(F.col("response") == "ACCEPTED")
           .select(F.col("delivery_id").alias("_d"), F.col("rider_id").alias("_r")).distinct())
    d = deliveries.filter(F.col("rider_id").isNotNull())
    return d.join(acc, (d.delivery_id == acc._d) & (d.rider_id == acc._r), "left_anti")


def ownership_mismatch(items: DataFrame, units: DataFrame, unit_order: list[str] | None = None) -> DataFrame:
    """JN-12: items whose order differs from their unit's order (only when the unit is
    found). Repeated unit ids are reduced to the last one first."""
    u = last_rows(units, "fulfilment_unit_id", unit_order or LAST_ORDER["fulfilment_units"], ["order_id"]) \
        .withColumnRenamed("order_id", "unit_order_id")
    j = items.join(u, "fulfilment_unit_id")
    return j.filter(~F.col("order_id").eqNullSafe(F.col("unit_order_id"))) \
        .select("order_item_id", "fulfilment_unit_id", "order_id", "unit_order_id")


# Delivery terminal status -> the unit status it implies (fixed mapping).
IMPLIED_UNIT_STATUS = {"DELIVERED": "COMPLETED", "CANCELLED": "CANCELLED", "FAILED": "FAILED"}


def state_mismatch(deliveries: DataFrame, units: DataFrame) -> DataFrame:
    """JN-13: delivery status implies a unit status; report deliveries whose unit (when found; of
    repeated ids the last) is in another status (a missing unit status counts as different)."""
    expected = None
    for d, u in IMPLIED_UNIT_STATUS.items():
        expected = F.when(F.col("status") == d, F.lit(u)) if expected is None else expected.when(
            F.col("status") == d, F.lit(u))
    d = deliveries.select("delivery_id", "fulfilment_unit_id", "status", expected.alias("expected_unit_status"))
    u = last_rows(units, "fulfilment_unit_id", LAST_ORDER["fulfilment_units"], ["status"]) \
        .withColumnRenamed("status", "unit_status")
    j = d.filter(F.col("expected_unit_status").isNotNull()).join(u, "fulfilment_unit_id")
    return j.filter(~F.col("unit_status").eqNullSafe(F.col("expected_unit_status")))


def coverage_gap(parents: DataFrame, children: DataFrame, key: str, child_key: str | None = None) -> DataFrame:
    """JN-14: parents with no child. Both sides are shuffled into as many partitions as their size asks for, so
    that a task sorts no more rows when the tables grow."""
    ck = child_key or key
    ids = children.select(F.col(ck).alias("_ck")).filter(F.col("_ck").isNotNull())
    n = range_partitions(parents.select(key).unionByName(ids.select(F.col("_ck").alias(key))), KEY_PARTITION_BYTES)
    return parents.repartition(n, key).join(ids.repartition(n, "_ck"), F.col(key) == F.col("_ck"), "left_anti")


def zone_of_point_expr(lat, lon, zones=None) -> tuple[Column, Column]:
    """JN-15 as a row-local expression: (zone_id, number of boxes holding the point).

    The zone whose box centre +- spread holds the point; overlapping boxes go to the
    nearest centre, then the smaller zone_id; NULL when no box holds it. The zone list is
    a literal array (five fixed rows), so this is a range lookup with no join at all."""
    from ..sources.zones import ZONES
    zs = zones or ZONES
    la = F.col(lat) if isinstance(lat, str) else lat
    lo = F.col(lon) if isinstance(lon, str) else lon
    arr = F.array(*[F.struct(F.lit(z).alias("zone_id"), F.lit(float(cy)).alias("cy"), F.lit(float(cx)).alias("cx"),
                             F.lit(float(sp)).alias("sp")) for z, cy, cx, sp in zs])
    inside = F.filter(arr, lambda z: (la >= z["cy"] - z["sp"]) & (la <= z["cy"] + z["sp"])
                      & (lo >= z["cx"] - z["sp"]) & (lo <= z["cx"] + z["sp"]))
    ranked = F.transform(inside, lambda z: F.struct(
        (F.pow(la - z["cy"], 2) + F.pow(lo - z["cx"], 2)).alias("d"), z["zone_id"].alias("zone_id")))
    return F.array_min(ranked)["zone_id"], F.size(inside)


def zone_of_point(points: DataFrame, lat: str, lon: str, out: str = "zone_of_point") -> DataFrame:
    """JN-15 over a DataFrame (row-local, no shuffle)."""
    z, n = zone_of_point_expr(lat, lon)
    return points.withColumn(out, z).withColumn("n_zone_boxes", n.cast("long"))


def alternate_address(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """JN-16: orders delivered outside the customer's registered zone."""
    c = customers.select(F.col("customer_id"), F.col("zone_id").alias("customer_zone"))
    j = orders.join(c, "customer_id")
    return j.filter(~F.col("delivery_zone").eqNullSafe(F.col("customer_zone"))) \
        .select("order_id", "customer_id", "delivery_zone", "customer_zone")


def store_hour_grid(stores: DataFrame, start: str, hours: int = 24, ts: str = "recorded_at") -> DataFrame:
    """JN-11: every store x every hour from ``start``: a generator, no join, no shuffle."""
    t0 = F.lit(start).cast("timestamp_ntz")
    return stores.withColumn("_h", F.explode(F.sequence(F.lit(0), F.lit(hours - 1)))) \
        .withColumn(ts, add_seconds(t0, F.col("_h") * 3600)).drop("_h")


# ---------------------------------------------------------------------------------
# Candidate picks without materialising candidate pairs.
# ---------------------------------------------------------------------------------

HASH_MODULUS = 2147483647      # 2^31 - 1
HASH_MULTIPLIER = 48271


def pick_hash(request_id: Column, seed: int) -> Column:
    """Arithmetic (engine-independent) non-negative hash of a bigint id: one Lehmer step,
    reduced first so the product stays far below 2^63 for any id."""
    m = F.lit(HASH_MODULUS)
    return F.pmod(F.pmod(request_id, m) * F.lit(HASH_MULTIPLIER) + F.lit(seed), m)


def indexed_candidates(candidates: DataFrame, group: str, order: str, bucket_mod: int = 64) -> DataFrame:
    """Dense 0-based index of each candidate inside its group (ordered by
    ``(order % bucket_mod, order)``), plus the group size. The per-group window is split
    by the bucket, so a group with most candidates is still spread over tasks."""
    bucket = F.pmod(id_number(candidates, order), F.lit(bucket_mod))
    return dense_rank_index(candidates, group, [bucket, F.col(order)], bucket, out="cand_idx")


def pick_from_groups(requests: DataFrame, request_id: str, request_group: str, indexed: DataFrame,
                     cand_group: str, k: int = 1, seed: int = 17, exclude_idx: str | None = None) -> DataFrame:
    """Pick up to ``k`` distinct candidates of the request's group, without replacement:
    start at hash(request) mod n and take consecutive indices. With ``exclude_idx`` the
    candidate at that index is skipped (n-1 remain). Output: one row per pick, with
    ``pick_no`` 1..k. Cost: one equi-join on (group, index); no pair is formed."""
    sizes = indexed.groupBy(F.col(cand_group).alias("_g")).agg(F.max("cand_idx_group_size").alias("_n"))
    r = requests.join(sizes, F.col(request_group) == F.col("_g"), "left")
    n_eff = F.col("_n") - (F.when(F.col(exclude_idx).isNotNull(), 1).otherwise(0) if exclude_idx else F.lit(0))
    # groups with no eligible candidate are dropped before any modulo by their size
    r = r.withColumn("_neff", n_eff).filter(F.col("_neff").isNotNull() & (F.col("_neff") > 0))
    r = r.withColumn("_start", F.pmod(pick_hash(id_number(requests, request_id), seed), F.col("_neff")))
    r = r.withColumn("pick_no", F.explode(F.sequence(F.lit(1), F.lit(k))))
    r = r.filter(F.col("pick_no") <= F.col("_neff"))
    idx = F.pmod(F.col("_start") + F.col("pick_no") - 1, F.col("_neff"))
    if exclude_idx:
        idx = F.when(F.col(exclude_idx).isNotNull() & (idx >= F.col(exclude_idx)), idx + 1).otherwise(idx)
    r = r.withColumn("_idx", idx)
    c = indexed.select(F.col(cand_group).alias("_cg"), F.col("cand_idx").alias("_ci"),
                       *[F.col(x) for x in indexed.columns if x not in (cand_group, "cand_idx", "cand_idx_group_size")])
    j = r.join(c, (F.col("_g") == F.col("_cg")) & (F.col("_idx") == F.col("_ci")))
    return j.drop("_g", "_n", "_neff", "_start", "_idx", "_cg", "_ci")


def units_outside_store_candidates(units: DataFrame, orders: DataFrame, stores: DataFrame) -> DataFrame:
    """JN-5 on the record: units whose store was no candidate of their order, with the reason: not a known
    store, not active, or of another zone although the order's zone has an active store. Units without
    a store or without their order are left to the foreign-key rules."""
    o = last_rows(orders, "order_id", LAST_ORDER["orders"], ["delivery_zone"])
    s = last_rows(stores, "store_id", LAST_ORDER["stores"], ["zone", "status"])
    served = s.filter("status = 'ACTIVE' and zone is not null").select(F.col("zone").alias("_served")).distinct()
    s = s.select("store_id", F.col("zone").alias("store_zone"), F.col("status").alias("_status"), F.lit(True).alias("_known"))
    j = units.filter(F.col("store_id").isNotNull()).select("fulfilment_unit_id", "order_id", "store_id") \
        .join(o, "order_id").join(s, "store_id", "left").join(served, F.col("delivery_zone") == F.col("_served"), "left")
    other = ~F.col("store_zone").eqNullSafe(F.col("delivery_zone")) & F.col("_served").isNotNull()
    reason = (F.when(F.col("_known").isNull(), "UNKNOWN_STORE").when(~F.col("_status").eqNullSafe(F.lit("ACTIVE")), "INACTIVE_STORE")
              .when(other, "OTHER_ZONE"))
    return j.withColumn("reason", reason).filter("reason is not null").select(
        "fulfilment_unit_id", "order_id", "store_id", "delivery_zone", "store_zone", "reason")
