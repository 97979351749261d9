"""Source and sink queries: each round-trips data derived from the
supplied tables through the shared scratch folder (``spark.checkpoint.dir``)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..quality import suite
from ..session import kept, scratch_path
from ..sources import io
from ..sources.schemas import columns as declared_columns
from ..sources.zones import zone_dim
from .fixtures import RAW_TABLES, qc, raw, registry
from .registry import query
from .q_quality import suite_sql

DELIVERY_COLS = declared_columns("deliveries")
ID_COLS = {"delivery_id", "fulfilment_unit_id", "rider_id"}
TS_COLS = {"rider_arrived_at_store", "picked_up_at", "delivery_started_at", "delivered_at", "cancelled_at", "failed_at"}


def _written_deliveries(spark, sf) -> str:
    path = scratch_path(spark, "deliveries-csv")
    io.write_csv_ordered(qc(spark, sf, "deliveries"), path, "deliveries")
    return path


def _text_sql(c: str) -> str:
    if c in TS_COLS:
        return f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}"
    if c in ID_COLS or c == "delivery_distance":
        return f"cast({c} as varchar) AS {c}"
    return c


@query("write_csv_ordered", section="SNK-1",
       oracle=f"SELECT {', '.join(_text_sql(c) for c in DELIVERY_COLS)} FROM qc_deliveries")
def q_write_csv_ordered(spark, sf):
    path = _written_deliveries(spark, sf)
    # read back as plain text: exactly what the file holds, in declared column order
    return spark.read.option("header", "true").csv(path).select(*DELIVERY_COLS)


@query("scan_csv_typed", section="SRC-1", oracle="SELECT " + ", ".join(
    f"cast({c} as varchar) AS {c}" if c in ID_COLS else c for c in DELIVERY_COLS) + " FROM qc_deliveries")
def q_scan_csv_typed(spark, sf):
    """A folder whose files differ in column order, each bound by its own header."""
    d = qc(spark, sf, "deliveries")
    odd = F.pmod(F.xxhash64("delivery_id"), F.lit(2)) == 1
    path = scratch_path(spark, "deliveries-mixed")
    io.write_csv_ordered(d.filter(~odd), f"{path}/a", "deliveries")
    io.write_csv_ordered(d.filter(odd), f"{path}/b", cols=DELIVERY_COLS[::-1])
    return io.scan_csv_typed(spark, path, "deliveries")


_SHORT, _LONG = "delivery_id % 53 = 4", "delivery_id % 59 = 6"


@query("scan_csv_malformed", section="SRC-1", oracle=f"""
SELECT CASE WHEN {_SHORT} THEN 'short' ELSE 'long' END AS kind, cast(delivery_id as varchar) AS delivery_id, status
FROM qc_deliveries WHERE delivery_id IS NOT NULL AND ({_SHORT} OR {_LONG})""")
def q_scan_csv_malformed(spark, sf):
    """Rows with too few or too many fields in a folder of CSV files: each is reported with its line."""
    names = ["delivery_id", "status", "fulfilment_unit_id", "rider_id"]
    d = qc(spark, sf, "deliveries").filter("delivery_id is not null").withColumn("file", F.col("delivery_id") % 4)
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names]
    line = F.when(F.expr(_SHORT), F.concat_ws(",", *fields[:2])).when(F.expr(_LONG), F.concat_ws(",", *fields, F.lit("x"))).otherwise(
        F.concat_ws(",", *fields))
    heads = spark.range(4).select(F.col("id").alias("file"), F.lit(0).alias("at"), F.lit(",".join(names)).alias("line"))
    lines = heads.unionByName(d.select(F.col("file").cast("long"), F.lit(1).alias("at"), line.alias("line")))
    path = scratch_path(spark, "malformed-csv")
    (lines.repartition("file").sortWithinPartitions("file", "at").select("file", "line").write.partitionBy("file").text(path))
    odd = io.malformed_rows(spark, path, "deliveries")
    part = F.split("line", ",", -1)
    return odd.select(F.when(F.size(part) < len(names), "short").otherwise("long").alias("kind"), part[0].alias("delivery_id"),
                      F.nullif(part[1], F.lit("")).alias("status"))


@query("require_datasets", section="SRC-2", oracle="\nUNION ALL\n".join(
    f"SELECT '{t}' AS dataset, true AS present, count(*) AS n_rows FROM {t}" for t in RAW_TABLES))
def q_require_datasets(spark, sf):
    paths = {t: f"{sf.rstrip('/')}/{t}.parquet" for t in RAW_TABLES}
    io.require_datasets(spark, paths)            # raises, naming every missing input
    parts = [raw(spark, sf, t).agg(F.count(F.lit(1)).alias("n_rows"))
             .select(F.lit(t).alias("dataset"), F.lit(True).alias("present"), "n_rows") for t in RAW_TABLES]
    return reduce(DataFrame.unionByName, parts)


# planted bad text: (column, condition on the delivery, text)
_BAD_TEXT = [("delivery_distance", "delivery_id % 97 = 3", "far"), ("delivered_at", "delivery_id % 89 = 5", "soon"),
             ("failed_at", "delivery_id % 101 = 7", "2024-13-40 99:00:00")]


def _conversion_sql() -> str:
    bad = {c: cond for c, cond, _ in _BAD_TEXT}
    return "\nUNION ALL\n".join(
        f"SELECT 'deliveries' AS dataset, '{c}' AS \"column\", count(*) AS n_rows, "
        f"count(CASE WHEN {bad.get(c, 'false')} THEN 1 END) AS n_unconverted FROM qc_deliveries" for c in DELIVERY_COLS)


@query("schema_conformance", section="SRC-4", oracle=_conversion_sql())
def q_schema_conformance(spark, sf):
    """Rows of a CSV file (columns in another order, some text spoilt) that do not convert."""
    d = qc(spark, sf, "deliveries").select(*[F.col(c).cast("string").alias(c) for c in reversed(DELIVERY_COLS)])
    for c, cond, text in _BAD_TEXT:
        d = d.withColumn(c, F.when(F.expr(cond.replace("delivery_id", "cast(delivery_id as bigint)")), F.lit(text)).otherwise(F.col(c)))
    path = scratch_path(spark, "spoilt-csv")
    io.write_csv_ordered(d, path, cols=d.columns)
    return io.conversion_counts(spark, path, "deliveries")


# column counts of the derived tables (their schemas are fixed by fixtures.py)
_N_COLUMNS = {"customers": 4, "stores": 6, "riders": 4, "orders": 11, "fulfilment_units": 14, "order_items": 5,
              "deliveries": 15, "rider_assignments": 8, "operational_events": 9, "store_staffing": 7}


@query("dataset_registry", section="SRC-5", oracle="\nUNION ALL\n".join(
    f"SELECT '{t}' AS dataset, {n} AS n_columns, count(*) AS n_rows FROM qc_{t}" for t, n in _N_COLUMNS.items()))
def q_dataset_registry(spark, sf):
    reg = io.DatasetRegistry(registry(spark, sf))
    reg.create_views(prefix="dk_")
    parts = [spark.sql(f"SELECT '{t}' AS dataset, {len(reg[t].columns)} AS n_columns, count(*) AS n_rows FROM dk_{t}")
             for t in reg.tables]
    return reduce(DataFrame.unionByName, parts)


@query("dataset_row_counts", section="SNK-4", oracle="\nUNION ALL\n".join(
    f"SELECT '{t}' AS dataset, count(*) AS n_rows FROM qc_{t}" for t in _N_COLUMNS))
def q_dataset_row_counts(spark, sf):
    return io.DatasetRegistry(registry(spark, sf)).row_counts()


@query("zone_dim", section="SRC-6", oracle="""
SELECT z.zone_id, z.center_lat, z.center_lon, z.spread, count(c.customer_id) AS n_customers
FROM qc_zones z LEFT JOIN qc_customers c ON c.zone_id = z.zone_id
GROUP BY z.zone_id, z.center_lat, z.center_lon, z.spread
""")
def q_zone_dim(spark, sf):
    counts = qc(spark, sf, "customers").groupBy("zone_id").agg(F.count(F.lit(1)).alias("n_customers"))
    z = zone_dim(spark).drop("zone_idx")
    return z.join(counts, "zone_id", "left").select("zone_id", "center_lat", "center_lon", "spread",
                                                     F.coalesce("n_customers", F.lit(0)).alias("n_customers"))


@query("curated_views", section="SNK-3", oracle="""
SELECT cast(delivered_at as date) AS delivery_date, count(*) AS n_delivered,
       cast(sum(cast(round(delivery_distance * 100, 0) as bigint)) as bigint) AS total_centikm
FROM qc_deliveries WHERE status = 'DELIVERED' AND delivered_at IS NOT NULL GROUP BY 1
""")
def q_curated_views(spark, sf):
    reg = io.DatasetRegistry(registry(spark, sf))
    reg.create_views(prefix="dk_")
    spark.sql("""CREATE OR REPLACE TEMP VIEW dk_daily_deliveries AS
                 SELECT to_date(delivered_at) AS delivery_date, count(*) AS n_delivered,
                        sum(cast(round(delivery_distance * 100, 0) as bigint)) AS total_centikm
                 FROM dk_deliveries WHERE status = 'DELIVERED' AND delivered_at IS NOT NULL
                 GROUP BY to_date(delivered_at)""")
    return spark.table("dk_daily_deliveries")


@query("publish_gated", section="SNK-2", oracle=f"""
WITH v AS ({suite_sql()})
SELECT count(*) AS n_errors, count(*) = 0 AS passed, count(*) = 0 AS published FROM v
""")
def q_publish_gated(spark, sf):
    tables = registry(spark, sf, stored_log=True)
    res = io.publish_gated(spark, tables, suite.validate(tables), scratch_path(spark, "published"))
    return spark.createDataFrame([(res["n_errors"], res["passed"], res["published"])],
                                 "n_errors bigint, passed boolean, published boolean")


def _month(c: str, n: int = 0) -> str:
    return f"strftime({c} + INTERVAL {n} MONTH, '%Y-%m')"


@query("publish_partitions", section="SNK-3", oracle=f"""
WITH d AS (SELECT date_trunc('month', delivered_at) AS m, delivery_distance AS km FROM qc_deliveries WHERE delivered_at IS NOT NULL),
b AS (SELECT min(m) AS f FROM d)
SELECT {_month('m')} AS month, count(*) AS n_delivered,
       cast(sum(cast(round((km + CASE WHEN {_month('m')} = {_month('f', 1)} THEN 1.0 ELSE 0.0 END) * 100, 0) as bigint)) as bigint) AS total_centikm
FROM d, b WHERE {_month('m')} BETWEEN {_month('f', 1)} AND {_month('f', 18)} AND {_month('m')} <> {_month('f', 2)} GROUP BY 1""")
def q_publish_partitions(spark, sf):
    """Deliveries partitioned by month; one month is published again with corrected rows, one is emptied,
    and a range of months is read back (only its partitions are scanned)."""
    d = qc(spark, sf, "deliveries").filter("delivered_at is not null").select(
        "delivery_id", "delivery_distance", F.date_format("delivered_at", "yyyy-MM").alias("month"))
    path = scratch_path(spark, "deliveries-by-month")
    io.publish_partitions(d, path, "month")

    def later(n):
        return F.date_format(F.add_months(F.to_date(F.min("month"), "yyyy-MM"), n), "yyyy-MM")

    second, third, last = spark.read.parquet(path).agg(later(1), later(2), later(18)).collect()[0]
    fixed = d.filter(F.col("month") == second).withColumn("delivery_distance", F.col("delivery_distance") + F.lit(1.0))
    io.publish_partitions(fixed, path, "month", touched=[second, third])
    back = spark.read.parquet(path).filter(F.col("month").between(second, last))
    return back.groupBy("month").agg(F.count(F.lit(1)).alias("n_delivered"), F.sum(
        F.round(F.col("delivery_distance") * 100, 0).cast("bigint")).alias("total_centikm"))


def _once(table: str, key: str) -> str:
    return f"SELECT {key} FROM qc_{table} WHERE {key} IS NOT NULL GROUP BY 1 HAVING count(*) = 1"


def _clean_sql() -> str:
    from ..quality.rules import rules_for
    broken = {t: " OR ".join(f"coalesce({r.condition}, false)" for r in rules_for(t, ("row",))) or "false" for t in ("orders", "store_staffing")}
    kept = {
        "customers": f"qc_customers WHERE customer_id IN ({_once('customers', 'customer_id')})",
        "stores": f"qc_stores WHERE store_id IN ({_once('stores', 'store_id')})",
        "riders": f"qc_riders WHERE rider_id IN ({_once('riders', 'rider_id')})",
        "orders": f"qc_orders WHERE order_id IN ({_once('orders', 'order_id')}) AND NOT ({broken['orders']}) "
                  f"AND customer_id IN ({_once('customers', 'customer_id')})",
        "store_staffing": f"qc_store_staffing WHERE staffing_snapshot_id IN ({_once('store_staffing', 'staffing_snapshot_id')}) "
                          f"AND NOT ({broken['store_staffing']}) AND store_id IN ({_once('stores', 'store_id')})",
    }
    from ..quality.keys import UNIQUE_ORDER
    return "\nUNION ALL\n".join(f"SELECT '{t}' AS dataset, true AS published, " + (
        f"count(*) AS n_rows FROM {kept[t]}" if t in kept else "0 AS n_rows") for t in UNIQUE_ORDER)


def clean_part(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Rows of the master tables, orders and staffing that break no rule, in declared columns (those that
    the supplied data does not fill are NULL), each computed once and kept; the other tables empty."""
    from ..sources.schemas import key_of
    out = {}
    for t, df in tables.items():
        d = df.select(*[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
                        for f in io.struct_type(t)])
        if t not in ("customers", "stores", "riders", "orders", "store_staffing"):
            out[t] = d.limit(0)
            continue
        k = key_of(t)
        single = d.groupBy(k).agg(F.count(F.lit(1)).alias("_n")).filter("_n = 1").select(k)
        checked = suite.row_violations(d, t, set())
        out[t] = checked.filter(F.size("_violations") == 0).select(*d.columns).join(single, k, "left_semi")
    # parents and their children are read many times (by the joins here, every rule and the publication)
    for t in ("customers", "stores", "riders"):
        out[t] = kept(out[t], f"clean-{t}")
    out["orders"] = kept(out["orders"].join(out["customers"].select("customer_id"), "customer_id", "left_semi").select(
        *declared_columns("orders")), "clean-orders")
    out["store_staffing"] = kept(out["store_staffing"].join(out["stores"].select("store_id"), "store_id", "left_semi").select(
        *declared_columns("store_staffing")), "clean-staffing")
    return out


@query("publish_clean", section="SNK-2", oracle=_clean_sql())
def q_publish_clean(spark, sf):
    """A publication that passes the gate: written, made current, and read back through the pointer."""
    tables = clean_part(registry(spark, sf))
    target = scratch_path(spark, "published-clean")
    res = io.publish_gated(spark, tables, suite.validate(tables), target, "parquet")
    parts = [io.read_published(spark, target, t, "parquet").agg(F.count(F.lit(1)).alias("n_rows")) if res["published"]
             else spark.createDataFrame([(0,)], "n_rows bigint") for t in tables]
    return reduce(DataFrame.unionByName, [p.select(F.lit(t).alias("dataset"), F.lit(res["published"]).alias("published"), "n_rows")
                                          for t, p in zip(tables, parts)])
