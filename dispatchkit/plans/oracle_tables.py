"""The derived operational tables as DuckDB SQL (common table expressions).

Independent SQL formulation of ``fixtures.py`` for the oracle. ``with_tables(sql)``
prefixes exactly the CTEs a query mentions (plus their dependencies).
"""

from __future__ import annotations

import re

S = "interval '1' second"

CTES: dict[str, str] = {}
DEPS: dict[str, list[str]] = {}


def _cte(name: str, deps: list[str], body: str) -> None:
    CTES[name] = body
    DEPS[name] = deps


_cte("qc_zones", [], """
SELECT * FROM (VALUES
  (0, 'BLR-CEN', cast(12.9716 as double), cast(77.5946 as double), cast(0.025 as double)),
  (1, 'BLR-NTH', cast(13.05 as double), cast(77.59 as double), cast(0.035 as double)),
  (2, 'BLR-STH', cast(12.9 as double), cast(77.59 as double), cast(0.035 as double)),
  (3, 'BLR-EST', cast(12.97 as double), cast(77.67 as double), cast(0.035 as double)),
  (4, 'BLR-WST', cast(12.96 as double), cast(77.53 as double), cast(0.035 as double))
) AS t(zone_idx, zone_id, center_lat, center_lon, spread)""")


def _lat(k: str, z: str = "z") -> str:
    return f"({z}.center_lat + {z}.spread * (cast((({k})*37) % 1001 - 500 as double) / 500))"


def _lon(k: str, z: str = "z") -> str:
    return f"({z}.center_lon + {z}.spread * (cast((({k})*53) % 1001 - 500 as double) / 500))"


_cte("qc_customers", ["qc_zones"], f"""
SELECT c.c_custkey AS customer_id, z.zone_id, {_lat('c.c_custkey')} AS latitude, {_lon('c.c_custkey')} AS longitude
FROM customer c JOIN qc_zones z ON c.c_nationkey % 5 = z.zone_idx""")

_cte("qc_stores", ["qc_zones"], f"""
SELECT s.s_suppkey AS store_id, z.zone_id AS zone, {_lat('s.s_suppkey')} AS latitude, {_lon('s.s_suppkey')} AS longitude,
       cast(80 + s.s_suppkey % 101 as integer) AS baseline_capacity,
       CASE WHEN s.s_acctbal < 0 THEN 'INACTIVE' ELSE 'ACTIVE' END AS status
FROM supplier s JOIN qc_zones z ON s.s_nationkey % 5 = z.zone_idx""")

_cte("qc_riders", ["qc_zones"], """
SELECT c.c_custkey AS rider_id, CASE WHEN c.c_custkey % 20 = 0 THEN 'BIKE' ELSE 'SCOOTER' END AS vehicle_type,
       z.zone_id AS home_zone, CASE WHEN c.c_acctbal < 0 THEN 'INACTIVE' ELSE 'ACTIVE' END AS status
FROM customer c JOIN qc_zones z ON c.c_nationkey % 5 = z.zone_idx
WHERE c.c_custkey % 10 = 0""")

_cte("ord_t", [], f"""
SELECT o_orderkey AS k, o_custkey, o_orderdate,
       o_orderdate + {S} * ((o_orderkey*7919) % 86400) AS created,
       o_orderdate + {S} * ((o_orderkey*7919) % 86400)
         + {S} * (CASE WHEN o_orderkey % 97 = 0 THEN -10 ELSE 5 + o_orderkey % 41 END) AS base,
       CASE WHEN o_orderkey % 50 = 0 THEN 'CANCELLED' WHEN o_orderkey % 50 = 1 THEN 'FAILED' ELSE 'DELIVERED' END AS st
FROM orders""")

_cte("qc_orders", ["ord_t", "qc_zones"], f"""
SELECT t.k AS order_id, CASE WHEN t.k % 307 = 0 THEN -1 ELSE t.o_custkey END AS customer_id,
       t.created AS created_at, t.base AS payment_success_at,
       {_lat('t.k')} AS delivery_latitude, {_lon('t.k')} AS delivery_longitude,
       z.zone_id AS delivery_zone, t.st AS status,
       CASE WHEN t.st = 'CANCELLED' OR t.k % 89 = 0 THEN t.base + {S} * 600 END AS cancelled_at,
       CASE WHEN t.st = 'CANCELLED' OR t.k % 83 = 0 THEN 'STORE_ISSUE' END AS cancellation_reason,
       CASE WHEN t.st = 'FAILED' OR t.k % 79 = 0 THEN 'ITEM_UNAVAILABLE' END AS failure_reason
FROM ord_t t LEFT JOIN customer c ON t.o_custkey = c.c_custkey
LEFT JOIN qc_zones z ON (c.c_nationkey + CASE WHEN t.k % 10 = 0 THEN 1 ELSE 0 END) % 5 = z.zone_idx""")

_cte("f0", ["ord_t"], """
SELECT g.l_orderkey*100000 + g.l_suppkey AS fid, g.l_orderkey AS k, g.l_suppkey AS s,
       g.l_orderkey*31 + g.l_suppkey*17 AS h, 30*g.n AS w, t.base, t.o_custkey - t.o_custkey % 10 AS rider,
       CASE WHEN (g.l_orderkey*31 + g.l_suppkey*17) % 100 < 3 THEN 'CANCELLED'
            WHEN (g.l_orderkey*31 + g.l_suppkey*17) % 100 < 5 THEN 'FAILED' ELSE 'COMPLETED' END AS st
FROM (SELECT l_orderkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_suppkey) g
JOIN ord_t t ON g.l_orderkey = t.k""")

_cte("qc_fulfilment_units", ["f0"], f"""
SELECT fid AS fulfilment_unit_id,
       CASE WHEN h % 211 = 0 THEN -1 WHEN h % 199 = 0 THEN k + 1 ELSE k END AS order_id,
       CASE WHEN h % 229 = 0 THEN -1 ELSE s END AS store_id,
       st AS status,
       base + {S} * (30 + h % 91) AS assigned_to_store_at,
       base + {S} * (90 + h % 91 + h % 121) AS picking_started_at,
       CASE WHEN h % 103 = 0 THEN base ELSE base + {S} * (320 + w + h % 120) END AS picking_completed_at,
       CASE WHEN st <> 'CANCELLED' THEN base + {S} * (900 + w + h % 31) END AS packing_started_at,
       CASE WHEN st <> 'CANCELLED' THEN base + {S} * (960 + w + h % 91) END AS packing_completed_at,
       CASE WHEN st = 'CANCELLED' AND h % 7 <> 0 THEN base + {S} * (1100 + w) END AS cancelled_at,
       CASE WHEN st = 'CANCELLED' AND h % 11 <> 0 THEN 'CUSTOMER_REQUEST' END AS cancellation_reason,
       CASE WHEN st = 'FAILED' AND h % 7 <> 0 THEN base + {S} * (1100 + w) END AS failed_at,
       CASE WHEN st = 'FAILED' AND h % 11 <> 0 THEN 'NO_RIDER_ACCEPTED' END AS failure_reason,
       CASE WHEN st = 'COMPLETED' AND h % 107 <> 0 THEN base + {S} * (2400 + w + h % 600) END AS completed_at
FROM f0""")

_cte("qc_order_items", [], """
SELECT l_orderkey*10 + l_linenumber AS order_item_id,
       CASE WHEN l_partkey % 409 = 0 THEN -1 ELSE l_orderkey END AS order_id,
       CASE WHEN l_partkey % 401 = 0 THEN -1 ELSE l_orderkey*100000 + l_suppkey END AS fulfilment_unit_id,
       l_partkey AS product_id, cast(trunc(l_quantity) as integer) AS quantity
FROM lineitem WHERE (l_orderkey*31 + l_suppkey*17) % 227 <> 0""")

_cte("d0", ["f0"], """
SELECT fid, k, s, h, w, base, rider,
       CASE WHEN h % 109 = 0 THEN 'CANCELLED' WHEN h % 113 = 0 THEN 'FAILED' WHEN h % 127 = 0 THEN 'DELIVERED'
            WHEN st = 'COMPLETED' THEN 'DELIVERED' ELSE st END AS st
FROM f0""")

_cte("qc_deliveries", ["d0"], f"""
SELECT fid AS delivery_id, CASE WHEN h % 233 = 0 THEN -1 ELSE fid END AS fulfilment_unit_id,
       CASE WHEN st <> 'DELIVERED' OR h % 137 = 0 THEN NULL WHEN h % 131 = 0 THEN -1 ELSE rider END AS rider_id,
       st AS status,
       CASE WHEN st = 'DELIVERED' AND h % 239 <> 0 THEN base + {S} * (1300 + w) END AS rider_arrived_at_store,
       CASE WHEN st = 'DELIVERED' AND h % 149 <> 0
            THEN base + {S} * ((CASE WHEN h % 139 = 0 THEN 1270 ELSE 1360 END) + w) END AS picked_up_at,
       CASE WHEN st = 'DELIVERED' AND h % 241 <> 0
            THEN base + {S} * ((CASE WHEN h % 151 = 0 THEN 1000 ELSE 1420 END) + w + h % 60) END AS delivery_started_at,
       CASE WHEN st = 'DELIVERED' AND h % 163 <> 0
            THEN base + {S} * ((CASE WHEN h % 157 = 0 THEN 700 ELSE 2400 END) + w + h % 600) END AS delivered_at,
       cast(h % 1200 as double) / 100 AS delivery_distance,
       CASE h % 4 WHEN 0 THEN 'LOW' WHEN 1 THEN 'MODERATE' WHEN 2 THEN 'HIGH' ELSE 'SEVERE' END AS traffic_condition,
       CASE h % 3 WHEN 0 THEN 'CLEAR' WHEN 1 THEN 'CLOUDY' ELSE 'RAIN' END AS weather_condition,
       CASE WHEN st = 'CANCELLED' AND h % 7 <> 0 THEN base + {S} * (1100 + w) END AS cancelled_at,
       CASE WHEN st = 'CANCELLED' AND h % 11 <> 0 THEN 'CUSTOMER_REQUEST' END AS cancellation_reason,
       CASE WHEN st = 'FAILED' AND h % 7 <> 0 THEN base + {S} * (1100 + w) END AS failed_at,
       CASE WHEN st = 'FAILED' AND h % 11 <> 0 THEN 'NO_RIDER_ACCEPTED' END AS failure_reason
FROM d0""")

_cte("a0", ["d0"], """
SELECT d0.*, g.n,
       CASE WHEN g.n = 1 + d0.h % 3 THEN d0.rider ELSE 10 * ((d0.h + g.n) % 15) END AS a_rider,
       CASE WHEN g.n = 1 + d0.h % 3 AND d0.st = 'DELIVERED' AND d0.h % 173 <> 0 THEN 'ACCEPTED'
            WHEN (d0.h + g.n) % 2 = 0 THEN 'REJECTED' ELSE 'EXPIRED' END AS r
FROM d0 JOIN (VALUES (1), (2), (3)) AS g(n) ON g.n <= 1 + d0.h % 3""")

_cte("qc_rider_assignments", ["a0"], f"""
SELECT fid*10 + n AS assignment_id, CASE WHEN h % 167 = 0 THEN -1 ELSE fid END AS delivery_id,
       CASE WHEN h % 251 = 0 THEN -1 ELSE a_rider END AS rider_id,
       base + {S} * (1100 + w + 20*n) AS offered_at,
       CASE WHEN (r <> 'EXPIRED' AND h % 179 <> 0) OR (r = 'EXPIRED' AND h % 181 = 0)
            THEN base + {S} * (1120 + w + 20*n + h % 71) END AS responded_at,
       CASE WHEN (r = 'EXPIRED' AND h % 191 <> 0) OR (r <> 'EXPIRED' AND h % 193 = 0)
            THEN base + {S} * (1120 + w + 20*n + h % 71) END AS expired_at,
       r AS response, CASE WHEN r = 'REJECTED' AND h % 197 <> 0 THEN 'BUSY' END AS rejection_reason
FROM a0""")


def _ev(code: int, etype: str, src: str, tcol: str, eid: str, h: str, order: str | None, unit: str | None,
        delivery: str | None, store: str | None, rider: str | None) -> str:
    def f(v, m):
        return "NULL" if v is None else f"CASE WHEN ({h} + {code}) % {m} = 0 THEN -1 ELSE {v} END"
    return (f"SELECT {eid}*16 + {code} AS event_id, '{etype}' AS event_type, {tcol} AS occurred_at, "
            f"cast({f(order, 263)} as bigint) AS order_id, cast({f(unit, 269)} as bigint) AS fulfilment_unit_id, "
            f"cast({f(delivery, 271)} as bigint) AS delivery_id, cast({f(store, 277)} as bigint) AS store_id, "
            f"cast({f(rider, 281)} as bigint) AS rider_id, cast(NULL as varchar) AS reason "
            f"FROM {src} WHERE {tcol} IS NOT NULL AND ({h} + {code}) % 89 <> 0")


_ev_parts = [
    _ev(1, "ORDER_CREATED", "ord_t", "created", "k", "k*31", "k", None, None, None, None),
    _ev(2, "PAYMENT_SUCCESS", "ord_t", "base", "k", "k*31", "k", None, None, None, None),
]
_fsrc = "f0 JOIN qc_fulfilment_units u ON f0.fid = u.fulfilment_unit_id"
for _c, _t, _col in [(3, "STORE_ASSIGNED", "assigned_to_store_at"), (4, "PICKING_STARTED", "picking_started_at"),
                     (5, "PICKING_COMPLETED", "picking_completed_at"), (6, "FULFILMENT_CANCELLED", "u.cancelled_at"),
                     (7, "PACKING_STARTED", "packing_started_at"), (8, "PACKING_COMPLETED", "packing_completed_at")]:
    _ev_parts.append(_ev(_c, _t, _fsrc, _col, "f0.fid", "f0.h", "f0.k", "f0.fid", None, "f0.s", None))
_dsrc = "f0 JOIN qc_deliveries dd ON f0.fid = dd.delivery_id"
_ev_parts.append(_ev(10, "DELIVERY_FAILED", _dsrc, "dd.failed_at", "f0.fid", "f0.h", "f0.k", "f0.fid", "f0.fid",
                     "f0.s", None))
_asrc = ("a0 JOIN qc_rider_assignments ra ON ra.assignment_id = a0.fid*10 + a0.n AND a0.r = 'ACCEPTED'")
_ev_parts.append(_ev(11, "RIDER_ASSIGNED", _asrc, "ra.responded_at", "a0.fid", "a0.h", "a0.k", "a0.fid", "a0.fid",
                     "a0.s", "a0.a_rider"))
for _c, _t, _col in [(12, "RIDER_ARRIVED_AT_STORE", "dd.rider_arrived_at_store"), (13, "PICKED_UP", "dd.picked_up_at"),
                     (14, "DELIVERY_STARTED", "dd.delivery_started_at"), (15, "DELIVERED", "dd.delivered_at")]:
    _ev_parts.append(_ev(_c, _t, _dsrc, _col, "f0.fid", "f0.h", "f0.k", "f0.fid", "f0.fid", "f0.s", "f0.rider"))

_cte("qc_operational_events", ["ord_t", "f0", "qc_fulfilment_units", "qc_deliveries", "a0", "qc_rider_assignments"],
     "\nUNION ALL\n".join(_ev_parts))

_cte("qc_store_staffing", [], f"""
SELECT s*24 + n AS staffing_snapshot_id,
       CASE WHEN s % 293 = 0 AND n = 23 THEN -1 ELSE s END AS store_id,
       timestamp '1995-07-01 00:00:00' + {S} * (n * 2592000) AS recorded_at,
       cast(1 + (s + n) % 5 as integer) AS pickers_scheduled,
       cast(least(1 + (s + n) % 5, (s*3 + n) % 6) as integer) AS pickers_available,
       cast(1 + (s + n) % 3 as integer) AS packers_scheduled,
       cast(least(1 + (s + n) % 3, (s*5 + n) % 4) as integer) AS packers_available
FROM (SELECT s_suppkey AS s FROM supplier WHERE s_suppkey % 37 <> 36) sp, range(0, 24) AS g(n)""")


def _closure(names: list[str]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        if n in out:
            return
        for d in DEPS[n]:
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def with_tables(sql: str) -> str:
    """Prefix ``sql`` with the CTEs of every derived table it mentions."""
    used = [n for n in CTES if re.search(rf"\b{n}\b", sql)]
    if not used:
        return sql
    names = _closure(used)
    ctes = ",\n".join(f"{n} AS ({CTES[n]}\n)" for n in names)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
