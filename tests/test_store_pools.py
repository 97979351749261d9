"""Store pools against a scan of all stores."""

from dispatchkit.operators.joins import units_outside_store_candidates
from dispatchkit.operators.store_pools import pool_members, second_store_pools, store_pools

STORES = [(1, "A", "ACTIVE"), (2, "A", "ACTIVE"), (3, "B", "ACTIVE"), (4, "C", "CLOSED"), (5, None, "ACTIVE"), (2, "A", "ACTIVE")]
ORDERS = [(10, "A"), (11, "B"), (12, "C"), (13, "D"), (14, None)]
UNITS = [(100, 10, 1), (101, 10, 3), (102, 11, 3), (103, 12, 4), (104, 13, 1), (105, 14, 1), (106, 10, None), (107, 99, 1), (108, 11, 77), (109, 11, 5)]


def frames(spark, stores=STORES):
    return (spark.createDataFrame([(i, f"s{i}", 0.0, 0.0, z, s) for i, z, s in stores],
                                  "store_id long, store_name string, latitude double, longitude double, zone string, status string"),
            spark.createDataFrame([(o, z, None, None, "CREATED") for o, z in ORDERS],
                                  "order_id long, delivery_zone string, created_at timestamp_ntz, payment_success_at timestamp_ntz, status string"),
            spark.createDataFrame(UNITS, "fulfilment_unit_id long, order_id long, store_id long"))


def test_pools_of_orders(spark):
    stores, orders, _ = frames(spark)
    got = {r.order_id: (r.cand_zone, r.n_candidates) for r in store_pools(orders, stores).collect()}
    assert got == {10: ("A", 2), 11: ("B", 1), 12: ("*", 4), 13: ("*", 4), 14: ("*", 4)}
    members = sorted((r.cand_zone, r.store_id) for r in pool_members(stores).collect())
    assert members == [("*", 1), ("*", 2), ("*", 3), ("*", 5), ("A", 1), ("A", 2), ("B", 3)]
    none = store_pools(orders, stores.filter("status = 'CLOSED'")).collect()
    assert {(r.cand_zone, r.n_candidates) for r in none} == {(None, 0)} and len(none) == 5


def test_alternatives_of_units(spark):
    stores, orders, units = frames(spark)
    got = {r.fulfilment_unit_id: r.n_alternatives for r in second_store_pools(units, orders, stores).collect()}
    act = {i: z for i, z, s in STORES if s == "ACTIVE"}
    zone = dict(ORDERS)
    assert got == {u: sum(z is not None and z == zone[o] and i != s for i, z in act.items())
                   for u, o, s in UNITS if s is not None and o in zone}


def test_recorded_stores_outside_their_pool(spark):
    stores, orders, units = frames(spark)
    got = {r.fulfilment_unit_id: r.reason for r in units_outside_store_candidates(units, orders, stores).collect()}
    assert got == {101: "OTHER_ZONE", 103: "INACTIVE_STORE", 108: "UNKNOWN_STORE", 109: "OTHER_ZONE"}
