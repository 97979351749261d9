"""Rules over several tables, decided in one co-partitioned pass per key.

Rules that look at the same key are decided together. The *facts* of a key (is it known, has it an
item, which required events has it, how often was it accepted, ...) come from all tables that tell
something about it: narrow rows, unioned and aggregated once by the key. The *probes* are the rows
that rules are about: narrow rows of all those tables, tagged, unioned and joined once with the facts.
That is two exchanges per key however many rules there are. The aggregate combines before its shuffle,
so a hot key is one row per task there; a hot key among the probes is split by AQE, as each key has
one row of facts. Probes without a key never match and skip the join, so they do not meet in one task.

Passes:
* (delivery, rider): AE-01, and whether a delivery's rider accepted an offer for it;
* unit: FK-05, FK-06, FK-11, OWN-01, COV-01, SM-01..03, and SM-04 for deliveries whose unit exists;
* delivery: FK-08, FK-12, EV-01..06;
* order and customer, told apart by a tag: FK-01, FK-02, FK-04, FK-10;
* store: FK-03, FK-13, FK-15; rider: FK-07, FK-09, FK-14 (apart, so that AQE may broadcast such few ids).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..operators import joins, lifecycle
from ..sources.schemas import key_of
from .keys import FOREIGN_KEYS
from .rules import BY_ID

#: Parents of which only the ids are asked, by pass.
REFERRED = (("orders", "customers"), ("stores",), ("riders",))
UNIT, DELIVERY = "fulfilment_unit_id", "delivery_id"
OUT = ["rule_id", "severity", "dataset", "entity_id", "column", "detail"]


def _hit(rule_id: str, cond: Column) -> Column:
    """The rule as a struct where ``cond`` holds (and is not NULL), else NULL."""
    r = BY_ID[rule_id]
    return F.when(cond, F.struct(F.lit(r.rule_id).alias("rule_id"), F.lit(r.severity).alias("severity"),
                                 F.lit(r.dataset).alias("dataset"), F.lit(r.column).alias("column"),
                                 F.lit(r.description).alias("detail")))


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _decide(probes: list[DataFrame], facts: DataFrame, hits: list[Column], on: tuple[str, ...] = ("key",),
            keyless: list[DataFrame] | None = None) -> DataFrame:
    """The rules that the probes break, one row each; at most one row of facts per key. ``keyless``: where
    the probes without a key are to be read from, if a cheaper plan than that of ``probes`` has them."""
    def present():
        return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in on])

    joined = _union(probes).filter(present()).join(facts, list(on), "left").unionByName(
        _union(keyless or probes).filter(~present()), allowMissingColumns=True)
    # a slot for every rule, empty ones dropped afterwards: see ``suite.row_local``
    return joined.select(F.col("entity_id").cast("string").alias("entity_id"), F.inline(F.array(*hits))).filter("rule_id is not null").select(OUT)


def _numbered(names: list[str], tag: str) -> Column:
    """The tag of a probe as a small number: probes are shuffled and sorted, so they are kept narrow."""
    return F.lit(names.index(tag)).cast("byte")


def _entity(t: dict[str, DataFrame], named: list[tuple[str, str]]) -> str:
    """Type in which the ids of probes of several tables travel; ``_decide`` writes them as text."""
    return joins._common_key_type([(t[table], column) for table, column in named if table in t and column in t[table].columns])


def _told(flag: str) -> Column:
    return F.coalesce(F.col(flag), F.lit(False))


def _type(tables: dict[str, DataFrame], column: str, names: list[str]) -> str:
    return joins._common_key_type([(tables[t], column) for t in names if t in tables and column in tables[t].columns])


PAIR = ["d", "r", "no_d", "no_r"]
EVENT = 1 << 32


def _pair(df: DataFrame, d_type: str, r_type: str) -> DataFrame:
    """``df`` with its (delivery, rider) as columns that are never NULL, so that two missing ids match
    by plain equality."""
    for name, flag, column, kind in (("d", "no_d", DELIVERY, d_type), ("r", "no_r", "rider_id", r_type)):
        empty = F.lit(0).cast("long") if kind == "long" else F.lit("")
        df = df.withColumn(flag, F.col(column).isNull()).withColumn(name, F.coalesce(F.col(column).cast(kind), empty))
    return df


def pair_facts(t: dict[str, DataFrame], d_type: str, r_type: str) -> DataFrame:
    """Per (delivery, rider) and in one number, so that every use reads the same exchange: RIDER_ASSIGNED
    events times ``EVENT``, and accepted offers."""
    def rows(df, accepted, assigned):
        return _pair(df, d_type, r_type).select(*PAIR, F.lit(accepted + assigned * EVENT).cast("long").alias("n"))

    parts = [rows(t["rider_assignments"].filter("response = 'ACCEPTED'"), 1, 0)]
    if "operational_events" in t and {"event_type", DELIVERY, "rider_id"} <= set(t["operational_events"].columns):
        parts.append(rows(t["operational_events"].filter("event_type = 'RIDER_ASSIGNED'"), 0, 1))
    return _union(parts).groupBy(*PAIR).agg(F.sum("n").alias("n"))


def pair_pass(t: dict[str, DataFrame], skip: set[str]) -> tuple[list[DataFrame], DataFrame | None]:
    """AE-01 (two missing values match), and the deliveries with ``unaccepted``: a rider who never
    accepted an offer for them (an offer of no delivery is none)."""
    if "rider_assignments" not in t or {"AE-01", "SM-04"} <= skip:
        return [], None
    types = (_type(t, DELIVERY, ["deliveries", "rider_assignments", "operational_events"]),
             _type(t, "rider_id", ["deliveries", "rider_assignments", "operational_events"]))
    facts = pair_facts(t, *types)
    out, marked = [], None
    if "AE-01" not in skip:
        offers = _pair(t["rider_assignments"].filter("response = 'ACCEPTED'"), *types).select(
            F.col("assignment_id").cast("string").alias("entity_id"), *PAIR)
        out.append(_decide([offers], facts, [_hit("AE-01", F.coalesce(F.expr(f"n div {EVENT}"), F.lit(0)) != 1)], tuple(PAIR)))
    if "SM-04" not in skip:
        rows = _pair(t["deliveries"].select(DELIVERY, UNIT, "rider_id", "status"), *types)
        marked = rows.join(facts, PAIR, "left").withColumn(
            "unaccepted", ~F.col("no_r") & (F.col("no_d") | (F.coalesce(F.col("n") % EVENT, F.lit(0)) == 0)))
    return out, marked


def unit_pass(t: dict[str, DataFrame], skip: set[str], deliveries: DataFrame | None) -> list[DataFrame]:
    """All rules about a fulfilment unit's id."""
    if "fulfilment_units" not in t or UNIT not in t["fulfilment_units"].columns:
        return []
    kt = _type(t, UNIT, ["fulfilment_units", "order_items", "deliveries", "operational_events"])
    ot = _type(t, "order_id", ["order_items", "fulfilment_units"]) if all(
        x in t and "order_id" in t[x].columns for x in ("order_items", "fulfilment_units")) else "string"
    key = F.col(UNIT).cast(kt).alias("key")
    units = t["fulfilment_units"]
    has = set(units.columns)
    order = [F.col(c) for c in joins.LAST_ORDER["fulfilment_units"] if c in has]
    known = units.select(key, F.struct(*order, F.lit(0)).alias("rank"), F.lit(True).alias("is_unit"), F.struct(
        (F.col("order_id").cast(ot) if "order_id" in has else F.lit(None).cast(ot)).alias("order_id"),
        (F.col("status") if "status" in has else F.lit(None).cast("string")).alias("status")).alias("unit"))
    parts = [known]
    if "COV-01" not in skip:
        parts.append(t["order_items"].select(key, F.lit(True).alias("has_item")))
    rows = _union(parts).filter("key is not null")
    flags = [F.max(c).alias(c) for c in rows.columns if c in ("is_unit", "has_item")]
    facts = rows.groupBy("key").agg(F.max_by("unit", "rank").alias("unit"), *flags)

    probes, keyless, hits = [], [], []
    tags = ["item", "delivery", "event", "unit"]
    et = _entity(t, [("order_items", "order_item_id"), ("deliveries", DELIVERY), ("operational_events", "event_id"), ("fulfilment_units", UNIT)])

    def probe(df, tag, entity, *more, need=None, plain=None):
        def rows(x):
            return (x if need is None else x.filter(need)).select(
                key, _numbered(tags, tag).alias("tag"), F.col(entity).cast(et).alias("entity_id"), *[c for c in more if c in x.columns])
        probes.append(rows(df))
        keyless.append(rows(df if plain is None else plain))

    def rule(rule_id, tag, cond):
        if rule_id not in skip:
            hits.append(_hit(rule_id, (F.col("tag") == _numbered(tags, tag)) & cond))

    if not {"FK-05", "OWN-01"} <= skip:
        other = ["order_id"] if "OWN-01" not in skip else []
        items = t["order_items"].withColumn("order_id", F.col("order_id").cast(ot)) if other else t["order_items"]
        probe(items, "item", "order_item_id", *other)
        rule("FK-05", "item", ~_told("is_unit"))
        if other:
            rule("OWN-01", "item", _told("is_unit") & ~F.col("order_id").eqNullSafe(F.col("unit.order_id")))
    if not {"FK-06", "SM-01", "SM-02", "SM-03", "SM-04"} <= skip:
        d = t["deliveries"] if deliveries is None else deliveries
        probe(d, "delivery", DELIVERY, "status", "unaccepted", plain=t["deliveries"])
        rule("FK-06", "delivery", ~_told("is_unit"))
        for rule_id, (status, implied) in zip(("SM-01", "SM-02", "SM-03"), joins.IMPLIED_UNIT_STATUS.items()):
            if rule_id not in skip:
                rule(rule_id, "delivery", _told("is_unit") & (F.col("status") == status) & ~F.col("unit.status").eqNullSafe(F.lit(implied)))
        if deliveries is not None:
            rule("SM-04", "delivery", _told("is_unit") & F.col("unaccepted"))
    if "FK-11" not in skip:
        probe(t["operational_events"], "event", "event_id", need=F.col(UNIT).isNotNull())
        rule("FK-11", "event", ~_told("is_unit"))
    if "COV-01" not in skip:
        probe(units, "unit", UNIT)
        rule("COV-01", "unit", ~_told("has_item"))
    return [_decide(probes, facts, hits, keyless=keyless)] if hits else []


def delivery_pass(t: dict[str, DataFrame], skip: set[str]) -> list[DataFrame]:
    """References to deliveries, and the events that a delivery's status requires."""
    if "deliveries" not in t or DELIVERY not in t["deliveries"].columns:
        return []
    kt = _type(t, DELIVERY, ["deliveries", "rider_assignments", "operational_events"])
    key = F.col(DELIVERY).cast(kt).alias("key")
    required = {"DELIVERED": lifecycle.REQUIRED_DELIVERED, "FAILED": lifecycle.REQUIRED_FAILED}
    numbered = [(f"EV-{i:02d}", status, event) for i, (status, event) in
                enumerate([(s, e) for s, events in required.items() for e in events], 1)]
    evented = not {rule_id for rule_id, *_ in numbered} & skip
    parts = [t["deliveries"].select(key, F.lit(True).alias("is_delivery"), F.lit(None).cast("string").alias("event_type"))]
    if evented:
        parts.append(t["operational_events"].filter(F.col("event_type").isin([e for *_, e in numbered])).select(
            key, F.lit(None).cast("boolean").alias("is_delivery"), "event_type"))
    facts = _union(parts).filter("key is not null").groupBy("key").agg(
        F.max("is_delivery").alias("is_delivery"), *[F.max(F.col("event_type") == e).alias(f"has_{e}") for *_, e in numbered if evented])
    probes, hits = [], []
    tags = ["rider_assignments", "operational_events", "deliveries"]
    et = _entity(t, [(table, key_of(table)) for table in tags])
    for rule_id, table, need in (("FK-08", "rider_assignments", None), ("FK-12", "operational_events", F.col(DELIVERY).isNotNull())):
        if rule_id not in skip:
            df = t[table] if need is None else t[table].filter(need)
            probes.append(df.select(key, _numbered(tags, table).alias("tag"), F.col(key_of(table)).cast(et).alias("entity_id")))
            hits.append(_hit(rule_id, (F.col("tag") == _numbered(tags, table)) & ~_told("is_delivery")))
    if evented:
        probes.append(t["deliveries"].filter(F.col("status").isin(list(required))).select(
            key, _numbered(tags, "deliveries").alias("tag"), F.col(DELIVERY).cast(et).alias("entity_id"), "status"))
        hits += [_hit(rule_id, (F.col("tag") == _numbered(tags, "deliveries")) & (F.col("status") == status) & ~_told(f"has_{event}"))
                 for rule_id, status, event in numbered]
    return [_decide(probes, facts, hits)] if hits else []


def reference_pass(t: dict[str, DataFrame], skip: set[str], parents: tuple[str, ...]) -> list[DataFrame]:
    """References to tables of which only the ids are asked, with a tag per parent."""
    specs = [sp for sp in FOREIGN_KEYS if sp[3] in parents and sp[0] not in skip]
    if not specs:
        return []
    kt = joins._common_key_type([(t[sp[1]], sp[2]) for sp in specs] + [(t[sp[3]], sp[4]) for sp in specs])
    on = ("parent", "key")[len(parents) == 1:]                     # one parent needs no tag
    facts = _union([t[p].select(F.lit(parents.index(p)).alias("parent"), F.col(k).cast(kt).alias("key")).select(*on)
                    for p, k in dict.fromkeys((sp[3], sp[4]) for sp in specs)]).filter("key is not null").distinct()
    probes, hits = [], []
    tags, et = [sp[0] for sp in specs], _entity(t, [(sp[1], key_of(sp[1])) for sp in specs])
    for rule_id, child, column, parent, _, optional in specs:
        df = t[child].filter(F.col(column).isNotNull()) if optional else t[child]
        probes.append(df.select(F.lit(parents.index(parent)).alias("parent"), F.col(column).cast(kt).alias("key"),
                                _numbered(tags, rule_id).alias("tag"), F.col(key_of(child)).cast(et).alias("entity_id"))
                      .select(*on, "tag", "entity_id"))
        hits.append(_hit(rule_id, (F.col("tag") == _numbered(tags, rule_id)) & F.col("known").isNull()))
    return [_decide(probes, facts.withColumn("known", F.lit(True)), hits, on)]


def keyed_violations(tables: dict[str, DataFrame], skip: set[str]) -> list[DataFrame]:
    """The violations of all rules over several tables but OV-01; rules in ``skip`` are left out."""
    pairs, deliveries = pair_pass(tables, skip)
    out = [*pairs, *unit_pass(tables, skip, deliveries), *delivery_pass(tables, skip)]
    for parents in REFERRED:
        out += reference_pass(tables, skip, parents)
    return out
