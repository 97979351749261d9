"""Conversation structure repair with Four-Russians block tables (operator 13).

A conversation's rows, in turn order, are edited at least cost so that the initials of their roles
read ``(s?(ua)+)?``. Edits: Keep 0, Rerole to user or assistant 3, Delete 4 (the only one for blank
and duplicate rows), Insert an empty user or assistant row 3; a truncated row that is not deleted adds
3. Among the cheapest edit sequences the one whose initials are least in ASCII order is taken.

A row is one of nine symbols: must go, or one of the initials s, u, a, other, truncated or not. The
dynamic program has four states (nothing yet, after s, after u, after a); the pattern fixes what an
insertion or a new role can be, so a state and an edit name one next state. A cost vector is normalised
by its least entry, and entries more than ``DEAD`` above it can never be part of a cheapest edit, so
only a few dozen vectors exist. ``block_tables`` precomputes, for every vector and every block of
``BLOCK`` symbols, the vector after the block and the cost added. Conversations are processed block by
block by lookup; then the blocks are expanded backward, and at each row the states on cheapest paths
are ranked by their best remaining initials, which makes ties exact without comparing strings. A
backward step depends on few values and is looked up once it is known.

Texts are range-sorted by (conversation, turn) once. Conversations inside one range partition are
repaired there in one streaming pass. The first and last conversation of each partition may go on in
others, however many rows they have: for these, one byte a row comes together per conversation (as
the audit does), and the texts stay in their segments. Duplicates among them are found by an aggregate
on (conversation, digest).

Defined results: NULL role or text counts as one space; NULL turns come first; NULL conversation ids
are one conversation; rows of one turn are ordered by role and text; an initial is the first character,
so an empty or unknown role fits nowhere and is reroled or deleted; rows that are equal in all columns are
duplicates; a conversation whose rows are all marked ``absent`` has zeros and an empty repair; an
empty table gives no rows; further columns are ignored; very long texts are handled whole.
"""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StringType, StructField, StructType

from ..operators.ordered import range_partitions
from .common import materialize

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
BLOCK = 4
#: No state can be worth more than a deletion and two insertions over another.
DEAD = DELETE + 2 * INSERT + TRUNCATED
START, AFTER_S, AFTER_U, AFTER_A = range(4)
FINAL = (START, AFTER_A)
#: State after inserting the one row that fits (user, or assistant after a user).
NEXT = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
#: Symbols: 0 must go; 1 + 2 * (s, u, a, other) + truncated.
INITIALS, SYMBOLS = "sua", 9
#: What follows from keeping a row of each initial, by state (absent: does not fit).
KEPT = ({START: AFTER_S}, {START: AFTER_U, AFTER_S: AFTER_U, AFTER_A: AFTER_U}, {AFTER_U: AFTER_A}, {})
FAR = np.iinfo(np.int32).max // 2


def symbol(role: str, fault: str | None) -> int:
    if fault in ("blank", "duplicate"):
        return 0
    kind = INITIALS.find(role[0]) if role else -1
    return 1 + 2 * (kind if kind >= 0 else 3) + (fault == "truncated")


@functools.cache
def moves(sym: int) -> tuple:
    """(initial, from, to, cost) of the edits that use up a row of this symbol."""
    out = [("D", q, q, DELETE) for q in range(4)]
    if sym:
        kind, more = (sym - 1) // 2, TRUNCATED * ((sym - 1) % 2)
        out += [("K", q, to, KEEP + more) for q, to in KEPT[kind].items()]
        out += [("R", q, NEXT[q], REROLE + more) for q in range(4)]
    return tuple(out)


def with_inserts(v: list[int]) -> list[int]:
    """Costs after any number of insertions before the next row."""
    v = list(v)
    for _ in range(3):
        for q in range(4):
            v[NEXT[q]] = min(v[NEXT[q]], v[q] + INSERT)
    return v


def step(v: tuple[int, ...], sym: int) -> tuple[tuple[int, ...], int]:
    """(normalised vector, cost added) after a row; vectors include insertions."""
    after = [FAR] * 4
    for _, q, to, cost in moves(sym):
        after[to] = min(after[to], v[q] + cost)
    after = with_inserts(after)
    least = min(after)
    return tuple(x - least if x - least <= DEAD else FAR for x in after), least


FIRST = tuple(with_inserts([0, FAR, FAR, FAR]))


@functools.cache
def block_tables():
    """(vectors, next[vector, symbol], cost[vector, symbol], next and cost per block of BLOCK symbols)."""
    vectors, number, todo, rows = [FIRST], {FIRST: 0}, [FIRST], []
    while todo:
        v, row = todo.pop(0), []
        for sym in range(SYMBOLS):
            w, cost = step(v, sym)
            if w not in number:
                number[w] = len(vectors)
                vectors.append(w)
                todo.append(w)
            row.append((number[w], cost))
        rows.append(row)
    nxt, cost = (np.array([[x[i] for x in row] for row in rows], np.int32) for i in (0, 1))
    many_next, many_cost = np.arange(len(vectors), dtype=np.int32)[:, None], np.zeros((len(vectors), 1), np.int32)
    for _ in range(BLOCK):
        many_cost = (many_cost[:, :, None] + cost[many_next]).reshape(len(vectors), -1)
        many_next = nxt[many_next].reshape(len(vectors), -1)
    return vectors, nxt, cost, many_next, many_cost


def ranked(options: list[tuple]) -> tuple:
    """For each state (or None) its place among the others by (initial, place of what follows)."""
    order = sorted({o for o in options if o is not None})
    return tuple(None if o is None else order.index(o) for o in options)


def settle(v: tuple[int, ...], places: dict) -> tuple[tuple, tuple]:
    """Options of the states at one position once insertions are seen. ``places``: state -> (initial,
    place) of its best use of the next row, if that is on a cheapest path. An insertion leads to a
    state of the same position; costs rise along insertions, so states are settled from the dearest."""
    best = {q: places.get(q) for q in range(4)}
    # a tight insertion q -> NEXT[q] is on a cheapest path if its end is
    for q in sorted(range(4), key=lambda q: -v[q]):
        to = NEXT[q]
        if v[q] < FAR and v[to] == v[q] + INSERT and best[to] is not None:
            # its place only has to be compared with uses of the next row, which start otherwise
            if best[q] is None or "I" < best[q][0]:
                best[q] = ("I", best[to])
    return tuple(best[q] for q in range(4))


def _flat(option):
    """Options as tuples that compare like the strings of initials they stand for."""
    out = []
    while option is not None and option[0] == "I":
        out.append("I")
        option = option[1]
    return (*out, *option) if option is not None else None


@functools.cache
def back(v: tuple[int, ...], sym: int, after: tuple) -> tuple[tuple, tuple]:
    """One row backward. ``v``: costs before the row; ``after``: place of each state after the row
    (None: on no cheapest path). Returns (places before the row, per state the initials to write up to
    and with this row, and the state after)."""
    reached = [FAR] * 4
    for _, q, to, cost in moves(sym):
        reached[to] = min(reached[to], v[q] + cost)
    closed = with_inserts(reached)
    use = {}
    for initial, q, to, cost in moves(sym):
        # v holds insertions before the row; a move is tight if it gives the state's cost after the
        # row, and that state is alive by itself (insertions after the row belong to the next one)
        if v[q] < FAR and after[to] is not None and v[q] + cost == closed[to]:
            option = (initial, after[to], to)
            if q not in use or option < use[q]:
                use[q] = option
    options = tuple(_flat(o) for o in settle(v, use))
    return ranked(list(options)), options


def end_places(v: tuple[int, ...]) -> tuple[tuple, tuple, int]:
    """(places, options, cost above the least entry) at the end of a conversation."""
    least = min(v[q] for q in FINAL)
    options = tuple(_flat(o) for o in settle(v, {q: ("", 0, q) for q in FINAL if v[q] == least}))
    return ranked(list(options)), options, least


def solve(symbols: np.ndarray) -> tuple[int, list[str]]:
    """(cost, edits): for every row the initials up to and with its own edit, then the insertions at
    the end (one more entry)."""
    vectors, nxt, _, many_next, many_cost = block_tables()
    n = len(symbols)
    whole = n - n % BLOCK
    weight = SYMBOLS ** np.arange(BLOCK - 1, -1, -1)
    codes = (symbols[:whole].reshape(-1, BLOCK).astype(np.int64) * weight).sum(axis=1).tolist()
    at, cost, bounds = 0, 0, [0]
    for code in codes:
        cost += int(many_cost[at, code])
        at = int(many_next[at, code])
        bounds.append(at)
    last = [at]
    for sym in symbols[whole:].tolist():
        cost += step(vectors[at], sym)[1]
        at = int(nxt[at, sym])
        last.append(at)
    places, options, more = end_places(vectors[at])
    chosen: list[tuple] = [options]
    blocks = [(whole, n, last)] + [(k * BLOCK, (k + 1) * BLOCK, None) for k in range(len(codes) - 1, -1, -1)]
    for lo, hi, inner in blocks:
        if inner is None:                                # expand the block from its stored vector
            inner = [bounds[lo // BLOCK]]
            for sym in symbols[lo:hi].tolist():
                inner.append(int(nxt[inner[-1], sym]))
        for i in range(hi - 1, lo - 1, -1):
            places, options = back(vectors[inner[i - lo]], int(symbols[i]), places)
            chosen.append(options)
    chosen.reverse()
    state, edits = START, []
    for options in chosen:
        option = options[state]
        head = [x for x in option if isinstance(x, str)]
        edits.append("".join(head))
        state = option[-1]
    return cost + more, edits


ROLES = {AFTER_U: "user", AFTER_A: "assistant"}


def written(edits: list[str], roles: list[str], texts: list[str], state: int = START) -> tuple[list[tuple[str, str]], int]:
    """Repaired (role, text) rows of these edits from a state on, and the state after them."""
    out = []
    for edit, role, text in zip(edits, [*roles, None], [*texts, None]):
        for initial in edit:
            if initial == "D":
                continue
            if initial == "K":
                state = KEPT[INITIALS.find(role[0])][state]
                out.append((role, text))
            else:
                state = NEXT[state]
                out.append((ROLES[state], "" if initial == "I" else text))
    return out, state


BLANKS = "\t\n\x0b\x0c\r "


def fault_of(text: str, seen: bool) -> str | None:
    bare = text.strip(BLANKS)
    if not bare:
        return "blank"
    if seen:
        return "duplicate"
    return None if bare[-1] in ".!?" else "truncated"


FAULTS = ("blank", "duplicate", "truncated")
LEGAL = {"su", "ua", "au"}
PIECE = ("part", "conv_id", "whole", "rows", *FAULTS, "illegal", "first_turn", "last_turn", "turns", "first_initial",
         "last_initial", "cost", "audit", "repaired")


def describe(roles, turns, faults) -> list:
    """Counts of one run of rows: rows, faults, illegal pairs, turns and the initials at its ends."""
    initials = [r[:1] for r in roles]
    known = [t for t in turns if t is not None]
    return [len(roles), *[sum(f == k for f in faults) for k in FAULTS],
            sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])), known[0] if known else None,
            known[-1] if known else None, len(set(known)), initials[0] if initials else None, initials[-1] if initials else None]


def lines(rows: list[tuple[str, str]]) -> str:
    return "\n".join(f"{role}:{text}" for role, text in rows)


def _schema(id_type) -> StructType:
    kinds = {"part": IntegerType(), "conv_id": id_type, "whole": BooleanType(), "first_initial": StringType(),
             "last_initial": StringType(), "audit": StringType(), "repaired": StringType()}
    return StructType([StructField(c, kinds.get(c, LongType())) for c in PIECE])


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", absent_col: str | None = None, partitions: int | None = None) -> DataFrame:
    """Pieces of the repaired conversations, one row per conversation and range partition: counts, the
    cost (in the first piece), its part of the audit and the repaired ``role:text`` lines. ``whole``
    marks conversations of one piece; others follow each other by ``part`` (see ``joined``).
    ``absent_col`` marks rows that only name a conversation."""
    import pyarrow as pa
    id_type = rows.schema[conv_col].dataType
    piece = _schema(id_type)
    schema = StructType([*piece.fields, StructField("at", LongType()), StructField("turn", LongType()),
                         StructField("role", StringType()), StructField("text", StringType()), StructField("absent", BooleanType())])

    def text_of(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    plain = rows.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), text_of(role_col).alias("role"),
                        text_of(text_col).alias("text"),
                        (F.coalesce(F.col(absent_col), F.lit(False)) if absent_col else F.lit(False)).alias("absent"))
    # equal rows are interchangeable; the last key only lets a range end among them
    spread = plain.withColumn("tie", F.monotonically_increasing_id())
    order = ["conv_id", "turn", "role", "text", "tie"]
    ranged = spread.repartitionByRange(partitions or range_partitions(rows), *order).sortWithinPartitions(*order).drop("tie")

    def sweep(batches):
        from pyspark import TaskContext
        part, at, runs = TaskContext.get().partitionId(), 0, []
        held: list[list] = []                                   # the open conversation's rows

        def raw():
            """Rows of a conversation that may go on in another partition."""
            n = len(held)
            empty = {f.name: pa.nulls(n, t) for f, t in zip(piece.fields, out_types)}
            empty["part"], empty["conv_id"] = pa.array([part] * n, pa.int32()), pa.array([h[0] for h in held], out_types[1])
            return pa.RecordBatch.from_arrays(
                [*empty.values(), pa.array(range(at - n, at), pa.int64()), *[pa.array([h[i] for h in held], t) for i, t in
                 ((1, pa.int64()), (2, pa.string()), (3, pa.string()), (4, pa.bool_()))]], names=schema.names)

        def whole():
            here = [h for h in held if not h[4]]
            seen, faults = set(), []
            for _, _, role, text, _ in here:
                faults.append(fault_of(text, (role, text) in seen))
                seen.add((role, text))
            roles, texts = [h[2] for h in here], [h[3] for h in here]
            cost, edits = solve(np.array([symbol(r, f) for r, f in zip(roles, faults)], np.int8))
            runs.append([part, held[0][0], True, *describe(roles, [h[1] for h in here], faults), cost, "".join(edits),
                         lines(written(edits, roles, texts)[0])])

        def shown():
            n, table = len(runs), list(zip(*runs))
            runs.clear()
            return pa.RecordBatch.from_arrays([*[pa.array(c, t) for c, t in zip(table, out_types)],
                                               *[pa.nulls(n, f) for f in (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_())]],
                                              names=schema.names)

        first, out_types = True, None
        for batch in batches:
            if out_types is None:
                from pyspark.sql.pandas.types import to_arrow_type
                out_types = [batch.schema.types[0] if f.name == "conv_id" else to_arrow_type(f.dataType) for f in piece.fields]
            size = 0
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if held and row[0] != held[0][0]:
                    if first:
                        yield raw()
                    else:
                        whole()
                        size += sum(len(h[3]) for h in held)
                    first = False
                    held.clear()
                held.append(row)
                at += 1
                if size > 4_000_000:
                    yield shown()
                    size = 0
            if runs:
                yield shown()
        if held:
            yield raw()

    stored = materialize(ranged.mapInArrow(sweep, schema), "repair-pieces")
    names = [f.name for f in piece.fields]
    edge = stored.filter("at is not null").select("part", "conv_id", "at", "turn", "role", "text", "absent")
    return stored.filter("at is null").select(names).unionByName(edge_pieces(edge, piece).select(names))


def edge_pieces(edge: DataFrame, piece: StructType) -> DataFrame:
    """Pieces of the conversations at the ends of range partitions."""
    import pyarrow as pa
    id_type = piece["conv_id"].dataType
    here = edge.filter("not absent")
    digest = F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256)
    key = here.select("conv_id", digest.alias("digest"), "part", "at")
    firsts = key.groupBy("conv_id", "digest").agg(F.min(F.struct("part", "at")).alias("first"))
    firsts = firsts.select(F.col("conv_id").alias("c"), F.col("digest").alias("d"), "first")
    repeats = (key.join(firsts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d")))
               .filter(F.struct("part", "at") > F.col("first"))
               .select(F.col("part").alias("p"), F.col("conv_id").alias("c"), F.col("at").alias("again")))

    def pack(key_, rows, again):
        """One row per piece: its rows' symbols (one byte each) and its counts."""
        order = np.argsort(rows.column("at").to_numpy(), kind="stable")
        rows = rows.take(pa.array(order))
        dup = set(again.column("again").to_pylist())
        ok = [not a for a in rows.column("absent").to_pylist()]
        at, turns, roles, texts = ([x for x, o in zip(rows.column(c).to_pylist(), ok) if o] for c in ("at", "turn", "role", "text"))
        faults = [fault_of(t, i in dup) for i, t in zip(at, texts)]
        symbols = np.array([symbol(r, f) for r, f in zip(roles, faults)], np.int8)
        return out_table(packed, key_, [*describe(roles, turns, faults), symbols.tobytes()])

    def out_table(schema, key_, values):
        from pyspark.sql.pandas.types import to_arrow_type
        fields = schema.fields
        head = [pa.array([k.as_py()], k.type) for k in key_]
        tail = [pa.array([v], to_arrow_type(f.dataType)) for v, f in zip(values, fields[len(head):])]
        return pa.table([*head, *tail], names=[f.name for f in fields])

    from pyspark.sql.types import BinaryType
    counts = [f for f in piece.fields if f.name not in ("part", "conv_id", "whole", "cost", "audit", "repaired")]
    packed = StructType([piece["part"], piece["conv_id"], *counts, StructField("symbols", BinaryType())])
    by_piece = ["part", "conv_id"]
    pieces = materialize(edge.groupBy(*by_piece).cogroup(repeats.groupBy("p", "c")).applyInArrow(pack, packed), "repair-packed")

    solved = StructType([piece["part"], piece["conv_id"], StructField("n_parts", LongType()), piece["cost"],
                         StructField("state", IntegerType()), StructField("edits", BinaryType())])

    def decide(key_, rows):
        """All symbols of a conversation, one byte a row: edits and first state of every piece."""
        rows = rows.sort_by("part")
        symbols = [np.frombuffer(s, np.int8) for s in rows.column("symbols").to_pylist()]
        cost, edits = solve(np.concatenate(symbols))
        state, at, out = START, 0, []
        kinds = {k: (1 + 2 * i, 2 + 2 * i) for i, k in enumerate("sua")}
        ends = np.cumsum([len(s) for s in symbols])
        for k, (s, end) in enumerate(zip(symbols, ends.tolist())):
            own = edits[at:end] + (edits[end:] if k == len(symbols) - 1 else [])
            out.append((state, "\n".join(own).encode()))
            for sym, edit in zip(s.tolist(), own):
                for initial in edit:
                    if initial == "K":
                        state = KEPT[next(i for i, c in enumerate("sua") if sym in kinds[c])][state]
                    elif initial in "IR":
                        state = NEXT[state]
            at = end
        n = rows.num_rows
        return pa.table([rows.column("part"), rows.column("conv_id"), pa.array([n] * n, pa.int64()),
                         pa.array([cost] + [0] * (n - 1), pa.int64()), pa.array([x[0] for x in out], pa.int32()),
                         pa.array([x[1] for x in out], pa.binary())], names=solved.names)

    decided = pieces.select("part", "conv_id", "symbols").groupBy("conv_id").applyInArrow(decide, solved)

    done = StructType([piece["part"], piece["conv_id"], piece["whole"], piece["cost"], piece["audit"], piece["repaired"]])

    def write(key_, rows, how):
        rows = rows.take(pa.array(np.argsort(rows.column("at").to_numpy(), kind="stable")))
        ok = [not a for a in rows.column("absent").to_pylist()]
        roles, texts = ([x for x, o in zip(rows.column(c).to_pylist(), ok) if o] for c in ("role", "text"))
        raw = how.column("edits")[0].as_py().decode()
        edits = raw.split("\n")
        repaired, _ = written(edits, roles, texts, how.column("state")[0].as_py())
        return out_table(done, key_, [how.column("n_parts")[0].as_py() == 1, how.column("cost")[0].as_py(), "".join(edits),
                                      lines(repaired) if repaired else None])

    ended = edge.groupBy(*by_piece).cogroup(decided.groupBy(*by_piece)).applyInArrow(write, done)
    left = pieces.drop("symbols")
    right = ended.select(F.col("part").alias("p"), F.col("conv_id").alias("c"), "whole", "cost", "audit", "repaired")
    return left.join(right, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p"))).drop("p", "c")


JOINED = ("gaps", *FAULTS, "illegal", "cost", "audit", "repaired_sha256")


def joined(pieces: DataFrame) -> DataFrame:
    """One row per conversation: its counts, cost, audit and the digest of its repaired lines. Only
    conversations of several pieces are shuffled; their pieces pass by in order, so a task holds one
    piece and the audit so far."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_type
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns"), F.lit(0))
    own = pieces.filter("whole").select("conv_id", gaps.alias("gaps"), *FAULTS, "illegal", "cost", "audit",
                                        F.sha2(F.coalesce("repaired", F.lit("")), 256).alias("repaired_sha256"))
    schema = own.schema

    def join(batches):
        import hashlib
        now, out = None, []

        def close():
            gap = now["last"] - now["first"] + 1 - now["turns"] if now["first"] is not None else 0
            out.append((now["id"], gap, *now["faults"], now["illegal"], now["cost"], "".join(now["audit"]), now["sha"].hexdigest()))

        types = None
        for batch in batches:
            types = types or [batch.schema.field("conv_id").type if f.name == "conv_id" else to_arrow_type(f.dataType) for f in schema.fields]
            for r in batch.to_pylist():
                if now is None or r["conv_id"] != now["id"]:
                    if now is not None:
                        close()
                    now = {"id": r["conv_id"], "first": None, "last": None, "turns": 0, "faults": [0, 0, 0], "illegal": 0, "cost": 0,
                           "audit": [], "sha": hashlib.sha256(), "initial": None, "begun": False}
                now["faults"] = [a + r[k] for a, k in zip(now["faults"], FAULTS)]
                now["illegal"] += r["illegal"]
                if r["rows"]:
                    if now["initial"] is not None:
                        now["illegal"] += now["initial"] + r["first_initial"] not in LEGAL
                    now["initial"] = r["last_initial"]
                if r["first_turn"] is not None:
                    now["turns"] += r["turns"] - (now["last"] == r["first_turn"])
                    now["first"] = r["first_turn"] if now["first"] is None else now["first"]
                    now["last"] = r["last_turn"]
                now["cost"] += r["cost"]
                now["audit"].append(r["audit"])
                if r["repaired"] is not None:
                    now["sha"].update((("\n" if now["begun"] else "") + r["repaired"]).encode())
                    now["begun"] = True
        if now is not None:
            close()
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=schema.names)

    several = pieces.filter("not whole").repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return own.unionByName(several.mapInArrow(join, schema))


def damaged(conversations: DataFrame) -> DataFrame:
    """The conversations with faults planted by crc32 of ``conv_id:turn`` mod 20; dropped rows are
    marked ``absent``."""
    def text(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    body = (F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace(text("text"), "[.!?]", ""))
            .otherwise(text("text")))
    one = conversations.select("conv_id", "turn", F.col("role"), F.col("text"), kind.alias("kind"))
    rows = one.select("conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(text("role")).alias("role"),
                      body.alias("text"), (F.col("kind") == 0).alias("absent"),
                      F.explode(F.expr("CASE WHEN kind = 3 THEN array(0, 1) ELSE array(0) END")).alias("copy"))
    return rows.drop("copy")
