"""N-gram Jaccard join by prefix filtering (operator 4).

A document's set is its distinct word 5-grams (fewer words: the whole sequence as one; no words:
empty, linked with nothing). Two sets link at Jaccard >= ``percent`` / 100.

1. Frequencies. All n-grams of all documents are counted in a sketch of 2**22 counters (a fixed
   4 MB, whatever the input); a gram's code is its counter's log2 class followed by its hash, so
   the order of codes is rare-first and the same everywhere. The sketch only orders: any order
   gives the same links.
2. Signatures. Documents with equal sets are one class (64-bit hash of the set). A class enters
   the index once per scan task, with its prefix: the first n - ceil(t n) + 1 codes.
3. Lists. Prefix codes are shuffled and sorted; codes with one class go. A list's pivots are its
   first classes (by hash, so that lists of much the same classes have the same pivots) in each of
   two staggered sequences of size bands; within a band the length filter holds. A class is paired
   with the pivots of its bands. Positional filter, one row per pair, suffix filter, then one exact
   count of common codes per pair. The suffix filter works on parity bitmaps: a set's bitmap has two to
   four bits per code, each code flips one bit, and two sets differ in at least as many codes as their
   bitmaps differ in bits. The bitmaps hold the whole sets, as a code behind one prefix may lie in
   the other, and grow with the sets, so that long documents with one passage in common are told apart.
4. Components of the pivot links. Lists whose members are not all in one component are open. They
   are paired again with more pivots of other components, and at last every pair of members in
   *different* components that passes the filters is verified (the join over the lists applies the
   parity filter with 256 bits itself; long lists are split by salts). Pairs inside one component cannot
   change it; so the components are exact though thousands of near copies of one text are linked
   over their pivots and not pair by pair. ``links`` returns all links instead.

Results depend on hashes of 58 bits per gram and 64 bits per set. Defined results: NULL text
counts as empty; a component's id is the smallest non-NULL id; repeated rows are documents of
their own; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from .common import bitmap, materialize, whole_rows
from .components import connected

WORDS = 5
PERCENT = 80
SKETCH_BITS = 22
SLICE_BITS = 14
#: Least bits of a parity bitmap; the join over list members compares this many, as LANES longs.
PARITY_BITS = 256
LANES = [f"p{i}" for i in range(PARITY_BITS // 64)]
#: Rows of a list that one salt of the join over list members holds.
SALT_ROWS = 2048
#: Text that a task hashes at a time; what it holds besides is a few dozen bytes per byte of it.
SLICE_BYTES = 1_000_000
PIVOTS = 8
#: A class shares many lists with its near copies. Past this many rows of a list, only every THIN-th
#: list pairs its rows with pivots (the last round covers all lists).
CROWD, THIN = 64, 4
#: Pivots per band of the later rounds; None: all pairs of members in different components.
MORE_PIVOTS = (64, None)
HASH = np.uint64((1 << 58) - 1)


def prefix_size(n, percent: int = PERCENT):
    """Codes of a set of n that must be indexed: n - ceil(t n) + 1."""
    return n - (percent * n + 99) // 100 + 1


def shingle_runs(column, k: int):
    """(hashes, first hash of each row and the total): the rows' n-grams in text order."""
    from . import grams
    h, first = grams.words(column, lower=True)
    count = np.diff(first)
    g = grams.grams(h, k)
    size = np.maximum(count - k + 1, 0)
    upto = np.cumsum(size)
    out = g[np.repeat(first[:-1] - upto + size, size) + np.arange(upto[-1] if len(upto) else 0)] if len(g) else g
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        whole = np.array([grams.grams(h[first[i]:first[i + 1]], int(count[i]))[0] for i in short], np.uint64)
        out = np.insert(out, (upto - size)[short], whole)
        size[short] = 1
        upto = np.cumsum(size)
    return out, np.concatenate([[0], upto]).astype(np.int64)


def frequency_classes(docs: DataFrame, text_col: str, k: int) -> np.ndarray:
    """log2 class of every sketch counter, summed over all documents (2**22 bytes)."""
    import pyarrow as pa
    width, cut = 1 << SKETCH_BITS, 1 << SLICE_BITS

    def count(batches):
        import zstandard
        from .tokens import slices
        total = np.zeros(width, np.uint32)
        for batch in batches:
            for lo, hi in slices(batch.column(0), SLICE_BYTES):
                g, _ = shingle_runs(batch.column(0).slice(lo, hi - lo), k)
                cells, n = np.unique(((g & HASH) >> np.uint64(58 - SKETCH_BITS)).astype(np.uint32), return_counts=True)
                total[cells] += n.astype(np.uint32)
        press = zstandard.ZstdCompressor()
        used = [i for i in range(width // cut) if total[i * cut:(i + 1) * cut].any()]
        blobs = [press.compress(total[i * cut:(i + 1) * cut].tobytes()) for i in used]
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(blobs, pa.binary())], names=["slice", "counts"])

    def add(batches):
        import zstandard
        expand, total = zstandard.ZstdDecompressor(), {}
        for batch in batches:
            for i, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(expand.decompress(blob), np.uint32)
                total[i] = total[i] + part if i in total else part.astype(np.uint64)
        classes = [np.minimum(63, np.ceil(np.log2(x.astype(np.float64) + 1))).astype(np.uint8) for x in total.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in classes], pa.binary())],
                                         names=["slice", "classes"])

    text = docs.select(F.col(text_col).cast("string").alias("text"))
    rows = (text.mapInArrow(count, "slice int, counts binary").repartition("slice")
            .mapInArrow(add, "slice int, classes binary").collect())
    out = np.zeros(width, np.uint8)
    for r in rows:
        out[r["slice"] * cut:(r["slice"] + 1) * cut] = np.frombuffer(r["classes"], np.uint8)
    return out


def codes_of(g: np.ndarray, classes: np.ndarray) -> np.ndarray:
    h = g & HASH
    return (classes[h >> np.uint64(58 - SKETCH_BITS)].astype(np.uint64) << np.uint64(58)) | h


def set_hash(codes: np.ndarray) -> int:
    import xxhash
    return int(np.uint64(xxhash.xxh3_64_intdigest((codes & HASH).tobytes())).astype(np.int64))


def code_sets(column, classes: np.ndarray, k: int):
    """The rows' distinct codes, in order."""
    g, first = shingle_runs(column, k)
    codes = codes_of(g, classes)
    return [np.unique(codes[a:b]) for a, b in zip(first, first[1:])]


def parities(codes: np.ndarray) -> np.ndarray:
    """Parity bitmap of a set (bytes): 2 to 4 bits a code, a power of two, at least PARITY_BITS."""
    bits = max(PARITY_BITS, 1 << (2 * len(codes) - 1).bit_length() if len(codes) else 0)
    flips = np.bincount((codes & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((flips & 1).astype(np.uint8), bitorder="little")


def folded(bitmaps: np.ndarray, size: int) -> np.ndarray:
    """Bitmaps (one a row) of ``size`` bytes: those of the same sets with fewer bits."""
    return np.bitwise_xor.reduce(bitmaps.reshape(len(bitmaps), -1, size), axis=1)


def signatures(docs: DataFrame, classes: np.ndarray, id_col: str, text_col: str, k: int, percent: int) -> DataFrame:
    """Stored table: id, n, cls and, for a class's first document in each scan task, its prefix, its
    parity bitmap and that bitmap folded to LANES."""
    import pyarrow as pa
    schema = StructType([StructField("id", docs.schema[id_col].dataType), StructField("n", LongType()),
                         StructField("cls", LongType()), StructField("prefix", BinaryType()),
                         StructField("parity", BinaryType()), *[StructField(x, LongType()) for x in LANES]])

    def sign(batches):
        from .tokens import slices
        seen: set[int] = set()
        for batch in batches:
            for lo, hi in slices(batch.column(1), SLICE_BYTES):
                sets = code_sets(batch.column(1).slice(lo, hi - lo), classes, k)
                cls = [set_hash(s) for s in sets]
                prefix, parity, lanes = [], [], np.zeros((len(sets), len(LANES)), np.int64)
                for i, (s, c) in enumerate(zip(sets, cls)):
                    new = len(s) > 0 and c not in seen
                    seen.add(c)
                    marks = parities(s) if new else None
                    prefix.append(s[:prefix_size(len(s), percent)].tobytes() if new else None)
                    parity.append(marks.tobytes() if new else None)
                    if new:
                        lanes[i] = folded(marks[None, :], PARITY_BITS // 8).view("<i8")[0]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(cls, pa.int64()), pa.array(prefix, pa.binary()), pa.array(parity, pa.binary()),
                     *[pa.array(x) for x in lanes.T]],
                    names=schema.names)

    rows = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    return materialize(rows.mapInArrow(sign, schema), "jaccard-signatures")


def with_pivots(pivots: dict, most: int, percent: int, n: int, pos: int, row: tuple) -> list[tuple]:
    """Pivots of the row's size bands that length and positional filter allow; the row becomes a
    pivot of a band that has fewer than ``most``. Two staggered sequences of bands: sets of much the
    same size share a band of one of them."""
    found, size = [], math.log(n) / math.log(100 / percent)
    for band in ((0, math.floor(size)), (1, math.floor(size + 0.5))):
        known = pivots.setdefault(band, [])
        found += [other for other, m, place in known
                  if 100 * min(n, m) >= percent * max(n, m)
                  and (100 + percent) * min(n - pos, m - place) >= percent * (n + m) and other not in found]
        if len(known) < most:
            known.append((row, n, pos))
    return found


def prefix_lists(signed: DataFrame, percent: int) -> DataFrame:
    """Stored table of the lists with two classes or more: code, cls, n, pos, and the pivots that
    length and positional filter allow for the row."""
    import pyarrow as pa

    def spread(batches):
        for batch in batches:
            rows = [(np.frombuffer(p, np.int64), c, n) for c, n, p in zip(*[batch.column(i).to_pylist() for i in range(3)])]
            for lo in range(0, len(rows), 500):
                part = rows[lo:lo + 500]
                size = [len(x) for x, _, _ in part]
                pos = np.concatenate([np.arange(s) for s in size]) if part else np.zeros(0, np.int64)
                n = np.repeat(np.array([n for _, _, n in part], np.int64), size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([x for x, _, _ in part])), pa.array(np.repeat(np.array([c for _, c, _ in part], np.int64), size)),
                     pa.array(n << 32 | pos)], names=["code", "cls", "n_pos"])

    def lists(batches):
        held = np.zeros((3, 0), np.int64)       # the open list's last row, once it is known whether it has company
        shown, code, seen, pivots = False, None, 0, {}        # the open list's rows so far and pivots, per band

        def sweep(rows, final):
            """Rows of lists of two or more; the last row waits for what follows it."""
            nonlocal held, shown, code, seen
            if not rows.shape[1]:
                return None
            keep = np.ones(rows.shape[1], bool)
            keep[1:] = (rows[0, 1:] != rows[0, :-1]) | (rows[1, 1:] != rows[1, :-1])
            rows = rows[:, keep]
            same = rows[0, 1:] == rows[0, :-1]
            company = np.zeros(rows.shape[1], bool)
            company[1:] |= same
            company[:-1] |= same
            if shown:
                company[0] = True
            last = rows.shape[1] if final else rows.shape[1] - 1
            out = []
            for i in np.flatnonzero(company[:last]).tolist():
                at, cls, n_pos = (int(x) for x in rows[:, i])
                if at != code:
                    code, seen = at, 0
                    pivots.clear()
                n, pos, seen = n_pos >> 32, n_pos & 0xFFFFFFFF, seen + 1
                near = with_pivots(pivots, PIVOTS, percent, n, pos, (cls,)) if seen <= CROWD or not at % THIN else []
                out.append((at, cls, n, pos, [x[0] for x in near]))
            shown = bool(company[-1]) if not final else False
            held = rows[:, last:]
            return out or None

        def batch_of(out):
            *numbers, others = zip(*out)
            return pa.RecordBatch.from_arrays([*[pa.array(x, pa.int64()) for x in numbers], pa.array(others, pa.list_(pa.int64()))],
                                              names=["code", "cls", "n", "pos", "pivots"])

        for batch in batches:
            rows = np.stack([batch.column(i).to_numpy() for i in range(3)])
            if out := sweep(np.concatenate([held, rows], axis=1), False):
                yield batch_of(out)
        if out := sweep(held, True):
            yield batch_of(out)

    posted = signed.filter("prefix is not null").select("cls", "n", "prefix").mapInArrow(
        spread, "code long, cls long, n_pos long")
    ordered = posted.repartition("code").sortWithinPartitions("code", "cls")
    return materialize(ordered.mapInArrow(lists, "code long, cls long, n long, pos long, pivots array<long>"), "jaccard-lists")


def needed_overlap(a, b, percent: int):
    """Least common codes of two linked sets: o with (100 + p) o >= p (a + b)."""
    return F.expr(f"({percent} * ({a} + {b}) + {100 + percent - 1}) div {100 + percent}")


def class_table(signed: DataFrame) -> DataFrame:
    """Stored table, one row per non-empty class: cls, the id of one of its documents and its LANES."""
    return materialize(signed.filter("prefix is not null").groupBy("cls").agg(
        F.min("id").alias("id"), *[F.max(x).alias(x) for x in LANES]), "jaccard-classes")


def of_members(rows: DataFrame, bits: int, marks: bytes) -> DataFrame:
    """The rows whose ``cls`` has its bit in the bitmap, found where they lie (few others come along)."""
    import pyarrow as pa

    def keep(batches):
        seen = np.unpackbits(np.frombuffer(marks, np.uint8)).view(bool)
        for batch in batches:
            yield batch.filter(pa.array(seen[batch.column(0).to_numpy()])).select(list(range(1, batch.num_columns)))

    return rows.select(F.pmod(F.xxhash64("cls"), F.lit(1 << bits)).alias("cell"), "*").mapInArrow(keep, rows.schema)


def class_sets(docs: DataFrame, wanted: DataFrame, frequencies: np.ndarray, id_col: str, text_col: str, k: int) -> DataFrame:
    """Stored table (cls, codes) of the classes in ``wanted`` (cls, id). The texts stay where they
    are: a bitmap of the wanted ids tells the scan which documents to work on. A class may appear twice
    or unasked, where an id repeats or a bit is shared."""
    import pyarrow as pa
    bits, marks = bitmap(F.xxhash64("id"), wanted)

    def fill(batches):
        from .tokens import slices
        seen = np.unpackbits(np.frombuffer(marks, np.uint8)).view(bool)
        for batch in batches:
            batch = batch.filter(pa.array(seen[batch.column(0).to_numpy()]))
            for lo, hi in slices(batch.column(1), SLICE_BYTES):
                sets = code_sets(batch.column(1).slice(lo, hi - lo), frequencies, k)
                yield pa.RecordBatch.from_arrays([pa.array([set_hash(s) for s in sets], pa.int64()),
                                                  pa.array([s.tobytes() for s in sets], pa.binary())], names=["cls", "codes"])

    rows = docs.select(F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << bits)).alias("cell"), F.col(text_col).cast("string").alias("text"))
    return materialize(rows.mapInArrow(fill, "cls long, codes binary"), "jaccard-sets")


def suffix_filtered(pairs: DataFrame, signed: DataFrame, percent: int) -> DataFrame:
    """The stored pairs (a, b) whose overlap the parity bitmaps do not rule out."""
    import pyarrow as pa
    import pyarrow.compute as pc

    def suffix(batches):
        for batch in batches:
            a, b, na, nb = (batch.column(i).to_numpy() for i in range(4))
            size_a, size_b = (pc.binary_length(batch.column(i)).to_numpy(zero_copy_only=False) for i in (4, 5))
            ok = np.zeros(len(a), bool)
            for x, y in set(zip(size_a.tolist(), size_b.tolist())):
                rows = np.flatnonzero((size_a == x) & (size_b == y))
                left, right = (np.frombuffer(b"".join(batch.column(i).take(pa.array(rows)).to_pylist()), np.uint8)
                               .reshape(len(rows), -1) for i in (4, 5))
                differ = np.bitwise_count(folded(left, min(x, y)) ^ folded(right, min(x, y))).sum(axis=1, dtype=np.int64)
                both = na[rows] + nb[rows]
                ok[rows] = (100 + percent) * (both - differ) >= 2 * percent * both
            yield pa.RecordBatch.from_arrays([pa.array(a[ok]), pa.array(b[ok])], names=["a", "b"])

    members = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct()
    bits, marks = bitmap(F.xxhash64("cls"), members)
    found = of_members(signed.filter("prefix is not null").select("cls", "n", "parity"), bits, marks)
    found = materialize(found.dropDuplicates(["cls"]), "jaccard-parity")

    def side(x):
        return found.select(F.col("cls").alias(x), F.col("n").alias(f"n_{x}"), F.col("parity").alias(f"parity_{x}"))

    return (pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "parity_a", "parity_b")
            .mapInArrow(suffix, "a long, b long"))


def exactly_linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link, by one count of common codes per pair."""
    import pyarrow as pa

    def exact(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            sets_a, sets_b = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            ok = np.zeros(len(a), bool)
            for i, (x, y) in enumerate(zip(sets_a, sets_b)):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                ok[i] = (100 + percent) * common >= percent * (len(x) + len(y))
            yield pa.RecordBatch.from_arrays([pa.array(a[ok]), pa.array(b[ok])], names=["a", "b"])

    def side(x):
        return sets.select(F.col("cls").alias(x), F.col("codes").alias(f"codes_{x}"))

    return (pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "codes_a", "codes_b")
            .mapInArrow(exact, "a long, b long"))


def pivot_pairs(lists: DataFrame) -> DataFrame:
    """Members with their pivots, once per pair."""
    return (lists.select("cls", F.explode("pivots").alias("pivot"))
            .select(F.least("cls", "pivot").alias("a"), F.greatest("cls", "pivot").alias("b")).distinct())


def open_pairs(open_lists: DataFrame, percent: int, most: int) -> DataFrame:
    """Rows of open lists with up to ``most`` pivots a band in another component, once per pair. The
    order differs from that of the first pivots."""
    import pyarrow as pa

    def pair(batches):
        code, seen, pivots = None, 0, {}
        for batch in batches:
            out = []
            for at, cls, n, pos, comp in zip(*[c.to_pylist() for c in batch.columns]):
                if at != code:
                    code, seen = at, 0
                    pivots.clear()
                seen += 1
                if seen <= CROWD or not at % THIN:
                    out += [(min(cls, x), max(cls, x)) for x, c in with_pivots(pivots, most, percent, n, pos, (cls, comp)) if c != comp]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], names=["a", "b"])

    ordered = (open_lists.select("code", "cls", "n", "pos", "comp").repartition("code")
               .sortWithinPartitions("code", F.xxhash64("cls"), "cls"))
    return ordered.mapInArrow(pair, "a long, b long").distinct()


def member_pairs(lists: DataFrame, classes: DataFrame, percent: int, across: bool) -> DataFrame:
    """All pairs within the lists that pass length, positional and (256 bits) parity filters, once per
    pair; ``across``: only between different values of ``comp``. A list of many rows is split: each of its
    rows is compared, under every salt, with the rows of that salt."""
    salts = lists.groupBy("code").agg(F.ceil(F.count(F.lit(1)) / SALT_ROWS).alias("salts"))
    rows = lists.drop("pivots").join(salts, "code").join(classes.drop("id"), "cls")
    x = rows.withColumn("salt", F.pmod(F.xxhash64("cls"), "salts")).alias("x")
    y = rows.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1))).alias("y")
    most = F.least(F.expr("x.n - x.pos"), F.expr("y.n - y.pos"))
    differ = " + ".join(f"bit_count(x.{p} ^ y.{p})" for p in LANES)
    on = (F.expr("x.code = y.code and x.salt = y.salt") & F.expr("x.n < y.n or (x.n = y.n and x.cls < y.cls)")
          & F.expr(f"100 * x.n >= {percent} * y.n") & (most >= needed_overlap("x.n", "y.n", percent))
          & F.expr(f"{100 + percent} * (x.n + y.n - ({differ})) >= {2 * percent} * (x.n + y.n)"))
    if across:
        on = on & F.expr("x.comp <> y.comp")
    return (x.join(y, on).select(F.least("x.cls", "y.cls").alias("a"), F.greatest("x.cls", "y.cls").alias("b"))
            .distinct())


def merged(parts: DataFrame, links: DataFrame) -> DataFrame:
    """Components (node, root) after further links (a, b) between them and nodes of no component."""
    ends = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    known = materialize(parts.unionByName(ends.join(parts, "node", "left_anti").withColumn("root", F.col("node"))), "jaccard-parts")
    edges = (links.join(known.select(F.col("node").alias("a"), F.col("root").alias("u")), "a")
             .join(known.select(F.col("node").alias("b"), F.col("root").alias("v")), "b")
             .select(F.col("u").alias("a"), F.col("v").alias("b")))
    top = connected(edges).select(F.col("node").alias("root"), F.col("root").alias("top"))
    return materialize(known.join(top, "root", "left").select("node", F.coalesce("top", "root").alias("root")), "jaccard-parts")


class JaccardJoin:
    """The join's stored intermediate tables; made once, used by ``links`` and ``components``."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = WORDS,
                 percent: int = PERCENT):
        self.docs, self.id_col, self.text_col, self.k, self.percent = docs, id_col, text_col, k, percent
        self.frequencies = frequency_classes(docs, text_col, k)
        self.signed = signatures(docs, self.frequencies, id_col, text_col, k, percent)
        self.lists = prefix_lists(self.signed, percent)
        self.classes = class_table(self.signed)

    def verified(self, pairs: DataFrame) -> DataFrame:
        """Stored links among the pairs: suffix filter first, then the sets of what is left."""
        pairs = materialize(pairs, "jaccard-pairs")
        if pairs.isEmpty():
            return pairs
        near = materialize(suffix_filtered(pairs, self.signed, self.percent), "jaccard-near")
        if near.isEmpty():
            return near
        members = near.select(F.col("a").alias("cls")).union(near.select("b")).distinct()
        wanted = self.classes.join(members, "cls", "left_semi").select("cls", "id")
        sets = class_sets(self.docs, wanted, self.frequencies, self.id_col, self.text_col, self.k)
        return materialize(exactly_linked(near, sets, self.percent).distinct(), "jaccard-links")

    def links(self) -> DataFrame:
        """Every link between different sets, as pairs of classes (see ``signed`` for members)."""
        return self.verified(member_pairs(self.lists, self.classes, self.percent, across=False))

    def roots(self) -> DataFrame:
        """(cls, root) of every class that links with another."""
        parts = connected(self.verified(pivot_pairs(self.lists)))
        for most in MORE_PIVOTS:
            labelled = self.lists.join(parts, F.col("cls") == F.col("node"), "left").select(
                "code", "cls", "n", "pos", F.coalesce("root", "cls").alias("comp"))
            open_codes = labelled.groupBy("code").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi")
            lists = materialize(labelled.join(open_codes.select("code"), "code", "left_semi"), "jaccard-open")
            if lists.isEmpty():
                break
            pairs = open_pairs(lists, self.percent, most) if most else member_pairs(lists, self.classes, self.percent, across=True)
            links = self.verified(pairs)
            if not links.isEmpty():
                parts = merged(parts, links)
        return parts.select(F.col("node").alias("cls"), "root")

    def components(self) -> DataFrame:
        """One row per document: id, n, smallest id of its component."""
        roots = self.roots()
        least = self.signed.filter("n > 0").groupBy("cls").agg(F.min("id").alias("least"))
        rooted = least.join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
        top = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
        answer = rooted.join(top, "root").select("cls", "component_id")
        full = self.signed.filter("n > 0").select("id", "n", "cls").join(answer, "cls").select("id", "n", "component_id")
        return full.unionByName(self.signed.filter("n = 0").select("id", "n", F.col("id").alias("component_id")))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = WORDS,
                       percent: int = PERCENT) -> DataFrame:
    """One row per document: id, ``n_shingles``, ``component_id``."""
    return JaccardJoin(docs, id_col, text_col, k, percent).components().select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = WORDS,
                      percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` whose id is their component's, with all their columns. Rows without an
    id, and documents without words, stay."""
    found = JaccardJoin(docs, id_col, text_col, k, percent).components()
    keep = found.filter(F.col("id").eqNullSafe(F.col("component_id")) | F.col("id").isNull()).select(
        F.col("id").alias("keep_id")).distinct()
    return (whole_rows(docs, id=F.col(id_col)).join(keep, F.col("id").eqNullSafe(F.col("keep_id")), "left_semi")
            .select("_row.*"))
