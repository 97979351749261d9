"""Ranked lexical search by pipelined term partitioning (operator 11).

Terms are partitioned over ``owners`` term owners. Items travel in bundles; a bundle visits the
owners one after another and carries a sparse accumulator (slot, document, score) that every owner
enlarges by the integer contributions of its own terms. After the last owner the best documents
are selected.

1. Items. An item's distinct terms are found in Spark; up to ``BUNDLE`` items form a bundle.
2. Postings. One pass over all whole texts: runs of documents form blocks (at most ``BLOCK_DOCS``
   documents and about ``BLOCK_BYTES`` of text), and each block writes one row per term that items
   ask for, with the documents, frequencies and lengths packed, in its owner's folder. A bitmap of
   the wanted terms (at most 32 MB) only spares postings nobody asks for.
3. Weights. Document frequencies are sums over all blocks, N and L over all documents.
4. Pipeline. For every owner in turn the accumulators, keyed by (bundle, block), are cogrouped with
   the owner's postings. A block bounds what a group can hold, whatever a term's frequency or the
   corpus's size: a term of all documents is one row per block.
5. Selection. Each block hands on its k best documents per item (local numbers follow the ids, so
   ties are exact); a window per item with a group limit before its shuffle takes the k best.

Terms are known by 64-bit hashes. Defined results: NULL and empty texts have no terms and are never
found; item rows with one id form one item; items without terms have no rows; documents with equal
ids are documents of their own; NULL ids sort first; an empty table gives no rows; further columns
are ignored; a very long text is a block of its own.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from .common import bitmap, materialize

OWNERS = 4
BUNDLE = 256
BLOCK_DOCS = 4096
BLOCK_BYTES = 8_000_000
SLICE_BYTES = 1_000_000
BEST = 50

#: Everything but ASCII letters, ASCII digits and non-ASCII characters separates terms.
BREAK = np.ones(256, bool)
BREAK[128:] = False
for _first, _last in ("09", "AZ", "az"):
    BREAK[ord(_first):ord(_last) + 1] = False


def term_runs(column):
    """(term hashes, first of each row and the total) of an Arrow string column."""
    from . import grams
    h, first = grams.words(column, lower=True, breaks=BREAK)
    return h.view(np.int64), first


def item_bundles(items: DataFrame, item_col: str, text_col: str, bundle: int = BUNDLE) -> DataFrame:
    """Stored table, one row per item with terms: bundle, slot, item_id, terms (distinct hashes)."""
    import pyarrow as pa
    id_type = items.schema[item_col].dataType

    def find(batches):
        for batch in batches:
            h, first = term_runs(batch.column(1))
            which = np.repeat(np.arange(len(first) - 1), np.diff(first))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(which)), pa.array(h)], names=["item_id", "term"])

    def number(batches):
        from pyspark import TaskContext
        seen = 0
        for batch in batches:
            at = seen + np.arange(batch.num_rows)
            seen += batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array((TaskContext.get().partitionId() << 32) + at // bundle), pa.array((at % bundle).astype(np.int32)),
                 *batch.columns], names=["bundle", "slot", "item_id", "terms"])

    found = items.select(F.col(item_col), F.col(text_col).cast("string")).mapInArrow(
        find, StructType([StructField("item_id", id_type), StructField("term", LongType())])).distinct()
    terms = found.groupBy("item_id").agg(F.collect_list("term").alias("terms"))
    return materialize(terms.mapInArrow(number, StructType([
        StructField("bundle", LongType()), StructField("slot", IntegerType()), StructField("item_id", id_type),
        StructField("terms", ArrayType(LongType()))])), "search-items")


def posting_table(docs: DataFrame, wanted: DataFrame, owners: int, id_col: str, text_col: str) -> DataFrame:
    """Stored table in one folder per owner: block, term, and packed per posting the document's
    local number, its frequency and the document's length. Owner -1 has one row per block: ids in
    order, the documents with terms, and all their terms."""
    import pyarrow as pa
    id_type = docs.schema[id_col].dataType
    schema = StructType([StructField("owner", IntegerType()), StructField("block", LongType()), StructField("term", LongType()),
                         StructField("local", BinaryType()), StructField("tf", BinaryType()), StructField("n", BinaryType()),
                         StructField("ids", ArrayType(id_type)), StructField("n_docs", LongType()), StructField("n_terms", LongType())])
    bits, marks = bitmap(F.col("term"), wanted)

    def post(batches):
        import pyarrow.compute as pc
        from pyspark import TaskContext
        from .tokens import slices
        asked = np.unpackbits(np.frombuffer(marks, np.uint8)).view(bool)
        mask = np.int64((1 << bits) - 1)
        block = TaskContext.get().partitionId() << 32
        id_arrays, sizes, terms, held, text = [], [], [], [], 0

        def flush():
            nonlocal block, text
            ids = pa.concat_arrays(id_arrays)
            order = pc.sort_indices(ids, null_placement="at_start")
            rank = np.empty(len(ids), np.uint32)
            rank[order.to_numpy()] = np.arange(len(ids), dtype=np.uint32)
            n, term, doc = np.concatenate(sizes), np.concatenate(terms), rank[np.concatenate(held)]
            sort = np.lexsort((doc, term))
            term, doc = term[sort], doc[sort]
            new = np.ones(len(term), bool)
            new[1:] = (term[1:] != term[:-1]) | (doc[1:] != doc[:-1])
            at = np.flatnonzero(new)
            tf = np.diff(np.append(at, len(term))).astype("<u4")
            term, doc = term[at], doc[at].astype("<u4")
            size = n[order.to_numpy()].astype("<u4")[doc]
            cut = np.flatnonzero(np.append(True, term[1:] != term[:-1])) if len(term) else np.zeros(0, np.int64)
            offsets = pa.array(4 * np.append(cut, len(term)), pa.int32()).buffers()[1]

            def packed(x):
                return pa.Array.from_buffers(pa.binary(), len(cut), [None, offsets, pa.py_buffer(x.tobytes())])

            owner = np.mod(term[cut], owners).astype(np.int32)
            none = pa.nulls(len(cut), pa.list_(ids.type))
            yield pa.RecordBatch.from_arrays(
                [pa.array(owner), pa.array(np.full(len(cut), block)), pa.array(term[cut]), packed(doc), packed(tf), packed(size),
                 none, pa.nulls(len(cut), pa.int64()), pa.nulls(len(cut), pa.int64())], names=schema.names)
            yield pa.RecordBatch.from_arrays(
                [pa.array([-1], pa.int32()), pa.array([block], pa.int64()), pa.nulls(1, pa.int64()),
                 *[pa.nulls(1, pa.binary()) for _ in range(3)], pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids.take(order)),
                 pa.array([int((n > 0).sum())], pa.int64()), pa.array([int(n.sum())], pa.int64())], names=schema.names)
            block, text = block + 1, 0
            for x in (id_arrays, sizes, terms, held):
                x.clear()

        for batch in batches:
            size = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
            for lo, hi in slices(batch.column(1), SLICE_BYTES):
                for a in range(lo, hi, BLOCK_DOCS):
                    b = min(hi, a + BLOCK_DOCS)
                    base = sum(len(x) for x in sizes)
                    if id_arrays and (base + b - a > BLOCK_DOCS or text + int(size[a:b].sum()) > BLOCK_BYTES):
                        yield from flush()
                        base = 0
                    h, first = term_runs(batch.column(1).slice(a, b - a))
                    doc = np.repeat(np.arange(base, base + b - a, dtype=np.int64), np.diff(first))
                    ask = asked[h & mask]
                    id_arrays.append(batch.column(0).slice(a, b - a))
                    sizes.append(np.diff(first))
                    terms.append(h[ask])
                    held.append(doc[ask])
                    text += int(size[a:b].sum())
        if id_arrays:
            yield from flush()

    rows = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    return materialize(rows.mapInArrow(post, schema), "search-postings", partition_by=["owner"])


def term_weights(bundles: DataFrame, postings: DataFrame, n_docs: int) -> DataFrame:
    """Stored table: bundle, term, its weight and the slots of the bundle's items that have it."""
    df = (postings.filter("owner >= 0").groupBy("term").agg(F.sum(F.expr("octet_length(local) div 4")).alias("df")))
    asked = bundles.select("bundle", "slot", F.explode("terms").alias("term")).groupBy("bundle", "term").agg(
        F.collect_list("slot").alias("slots"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1).cast("double"))).cast("long")
    return materialize(asked.join(df, "term").select("bundle", "term", weight.alias("w"), "slots"), "search-weights")


STATE = "bundle long, block long, slot binary, local binary, score binary"


def add_owner(state: DataFrame, weights: DataFrame, postings: DataFrame, owner: int, n_docs: int, n_terms: int) -> DataFrame:
    """The bundles' accumulators after the visit to one owner."""
    import pyarrow as pa

    def visit(key, left, right):
        slots = [np.frombuffer(x, "<u2") for x in left.column("slot").to_pylist()]
        locals_ = [np.frombuffer(x, "<u4") for x in left.column("local").to_pylist()]
        scores = [np.frombuffer(x, "<i8") for x in left.column("score").to_pylist()]
        asked = [np.array(x, np.int64) for x in right.column("slots").to_pylist()]
        docs = [np.frombuffer(x, "<u4") for x in right.column("local").to_pylist()]
        height = 1 + max([int(x.max()) for x in slots + asked if len(x)], default=-1)
        width = 1 + max([int(x.max()) for x in locals_ + docs if len(x)], default=-1)
        total = np.zeros((height, width), np.int64)
        for s, d, x in zip(slots, locals_, scores):
            total[s, d] = x
        for s, d, w, tf, n in zip(asked, docs, right.column("w").to_pylist(), right.column("tf").to_pylist(),
                                  right.column("n").to_pylist()):
            tf, n = np.frombuffer(tf, "<u4").astype(np.int64), np.frombuffer(n, "<u4").astype(np.int64)
            m = 50 + (50 * n * n_docs) // n_terms
            total[np.ix_(s, d)] += w * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))
        s, d = np.nonzero(total)
        return pa.table({"bundle": [key[0].as_py()], "block": [key[1].as_py()], "slot": [s.astype("<u2").tobytes()],
                         "local": [d.astype("<u4").tobytes()], "score": [total[s, d].astype("<i8").tobytes()]},
                        schema=pa.schema([("bundle", pa.int64()), ("block", pa.int64()), ("slot", pa.binary()),
                                          ("local", pa.binary()), ("score", pa.binary())]))

    own = postings.filter(F.col("owner") == owner).select("term", "block", "local", "tf", "n").join(weights, "term").select(
        "bundle", "block", "w", "slots", "local", "tf", "n")
    return (state.groupBy("bundle", "block").cogroup(own.groupBy("bundle", "block")).applyInArrow(visit, STATE))


def block_best(state: DataFrame, k: int) -> DataFrame:
    """The k best documents of every item in every block (ties: smaller local number)."""
    import pyarrow as pa

    def best(batches):
        for batch in batches:
            for bundle, block, s, d, x in zip(*[c.to_pylist() for c in batch.columns]):
                s, d, x = np.frombuffer(s, "<u2"), np.frombuffer(d, "<u4"), np.frombuffer(x, "<i8")
                order = np.lexsort((d, -x, s))
                s = s[order]
                place = np.arange(len(s)) - np.searchsorted(s, s, side="left")
                order, s = order[place < k], s[place < k]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(s), bundle, np.int64)), pa.array(s.astype(np.int32)),
                     pa.array(np.full(len(s), block, np.int64)), pa.array(d[order].astype(np.int64)), pa.array(x[order])],
                    names=["bundle", "slot", "block", "local", "score"])

    return state.mapInArrow(best, "bundle long, slot int, block long, local long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = BEST, owners: int = OWNERS, id_col: str = "doc_id",
           text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The k documents with the highest positive score for every item: item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    bundles = item_bundles(items, item_col, item_text_col)
    postings = posting_table(docs, bundles.select(F.explode("terms").alias("term")).distinct(), owners, id_col, text_col)
    blocks = postings.filter("owner = -1")
    n_docs, n_terms = blocks.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).collect()[0]
    weights = term_weights(bundles, postings, n_docs)
    state = spark.createDataFrame([], STATE)
    for owner in range(owners):
        state = add_owner(state, weights, postings, owner, n_docs, max(1, n_terms))
    ids = blocks.select("block", F.posexplode("ids").alias("local", "doc_id"))
    found = block_best(state, k).join(ids, ["block", "local"])
    order = Window.partitionBy("bundle", "slot").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"), "block", "local")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return (ranked.join(bundles.select("bundle", "slot", "item_id"), ["bundle", "slot"])
            .select(F.col("item_id").alias(item_col), "rank", F.col("doc_id").alias(id_col), "score"))
