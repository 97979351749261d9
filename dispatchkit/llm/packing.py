"""Packing by concatenate and cut (operator 9).

Pass 1 tokenizes every document once and stores (part, position inside the part, ids); a part is
one task of the scan. The parts' token totals, one row a part, give each part its global offset
by a running sum, so a document's place in the one long concatenation is known without moving
its ids. Pass 2 cuts that concatenation into windows of ``length`` ids: a document that crosses
window boundaries gets one boundary record (piece) per window. What is left after the last full
window is cut at powers of two, largest first, so no sequence needs padding.

The only broadcast is one row per part (16 bytes for each task of the scan). No ids are shuffled.

Defined results: NULL or empty text is a document of the end id alone; very long texts are cut
into many pieces; repeated rows are documents of their own; NULL ids are kept; an empty table
gives no pieces; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from .common import materialize

LENGTH = 1024
BATCH_IDS = 1 << 20


def token_table(docs: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stored table: part, local (first id's position in the part), id, n_tokens, ids
    (little-endian, 2 bytes an id if the vocabulary allows, else 4)."""
    import pyarrow as pa
    schema = StructType([StructField("part", IntegerType()), StructField("local", LongType()),
                         StructField("doc_id", docs.schema[id_col].dataType), StructField("n_tokens", LongType()),
                         StructField("ids", BinaryType())])

    def tokenize(batches):
        from pyspark import TaskContext
        from . import tokens
        encoder, part, local = tokens.load(path), TaskContext.get().partitionId(), 0
        for batch in batches:
            for lo, hi in tokens.slices(batch.column(1)):
                ids = encoder.encode(batch.column(1).slice(lo, hi - lo), end_id)
                n = np.array([len(x) for x in ids], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), part, np.int32)), pa.array(local + np.cumsum(n) - n),
                     batch.column(0).slice(lo, hi - lo), pa.array(n), pa.array([x.tobytes() for x in ids], pa.binary())],
                    names=schema.names)
                local += int(n.sum())

    rows = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    return materialize(rows.mapInArrow(tokenize, schema), "tokens")


def part_offsets(parts: DataFrame) -> DataFrame:
    """Second prefix sum: each part's global offset, and the total (one row per part)."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return (parts.groupBy("part").agg(F.sum("n_tokens").alias("n"))
            .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"),
                    F.sum("n").over(Window.partitionBy()).alias("total")))


def tail_cuts(total: int, length: int) -> list[int]:
    """Starts of the sequences after the last full window: a power of two each."""
    at, cuts = total - total % length, []
    for bit in range(length.bit_length(), -1, -1):
        if (total % length) >> bit & 1:
            cuts.append(at)
            at += 1 << bit
    return cuts


def cut_pieces(start: int, end: int, total: int, length: int) -> list[tuple[int, int, int, int]]:
    """(from, to, sequence, offset) of the pieces of ids [start, end) of the concatenation."""
    full = total // length
    body = min(end, full * length)
    bounds = [start, *range((start // length + 1) * length, body, length)] if start < body else []
    pieces = [(a, b, a // length, a % length) for a, b in zip(bounds, [*bounds[1:], body])]
    if end > full * length:
        tail = [*tail_cuts(total, length), total]
        for k, (a, b) in enumerate(zip(tail, tail[1:])):
            lo, hi = max(a, start), min(b, end)
            if lo < hi:
                pieces.append((lo, hi, full + k, lo - a))
    return pieces


def pack(docs: DataFrame, path: str, end_id: int = 0, length: int = LENGTH, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per piece: id, start and length in the document, its ids (4 bytes little-endian
    each), the document's number of ids, sequence and offset there."""
    import pyarrow as pa
    table = token_table(docs, path, end_id, id_col, text_col)
    schema = StructType([StructField("doc_id", docs.schema[id_col].dataType), StructField("start", LongType()),
                         StructField("length", LongType()), StructField("ids", BinaryType()),
                         StructField("doc_tokens", LongType()), StructField("sequence_id", LongType()),
                         StructField("offset", LongType())])

    def cut(batches):
        for batch in batches:
            doc, where, total, n, ids = (batch.column(i) for i in range(5))
            where, total, n = where.to_numpy(), total.to_numpy(), n.to_numpy()
            rows, held = [], 0

            def out():
                at, start, size, data, whole, seq, off = zip(*rows)
                return pa.RecordBatch.from_arrays(
                    [doc.take(pa.array(at)), *[pa.array(x, pa.int64()) for x in (start, size)], pa.array(data, pa.binary()),
                     *[pa.array(x, pa.int64()) for x in (whole, seq, off)]], names=schema.names)

            for i in range(len(n)):
                raw, first = ids[i].as_py(), int(where[i])
                own = np.frombuffer(raw, f"<u{len(raw) // int(n[i])}").astype("<u4")
                for a, b, seq, off in cut_pieces(first, first + int(n[i]), int(total[i]), length):
                    rows.append((i, a - first, b - a, own[a - first:b - first].tobytes(), int(n[i]), seq, off))
                held += len(own)
                if held >= BATCH_IDS:
                    yield out()
                    rows, held = [], 0
            if rows:
                yield out()

    placed = table.join(F.broadcast(part_offsets(table)), "part").select(
        "doc_id", (F.col("base") + F.col("local")).alias("first"), "total", "n_tokens", "ids")
    return placed.mapInArrow(cut, schema)
