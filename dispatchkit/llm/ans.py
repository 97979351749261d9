"""Token files by static range asymmetric numeral systems (operator 6).

Format. A token file is a Parquet folder of block rows, written by Spark's committer (a lost
executor leaves no half file). One frequency table is shared by all blocks: counts over all
documents, scaled to 2**20 with at least 1 for each id of the vocabulary, stored beside the
blocks. A block holds whole documents (ids and lengths are part of the row) of about
``block_tokens`` ids and decodes on its own: its ids are dealt to interleaved lanes (id i belongs
to lane i mod lanes), every lane is a 64-bit range coder that gives off 32-bit words, and all lanes
advance together, so one numpy step codes one id of each lane. Every ``every`` steps the lane
states and the word position are kept as a checkpoint, from which decoding can start inside a
block. The CRC-32 of the ids is checked after decoding.

Order. Texts are range-partitioned and sorted by id (NULL last), tokenized where they land, and
the parts and blocks are numbered in that order; a running sum over one row per part gives global
positions.

Defined results: NULL or empty text is a document of the end id alone; rows that repeat an id
follow one another, ordered by text hash; a text of any length is one document of one block; an
empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (ArrayType, BinaryType, IntegerType, LongType, StructField, StructType)

from .common import materialize
from .packing import part_offsets, token_table

SCALE_BITS = 20
LOW = np.uint64(1 << 31)
LANES = 1024
BLOCK_TOKENS = 1 << 18
EVERY = 128


def scaled(counts: np.ndarray, bits: int = SCALE_BITS) -> np.ndarray:
    """Frequencies of at least 1 that sum to 2**bits, in proportion to the counts."""
    total, room = max(int(counts.sum()), 1), (1 << bits) - len(counts)
    freq = 1 + counts.astype(np.int64) * room // total
    freq[int(np.argmax(counts))] += (1 << bits) - int(freq.sum())
    return freq


def encode(ids: np.ndarray, freq: np.ndarray, lanes: int, every: int = EVERY):
    """(words, checkpoints): the 32-bit words of a block and, for every ``every``-th step, the
    position of its first word and the lane states before that step."""
    starts = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64)
    freq = freq.astype(np.uint64)
    steps = -(-len(ids) // lanes)
    state, parts, marks, used = np.full(lanes, LOW, np.uint64), [], {}, 0
    limit = freq * (LOW >> np.uint64(SCALE_BITS) << np.uint64(32))
    for step in range(steps - 1, -1, -1):
        sym = ids[step * lanes:(step + 1) * lanes]
        x = state[:len(sym)]
        full = x >= limit[sym]
        if full.any():
            parts.append((x[full] & np.uint64(0xFFFFFFFF)).astype("<u4"))
            used += len(parts[-1])
            x = np.where(full, x >> np.uint64(32), x)
        f = freq[sym]
        q = x // f
        state[:len(sym)] = (q << np.uint64(SCALE_BITS)) + (x - q * f) + starts[sym]
        if step % every == 0:
            marks[step] = (used, state.copy())
    words = np.concatenate(parts[::-1]) if parts else np.zeros(0, "<u4")
    return words, [(step, used - marks[step][0], marks[step][1]) for step in sorted(marks)]


def lookup(freq: np.ndarray) -> np.ndarray:
    """Slot -> id."""
    return np.repeat(np.arange(len(freq), dtype=np.uint32), freq)


def decode(words: np.ndarray, state: np.ndarray, at: int, step: int, last: int, n: int, lanes: int,
           freq: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Ids of steps [step, last) from a checkpoint's states and word position."""
    starts = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64)
    freq = freq.astype(np.uint64)
    mask, bits, state, out = np.uint64((1 << SCALE_BITS) - 1), np.uint64(SCALE_BITS), state.copy(), []
    for k in range(step, last):
        width = min(lanes, n - k * lanes)
        x = state[:width]
        slot = x & mask
        sym = slots[slot]
        x = freq[sym] * (x >> bits) + slot - starts[sym]
        low = np.flatnonzero(x < LOW)
        if len(low):
            x[low] = (x[low] << np.uint64(32)) | words[at:at + len(low)]
            at += len(low)
        state[:width] = x
        out.append(sym)
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


def count_ids(table: DataFrame, size: int) -> np.ndarray:
    """Occurrences of each id over the whole table (bounded by the vocabulary)."""
    import pyarrow as pa

    def count(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            width = 2 if size <= 1 << 16 else 4
            data = b"".join(batch.column(0).to_pylist())
            total += np.bincount(np.frombuffer(data, f"<u{width}"), minlength=size)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["id", "n"])

    rows = table.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(size, np.int64)
    counts[[r.id for r in rows]] = [r.n for r in rows]
    return counts


def write_token_files(docs: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
                      lanes: int = LANES, block_tokens: int = BLOCK_TOKENS, every: int = EVERY) -> tuple[DataFrame, DataFrame]:
    """Write all documents' ids; returns (blocks, frequency table) as read from the files."""
    import pyarrow as pa
    from . import tokens
    spark = docs.sparkSession
    size = tokens.load(path).size
    id_type = docs.schema[id_col].dataType
    order = [F.col(id_col).asc_nulls_last(), F.xxhash64(F.col(text_col))]
    ordered = docs.select(id_col, text_col).repartitionByRange(*order).sortWithinPartitions(*order)
    table = token_table(ordered, path, end_id, id_col, text_col)
    freq = scaled(count_ids(table, size))
    shared = materialize(spark.createDataFrame([(i, int(f)) for i, f in enumerate(freq)], "id int, freq int").coalesce(1),
                         "token-file-freq")
    checkpoint = StructType([StructField("step", IntegerType()), StructField("word", LongType()),
                             StructField("states", BinaryType())])
    schema = StructType([
        StructField("part", IntegerType()), StructField("first", LongType()), StructField("n_tokens", LongType()),
        StructField("doc_ids", ArrayType(id_type)), StructField("doc_tokens", ArrayType(LongType())),
        StructField("lanes", IntegerType()), StructField("words", BinaryType()),
        StructField("checkpoints", ArrayType(checkpoint)), StructField("ids_crc32", LongType())])

    def blocks(batches):
        doc_ids, data, at = [], [], (None, 0)

        def out():
            ids = np.concatenate(data).astype(np.uint32)
            wide = max(1, min(lanes, len(ids) // 64))
            words, marks = encode(ids, freq, wide, every)
            block = {"part": at[0], "first": at[1], "n_tokens": len(ids), "doc_ids": doc_ids,
                     "doc_tokens": [len(x) for x in data], "lanes": wide, "words": words.tobytes(),
                     "checkpoints": [{"step": s, "word": w, "states": x.astype("<u8").tobytes()} for s, w, x in marks],
                     "ids_crc32": zlib.crc32(ids.astype("<u4").tobytes())}
            return pa.RecordBatch.from_pylist([block], schema=arrow)

        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)
        held = 0
        for batch in batches:
            for part, local, doc_id, raw in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                own = np.frombuffer(raw, "<u2" if size <= 1 << 16 else "<u4")
                if data and (held >= block_tokens or part != at[0] or local != at[1] + held):
                    yield out()
                    doc_ids, data, held = [], [], 0
                if not data:
                    at = (part, local)
                doc_ids.append(doc_id)
                data.append(own)
                held += len(own)
        if data:
            yield out()

    coded = table.select("part", "local", "doc_id", "ids").mapInArrow(blocks, schema)
    return materialize(coded, "token-files", codec="uncompressed"), shared


def read_token_files(blocks: DataFrame, shared: DataFrame) -> DataFrame:
    """Decode: one row per document in file order: id, part, local, n_tokens and its ids
    (4 bytes little-endian each). A block whose checksum differs stops the job."""
    import pyarrow as pa
    freq = np.array([r.freq for r in shared.orderBy("id").collect()], np.int64)      # bounded by the vocabulary
    id_type = blocks.schema["doc_ids"].dataType.elementType
    schema = StructType([StructField("doc_id", id_type), StructField("part", IntegerType()),
                         StructField("local", LongType()), StructField("n_tokens", LongType()),
                         StructField("ids", BinaryType())])

    def docs(batches):
        from pyspark.sql.pandas.types import to_arrow_type
        slots = lookup(freq)
        for batch in batches:
            for b in range(batch.num_rows):
                row = {k: batch.column(i)[b].as_py() for i, k in enumerate(batch.schema.names)}
                words = np.frombuffer(row["words"], "<u4").astype(np.uint64)
                mark, n, wide = row["checkpoints"][0], row["n_tokens"], row["lanes"]
                ids = decode(words, np.frombuffer(mark["states"], "<u8"), mark["word"], 0, -(-n // wide), n, wide, freq, slots)
                raw = ids.astype("<u4").tobytes()
                if zlib.crc32(raw) != row["ids_crc32"]:
                    raise ValueError(f"token block {row['part']}:{row['first']} is damaged")
                sizes = np.array(row["doc_tokens"], np.int64)
                ends = np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], to_arrow_type(id_type)), pa.array(np.full(len(sizes), row["part"], np.int32)),
                     pa.array(row["first"] + ends - sizes), pa.array(sizes),
                     pa.array([raw[4 * (e - s):4 * e] for s, e in zip(sizes.tolist(), ends.tolist())], pa.binary())],
                    names=schema.names)

    return blocks.mapInArrow(docs, schema)


def documents_of(blocks: DataFrame, shared: DataFrame) -> DataFrame:
    """Documents as read from the files, with their global position (``start``)."""
    offsets = part_offsets(blocks.select("part", "n_tokens"))
    return (read_token_files(blocks, shared).join(F.broadcast(offsets), "part")
            .select("doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids"))
