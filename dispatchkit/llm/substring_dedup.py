"""Substring dedup with fixed-block anchors (operator 10).

Every window of ``window`` words that also starts in a document with a smaller id is removed.
With blocks of b = (window + 1) / 2 words, each window of a document contains exactly one of the
document's non-overlapping blocks (those that start at a multiple of b). So:

1. Slices. Documents are stored in slices of some megabytes (compressed Arrow); a slice is the unit
   of all further work, whatever ids its rows carry.
2. Anchors. Each slice sends the distinct hashes of all its rolling b-word windows, marked where a
   hash is a reference block, sorted and packed, to the range the hash falls in. A hash that occurs
   twice or more, at least once as a block, is a hit and goes back to the slices that have it.
3. Extension. Around every hit a slice compares whole windows: for each window that contains a hit
   it sends the hash of all its words with the smallest id that has it. The smallest id of all
   slices decides; a slice is told the windows for which another one has a smaller id. Runs of
   such windows are the maximal repeats.
4. Removal. Words covered by a repeated window are cut; spans and the kept text come out.

A slice sends a hash once however often it occurs there, so a passage that a third of all documents
share reaches a range as one entry per slice. No pairs of documents are formed. Step 2 uses hashes
of about 35 bits more than the slices need to be told apart (a chance hit only costs a comparison),
step 3 uses 64 bits.

Defined results: NULL or empty text has no words; a NULL id is larger than any other; rows that
share an id do not remove each other's windows; ids are integers; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .common import materialize

WINDOW = 13
SLICE_BYTES = 8_000_000
LAST = np.iinfo(np.int64).max


def pack(values: np.ndarray) -> bytes:
    """Integers as compressed byte planes (of differences, where they are sorted)."""
    import zstandard
    planes = np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(data: bytes) -> np.ndarray:
    import zstandard
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data), dtype=np.uint64)


def text_slices(docs: DataFrame, id_col: str, text_col: str, slice_bytes: int) -> DataFrame:
    """Stored table (slice, data): rows (id, text) of a slice as one compressed Arrow stream."""
    import pyarrow as pa

    def cut(batches):
        from pyspark import TaskContext
        from .tokens import slices
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for lo, hi in slices(batch.column(1), slice_bytes):
                part = batch.slice(lo, hi - lo)
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                    out.write_batch(part)
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                                                 names=["slice", "data"])
                number += 1

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return materialize(rows.mapInArrow(cut, "slice long, data binary"), "substring-slices", codec="uncompressed")


class Slice:
    """The words of a slice and the windows that lie within one document."""

    def __init__(self, data: bytes, window: int):
        import pyarrow as pa
        from . import grams
        self.rows = pa.ipc.open_stream(data).read_all().combine_chunks().to_batches()[0]
        self.window, self.block = window, (window + 1) // 2
        self.h, self.first = grams.words(self.rows.column(1))
        count = np.diff(self.first)
        ids = self.rows.column(0).fill_null(LAST).to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(count)), count)
        self.place = np.arange(len(self.h)) - self.first[:-1][row]      # position in the document
        self.left = count[row] - self.place                             # words from here to its end
        self.long = count[row] >= window
        self.ids = ids[row]

    def anchors(self, shift: int):
        """(positions, hashes) of the rolling block-sized windows of documents that have a window."""
        from . import grams
        at = np.flatnonzero(self.long & (self.left >= self.block))
        return at, grams.grams(self.h, self.block)[at] >> np.uint64(shift) if len(at) else np.zeros(0, np.uint64)

    def windows(self):
        """(starts, hashes) of all whole windows."""
        from . import grams
        at = np.flatnonzero(self.left >= self.window)
        return at, grams.grams(self.h, self.window)[at] if len(at) else np.zeros(0, np.uint64)


def by_range(keys: np.ndarray, bits: int, width: int):
    """(range, from, to) of sorted keys of ``width`` bits cut by their top ``bits`` bits."""
    tops = keys >> np.uint64(width - bits)
    cuts = np.flatnonzero(np.diff(tops)) + 1
    for a, b in zip(np.concatenate([[0], cuts]).tolist(), np.append(cuts, len(keys)).tolist()):
        if a < b:
            yield int(tops[a]), a, b


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
            slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """One row per document: id, ``n_words``, ``spans`` (removed word ranges [from, to), maximal and
    in order) and ``kept_text`` (the other words, joined by one space)."""
    import pyarrow as pa
    slices = text_slices(docs, id_col, text_col, slice_bytes)
    n_slices = max(1, slices.select("slice").count())
    range_bits = max(4, (n_slices // 2).bit_length())
    width = min(64, n_slices.bit_length() + 35)
    shift = 64 - width
    entry = "range long, slice long, keys binary, extra binary"
    names = ["range", "slice", "keys", "extra"]
    answer = "slice long, keys binary"

    def rows_of(found, names):
        kinds = {"range": pa.int64(), "slice": pa.int64(), "keys": pa.binary(), "extra": pa.binary()}
        columns = list(zip(*found)) if found else [[] for _ in names]
        return pa.Table.from_arrays([pa.array(list(c), kinds[n]) for c, n in zip(columns, names)], names=names)

    def send_anchors(batches):
        for batch in batches:
            for number, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                s = Slice(data.as_buffer(), window)
                at, keys = s.anchors(shift)
                order = np.argsort(keys, kind="stable")
                keys, block = keys[order], s.place[at[order]] % s.block == 0
                new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[:len(keys)])
                if not len(new):
                    continue
                times = np.diff(np.append(new, len(keys)))
                mark = (np.maximum.reduceat(block, new).astype(np.uint64) | (times > 1).astype(np.uint64) << np.uint64(1))
                keys = keys[new]
                found = [(r, number, pack_sorted(keys[a:b]), pack(mark[a:b])) for r, a, b in by_range(keys, range_bits, width)]
                yield from rows_of(found, names).to_batches()

    def find_hits(table):
        keys = [unpack_sorted(x) for x in table.column("keys").to_pylist()]
        mark = np.concatenate([unpack(x) for x in table.column("extra").to_pylist()])
        size = np.array([len(k) for k in keys])
        every = np.concatenate(keys)
        owner = np.repeat(np.arange(len(keys)), size)
        order = np.argsort(every, kind="stable")
        new = np.flatnonzero(np.concatenate([[True], np.diff(every[order]) > 0]))
        times = np.diff(np.append(new, len(every)))
        any_mark = np.bitwise_or.reduceat(mark[order], new)
        hit = (any_mark & np.uint64(1) > 0) & ((times > 1) | (any_mark & np.uint64(2) > 0))
        good = order[np.repeat(hit, times)]
        return answers(table, every, owner, good)

    def answers(table, every, owner, good):
        good = good[np.lexsort((every[good], owner[good]))]
        number = table.column("slice").to_pylist()
        cuts = np.flatnonzero(np.diff(owner[good])) + 1
        found = [(number[owner[part[0]]], pack_sorted(every[part])) for part in np.split(good, cuts) if len(part)]
        return rows_of(found, ["slice", "keys"])

    def known(table):
        blobs = [unpack_sorted(x) for x in table.column("keys").to_pylist()]
        return np.sort(np.concatenate(blobs)) if blobs else np.zeros(0, np.uint64)

    def among(values, sorted_keys):
        if not len(sorted_keys):
            return np.zeros(len(values), bool)
        i = np.minimum(np.searchsorted(sorted_keys, values), len(sorted_keys) - 1)
        return sorted_keys[i] == values

    def send_windows(left, right):
        if not left.num_rows:
            return rows_of([], names)
        number, s, hits = left.column("slice")[0].as_py(), Slice(left.column("data")[0].as_buffer(), window), known(right)
        at, keys = s.anchors(shift)
        reach = np.zeros(len(s.h) + 1, np.int64)
        hit = at[among(keys, hits)]
        # a window contains the hit if it starts up to window - block words before it
        np.add.at(reach, np.maximum(hit - (window - s.block), 0), 1)
        np.add.at(reach, hit + 1, -1)
        at, keys = s.windows()
        near = np.cumsum(reach)[at] > 0
        at, keys = at[near], keys[near]
        order = np.lexsort((s.ids[at], keys))
        keys, ids = keys[order], s.ids[at[order]]
        new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[:len(keys)])
        keys, ids = keys[new], ids[new]
        return rows_of([(r, number, pack_sorted(keys[a:b]), pack(ids[a:b])) for r, a, b in by_range(keys, range_bits, 64)], names)

    def find_smaller(table):
        keys = [unpack_sorted(x) for x in table.column("keys").to_pylist()]
        ids = np.concatenate([unpack(x) for x in table.column("extra").to_pylist()]).astype(np.int64)
        every = np.concatenate(keys)
        owner = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
        order = np.argsort(every, kind="stable")
        new = np.flatnonzero(np.concatenate([[True], np.diff(every[order]) > 0]))
        least = np.repeat(np.minimum.reduceat(ids[order], new), np.diff(np.append(new, len(every))))
        return answers(table, every, owner, order[ids[order] > least])

    def remove(left, right):
        out = {"id": [], "n_words": [], "spans": [], "kept_text": []}
        if left.num_rows:
            s, elsewhere = Slice(left.column("data")[0].as_buffer(), window), known(right)
            at, keys = s.windows()
            order = np.lexsort((s.ids[at], keys))
            ks, ids = keys[order], s.ids[at[order]]
            new = np.flatnonzero(np.concatenate([[True], ks[1:] != ks[:-1]])[:len(ks)])
            least = np.repeat(ids[new], np.diff(np.append(new, len(ks)))) if len(new) else ids
            gone = at[order[(ids > least) | among(ks, elsewhere)]]
            change = np.zeros(len(s.h) + 1, np.int64)
            change[:] = np.bincount(gone, minlength=len(change)) - np.bincount(gone + window, minlength=len(change))[:len(change)]
            cut = np.cumsum(change)[:-1] > 0
            for i, text in enumerate(s.rows.column(1).to_pylist()):
                a, b = int(s.first[i]), int(s.first[i + 1])
                own, words = cut[a:b], (text or "").encode().split()
                edge = np.flatnonzero(np.diff(np.concatenate([[False], own, [False]]).astype(np.int8))).tolist()
                spans = [{"from": x, "to": y} for x, y in zip(edge[::2], edge[1::2])]
                if spans:
                    words = [w for w, c in zip(words, own.tolist()) if not c]
                out["n_words"].append(b - a)
                out["spans"].append(spans)
                out["kept_text"].append(b" ".join(words).decode())
            out["id"] = s.rows.column(0)
        span = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))
        return pa.table({"id": pa.array(out["id"], pa.int64()) if not left.num_rows else out["id"],
                         "n_words": pa.array(out["n_words"], pa.int64()), "spans": pa.array(out["spans"], span),
                         "kept_text": pa.array(out["kept_text"], pa.string())})

    hits = slices.mapInArrow(send_anchors, entry).groupBy("range").applyInArrow(find_hits, answer)
    found = (slices.groupBy("slice").cogroup(hits.groupBy("slice")).applyInArrow(send_windows, entry))
    smaller = found.groupBy("range").applyInArrow(find_smaller, answer)
    return (slices.groupBy("slice").cogroup(smaller.groupBy("slice"))
            .applyInArrow(remove, "id long, n_words long, spans array<struct<from:long,to:long>>, kept_text string")
            .withColumnRenamed("id", id_col))
