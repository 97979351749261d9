"""LM scoring with Brown class-based bigrams (operator 12).

P(w | v) = P(class(w) | class(v)) * P(w | class(w)). Words are put into ``CLASSES`` classes by exchange
clustering: round after round every word may move to the class that raises the likelihood of the
training corpus most, given the other words' classes. Tokens are words (A-Z lower-cased) and one end
per document.

1. Blocks. One pass over all whole texts turns runs of documents into blocks (about ``BLOCK_BYTES`` of
   text): the block's distinct words and its documents as word numbers.
2. Vocabulary. Distinct words go to word owners (parts of the hash range), which sum up training
   counts over all blocks. Owners answer each block, and the block keeps, for every word, where it
   stands with its owner. Words seen once in training share one class; a word never seen is unknown.
3. Exchange, ``ROUNDS`` times. Blocks turn their tokens into classes and send each owner, per word,
   the counts of classes before and after it. Owners merge them; the class bigrams (at most 68 x 68
   numbers, the only thing the driver sees) are summed over all owners; each owner then moves its
   words by the change of sum n log n (rows and columns of the class bigrams, less the marginals).
   Words of one round move side by side, after the first ``JOINT`` rounds only half of them; a round
   that lowers the likelihood is taken back and the next one moves half as many.
4. Scores. With the last classes the class bigrams are counted once more, and every document, trained
   on or held out, is scored where it lies. Transitions are smoothed towards the class unigram;
   an unknown word is as likely after a class as a word seen once (Good-Turing).

No vocabulary is broadcast or collected: tokens ask their block, blocks ask owners. Rows between blocks
and owners hold many words each; where input is so large that they hold single words, they are an
ordinary shuffle by word. Hot words cost one entry per block and context.

Words are known by 64-bit hashes. Defined results: NULL and empty texts are one end; very long texts are
a block of their own; a NULL id is not held out; repeated rows are documents of their own; without
training rows everything is unknown and scores 0; an empty table gives no rows; further columns are
ignored; equal gains move a word to the smaller class number.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (ArrayType, BinaryType, BooleanType, DoubleType, IntegerType, LongType, StructField,
                               StructType)

from .common import materialize

CLASSES = 64
ROUNDS = 3
#: Rounds in which all words may move.
JOINT = 2
#: An owner's words that move one by one; size of the groups of the others; entries weighed at a time.
SINGLE, GROUP, ENTRIES = 256, 2048, 1 << 15
#: Contexts besides the classes: words seen once, end, start; and the unknown word.
ONCE, END, START, UNKNOWN = CLASSES, CLASSES + 1, CLASSES + 2, CLASSES + 3
WIDTH = CLASSES + 3
AFTER = 128                     # a context number with this bit stands after the word
SMOOTH = 16.0
BLOCK_DOCS = 4096
BLOCK_BYTES = 8_000_000
SLICE_BYTES = 1_000_000
PART_WORDS = 1 << 17            # (block, word) pairs of one word owner, about


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 7 == 2, F.lit(False))


def squeezed(numbers: np.ndarray) -> bytes:
    """Numbers as compressed byte planes."""
    import zstandard
    a = np.ascontiguousarray(numbers)
    planes = a.view(np.uint8).reshape(-1, a.dtype.itemsize).T
    return zstandard.ZstdCompressor().compress(planes.tobytes())


def opened(blob: bytes, dtype) -> np.ndarray:
    import zstandard
    dtype = np.dtype(dtype)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(dtype.itemsize, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def token_blocks(docs: DataFrame, held: Column, id_col: str, text_col: str) -> DataFrame:
    """Stored table, one row per block: ids, held-out marks, words before each document, the distinct
    words, their training counts, and every token as a number of a distinct word."""
    import pyarrow as pa
    schema = StructType([StructField("block", LongType()), StructField("ids", ArrayType(docs.schema[id_col].dataType)),
                         StructField("held", BinaryType()), StructField("first", BinaryType()), StructField("words", BinaryType()),
                         StructField("counts", BinaryType()), StructField("codes", BinaryType()), StructField("n_words", LongType()),
                         StructField("n_train", LongType())])

    def cut(batches):
        import pyarrow.compute as pc
        from pyspark import TaskContext
        from . import grams
        from .tokens import slices
        block = TaskContext.get().partitionId() << 32
        ids, marks, hashes, sizes, text = [], [], [], [], 0

        def flush():
            nonlocal block, text
            h, size, out = np.concatenate(hashes), np.concatenate(sizes), np.concatenate(marks)
            words, code, n = np.unique(h, return_inverse=True, return_counts=True)
            order = np.argsort(-n, kind="stable")
            place = np.empty(len(words), np.uint32)
            place[order] = np.arange(len(words), dtype=np.uint32)
            code = place[code]
            train = np.bincount(code[np.repeat(~out, size)], minlength=len(words))
            one = pa.concat_arrays(ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block]), pa.ListArray.from_arrays(pa.array([0, len(one)], pa.int32()), one),
                 *[pa.array([x], pa.binary()) for x in (
                     out.tobytes(), squeezed(np.append(0, np.cumsum(size)).astype("<u4")), words[order].astype("<u8").tobytes(),
                     squeezed(train.astype("<u4")), squeezed(code.astype("<u4")))],
                 pa.array([len(words)]), pa.array([int((~out).sum())])], names=schema.names)
            block, text = block + 1, 0
            for x in (ids, marks, hashes, sizes):
                x.clear()

        for batch in batches:
            length = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
            for lo, hi in slices(batch.column(1), SLICE_BYTES):
                for a in range(lo, hi, BLOCK_DOCS):
                    b = min(hi, a + BLOCK_DOCS)
                    size = int(length[a:b].sum())
                    if ids and (sum(map(len, ids)) + b - a > BLOCK_DOCS or text + size > BLOCK_BYTES):
                        yield from flush()
                    h, first = grams.words(batch.column(1).slice(a, b - a), lower=True)
                    ids.append(batch.column(0).slice(a, b - a))
                    marks.append(batch.column(2).slice(a, b - a).to_numpy(zero_copy_only=False).astype(bool))
                    hashes.append(h)
                    sizes.append(np.diff(first))
                    text += size
        if ids:
            yield from flush()

    rows = docs.select(F.col(id_col), F.col(text_col).cast("string"), held)
    return materialize(rows.mapInArrow(cut, schema), "lm-blocks")


def owner_of(words: np.ndarray, bits: int) -> np.ndarray:
    return (words >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(words), np.int64)


def runs_of(owners: np.ndarray):
    """(owner, positions) for each owner, positions in order."""
    order = np.argsort(owners, kind="stable")
    cuts = np.flatnonzero(np.append(True, np.diff(owners[order]) != 0)) if len(owners) else []
    return [(int(owners[order[a]]), order[a:b]) for a, b in zip(cuts, np.append(cuts[1:], len(order)).astype(np.int64))]


def requests(blocks: DataFrame, bits: int) -> DataFrame:
    """(part, block, words, counts): each block's words by owner, in the block's order."""
    import pyarrow as pa

    def ask(batches):
        for batch in batches:
            for block, words, counts in zip(*[c.to_pylist() for c in batch.columns]):
                words, counts = np.frombuffer(words, "<u8"), opened(counts, "<u4")
                found = runs_of(owner_of(words, bits))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p for p, _ in found], pa.int64()), pa.array([block] * len(found), pa.int64()),
                     pa.array([words[at].tobytes() for _, at in found], pa.binary()),
                     pa.array([counts[at].tobytes() for _, at in found], pa.binary())], names=["part", "block", "words", "counts"])

    return blocks.select("block", "words", "counts").mapInArrow(ask, "part long, block long, words binary, counts binary")


def owners_answers(asked: DataFrame) -> DataFrame:
    """Stored table of the owners' counts: per block and part, every asked word's training count and
    its place among the part's words seen twice or more (block -1: these words' counts and first
    classes, and the numbers of words seen, and seen once)."""
    import pyarrow as pa
    schema = "part long, block long, counts binary, places binary, seen long, once long"

    def count(key, rows):
        words = [np.frombuffer(x, "<u8") for x in rows.column("words").to_pylist()]
        counts = [np.frombuffer(x, "<u4") for x in rows.column("counts").to_pylist()]
        kinds, code = np.unique(np.concatenate(words), return_inverse=True)
        total = np.bincount(code, np.concatenate(counts).astype(np.float64), len(kinds)).astype(np.int64)
        many = total > 1
        place = np.cumsum(many) - 1
        at, out = 0, [(-1, total[many].tobytes(), (kinds[many] % np.uint64(CLASSES)).astype(np.uint8).tobytes(),
                       int((total > 0).sum()), int((total == 1).sum()))]
        for block, w in zip(rows.column("block").to_pylist(), words):
            mine = code[at:at + len(w)]
            at += len(w)
            out.append((block, squeezed(total[mine]), squeezed(place[mine].astype("<i4")), None, None))
        block, c, p, seen, once = zip(*out)
        return pa.table([pa.array([key[0].as_py()] * len(out), pa.int64()), pa.array(block, pa.int64()), pa.array(c, pa.binary()),
                         pa.array(p, pa.binary()), pa.array(seen, pa.int64()), pa.array(once, pa.int64())],
                        names=["part", "block", "counts", "places", "seen", "once"])

    return materialize(asked.groupBy("part").applyInArrow(count, schema), "lm-owners")


def known_blocks(blocks: DataFrame, answers: DataFrame, bits: int) -> DataFrame:
    """Stored blocks in terms of the owners' words: per block the words seen twice or more (part, place,
    count) in order of part and the block's order; tokens are numbers of these, then once, then unknown."""
    import pyarrow as pa
    schema = StructType([StructField("block", LongType()), blocks.schema["ids"], *[StructField(c, BinaryType()) for c in (
        "held", "first", "parts", "places", "counts", "codes")]])

    def settle(key, left, right):
        left = left.to_pylist()[0]
        words = np.frombuffer(left["words"], "<u8")
        count, place = np.zeros(len(words), np.int64), np.zeros(len(words), np.int32)
        owners = dict(runs_of(owner_of(words, bits)))
        for p, c, x in zip(right.column("part").to_pylist(), right.column("counts").to_pylist(), right.column("places").to_pylist()):
            count[owners[p]], place[owners[p]] = opened(c, "<i8"), opened(x, "<i4")
        many = np.flatnonzero(count > 1)
        part = owner_of(words[many], bits)
        many = many[np.argsort(part, kind="stable")]
        number = np.full(len(words), len(many) + 1, np.uint32)
        number[count == 1] = len(many)
        number[many] = np.arange(len(many), dtype=np.uint32)
        ids = pa.array([left["ids"]], pa.list_(id_type(left_type)))
        return pa.table([pa.array([left["block"]]), ids, *[pa.array([x], pa.binary()) for x in (
            left["held"], left["first"], squeezed(owner_of(words[many], bits)), squeezed(place[many]), squeezed(count[many]),
            squeezed(number[opened(left["codes"], "<u4")]))]], names=schema.names)

    left_type = blocks.schema["ids"].dataType.elementType

    def id_type(t):
        from pyspark.sql.pandas.types import to_arrow_type
        return to_arrow_type(t)

    mine = blocks.select("block", "ids", "held", "first", "words", "codes")
    theirs = answers.filter("block >= 0").select(F.col("block").alias("b"), "part", "counts", "places")
    return materialize(mine.groupBy("block").cogroup(theirs.groupBy("b")).applyInArrow(settle, schema), "lm-known")


def wanted_places(known: DataFrame) -> DataFrame:
    """Stored requests of the rounds: (part, block, places)."""
    import pyarrow as pa

    def ask(batches):
        for batch in batches:
            for block, parts, places in zip(*[c.to_pylist() for c in batch.columns]):
                parts, places = opened(parts, "<i8"), opened(places, "<i4")
                found = runs_of(parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p for p, _ in found], pa.int64()), pa.array([block] * len(found), pa.int64()),
                     pa.array([squeezed(places[at]) for _, at in found], pa.binary())], names=["part", "block", "places"])

    return materialize(known.select("block", "parts", "places").mapInArrow(ask, "part long, block long, places binary"), "lm-asked")


def class_answers(asked: DataFrame, classes: DataFrame) -> DataFrame:
    """(block, part, classes): the classes of each block's words, in its order."""
    import pyarrow as pa

    def answer(key, rows, owner):
        own = np.frombuffer(owner.column("classes")[0].as_py(), np.uint8) if owner.num_rows else np.zeros(0, np.uint8)
        out = [own[opened(x, "<i4")].tobytes() for x in rows.column("places").to_pylist()]
        return pa.table([rows.column("block"), pa.array([key[0].as_py()] * len(out), pa.int64()), pa.array(out, pa.binary())],
                        names=["b", "part", "classes"])

    return asked.groupBy("part").cogroup(classes.select(F.col("part").alias("p"), "classes").groupBy("p")).applyInArrow(
        answer, "b long, part long, classes binary")


def block_classes(row: dict, right) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(numbers, classes) of a block's tokens and (begin, end) of its documents; every document is a
    start, its words and an end, whose numbers are -1."""
    order = np.argsort(right.column("part").to_numpy())
    answers = right.column("classes").to_pylist()
    table = np.concatenate([*[np.frombuffer(answers[i], np.uint8) for i in order], np.array([ONCE, UNKNOWN], np.uint8)])
    code, first = opened(row["codes"], "<u4"), opened(row["first"], "<u4").astype(np.int64)
    n = np.diff(first)
    begin = first[:-1] + 2 * np.arange(len(n))
    number = np.full(len(code) + 2 * len(n), -1, np.int64)
    cls = np.empty(len(number), np.uint8)
    word = np.ones(len(number), bool)
    word[begin] = word[begin + n + 1] = False
    number[word], cls[word] = code, table[code]
    cls[begin], cls[begin + n + 1] = START, END
    return number, cls, begin, begin + n + 2


def context_counts(known: DataFrame, answers: DataFrame) -> DataFrame:
    """(part, keys, n): per block and part, how often each context stands beside each of the part's
    words (key: place * 256 + context). Start and once are two further words, of part -1."""
    import pyarrow as pa

    def count(key, left, right):
        row = left.to_pylist()[0]
        parts, places = opened(row["parts"], "<i8"), opened(row["places"], "<i4").astype(np.int64)
        number, cls, begin, end = block_classes(row, right)
        trained = np.repeat(~np.frombuffer(row["held"], bool), end - begin)
        here = np.flatnonzero(trained[:-1] & (cls[:-1] != END))           # a bigram begins here
        a, b = number[here], number[here + 1]
        left_of, right_of = cls[here].astype(np.int64), cls[here + 1].astype(np.int64)
        before = (b >= 0) & (b < len(parts))
        after = (a >= 0) & (a < len(parts))
        key_, n = np.unique(np.concatenate([b[before] << 8 | left_of[before], a[after] << 8 | AFTER | right_of[after]]),
                            return_counts=True)
        rest = (~after) & (~before)
        key2, n2 = np.unique(left_of[rest] << 8 | right_of[rest], return_counts=True)
        out = [(-1, squeezed(key2), squeezed(n2.astype("<i8")))]
        which = key_ >> 8
        if len(key_):
            owner = parts[which]                                          # ascending, as words are in order of part
            cuts = np.flatnonzero(np.append(True, np.diff(owner) != 0))
            for lo, hi in zip(cuts, np.append(cuts[1:], len(owner)).astype(np.int64)):
                k = places[which[lo:hi]] << 8 | key_[lo:hi] & 255
                order = np.argsort(k, kind="stable")
                out.append((int(owner[lo]), squeezed(np.diff(k[order], prepend=0)), squeezed(n[lo:hi][order].astype("<i8"))))
        p, k, x = zip(*out)
        return pa.table([pa.array(p, pa.int64()), pa.array(k, pa.binary()), pa.array(x, pa.binary())], names=["part", "keys", "n"])

    return known.groupBy("block").cogroup(answers.groupBy("b")).applyInArrow(count, "part long, keys binary, n binary")


def merged_contexts(contexts: DataFrame, classes: DataFrame) -> DataFrame:
    """Stored table, one row per part: its words' counts and classes, and all contexts' counts."""
    import pyarrow as pa

    def merge(key, rows, owner):
        part = key[0].as_py()
        if part < 0:
            keys = [opened(x, "<i8") for x in rows.column("keys").to_pylist()]
        else:
            keys = [np.cumsum(opened(x, "<i8")) for x in rows.column("keys").to_pylist()]
        n = [opened(x, "<i8") for x in rows.column("n").to_pylist()]
        kinds, code = np.unique(np.concatenate(keys or [np.zeros(0, np.int64)]), return_inverse=True)
        total = np.bincount(code, np.concatenate(n or [np.zeros(0)]).astype(np.float64), len(kinds)).astype(np.int64)
        had = owner.num_rows > 0
        return pa.table([pa.array([part], pa.int64()), pa.array([owner.column("counts")[0].as_py() if had else b""], pa.binary()),
                         pa.array([owner.column("classes")[0].as_py() if had else b""], pa.binary()),
                         pa.array([squeezed(kinds)], pa.binary()), pa.array([squeezed(total)], pa.binary())],
                        names=["part", "counts", "classes", "keys", "n"])

    owners = classes.select(F.col("part").alias("p"), "counts", "classes")
    return materialize(contexts.groupBy("part").cogroup(owners.groupBy("p")).applyInArrow(
        merge, "part long, counts binary, classes binary, keys binary, n binary"), "lm-contexts")


def class_bigrams(merged: DataFrame) -> np.ndarray:
    """Counts of class pairs over all training tokens (WIDTH x WIDTH)."""
    import pyarrow as pa

    def add(batches):
        total = np.zeros(WIDTH * WIDTH, np.int64)
        for batch in batches:
            for part, classes, keys, n in zip(*[c.to_pylist() for c in batch.columns]):
                key, n, classes = opened(keys, "<i8"), opened(n, "<i8"), np.frombuffer(classes, np.uint8)
                if part < 0:
                    at, ok = (key >> 8) * WIDTH + (key & 255), np.ones(len(key), bool)
                else:
                    own, ctx = classes[key >> 8].astype(np.int64), key & 127
                    behind = key & AFTER > 0
                    at = np.where(behind, own * WIDTH + ctx, ctx * WIDTH + own)
                    ok = ~behind | (ctx >= CLASSES)               # pairs of two such words are told by the second
                np.add.at(total, at[ok], n[ok])
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["cell", "n"])

    cells = (merged.select("part", "classes", "keys", "n").mapInArrow(add, "cell int, n long")
             .groupBy("cell").agg(F.sum("n").alias("n")).collect())
    out = np.zeros(WIDTH * WIDTH, np.int64)
    for r in cells:
        out[r["cell"]] = r["n"]
    return out.reshape(WIDTH, WIDTH)


def weigh(x: np.ndarray) -> np.ndarray:
    """n log n (0 at 0)."""
    return x * np.log(np.maximum(x, 1e-300))


def information(bigrams: np.ndarray) -> float:
    """Sum of n log n over class pairs less the marginals: what exchange raises."""
    pairs = bigrams.astype(np.float64)
    return float(weigh(pairs).sum() - weigh(pairs.sum(axis=0)).sum() - weigh(pairs.sum(axis=1)).sum())


def moved(classes: np.ndarray, key: np.ndarray, n: np.ndarray, counts: np.ndarray, bigrams: np.ndarray, turn: int,
          share: float) -> np.ndarray:
    """The words' classes after one round of exchange among one owner's words, of which ``share`` may
    move: the most frequent ones one by one, the others in groups, each on the class pairs that the
    moves before it have left."""
    from .grams import mixed
    pairs = bigrams.astype(np.float64)
    tables = (pairs[:, :CLASSES], pairs[:CLASSES, :].T)               # [context, class]: before, after
    out, places = classes.copy(), np.arange(len(classes), dtype=np.uint64)
    first = np.searchsorted(key >> 8, np.arange(len(classes) + 1))
    free = (mixed(places << np.uint64(16) | np.uint64(turn)) >> np.uint64(32)) < share * 2.0 ** 32
    order = np.argsort(-counts, kind="stable")
    order = order[free[order]]
    for group in [*np.split(order[:SINGLE], np.arange(1, min(SINGLE, len(order)))),
                  *np.split(order[SINGLE:], np.arange(GROUP, max(0, len(order) - SINGLE), GROUP))]:
        own, size = out[group].astype(np.int64), first[group + 1] - first[group]
        upto, rows = np.cumsum(size), np.arange(len(group))
        entry = np.repeat(first[group] - upto + size, size) + np.arange(upto[-1] if len(upto) else 0)
        word, context, m = np.repeat(rows, size), key[entry] & 127, n[entry].astype(np.float64)
        side = (key[entry] & AFTER > 0).astype(np.int64)
        gain = np.zeros((len(group), CLASSES))
        for s, table in enumerate(tables):
            known = weigh(table)
            mine = np.flatnonzero(side == s)
            for lo in range(0, len(mine), ENTRIES):
                e = mine[lo:lo + ENTRIES]
                w, c, k, x = word[e], context[e], own[word[e]], m[e]
                value = weigh(table[c] + x[:, None]) - known[c]
                value[np.arange(len(e)), k] = known[c, k] - weigh(np.maximum(table[c, k] - x, 0))
                cuts = np.flatnonzero(np.append(True, np.diff(w) != 0))
                gain[w[cuts]] += np.add.reduceat(value, cuts, axis=0)
        total = counts[group].astype(np.float64)
        for t in (pairs.sum(axis=0)[:CLASSES], pairs.sum(axis=1)[:CLASSES]):
            value = weigh(t[None, :] + total[:, None]) - weigh(t)[None, :]
            value[rows, own] = weigh(t[own]) - weigh(np.maximum(t[own] - total, 0))
            gain -= value
        best = np.argmax(gain, axis=1)
        best = np.where(gain[rows, best] > gain[rows, own] + 1e-9, best, own)
        out[group] = best
        go = (best != own)[word]
        for s, table in enumerate(tables):
            e = np.flatnonzero(go & (side == s))
            np.add.at(table, (context[e], own[word[e]]), -m[e])
            np.add.at(table, (context[e], best[word[e]]), m[e])
        np.maximum(pairs, 0, out=pairs)             # a word beside itself is told by both its sides
    return out


def exchanged(merged: DataFrame, bigrams: np.ndarray, turn: int, share: float) -> DataFrame:
    """Stored owners' table (part, counts, classes) after a round."""
    import pyarrow as pa

    def exchange(batches):
        for batch in batches:
            for part, counts, classes, keys, n in zip(*[c.to_pylist() for c in batch.columns]):
                own = moved(np.frombuffer(classes, np.uint8), opened(keys, "<i8"), opened(n, "<i8"),
                            np.frombuffer(counts, "<i8"), bigrams, turn, share)
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([counts], pa.binary()),
                                                  pa.array([own.tobytes()], pa.binary())], names=["part", "counts", "classes"])

    return materialize(merged.filter("part >= 0").mapInArrow(exchange, "part long, counts binary, classes binary"), "lm-classes")


def log_model(bigrams: np.ndarray, smooth: float = SMOOTH) -> tuple[np.ndarray, np.ndarray]:
    """(log10 P(class | class before), log10 of the classes' token counts). Unknown is one more class: it
    takes as much as the words seen once, and as a history it is one of them."""
    n = np.zeros((WIDTH + 1, WIDTH + 1))
    n[:WIDTH, :WIDTH] = bigrams
    n[:, UNKNOWN] = n[:, ONCE]
    n[UNKNOWN] = n[ONCE]
    tokens = bigrams.sum(axis=0).astype(np.float64)
    prior = np.append(tokens, tokens[ONCE] + 1)
    prior /= prior.sum()
    with np.errstate(divide="ignore"):
        return (np.log10((n + smooth * prior) / (n.sum(axis=1, keepdims=True) + smooth)),
                np.log10(np.append(tokens, 1)))


def scored(known: DataFrame, answers: DataFrame, bigrams: np.ndarray, n_train: int, seen: int, id_col: str) -> DataFrame:
    """The documents' scores."""
    import pyarrow as pa
    id_type = known.schema["ids"].dataType.elementType
    schema = StructType([StructField(id_col, id_type), StructField("held_out", BooleanType()), StructField("n_tokens", LongType()),
                         StructField("n_known", LongType()), StructField("train_tokens", LongType()), StructField("base_score", DoubleType()),
                         StructField("score", DoubleType())])
    total = int(bigrams.sum())
    kinds = seen + (n_train > 0)

    def rate(key, left, right):
        from pyspark.sql.pandas.types import to_arrow_type
        move, size = log_model(bigrams)
        row = left.to_pylist()[0]
        number, cls, begin, end = block_classes(row, right)
        count = opened(row["counts"], "<i8")
        cls = cls.astype(np.int64)
        if not n_train:
            cls[cls == END] = UNKNOWN
        times = np.concatenate([count, [1, 0], [n_train]])[number]        # -1, a start or an end, is the last
        emit = np.log10(np.maximum(times, 1)) - size[cls]
        emit[(cls == UNKNOWN) | (cls == END) | (cls == START)] = 0.0
        step = np.zeros(len(cls))
        step[1:] = move[cls[:-1], cls[1:]] + emit[1:]
        base = np.log10((times + 1) / (total + kinds + 1))
        seen_ = (times > 0).astype(np.int64)
        for x in (step, base, seen_):
            x[begin] = 0
        per_doc = [np.add.reduceat(x, begin) for x in (seen_, base, step)]
        return pa.table([pa.array(row["ids"], to_arrow_type(id_type)), pa.array(np.frombuffer(row["held"], bool)),
                         pa.array(end - begin - 1), pa.array(per_doc[0]), pa.array(np.full(len(begin), total)),
                         pa.array(per_doc[1]), pa.array(per_doc[2])], names=schema.names)

    return known.groupBy("block").cogroup(answers.groupBy("b")).applyInArrow(rate, schema)


def lm_scores(docs: DataFrame, held: Column | None = None, rounds: int = ROUNDS, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """One row per document: id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``
    (add-one unigram) and ``score``, the class model's log10 probability of the text."""
    blocks = token_blocks(docs, held_out(F.col(id_col)) if held is None else F.coalesce(held, F.lit(False)), id_col, text_col)
    n_words, n_train = blocks.agg(F.coalesce(F.sum("n_words"), F.lit(0)), F.coalesce(F.sum("n_train"), F.lit(0))).collect()[0]
    bits = (int(n_words) // PART_WORDS).bit_length()
    answers = owners_answers(requests(blocks, bits))
    seen = answers.filter("block = -1").agg(F.coalesce(F.sum("seen"), F.lit(0))).collect()[0][0]
    known = known_blocks(blocks, answers, bits)
    asked = wanted_places(known)
    classes = answers.filter("block = -1").select("part", "counts", F.col("places").alias("classes"))
    best, share = None, 1.0
    for turn in range(rounds + 1):
        merged = merged_contexts(context_counts(known, class_answers(asked, classes)), classes)
        bigrams = class_bigrams(merged)
        if best is None or information(bigrams) >= information(best[2]):
            best = classes, merged, bigrams
        else:                                       # joint moves undid each other: again, with fewer
            share /= 2
        if turn < rounds:
            classes = exchanged(best[1], best[2], turn, share if turn < JOINT else share / 2)
    return scored(known, class_answers(asked, best[0]), best[2], n_train, seen, id_col)
