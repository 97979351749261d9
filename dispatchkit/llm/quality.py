"""Quality classifier: a generalised additive model with pairwise interactions (operator 5).

Features describe the text alone (lengths, character classes, repetition, line shape). The model
is an intercept plus one lookup table per feature plus a few two-feature tables. Training is
cyclic boosting: round after round, each feature in turn gets one shallow tree (at most four
leaves over its bins) fitted to the current logistic gradient, and the tree is added to the
feature's table; then the pairs whose best four-quadrant split gains most are boosted the same
way. Scoring is numpy bin lookup and addition.

Features of all documents are computed in one pass over the texts. The model is fitted on the
driver on at most ``max_rows`` labelled rows (those with the smallest id hashes), never on rows
that are held out. Labels, language, source and id are no inputs of a score.

Defined results: NULL and empty texts have a score; an unlabelled or one-class table gives the
label share (0.5 without labels) as every score; contradicting labels of one id all count; NULL
labels do not; NULL ids are not held out; repeated rows score alike; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StructField, StructType

from .common import materialize

MAX_ROWS = 20_000
BINS = 48
PAIR_BINS = 12
ROUNDS = 120
PAIR_ROUNDS = 40
PAIRS = 6
RATE = 0.15
FEATURES = ("log_bytes", "log_words", "word_bytes", "word_bytes_sd", "log_longest", "short_words", "capital_letters",
            "symbols", "digits", "non_ascii", "symbol_words", "bar_words", "stops", "distinct_words", "top_word",
            "adjacent_repeats", "repeated_grams", "log_line_bytes", "repeated_lines", "lower_starts")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1, F.lit(False))


def _classes() -> dict[str, np.ndarray]:
    code = np.arange(256)
    upper, lower = (code >= 65) & (code <= 90), (code >= 97) & (code <= 122)
    digit, blank = (code >= 48) & (code <= 57), np.isin(code, [9, 10, 11, 12, 13, 32])
    plain = np.isin(code, [ord(c) for c in ".,;:'\"-()?"])
    symbol = (code > 32) & (code < 127) & ~upper & ~lower & ~digit & ~plain
    return {"upper": upper, "lower": lower, "digit": digit, "blank": blank, "symbol": symbol, "high": code >= 128}


CLASS = _classes()


def describe(column) -> np.ndarray:
    """Feature rows of an Arrow string column."""
    import pyarrow as pa
    from . import grams
    out = np.zeros((len(column), len(FEATURES)))
    for i, text in enumerate(column.cast(pa.large_binary()).to_pylist()):
        if text:
            out[i] = _describe(np.frombuffer(text, np.uint8), *grams.words(pa.array([text], pa.large_binary())))
    return out


def _describe(data: np.ndarray, h: np.ndarray, first: np.ndarray) -> list[float]:
    from . import grams
    n, words = len(data), max(1, len(h))
    count = {k: int(c[data].sum()) for k, c in CLASS.items()}
    inside = ~CLASS["blank"][data]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    begin, end = edge[::2], edge[1::2]
    size = end - begin if len(begin) else np.zeros(1, np.int64)
    marks = np.concatenate([[0], np.cumsum(CLASS["symbol"][data])])
    with_symbol = (marks[end] - marks[begin] > 0).sum() if len(begin) else 0
    bars = ((size == 1) & (data[begin] == 124)).sum() if len(begin) else 0
    stops = np.isin(data[end - 1], [44, 46]).sum() if len(begin) else 0
    small = CLASS["lower"][data[begin]].sum() if len(begin) else 0
    kinds, times = np.unique(h, return_counts=True) if len(h) else (h, np.ones(1))
    four = grams.grams(h, 4)
    breaks = np.flatnonzero(data == 10)
    lines = np.split(data, breaks + 1) if len(breaks) < 5000 else [data[a:b] for a, b in zip(np.append(0, breaks + 1), np.append(breaks, n))]
    texts = [x.tobytes().strip() for x in lines]
    texts = [x for x in texts if x]
    letters = max(1, count["upper"] + count["lower"])
    return [np.log1p(n), np.log1p(len(h)), size.mean(), size.std(), np.log1p(size.max()), (size <= 3).sum() / words,
            count["upper"] / letters, count["symbol"] / n, count["digit"] / n, count["high"] / n, with_symbol / words,
            bars / words, stops / words, len(kinds) / words, times.max() / words,
            (h[1:] == h[:-1]).sum() / words if len(h) > 1 else 0.0,
            1 - len(np.unique(four)) / len(four) if len(four) else 0.0,
            np.log1p(n / max(1, len(texts))), 1 - len(set(texts)) / len(texts) if texts else 0.0, small / words]


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, x): the feature vector of every row."""
    import pyarrow as pa
    schema = f"doc_id {docs.schema[id_col].dataType.simpleString()}, x array<double>"

    def compute(batches):
        for batch in batches:
            x = describe(batch.column(1))
            at = pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(at, pa.array(x.ravel()))],
                                             names=["doc_id", "x"])

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(compute, schema)


def sample(described: DataFrame, labels: DataFrame, label_col: str = "quality", max_rows: int = MAX_ROWS):
    """Labelled feature rows for training, at most ``max_rows``: (X, y)."""
    lab = labels.select(F.col("doc_id").alias("_label_id"), F.col(label_col).cast("int").alias("y")).filter("y is not null")
    rows = described.filter(~held_out(F.col("doc_id"))).join(lab, F.col("doc_id") == F.col("_label_id")).select("doc_id", "x", "y")
    # a share of the id hashes that holds a few rows more than wanted, so that the driver gets no more
    cells = 1 << 30
    share = min(1.0, 1.1 * max_rows / max(1, rows.count()) + 1e-6)
    few = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(cells)) < int(share * cells))
    rows = few.orderBy(F.pmod(F.xxhash64("doc_id"), F.lit(cells)), "doc_id", "y", "x").limit(max_rows).collect()
    return np.array([r["x"] for r in rows]).reshape(-1, len(FEATURES)), np.array([r["y"] for r in rows], float)


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    cuts = np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))
    return cuts[cuts < x.max()] if len(x) else cuts


def _gain(g, h):
    return g * g / (h + 1.0)


def _tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Leaf values per bin of a greedy tree of that depth on one binned feature."""
    out = np.full(len(g), -g.sum() / (h.sum() + 1.0))
    if depth == 0 or len(g) < 2:
        return out
    cg, ch = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gain = _gain(cg, ch) + _gain(g.sum() - cg, h.sum() - ch)
    ok = (ch >= 1.0) & (h.sum() - ch >= 1.0)
    if not ok.any():
        return out
    cut = int(np.argmax(np.where(ok, gain, -1))) + 1
    return np.concatenate([_tree(g[:cut], h[:cut], depth - 1), _tree(g[cut:], h[cut:], depth - 1)])


def _quadrants(g: np.ndarray, h: np.ndarray):
    """(gain, table) of the best cut of both axes of a 2-D histogram."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    if g.shape[0] < 2 or g.shape[1] < 2:
        return 0.0, np.zeros_like(g)

    def corners(c):
        a = c[:-1, :-1]
        return a, c[:-1, -1:] - a, c[-1:, :-1] - a, c[-1, -1] - c[:-1, -1:] - c[-1:, :-1] + a

    parts = list(zip(corners(cg), corners(ch)))
    gain = sum(_gain(a, b) for a, b in parts)
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    table = np.zeros_like(g)
    values = [-a[i, j] / (b[i, j] + 1.0) for a, b in parts]
    table[:i + 1, :j + 1], table[:i + 1, j + 1:], table[i + 1:, :j + 1], table[i + 1:, j + 1:] = values
    return float(gain[i, j]), table


def fit(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, pair_rounds: int = PAIR_ROUNDS, pairs: int = PAIRS) -> dict:
    """The model: intercept, and per table its features, bin edges and values."""
    share = (y.sum() + 1) / (len(y) + 2)
    model = {"intercept": float(np.log(share / (1 - share))), "single": [], "pair": []}
    if not len(y) or y.min() == y.max():
        return model
    score = np.full(len(y), model["intercept"])

    def slope():
        p = 1 / (1 + np.exp(-score))
        return p - y, p * (1 - p)

    edges = [_edges(x[:, k], BINS) for k in range(x.shape[1])]
    bins = [np.searchsorted(e, x[:, k], side="left") for k, e in enumerate(edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    for _ in range(rounds):
        for k, b in enumerate(bins):
            g, h = slope()
            step = RATE * _tree(np.bincount(b, g, len(tables[k])), np.bincount(b, h, len(tables[k])))
            tables[k] += step
            score += step[b]
    coarse = [_edges(x[:, k], PAIR_BINS) for k in range(x.shape[1])]
    cbins = [np.searchsorted(e, x[:, k], side="left") for k, e in enumerate(coarse)]

    def histogram(i, j):
        g, h = slope()
        shape = (len(coarse[i]) + 1, len(coarse[j]) + 1)
        at = cbins[i] * shape[1] + cbins[j]
        return (np.bincount(at, g, shape[0] * shape[1]).reshape(shape), np.bincount(at, h, shape[0] * shape[1]).reshape(shape))

    ranked = sorted(((-_quadrants(*histogram(i, j))[0], i, j) for i in range(x.shape[1]) for j in range(i)))
    chosen = [(i, j) for _, i, j in ranked[:pairs]]
    doubles = {c: np.zeros((len(coarse[c[0]]) + 1, len(coarse[c[1]]) + 1)) for c in chosen}
    for _ in range(pair_rounds):
        for i, j in chosen:
            step = RATE * _quadrants(*histogram(i, j))[1]
            doubles[i, j] += step
            score += step[cbins[i], cbins[j]]
    model["single"] = [(k, edges[k], tables[k]) for k in range(x.shape[1])]
    model["pair"] = [(i, j, coarse[i], coarse[j], doubles[i, j]) for i, j in chosen]
    return model


def score_rows(model: dict, x: np.ndarray) -> np.ndarray:
    total = np.full(len(x), model["intercept"])
    for k, edges, values in model["single"]:
        total += values[np.searchsorted(edges, x[:, k], side="left")]
    for i, j, ei, ej, values in model["pair"]:
        total += values[np.searchsorted(ei, x[:, i], side="left"), np.searchsorted(ej, x[:, j], side="left")]
    return 1 / (1 + np.exp(-np.clip(total, -35, 35)))


def trained(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            label_col: str = "quality", max_rows: int = MAX_ROWS) -> dict:
    """Model from the labelled rows of ``docs`` that are not held out."""
    wanted = labels.filter(F.col(label_col).isNotNull()).select(F.col("doc_id").alias("_id")).distinct()
    described = materialize(features(docs, id_col, text_col), "quality-features")
    return fit(*sample(described.join(wanted, F.col("doc_id") == F.col("_id"), "left_semi"), labels, label_col, max_rows))


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "quality", max_rows: int = MAX_ROWS) -> DataFrame:
    """One row per document: id, ``held_out``, ``score`` (higher: label 1 likelier), ``predicted``."""
    import pyarrow as pa
    described = materialize(features(docs, id_col, text_col), "quality-features")
    model = fit(*sample(described, labels, label_col, max_rows))
    schema = StructType([StructField("doc_id", docs.schema[id_col].dataType), StructField("held_out", BooleanType()),
                         StructField("score", DoubleType()), StructField("predicted", IntegerType())])

    def score(batches):
        for batch in batches:
            x = batch.column(2).flatten().to_numpy().reshape(-1, len(FEATURES))
            s = score_rows(model, x)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s),
                                              pa.array((s >= 0.5).astype(np.int32))], names=schema.names)

    return described.select("doc_id", held_out(F.col("doc_id")), "x").mapInArrow(score, schema)


def accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality", max_rows: int = MAX_ROWS) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with all their columns (no shuffle)."""
    import pyarrow as pa
    model = trained(docs, labels, id_col, text_col, label_col, max_rows)
    at = docs.columns.index(text_col)

    def keep(batches):
        for batch in batches:
            yield batch.filter(pa.array(score_rows(model, describe(batch.column(at))) >= 0.5))

    return docs.mapInArrow(keep, docs.schema)
