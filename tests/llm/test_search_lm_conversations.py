"""Operators 11, 12 and 13 against brute force, odd rows included."""

import hashlib
import math
import random
import re
import sys
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dispatchkit.llm import brown_lm, conversation_repair as cr, grams, lexical_search

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ---- operator 11

def ranking(docs, items, k):
    counts = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    n_docs, n_terms = sum(1 for _, c in counts if c), sum(sum(c.values()) for _, c in counts)
    df = Counter(w for _, c in counts for w in c)
    terms = defaultdict(set)
    for item, text in items:
        terms[item] |= set(TERM.findall((text or "").translate(LOWER)))
    out = []
    for item, query in terms.items():
        scored = []
        for i, c in counts:
            n = sum(c.values())
            m = 50 + (50 * n * n_docs) // n_terms if n_terms else 0
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10 ** 9 * c[w]) // (1000 * c[w] + 20 * m))
                    for w in query if c[w])
            if s > 0:
                scored.append((-s, i is not None, i or 0, i))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return out


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string").withColumn("term", F.lit(1)).withColumn("bundle", F.lit("x"))


ITEMS = [(1, "a b c changed copy of"), (2, None), (3, "é 日本語, one! ONE"), (4, ""), (None, "two three"), (1, "v1 v2 v3 x-y"), (5, "-- ??")]


@pytest.mark.parametrize("k, owners", [(50, 4), (3, 1), (7, 3)])
def test_search_matches_brute_force(spark, docs, rows, k, owners):
    words = [(6, rows[4][1]), (7, " ".join(r[1][:40] for r in rows if r[1])[:3000])]
    got = [tuple(r) for r in lexical_search.search(docs, items_of(spark, ITEMS + words), k, owners).collect()]
    want = ranking([(r[0], r[1]) for r in rows], ITEMS + words, k)
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_search_in_small_blocks_and_bundles(spark, docs, rows, monkeypatch):
    monkeypatch.setattr(lexical_search, "BLOCK_DOCS", 5)
    items = [(i, " ".join(rows[i % 25][1].split()[:6])) for i in range(40)]
    monkeypatch.setattr(lexical_search.item_bundles, "__defaults__", (7,))
    got = [tuple(r) for r in lexical_search.search(docs, items_of(spark, items), 10).collect()]
    assert sorted(got) == sorted(ranking([(r[0], r[1]) for r in rows], items, 10))


def test_search_ties_null_ids_text_ids_and_empty_tables(spark, null_ids, docs, no_docs):
    items = items_of(spark, [(1, "alpha"), (2, "words")])
    got = [tuple(r) for r in lexical_search.search(null_ids, items, 2).collect()]
    assert sorted((i, r, -1 if d is None else d) for i, r, d, _ in got) == [(1, 1, -1), (1, 2, -1), (2, 1, 6)]
    named = spark.createDataFrame([("b", "alpha"), ("a", "alpha"), ("c", "beta")], "doc_id string, text string")
    assert [(r["rank"], r.doc_id) for r in lexical_search.search(named, items, 5).orderBy("rank").collect()] == [(1, "a"), (2, "b")]
    assert lexical_search.search(no_docs, items).count() == 0
    assert lexical_search.search(docs, items.limit(0)).count() == 0


# ---- operator 12

def lm_by_hand(rows, held):
    """Scores with classes that are hash % CLASSES (no exchange round)."""
    texts = [WORD.findall((t or "").translate(LOWER)) for _, t in rows]
    train = [x for (i, _), x in zip(rows, texts) if not held(i)]
    c = Counter(w for x in train for w in [*x, None])
    n, v = sum(c.values()), len(c)

    def cls(w):
        if w is None:
            return "end" if c[None] else "unknown"
        if c[w] < 2:
            return "once" if c[w] else "unknown"
        return int(grams.words(pa.array([w]))[0][0] % np.uint64(brown_lm.CLASSES))

    pairs, size = Counter(), Counter()
    for x in train:
        chain = ["start", *map(cls, x), cls(None)]
        pairs.update(zip(chain, chain[1:]))
        size.update(chain[1:])
    for a in {a for a, _ in pairs}:
        if pairs[a, "once"]:
            pairs[a, "unknown"] = pairs[a, "once"]
    prior = {**size, "unknown": size["once"] + 1}
    whole, history = sum(prior.values()), Counter()
    for (a, _), k in pairs.items():
        history[a] += k
    out = []
    for (i, _), x in zip(rows, texts):
        chain, score = [None, *x, None], 0.0
        kinds = ["start", *map(cls, x), cls(None)]
        for a, b, w in zip(kinds, kinds[1:], chain[1:]):
            a = "once" if a == "unknown" else a
            p = (pairs[a, b] + brown_lm.SMOOTH * prior[b] / whole) / (history[a] + brown_lm.SMOOTH)
            score += math.log10(p * (1 if b in ("unknown", "end") else c[w] / size[b]))
        tokens = [*x, None]
        out.append((i, held(i), len(tokens), sum(c[w] > 0 for w in tokens), n,
                    round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens), 6), round(score, 6)))
    return out


def fields(r):
    return (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6) + 0.0, round(r.score, 6) + 0.0)


def out_of_training(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def test_scores_without_exchange_match_brute_force(docs, rows):
    got = [fields(r) for r in brown_lm.lm_scores(docs, rounds=0).collect()]
    assert sorted(map(str, got)) == sorted(map(str, lm_by_hand([(r[0], r[1]) for r in rows], out_of_training)))


def test_blocks_do_not_change_scores(docs, rows, monkeypatch):
    one = {str(fields(r)) for r in brown_lm.lm_scores(docs.coalesce(1), rounds=2).collect()}
    monkeypatch.setattr(brown_lm, "BLOCK_DOCS", 3)
    assert {str(fields(r)) for r in brown_lm.lm_scores(docs, rounds=2).collect()} == one


def test_lm_odd_tables(spark, null_ids, no_docs):
    got = [fields(r) for r in brown_lm.lm_scores(null_ids, rounds=1).collect()]
    assert len(got) == 5 and sorted(g[2] for g in got) == [1, 3, 7, 7, 7]
    assert brown_lm.lm_scores(no_docs).count() == 0
    alone = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    for r in brown_lm.lm_scores(alone, held=F.lit(True)).collect():
        assert (r.held_out, r.n_known, r.train_tokens, r.base_score, r.score) == (True, 0, 0, 0.0, 0.0)


def test_exchange_raises_the_information_of_class_pairs(spark, monkeypatch):
    rng = random.Random(1)
    kinds = [[f"{k}{i}" for i in range(30)] for k in "abcd"]
    texts = [(i, " ".join(rng.choice(kinds[(i + j) % 4]) for j in range(60))) for i in range(200)]
    seen, plain = [], brown_lm.class_bigrams

    def watched(merged):
        p = plain(merged).astype(float)
        seen.append(sum(p[i, j] * math.log(p[i, j] * p.sum() / p[i].sum() / p[:, j].sum()) for i, j in zip(*np.nonzero(p))) / p.sum())
        return plain(merged)

    monkeypatch.setattr(brown_lm, "class_bigrams", watched)
    out = brown_lm.lm_scores(spark.createDataFrame(texts, "doc_id long, text string"), rounds=4).collect()
    assert seen[-1] > seen[0] and seen[-1] > 0.9 * math.log(4)
    held = [r for r in out if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) + 20 * len(held)


def test_transitions_are_a_distribution():
    rng = np.random.default_rng(2)
    pairs = rng.integers(0, 9, (brown_lm.WIDTH, brown_lm.WIDTH))
    pairs[:, brown_lm.START] = 0
    move, _ = brown_lm.log_model(pairs)
    assert np.allclose((10 ** move).sum(axis=1), 1)


# ---- operator 13

def cheapest(rows):
    """(cost, audit, repaired rows) by trying every edit from every row and state."""
    after, full = {"0": "u", "s": "u", "u": "a", "a": "u"}, {"u": "user", "a": "assistant"}

    sys.setrecursionlimit(100_000)

    @lru_cache(None)
    def go(i, q, inserted):
        out = [(0, "", ())] if i == len(rows) and q in "0a" else []
        t = after[q]
        if inserted < 3:
            c, a, r = go(i, t, inserted + 1)
            out.append((c + 3, "I" + a, ((full[t], ""),) + r))
        if i < len(rows):
            role, text, fault = rows[i]
            c, a, r = go(i + 1, q, 0)
            out.append((c + 4, "D" + a, r))
            if fault not in ("blank", "duplicate"):
                more, first = 3 * (fault == "truncated"), role[:1]
                if first and (q, first) in {("0", "s"), ("0", "u"), ("s", "u"), ("a", "u"), ("u", "a")}:
                    c, a, r = go(i + 1, first, 0)
                    out.append((c + more, "K" + a, ((role, text),) + r))
                c, a, r = go(i + 1, t, 0)
                out.append((c + 3 + more, "R" + a, ((full[t], text),) + r))
        return min(out, key=lambda x: x[:2], default=(10 ** 9, "", ()))

    return go(0, "0", 0)


def test_solver_matches_all_edit_sequences():
    rng = random.Random(3)
    for _ in range(1500):
        rows = tuple((rng.choice(["system", "user", "assistant", "user", "assistant", "tool", ""]), str(i),
                      rng.choice([None, None, None, "truncated", "blank", "duplicate"])) for i in range(rng.randint(0, 14)))
        cost, edits = cr.solve(np.array([cr.symbol(r, f) for r, _, f in rows], np.int8))
        written = cr.written(edits, [r[0] for r in rows], [r[1] for r in rows])[0]
        assert (cost, "".join(edits), tuple(written)) == cheapest(rows)


def test_block_lookup_equals_single_steps():
    vectors, _, _, many_next, many_cost = cr.block_tables()
    rng = random.Random(4)
    for _ in range(300):
        at, symbols = rng.randrange(len(vectors)), [rng.randrange(cr.SYMBOLS) for _ in range(cr.BLOCK)]
        v, cost = vectors[at], 0
        for s in symbols:
            v, c = cr.step(v, s)
            cost += c
        code = sum(s * cr.SYMBOLS ** (cr.BLOCK - 1 - i) for i, s in enumerate(symbols))
        assert vectors[many_next[at, code]] == v and many_cost[at, code] == cost


def conversations_by_hand(rows):
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((turn, " " if role is None else role, " " if text is None else text))
    out = []
    for conv, all_rows in groups.items():
        now = []
        for turn, role, text in all_rows:
            kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            now += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
        now.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        faults, seen = [], set()
        for _, role, text in now:
            bare = re.findall(r"[^\x20\x09-\x0D]", text)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None)
            seen.add((role, text))
        turns = [t for t, _, _ in now if t is not None]
        cost, audit, repaired = cheapest(tuple((r, x, f) for (_, r, x), f in zip(now, faults)))
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[faults.count(k) for k in cr.FAULTS],
                    sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(now, now[1:])), cost, audit,
                    hashlib.sha256("\n".join(f"{r}:{x}" for r, x in repaired).encode()).hexdigest()))
    return out


def conversation_rows():
    rng = random.Random(5)
    rows = []
    for c in range(60):
        for t in range(rng.randint(1, 9)):
            rows.append((c, t, rng.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None]),
                         rng.choice(["Yes.", "No!", "so what", "", None, f"é {c} {t}.", "  \t"])))
    rows += [(100, t, ("user", "assistant")[t % 2], f"line {t % 7}" + (".", "")[t % 5 == 0]) for t in range(260)]   # a hot conversation
    rows += [(None, 1, "user", "a."), (None, None, "assistant", "b"), (101, None, None, None), (101, None, "user", "x?")]
    rows += [(102, 0, "user", "same.")] * 30 + [(103, 3, "user", "y" * 50_000 + "."), (103, 9, "assistant", "z")]
    rows += [(i, 0, "user", "x.") for i in range(200, 260)]
    return rows


def repaired(df, partitions=None):
    damaged = cr.damaged(df)
    return [tuple(r) for r in cr.joined(cr.repair(damaged, absent_col="absent", partitions=partitions)).select(
        "conv_id", *cr.JOINED).collect()]


@pytest.mark.parametrize("partitions", [1, 40])
def test_conversations_match_brute_force(spark, partitions):
    rows = conversation_rows()
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").repartition(3)
    df = df.withColumn("part", F.lit("x")).withColumn("kind", F.lit("y")).withColumn("at", F.lit(0))
    assert sorted(map(str, repaired(df, partitions))) == sorted(map(str, conversations_by_hand(rows)))


def test_conversations_with_text_ids_and_an_empty_table(spark):
    rows = [("a", 0, "user", "hi."), ("a", 1, "assistant", "ho."), ("b", 0, "assistant", "ho")]
    df = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string")
    assert sorted(repaired(df)) == sorted(conversations_by_hand(rows))
    assert repaired(df.limit(0)) == []
