"""Operators 4, 7 and 10 against brute force, odd rows included."""

import hashlib
import re

from pyspark.sql import functions as F

from dispatchkit.llm import exact_dedup, jaccard_join, substring_dedup


def normal(t):
    return re.sub(r"[ \t\n\x0b\x0c\r]+", " ", t or "")


def test_exact_dedup_matches_brute_force(docs, rows):
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(normal(t), []).append(i)
    want, seen = [], set()
    for i, t, *_ in rows:
        g = groups[normal(t)]
        first = i == min(g) and (i, normal(t)) not in seen
        seen.add((i, normal(t)))
        want.append((i, min(g), len(g), first, hashlib.sha256(normal(t).encode()).hexdigest()))
    got = [tuple(r) for r in exact_dedup.exact_dedup(docs).collect()]
    assert sorted(got) == sorted(want)


def test_deduplicate_keeps_one_row_per_text_with_all_columns(docs, rows):
    kept = exact_dedup.deduplicate(docs)
    assert kept.columns == docs.columns
    got = kept.select("doc_id", "text").collect()
    assert len(got) == len({normal(r[1]) for r in rows})
    assert {(r.doc_id) for r in got if normal(r.text) == normal(rows[0][1])} == {0}


def test_exact_dedup_null_ids_and_empty_table(null_ids, no_docs):
    got = exact_dedup.exact_dedup(null_ids).collect()
    alpha = [r for r in got if r.group_size == 3]
    assert len(alpha) == 3 and {r.keep_id for r in alpha} == {5} and [r.doc_id for r in alpha if r.kept] == [5]
    assert [(r.keep_id, r.kept) for r in got if r.doc_id is None and r.group_size == 1] == [(None, True)]
    assert exact_dedup.exact_dedup(no_docs).count() == 0
    assert exact_dedup.deduplicate(no_docs).count() == 0
    assert exact_dedup.deduplicate(null_ids).count() == 3


def shingles(t):
    w = (t or "").encode().lower().split()
    if len(w) >= 5:
        return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4))
    return frozenset([tuple(w)]) if w else frozenset()


def brute_components(rows):
    sets = [(i, shingles(t)) for i, t, *_ in rows]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = set()
    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                parent[find(a)] = find(b)
                if x != y:
                    links.add(frozenset([x, y]))
    least = {}
    for k, (i, _) in enumerate(sets):
        least[find(k)] = min(least.get(find(k), i), i)
    return [(i, len(s), least[find(k)]) for k, (i, s) in enumerate(sets)], links


def test_jaccard_components_and_links_match_brute_force(docs, rows):
    want, links = brute_components(rows)
    join = jaccard_join.JaccardJoin(docs)
    assert sorted(tuple(r) for r in join.components().collect()) == sorted(want)
    found = join.links().collect()
    assert len(found) == len(links) and len({frozenset([r.a, r.b]) for r in found}) == len(links)


def test_jaccard_null_ids_empty_table_and_one_per_component(null_ids, no_docs, docs, rows):
    got = sorted(jaccard_join.jaccard_components(null_ids).collect(), key=str)
    assert sorted(r.component_id for r in got if r.n_shingles == 2) == [5, 5, 5]
    assert [(r.doc_id, r.component_id) for r in got if r.n_shingles == 0] == [(None, None)]
    assert jaccard_join.jaccard_components(no_docs).count() == 0
    kept = {r.doc_id for r in jaccard_join.one_per_component(docs).select("doc_id").collect()}
    assert kept == {c for _, _, c in brute_components(rows)[0]}


def test_split_lists_lose_no_link(docs, rows, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SALT_ROWS", 1)
    monkeypatch.setattr(jaccard_join, "MORE_PIVOTS", (None,))
    want, links = brute_components(rows)
    join = jaccard_join.JaccardJoin(docs)
    assert join.links().count() == len(links)
    assert sorted(tuple(r) for r in join.components().collect()) == sorted(want)


def test_parity_bitmaps_never_count_more_than_the_difference():
    import numpy as np
    rng = np.random.default_rng(5)
    for n in (1, 2, 100, 128, 129, 700, 20_000):
        for common in (0, n // 2, n - n // 9, n):
            codes = np.unique(rng.integers(0, 1 << 58, 3 * n, dtype=np.uint64))[:2 * n - common]
            rng.shuffle(codes)
            a, b = codes[:n], codes[len(codes) - n:]
            marks = [jaccard_join.parities(x)[None, :] for x in (a, b)]
            real = len(set(a.tolist()) ^ set(b.tolist()))
            for size in {marks[0].shape[1], 32}:
                x, y = (jaccard_join.folded(m, size) for m in marks)
                assert int(np.bitwise_count(x ^ y).sum()) <= real
            assert marks[0].shape[1] * 8 >= 2 * n
    assert len(jaccard_join.parities(np.zeros(0, np.uint64))) == 32


def test_prefix_size_never_misses():
    for n in range(1, 300):
        for m in range(n, 300):
            need = -(-80 * (n + m) // 180)
            if 100 * n >= 80 * m and need <= n:
                # sets sharing `need` codes meet within both prefixes
                assert need + jaccard_join.prefix_size(n) > n or need > n
                assert need + jaccard_join.prefix_size(m) > m


def brute_repeats(rows, window=13):
    first = {}
    for i, t, *_ in rows:
        w = (t or "").encode().split()
        for k in range(len(w) - window + 1):
            x = tuple(w[k:k + window])
            first[x] = min(first.get(x, i), i)
    out = []
    for i, t, *_ in rows:
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k:k + window])] < i:
                gone[k:k + window] = [True] * window
        out.append((i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return out


def test_substring_dedup_matches_brute_force(docs, rows):
    for slice_bytes in (8_000_000, 3_000):
        cut = substring_dedup.repeats(docs, slice_bytes=slice_bytes)
        removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["to"] - s["from"])
        got = [tuple(r) for r in cut.select("doc_id", "n_words", removed, "kept_text").collect()]
        assert sorted(got) == sorted(brute_repeats(rows))


def test_substring_dedup_null_ids_and_empty_table(spark, no_docs):
    text = " ".join(f"w{i}" for i in range(20))
    df = spark.createDataFrame([(None, text), (3, text), (None, None)], "doc_id long, text string")
    got = {(r.doc_id, r.n_words): len(r.spans) for r in substring_dedup.repeats(df).collect()}
    assert got == {(None, 20): 1, (3, 20): 0, (None, 0): 0}
    assert substring_dedup.repeats(no_docs).count() == 0


def test_packed_integers_round_trip():
    import numpy as np
    a = np.sort(np.random.default_rng(1).integers(0, 2**63, 1000).astype(np.uint64))
    assert (substring_dedup.unpack_sorted(substring_dedup.pack_sorted(a)) == a).all()
    assert len(substring_dedup.unpack(substring_dedup.pack(a[:0]))) == 0
