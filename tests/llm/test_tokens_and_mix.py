"""Operators 2, 6 and 9: tokens against the library, files round trip, packing and mix rules."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from dispatchkit.llm import ans, mixing, packing, tokens

ODD = ["", None, "  lead", "trail  ", "a  b", "tab\tx y", "nl\n\nz", "x\x1cy z", "日本語 テキスト", "it's don't I'LL 'S '", "été",
       "a b c", "1234 5,6", "<|endoftext|> hi a<|endoftext|>b", "İstanbul ΣΑΣ Σ.", " ", "\n", "a \nb", "ª º µ ² ¼", "emoji 😀👍🏽 x",
       "!!'s 's", "﻿x", "x\u0085y", "a\r\nb c", "line one\nline two", "x" * 3000]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_equals_the_library(name, rows):
    path = public_tokenizers.path(name)
    texts = ODD + [r[1] for r in rows]
    want = Tokenizer.from_file(path).encode_batch([t or "" for t in texts], add_special_tokens=False)
    for got in (tokens.Encoder(path).encode(texts, 1), [tokens.Encoder(path).encode([t], 1)[0] for t in texts[:30]]):
        assert [x.tolist() for x in got] == [w.ids + [1] for w in want[:len(got)]]


def test_encoder_cache_may_be_dropped_at_any_time(monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.json")
    e = tokens.Encoder(path)
    want = [x.tolist() for x in e.encode(ODD)]
    monkeypatch.setattr(tokens, "MAX_PARTS", 3)
    assert [x.tolist() for x in e.encode(ODD)] == want


@pytest.mark.parametrize("n,lanes", [(1, 1), (5, 1), (1000, 7), (70_000, 64)])
def test_ans_round_trip_from_every_checkpoint(n, lanes):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.3, n), 999).astype(np.uint32)
    freq = ans.scaled(np.bincount(ids, minlength=1000))
    assert freq.min() >= 1 and freq.sum() == 1 << ans.SCALE_BITS
    words, marks = ans.encode(ids, freq, lanes, every=16)
    for step, word, state in marks:
        steps = -(-n // lanes)
        got = ans.decode(words.astype(np.uint64), state, word, step, steps, n, lanes, freq, ans.lookup(freq))
        assert (got == ids[step * lanes:]).all()


def test_token_files_round_trip(docs, rows, no_docs):
    path = public_tokenizers.path("word_bpe_49k.json")
    blocks, shared = ans.write_token_files(docs, path, end_id=1, block_tokens=500, every=4)
    assert blocks.count() > 3
    k = Tokenizer.from_file(path)
    got = ans.documents_of(blocks, shared).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted(r[0] for r in rows)
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    want = Counter((i, tuple(k.encode(t or "", add_special_tokens=False).ids + [1])) for i, t, *_ in rows)
    assert Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in got) == want
    empty = ans.write_token_files(no_docs, path, end_id=1)
    assert ans.documents_of(*empty).count() == 0


def test_damaged_block_is_refused(docs):
    from pyspark.sql import functions as F
    blocks, shared = ans.write_token_files(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    with pytest.raises(Exception, match="damaged"):
        ans.read_token_files(blocks.withColumn("ids_crc32", F.col("ids_crc32") + 1), shared).collect()


@pytest.mark.parametrize("length", [1024, 16])
def test_packing_covers_every_id_once(docs, rows, length):
    path = public_tokenizers.path("byte_bpe_50k.json")
    k = Tokenizer.from_file(path)
    got = packing.pack(docs, path, 0, length).collect()
    want = Counter((i, tuple(k.encode(t or "", add_special_tokens=False).ids + [0])) for i, t, *_ in rows)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length > 0
        pieces[r.doc_id, r.doc_tokens].append((r.start, r.sequence_id, ids))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert Counter(r.doc_tokens for r in got if r.start == 0) == Counter(len(x[1]) for x in want.elements())
    for (i, t), n in want.items():
        if n == 1 and sum(x[0] == i for x in want) == 1:
            assert [x for _, _, p in sorted(pieces[i, len(t)]) for x in p] == list(t)
    sizes = {}
    for s, parts in sequences.items():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        sizes[s] = at
    assert sorted(sizes) == list(range(len(sizes)))
    assert all(n == length or n & (n - 1) == 0 for n in sizes.values())
    assert sum(sizes.values()) == sum(len(x[1]) for x in want.elements())


def test_packing_null_ids_and_empty_table(null_ids, no_docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert sum(r.length for r in packing.pack(null_ids, path).collect() if r.doc_id is None and r.doc_tokens == 1) == 1
    assert packing.pack(no_docs, path).count() == 0


def brute_targets(sizes, weights=(5, 2, 1)):
    """Share, stop at twice the size, share the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    left, open_, target = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > 2 * sizes[s]}
        if not over:
            target |= {s: left * weight[s] / total for s in open_}
            break
        target |= {s: 2.0 * sizes[s] for s in over}
        left -= sum(2 * sizes[s] for s in over)
        open_ -= over
    return target


def test_mix_meets_targets_and_reruns_agree(docs, rows):
    sizes = defaultdict(int)
    for _, t, _, s in rows:
        sizes[s] += len((t or "").encode().split())
    target = brute_targets(sizes)
    where, mix = mixing.mix_sources(docs, block_words=64)
    by_source = {r.source: r.target for r in where.select("source", "target").distinct().collect()}
    assert by_source.keys() == target.keys()
    assert all(abs(by_source[s] - target[s]) < 1e-6 for s in target)
    pieces = mix.collect()
    taken = defaultdict(int)
    for p in pieces:
        taken[p.source] += p.n_words
    assert all(taken[s] == int(target[s] + 1e-9) for s in target)
    # slots are evenly spread: every source's share holds in the first half of the mix as well
    slots = sorted({(p.slot, p.source) for p in pieces}, key=lambda x: x[0])
    assert len({s for s, _ in slots}) == len(slots)
    half, whole = Counter(s for _, s in slots[:len(slots) // 2]), Counter(s for _, s in slots)
    assert all(abs(half[s] - whole[s] / 2) <= 6 for s in whole)
    # epochs and blocks follow the slots in rank order
    ranks = defaultdict(list)
    for slot, source, epoch, block in sorted({(p.slot, p.source, p.epoch, p.block) for p in pieces}, key=lambda x: x[0]):
        ranks[source].append((epoch, block))
    assert all(r == sorted(r) for r in ranks.values())
    one, two = (sorted(map(str, mixing.taken_words(docs, block_words=64).collect())) for _ in range(2))
    assert one == two
    for r in mixing.taken_words(docs, block_words=64).collect():
        assert 0 <= r.taken <= 2 * r.size


def test_mix_edge_cases(no_docs, null_ids, unique_docs):
    assert mixing.taken_words(no_docs).count() == 0
    assert mixing.mixed_documents(no_docs).count() == 0
    assert mixing.taken_words(null_ids).count() == 5
    mixed = mixing.mixed_documents(unique_docs)
    assert mixed.columns == unique_docs.columns
    assert max(r["count"] for r in mixed.groupBy("doc_id").count().collect()) <= 2


def test_crc_of_ids_is_the_little_endian_one(spark):
    from pyspark.sql import functions as F
    raw = np.array([1, 70000], "<u4").tobytes()
    assert spark.createDataFrame([(bytearray(raw),)], "b binary").select(F.crc32("b")).first()[0] == zlib.crc32(raw)
