import math
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from lumenpath.llm import lexical as x

LOWER = {k: k + 32 for k in range(65, 91)}
DDL = "doc_id bigint, text string, score string, rank int"


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items, k):
    held = [(own, Counter(terms(text))) for own, text in docs if terms(text)]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item_id, text in {(i, t) for i, t in items if t is not None}:
        scores = []
        for own, counts in held:
            m = 25 + 75 * sum(counts.values()) * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * counts[t] // (1000 * counts[t] + 8 * m)) for t in terms(text) if t in counts)
            if score > 0:
                scores.append((-score, own is None, own or 0))
        out += [(str(item_id), rank, None if unnamed else own, -score) for rank, (score, unnamed, own) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def corpus(n, seed):
    rnd = random.Random(seed)
    words = [f"w{k}" for k in range(60)] + ["the", "The", "é", "ÉÀ", "x1", "1"]
    weights = [1 / (k + 1) for k in range(len(words))]
    draw = lambda size: ", ".join(rnd.choices(words, weights, k=size))
    docs = [(k, draw(rnd.choice([1, 3, 10, 40, 200]))) for k in range(n)]
    docs += [(1000 + k, docs[4][1]) for k in range(30)] + [docs[7], docs[7], (9, "w3 w3 w4"), (None, docs[8][1]), (None, "w50 w51")]
    docs += [(2000, None), (2001, ""), (2002, " .,\n"), (2003, "w1 " * 30000), (2004, " ".join(f"z{k}" for k in range(5000)) + " w40")]
    items = [(str(k), draw(rnd.choice([1, 4, 12]))) for k in range(25)] + [("3", "w2 again"), ("3", "w2 again"), (None, "w5 W5 w59"), ("90", None), ("91", ""), ("92", "nowhere"), ("93", "the")]
    return docs, items


@pytest.mark.parametrize("k,block_terms,shard", [(10, 1 << 14, 256), (3, 40, 8)])
def test_rank_equals_brute_force(rows, monkeypatch, k, block_terms, shard):
    monkeypatch.setattr(x, "SHARD", shard)
    docs, items = corpus(200, 1)
    frame = rows([(*d, "x", 1) for d in docs], DDL).repartition(3)
    asked = rows([(*i, 1.5) for i in items], "item_id string, text string, doc_id double")
    found = x.rank(frame, asked, k, block_terms)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(((str(r.item_id), r.rank, r.doc_id, r.score) for r in found.collect()), key=str) == brute(docs, items, k)


def test_no_documents_and_no_items(rows):
    docs, items = rows([(1, "a b", "", 0)], DDL), rows([("1", "a")], "item_id string, text string")
    assert [tuple(r) for r in x.rank(docs, items).collect()] == [("1", 1, 1, math.floor(1000 * math.log(4 / 3)) * (1_000_000_000 // 1800))]
    for few, asked in ((docs.where("false"), items), (docs, items.where("false")), (rows([(1, " ", "", 0), (2, None, "", 0)], DDL), items)):
        assert x.rank(few, asked).collect() == []


def test_bounds_hold_and_leave_out_documents():
    rnd = np.random.default_rng(5)
    vocabulary = np.unique(rnd.integers(0, 1 << 63, 400).astype(np.uint64))
    docs = []
    for k in range(256):
        some = np.sort(rnd.choice(vocabulary, rnd.integers(30, 60), replace=False))
        counts = rnd.geometric(0.4, len(some))
        docs.append((k, int(counts.sum()), some, counts))
    row = dict(zip(x.INDEX_NAMES, x._shard(docs)))
    total = sum(d[1] for d in docs)
    weights = rnd.integers(1, 9000, len(vocabulary))
    asked = [(k, np.sort(rnd.choice(len(vocabulary), 12, replace=False)), np.ones(12, np.int64)) for k in range(20)]
    block = x.Items(vocabulary, weights, asked, 256, total, 10)
    bound = block.bounds(row, np.array(row["lengths"]))
    whole = x.Items(vocabulary, weights, asked, 256, total, 256)
    whole.score(row, np.array(row["lengths"]), np.ones((20, 256), bool))
    scores = np.zeros((20, 256))
    for item, heap in enumerate(whole.heaps):
        for score, _, own in heap:
            scores[item, -own] = score
    assert (bound >= scores).all() and (scores > 0).any()
    block.visit(row)
    assert [sorted(h, reverse=True) for h in block.heaps] == [sorted(h, reverse=True)[:10] for h in whole.heaps]
    assert block.exact < 20 * 256 * 0.6


def test_every_entry_of_a_document_is_found():
    docs = [(1, 9, np.array([3, 5], np.uint64), np.array([8, 1])), (2, 1, np.array([7], np.uint64), np.array([1]))]
    row = dict(zip(x.INDEX_NAMES, x._shard(docs)))
    table = np.frombuffer(pa.decompress(row["slices"], row["bits"], codec="zstd", asbytes=True), np.uint8).reshape(row["bits"], 1)
    assert row["levels"] == 4
    for level in range(4):
        assert (table[x.places(x.entries(np.array([3], np.uint64), level), row["bits"])] & 128).all()


def _most_bytes(run):
    tracemalloc.start()
    try:
        result = run()
        return result, tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_large_shards_take_little_room():
    rnd = np.random.default_rng(3)
    docs = [(k, 20_000, np.sort(rnd.integers(0, 1 << 63, 20_000).astype(np.uint64)), np.ones(20_000, np.int64)) for k in range(40)]
    row, most = _most_bytes(lambda: x._shard(docs))
    assert most < 80_000_000  # the places of all entries at once took more
    row = dict(zip(x.INDEX_NAMES, row))
    vocabulary = np.unique(np.concatenate([d[2][:400] for d in docs]))
    asked = [(0, np.arange(len(vocabulary)), np.ones(len(vocabulary), np.int64))]
    items = x.Items(vocabulary, np.ones(len(vocabulary), np.int64), asked, 40, 800_000, 50)
    _, most = _most_bytes(lambda: items.visit({**row, "n_docs": 40}))
    assert sorted(-own for _, _, own in items.heaps[0]) == list(range(40)) and len({score for score, _, _ in items.heaps[0]}) == 1
    assert most < 100_000_000
