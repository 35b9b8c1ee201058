import random

import numpy as np
import pytest

from lumenpath.llm import hamming as h


def brute(vectors, queries, k, bits):
    code = lambda v: tuple(1 if x is not None and x > 0 else 0 for x in v)
    keep = lambda rows: sorted({(i, code(v)) for i, v in rows if i is not None and v is not None and len(v) == bits})
    data, out = keep(vectors), []
    for q, c in keep(queries):
        near = sorted((sum(a != b for a, b in zip(c, d)), i, d) for i, d in data if (i, d) != (q, c))[:k]
        out += [(q, rank, i, apart) for rank, (apart, i, _) in enumerate(near, 1)]
    return sorted(out)


def corpus(n, bits, seed):
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, 1) for _ in range(bits)] for _ in range(4)]
    data = [(i, [x + rnd.gauss(0, 0.7) for x in rnd.choice(centres)]) for i in range(n)]
    return data + [(1000 + i, data[3][1]) for i in range(30)] + [data[5], data[5], (7, data[8][1]), (None, data[1][1]), (2000, None), (2001, [1.0]), (2002, [float("nan")] * bits), (2003, [None] * bits), (2003, [])]


@pytest.mark.parametrize("bits,block,query_block", [(64, 1 << 16, 1 << 10), (64, 40, 7), (40, 64, 16), (128, 50, 50)])
def test_nearest_equal_brute_force(rows, bits, block, query_block):
    data = corpus(150, bits, 2)
    frame = rows([(i, v, "x", b"") for i, v in data], "id bigint, vector array<double>, distance string, code binary")
    asked = [(i, v) for i, v in data if i is not None and i % 10 == 0]
    found = h.nearest(frame.repartition(3), frame.where("id % 10 = 0"), 10, bits, block, query_block)
    assert found.columns == ["query_id", "rank", "neighbor_id", "distance"]
    assert sorted(tuple(r) for r in found.collect()) == brute(data, asked, 10, bits)


def test_fewer_vectors_than_asked_for_and_none(rows):
    ddl = "id bigint, vector array<float>"
    few = rows([(0, [1.0] * 64), (1, [-1.0] * 64)], ddl)
    assert sorted(tuple(r) for r in h.nearest(few, few, 5).collect()) == [(0, 1, 1, 64), (1, 1, 0, 64)]
    assert h.nearest(few.where("false"), few, 5).collect() == [] and h.nearest(few, few.where("false"), 5).collect() == []


def test_radii_grow_until_the_kth_distance_is_covered():
    rnd = np.random.default_rng(1)
    packed = rnd.integers(0, 256, (3000, 8), dtype=np.uint8)
    index = h.SegmentIndex(packed)
    for query in packed[:20] ^ rnd.integers(0, 4, (20, 8), dtype=np.uint8):
        distances = np.unpackbits(packed ^ query, axis=1).sum(axis=1)
        kth = np.sort(distances)[9]
        entries, found = index.nearest(query, 10)
        assert sorted(entries.tolist()) == np.flatnonzero(distances <= kth).tolist() and (distances[entries] == found).all()
