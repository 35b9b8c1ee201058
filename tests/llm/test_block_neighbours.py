import math
import random

import numpy as np
import pytest

from lumenpath.llm import block_neighbours as b


def taking_part(rows):
    fits = lambda v: v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    return sorted({(i, tuple(x + 0.0 for x in v)) for i, v in rows if i is not None and fits(v)})


def brute(vectors, queries, k):
    data, out = taking_part(vectors), []
    for q, v in taking_part(queries):
        near = []
        for i, w in data:
            if len(w) == len(v) and (i, w) != (q, v):
                total = 0.0
                for x, y in zip(v, w):
                    total += (x - y) * (x - y)
                near.append((math.sqrt(total), i))
        out += [(q, rank, i, apart) for rank, (apart, i) in enumerate(sorted(near)[:k], 1)]
    return sorted(out)


def corpus(n, width, seed):
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, 1) for _ in range(width)] for _ in range(5)]
    data = [(i, [float(np.float32(x + rnd.gauss(0, 0.3))) for x in rnd.choice(centres)]) for i in range(n)]
    data += [(1000 + i, data[3][1]) for i in range(40)] + [data[5], data[5], (7, data[8][1]), (20, [-x for x in data[20][1]])]
    odd = [(None, data[1][1]), (2000, None), (2010, []), (2020, [0.0] * width), (2030, [float("nan")] * width), (2040, [None] * width), (2050, [float("inf")] + [1.0] * (width - 1))]
    scales = [(2100 + i, [x * 10.0**e for x in data[0][1]]) for i, e in enumerate((-300, -160, -30, 30, 160, 300))]
    return data + odd + scales + [(2200, [1.0, 2.0]), (2210, [2.0, 1.0]), (2211, [0.0, -0.0, 1.0]), (2220, [0.0, 0.0, 1.0])]


@pytest.mark.parametrize("block,query_block,group_bytes", [(2048, 512, 64 << 20), (16, 5, 1000)])
def test_nearest_equal_brute_force(rows, monkeypatch, block, query_block, group_bytes):
    data = corpus(150, 24, 2)
    frame = rows([(i, v, "x", b"", 0) for i, v in data], "id bigint, vector array<double>, rank string, cell binary, part int")
    asked = [(i, v) for i, v in data if i is not None and i % 10 == 0]
    found = b.nearest(frame.repartition(3), frame.where("id % 10 = 0"), 10, block, query_block, group_bytes)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(tuple(r) for r in found.collect()) == brute(data, asked, 10)


def test_fewer_vectors_than_asked_for_and_none(rows):
    ddl = "id bigint, vector array<float>"
    few = rows([(0, [1.0, 0.0]), (1, [0.0, 1.0])], ddl)
    assert sorted(tuple(r) for r in b.nearest(few, few, 5).collect()) == [(0, 1, 1, math.sqrt(2)), (1, 1, 0, math.sqrt(2))]
    assert b.nearest(few.where("false"), few, 5).collect() == [] and b.nearest(few, few.where("false"), 5).collect() == []


@pytest.mark.parametrize("width", [3, 64, 2500])
def test_bounds_hold_and_leave_out_most_pairs(width):
    rnd = np.random.default_rng(width)
    data = rnd.normal(size=(400, width)) * 10.0 ** rnd.integers(-3, 3, (400, 1))
    data[7], data[8] = data[6], -data[6]
    queries = b.Rounded(data[:20])
    low, high = queries.bounds(b.Rounded(data))
    exact = np.sqrt(((data[:20, None] - data[None]) ** 2).sum(axis=2))
    assert (low <= exact * (1 + 1e-12)).all() and (exact <= high * (1 + 1e-12)).all()
    assert (queries.products(b.Rounded(data)) == queries.codes.astype(int) @ b.Rounded(data).codes.astype(int).T).all()
    best = [b.Nearest(10) for _ in range(20)]
    near = rnd.normal(size=(2000, width))
    computed = b.search_tile(b.Rounded(near[:20]), np.arange(20), b.Rounded(near), np.arange(2000), best)
    assert 200 <= computed < 20 * 800
