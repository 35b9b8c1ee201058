import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenpath.llm import prefix_trie as p

DDL = "conv_id bigint, turn bigint, role string, text string, depth string, key int"


def key(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def brute(data):
    turns = defaultdict(list)
    for conv_id, turn, role, text in data:
        if conv_id is not None:
            turns[conv_id].append((turn is not None, turn or 0, key(role or "", text or ""), text or ""))
    turns = {c: [x[2:] for x in sorted(rows)] for c, rows in turns.items()}
    members, ends, words = defaultdict(set), defaultdict(set), {(): 0}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole = turns.get(int(c / 20) * 20, [])[:h] + own[h:]
        for d in range(len(whole) + 1):
            node = tuple(k for k, _ in whole[:d])
            members[node].add(c)
            words[node] = sum(1 for w in whole[d - 1][1].replace("\x0b", " ").split() if w) if d else 0
        ends[tuple(k for k, _ in whole)].add(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, held in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(held) - 1) * words[node]
    return sorted(
        (min(held), len(node), min(members[node[:-1]]) if node else -1, len(held), children[node], leaves[node], saved[node],
         hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest())
        for node, held in members.items()
    )


def trie(frame):
    conv_id = F.col("conv_id")
    turns, conversations = p.borrow_heads(p.number_turns(frame), conv_id - conv_id % 20, F.crc32(conv_id.cast("string")) % 4, most=3)
    return p.prefix_trie(turns, conversations)


def result(frame):
    found = trie(frame)
    assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(-1 if x is None else x for x in row) for row in found.collect())


def corpus(seed, n):
    rnd = random.Random(seed)
    data = []
    for c in range(n):
        for turn in range(rnd.choice([1, 1, 2, 3, 4, 6])):
            data.append((c, turn, rnd.choice(["user", "assistant"]), rnd.choice(["a b c", "b", "a  b\tc d", "", "é\x0b x"])))
    return data


def odd_rows():
    return [
        (40, 0, "user", "first"), (40, 0, "user", "first"), (40, 0, "tool", "tied"), (40, None, None, None), (61, 5, "user", "alone"),
        (None, 1, "user", "nowhere"), (-7, 1, "user", "below"), (-20, 1, "user", "below"), (-20, 2, "user", "below again"), (1003, 1, "user", "x"),
    ]


@pytest.mark.parametrize("block,run,chunk", [(4096, 1 << 16, 1 << 16), (4, 5, 2)])
def test_trie_equals_brute_force(rows, monkeypatch, block, run, chunk):
    monkeypatch.setattr(p, "BLOCK", block)
    monkeypatch.setattr(p, "RUN", run)
    monkeypatch.setattr(p, "CHUNK", chunk)
    data = corpus(1, 90) + odd_rows()
    data += [(c, k, "user", f"same words {k}") for c in range(100, 160) for k in range(5)]  # copies
    data += [(c, k, "user", "hot" if k == 0 else f"{c} {k}") for c in range(160, 180) for k in range(3)]  # one first turn
    data += [(c, k, "user", f"long {min(k, 30 + c % 3)}") for c in range(200, 205) for k in range(40)]  # long ones that part late
    frame = rows([(*row, "x", 1) for row in data], DDL)
    assert result(frame.repartition(3)) == brute(data)


def test_one_conversation_in_many_tasks(rows, spark):
    data = [(5, k // 3, "user", f"turn {k}") for k in range(900)] + [(c, k, "user", f"turn {k}") for c in (25, 45) for k in range(4)]
    frame = rows([(*row, "x", 1) for row in data], DDL).repartition(4)
    numbered = p.number_turns(frame)
    assert sorted(r.place for r in numbered.where("conv_id = 5").collect()) == list(range(1, 901))
    assert result(frame) == brute(data)


def test_no_rows_and_only_conversations_without_turns(rows):
    assert result(rows([], DDL)) == [] and result(rows([(None, 1, "user", "x", "", 1)], DDL)) == []
    lone = next(c for c in range(1, 200) if c % 20 and zlib.crc32(str(c).encode()) % 4 > 1)
    data = [(lone, 0, "user", "dropped")]
    assert result(rows([(*row, "", 1) for row in data], DDL)) == brute(data) == [(lone, 0, -1, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest())]


def test_findclose_and_sums():
    rnd = np.random.default_rng(3)
    for size in (1, 2, 70, 500, 5000):
        depth, opens, stack, close = 0, [], [], {}
        for _ in range(size):
            if depth and rnd.random() < 0.45 + 0.1 * (depth > 150):
                close[stack.pop()] = len(opens)
                opens.append(False)
                depth -= 1
            else:
                stack.append(len(opens))
                opens.append(True)
                depth += 1
        while stack:
            close[stack.pop()] = len(opens)
            opens.append(False)
        trie = p.Parentheses(np.array(opens))
        at = np.flatnonzero(trie.opens)
        found = trie.findclose(at)
        assert found.tolist() == [close[i] for i in at.tolist()]
        assert trie.within(at, found, trie.opens.astype(int)).tolist() == [(close[i] - i + 1) // 2 for i in at.tolist()]
