import random
import re
from collections import defaultdict

import pytest

from lumenpath.llm import line_dedup as d


def brute(data, min_chars, min_docs):
    key = lambda line: re.sub("[A-Z]", lambda m: m.group(0).lower(), re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line))
    holders = defaultdict(set)
    for doc, text in data:
        for line in (text or "").split("\n") if doc is not None else ():
            holders[key(line)].add(doc)
    out = []
    for doc, text in data:
        lines = (text or "").split("\n")
        gone = [doc is not None and len(key(x)) >= min_chars and len(holders[key(x)]) >= min_docs and doc != max(holders[key(x)]) for x in lines]
        out.append((doc, len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone) if not g)))
    return sorted(out, key=str)


def corpus(n):
    rnd = random.Random(2)
    common = ["a common line", "A Common Line ", "\ta common line\r", "short", "ééé ééé ééé", "ÉÉÉ ééé ééé", " a common  line", ""]
    return [(k, "\n".join(rnd.choice([rnd.choice(common), f"own {rnd.random()}"]) for _ in range(rnd.randint(0, 9)))) for k in range(n)]


@pytest.mark.parametrize("batches,fan_in", [(1, 2), (4, 3), (7, 2)])
def test_lines_equal_brute_force(rows, batches, fan_in):
    data = corpus(40) + [(100, None), (101, ""), (102, "\n\n"), (None, "a common line\nown"), (3, "a common line\nagain"), (3, "a common line\nagain")]
    frame = rows([(d_, t, "x", True) for d_, t in data], "doc_id bigint, text string, n_lines string, h1 boolean").repartition(3)
    found = d.dedup_lines(frame, 8, 3, batches, fan_in)
    assert found.columns == ["doc_id", "text", "h1", "n_lines", "n_dropped"]
    got = sorted([(r["doc_id"], r["n_lines"], r["n_dropped"], r["text"] or "") for r in found.collect()], key=str)
    assert got == brute(data, 8, 3)


def test_empty_table_and_no_repeats(rows):
    ddl = "doc_id bigint, text string"
    assert d.dedup_lines(rows([], ddl)).collect() == []
    assert [tuple(r) for r in d.dedup_lines(rows([(1, "x\ny")], ddl)).collect()] == [(1, "x\ny", 2, 0)]


def test_runs_know_who_saw_a_key_first(spark, rows):
    runs = d.LineRuns(spark, fan_in=2)
    add = lambda *data: runs.add(rows(data, "h1 bigint, h2 bigint, doc_id bigint"))
    add((1, 1, 9), (1, 1, 8), (2, 2, 9))
    add((1, 1, 7), (3, 3, 6))
    add((2, 2, 5), (3, 3, 4), (4, 4, 4))
    assert [len(runs.levels[k]) for k in (0, 1)] == [1, 1]
    assert sorted(tuple(r) for r in runs.merged().collect()) == [(1, 1, 3, 9), (2, 2, 2, 9), (3, 3, 2, 6), (4, 4, 1, 4)]
