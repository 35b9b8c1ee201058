import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from lumenpath.llm import words as w
from lumenpath.llm.packing import cuts, grouped, pack, unpack

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAbZ éß0.-\n\t\x0b\x00", max_size=30)), max_size=6)
PATTERNS = [(w.BLANKS, r"[^\x20\x09-\x0D]+"), (w.NOT_ALPHANUMERIC, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")]


def split(text, pattern):
    return re.findall(pattern, re.sub("[A-Z]", lambda m: m.group(0).lower(), text or ""))


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.sampled_from(PATTERNS), st.integers(0, 3))
def test_words_are_those_of_the_pattern(texts, kind, skip):
    column = pa.array(texts, pa.string()).slice(skip)
    found = w.Words(column, kind[0])
    wanted = [split(t, kind[1]) for t in column.to_pylist()]
    assert np.diff(found.starts).tolist() == [len(x) for x in wanted]
    names = {}
    for h, word in zip(found.hashes.tolist(), [x for t in wanted for x in t]):
        assert names.setdefault(word, h) == h
    assert len(set(names.values())) == len(names)


def test_very_long_words_and_slices():
    texts = ["x" * 100_000, "x" * 100_001, "y " * 1000, None, ""]
    batch = pa.record_batch([pa.array(texts)], ["text"])
    parts = list(w.slices(batch, "text", 1000))
    assert sum(p.num_rows for p in parts) == 5
    hashes = [h for p in parts for h in w.Words(p.column("text")).hashes.tolist()]
    assert len(hashes) == 1002 and len(set(hashes)) == 3


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**40 - 1), max_size=50))
def test_packed_values_come_back(values):
    array = np.array(values, np.uint64)
    assert unpack(pack(array, 5), len(array), 5).tolist() == values


def test_groups_span_batches():
    batches = [pa.record_batch([pa.array(x, pa.int64())], ["k"]) for x in ([None, 1, 1], [], [1, 2], [2, 3])]
    assert [(k, t.num_rows) for k, t in grouped(iter(batches), "k")] == [(None, 1), (1, 3), (2, 2), (3, 1)]
    assert cuts(np.array([5, 5, 7])).tolist() == [0, 2, 3] and cuts(np.array([])).tolist() == [0]
