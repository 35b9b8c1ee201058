"""Benchmark decontamination with a generalised suffix automaton of the test items.

Words are runs of digits, letters and non-ASCII characters, A-Z lower-cased.  The automaton accepts every run of words
of every item.  A document's words stream through it; the length of the longest match that ends at each word says
which words lie inside a window, that is ``window`` consecutive words of an item (a shorter item is one window).

Only runs of words in which each neighbouring pair occurs in an item reach the automaton: no longer match can leave
such a run.  Items are collected in blocks of at most ``BLOCK_WORDS`` words; each block has its own automaton, broadcast
on its own, and the documents are scanned once for each block, with a written table in between.

Null and empty texts have no words and no hits.  Items without words are left out, and those without an id unless
``unnamed`` takes their windows too; rows that repeat an item id are parts of one item id.  Without items nothing is hit.  Repeated documents are judged each on its own.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenpath.llm.packing import tidied
from lumenpath.llm.words import NOT_ALPHANUMERIC, Words, slices
from lumenpath.sources.staging import Stage

WINDOW = 10
BLOCK_WORDS = 250_000


class Automaton:
    """Suffix automaton of several word sequences, with the items whose windows each state stands for."""

    def __init__(self, items: list[tuple[str | None, str]], window: int = WINDOW):
        words = Words(pa.array([text for _, text in items], pa.string()), NOT_ALPHANUMERIC)
        self.vocabulary, ids = np.unique(words.hashes, return_inverse=True)
        self.window, self.base = window, len(self.vocabulary) + 1
        self._next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        sequences = [(item, ids[a:b].tolist()) for (item, _), a, b in zip(items, words.starts, words.starts[1:]) if b > a]
        for _, sequence in sequences:
            last = 0
            for word in sequence:
                last = self._extend(last, word)
        self.step = {state * self.base + word: to for state, out in enumerate(self._next) for word, to in out.items()}
        del self._next
        pairs = [np.array(s[:-1], np.int64) * self.base + np.array(s[1:], np.int64) for _, s in sequences]
        self.pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
        self.shortest = min([min(len(s), window) for _, s in sequences], default=window)
        whole, short = defaultdict(set), defaultdict(set)
        for item, sequence in sequences:
            for state, matched in self._walk(sequence):
                if matched >= window:
                    whole[self._state_of(state, window)].add(item)
            if len(sequence) < window:
                short[self._state_of(state, matched), matched].add(item)
        self.whole = {state: tuple(found) for state, found in whole.items()}
        self.short = defaultdict(list)
        for (state, matched), found in short.items():
            self.short[state].append((matched, tuple(found)))
        self.short = dict(self.short)

    @classmethod
    def of(cls, parts: dict) -> Automaton:
        """The automaton with the attributes ``vars()`` gave for another one."""
        made = cls.__new__(cls)
        made.__dict__.update(parts)
        return made

    def _extend(self, last: int, word: int) -> int:
        out, link, length = self._next, self.link, self.length

        def split(state: int, target: int) -> int:
            copy = len(out)
            out.append(dict(out[target]))
            link.append(link[target])
            length.append(length[state] + 1)
            link[target] = copy
            while state >= 0 and out[state].get(word) == target:
                out[state][word] = copy
                state = link[state]
            return copy

        if word in out[last]:  # an earlier item already leads on from here
            target = out[last][word]
            return target if length[target] == length[last] + 1 else split(last, target)
        new = len(out)
        out.append({})
        link.append(0)
        length.append(length[last] + 1)
        state = last
        while state >= 0 and word not in out[state]:
            out[state][word] = new
            state = link[state]
        if state >= 0:
            target = out[state][word]
            link[new] = target if length[target] == length[state] + 1 else split(state, target)
        return new

    def _state_of(self, state: int, matched: int) -> int:
        """The state of the last ``matched`` words of what led to a state."""
        while self.length[self.link[state]] >= matched:
            state = self.link[state]
        return state

    def _walk(self, sequence: list[int]) -> Iterator[tuple[int, int]]:
        state = matched = 0
        step, base, link, length = self.step, self.base, self.link, self.length
        for word in sequence:
            to = step.get(state * base + word)
            while to is None and state:
                state = link[state]
                matched = length[state]
                to = step.get(state * base + word)
            if to is None:
                matched = 0
            else:
                state, matched = to, matched + 1
            yield state, matched

    def matches(self, sequence: list[int], spans: list[list[int]], items: set[str | None], first: int) -> None:
        """Adds the hit words of a sequence, whose first word has the number ``first``, and the items hit."""
        link, window, short = self.link, self.window, self.short
        for at, (state, matched) in enumerate(self._walk(sequence), first + 1):
            covered = 0
            if matched >= window:
                covered = matched
                items.update(self.whole[self._state_of(state, window)])
            if short:
                up, most = state, matched
                while up > 0:
                    for size, found in short.get(up, ()):
                        if size <= most:
                            covered = max(covered, size)
                            items.update(found)
                    up = link[up]
            if covered:
                if spans and at - covered <= spans[-1][1]:
                    while len(spans) > 1 and at - covered <= spans[-2][1]:
                        spans.pop()
                    spans[-1][0] = min(spans[-1][0], at - covered)
                    spans[-1][1] = at
                else:
                    spans.append([at - covered, at])

    def runs(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Item numbers of all words, and the first and last + 1 word of each run that may hold a window."""
        none = np.zeros(0, np.int64)
        if not len(self.vocabulary) or not len(words.hashes):
            return none, none, none
        ids = np.minimum(np.searchsorted(self.vocabulary, words.hashes), len(self.vocabulary) - 1)
        known = self.vocabulary[ids] == words.hashes
        joined = known[:-1] & known[1:]
        inner = words.starts[(words.starts > 0) & (words.starts < len(known))]
        joined[inner - 1] = False
        at = np.flatnonzero(joined)
        pair = ids[at] * self.base + ids[at + 1]
        place = np.minimum(np.searchsorted(self.pairs, pair), max(len(self.pairs) - 1, 0))
        joined[at] = self.pairs[place] == pair if len(self.pairs) else False
        begins, ends = known.copy(), known.copy()
        begins[1:] &= ~joined
        ends[:-1] &= ~joined
        first, stop = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        long = stop - first >= self.shortest
        return ids, first[long], stop[long]


def _merged(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return out


_FOUND = "n_words bigint, spans array<int>, items array<string>"


def _left(text: str, words: Words, k: int, spans: list[list[int]]) -> str:
    """The k-th text without the words of ``spans``."""
    data, at, left = text.encode(), 0, []
    for a, b in spans:
        i = int(words.starts[k])
        left.append(data[at : int(words.begin[i + a] - words.bounds[k])])
        at = int(words.end[i + b - 1] - words.bounds[k])
    return b"".join([*left, data[at:]]).decode()


def _scan(docs: DataFrame, automaton: Automaton, again: bool, keep_text: bool, cut: bool) -> DataFrame:
    """``spans`` holds the first and the last + 1 number of each run of hit words, one after the other; ``cut`` takes them from the text."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(automaton))
    kept = [field for field in docs.schema.fields if field.name not in ("n_words", "spans", "items") and (keep_text or field.name != "text")]
    schema = T.StructType(kept + T._parse_datatype_string(_FOUND).fields)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = Automaton.of(shared.value)
        for batch in batches:
            for part in slices(batch, "text"):
                words = Words(part.column("text"), NOT_ALPHANUMERIC)
                n = part.num_rows
                spans = [[list(x) for x in zip(s[::2], s[1::2])] for s in part.column("spans").to_pylist()] if again else [[] for _ in range(n)]
                items = [set(x) for x in part.column("items").to_pylist()] if again else [set() for _ in range(n)]
                ids, first, stop = auto.runs(words)
                owner = np.searchsorted(words.starts, first, side="right") - 1
                new: dict[int, list[list[int]]] = defaultdict(list)
                for a, b, k in zip(first.tolist(), stop.tolist(), owner.tolist()):
                    auto.matches(ids[a:b].tolist(), new[k], items[k], a - int(words.starts[k]))
                for k, found in new.items():
                    spans[k] = _merged(spans[k] + found)
                found = [
                    pa.array(np.diff(words.starts), pa.int64()),
                    pa.array([[x for span in s for x in span] for s in spans], pa.list_(pa.int32())),
                    pa.array([sorted(x - {None}) for x in items], pa.list_(pa.string())),
                ]
                columns = {f.name: part.column(f.name) for f in kept}
                if cut:
                    texts = [_left(text, words, k, s) if s else text for k, (text, s) in enumerate(zip(part.column("text").to_pylist(), spans))]
                    columns["text"] = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_arrays([*columns.values(), *found], names=[f.name for f in schema.fields])

    return docs.mapInArrow(tidied(scan), schema)


def matches(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, keep_text: bool = False, block_words: int = BLOCK_WORDS, unnamed: bool = False,
    cut: bool = False,
) -> DataFrame:
    """Adds ``n_words``, ``spans`` and ``items`` to documents that have a ``text``; ``items``: ``item_id``, ``text``.

    Columns of these three names that the documents bring are replaced.  With ``unnamed``, items without an id count for ``spans``.
    With ``keep_text`` and ``cut`` the text comes without the words of ``spans``.  A task has one worker process for all of this.
    """
    docs = docs.drop("n_words", "spans", "items")
    texts = items.select(F.col("item_id").cast("string").alias("item_id"), "text").where("text is not null")
    if not unnamed:
        texts = texts.where("item_id is not null")
    size = texts.agg(F.sum(F.char_length("text") / 2 + 1)).first()[0] or 0  # no more words than that
    blocks = int(size // block_words) + 1
    stage = Stage(docs.sparkSession, "decontaminate")
    out = docs
    for k in range(blocks):
        block = texts.where(F.pmod(F.xxhash64(F.coalesce("item_id", "text")), F.lit(blocks)) == k) if blocks > 1 else texts
        automaton = Automaton(sorted((tuple(row) for row in block.collect()), key=lambda x: (x[0] is None, x[0] or "", x[1])), window)
        last = k == blocks - 1
        out = _scan(out, automaton, again=k > 0, keep_text=keep_text or not last, cut=cut and last)
        if not last:
            out = stage.keep(f"block{k}", lambda frame=out: frame)
    return out


def n_hit():
    return F.aggregate(F.col("spans"), F.lit(0).cast("bigint"), lambda total, x: x - total).alias("n_hit")


def decontaminate(docs: DataFrame, items: DataFrame, max_coverage: float = 0.5, window: int = WINDOW) -> DataFrame:
    """The documents without the words inside windows of ``items``; what stands before and after stays as it is.

    A document of whose words more than ``max_coverage`` lie inside windows is left out.  Columns stay the same.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    hidden = docs.select(F.struct(*others, F.lit(None).alias("text")).alias("row"), F.col("text"))
    clean = matches(hidden, items, window, keep_text=True, unnamed=True, cut=True).where(n_hit() <= max_coverage * F.col("n_words"))
    return clean.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
