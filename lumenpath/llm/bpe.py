"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A text is split by the vocabulary's pattern; the bytes of each match are merged pair by pair, lowest rank first and leftmost
among equals.  A queue keeps a bucket of linked-list positions for each rank that waits; two levels of bitmaps say which
buckets are filled, and find-first-set picks the next rank.  An entry is stale, and skipped, when the pair that starts at its
position no longer has that rank.  A match of n bytes takes n log n steps, also when it is very long.  New words of a slice of
texts are merged together, a few hundred in one pass.

White space can only stand at the start of a match or be one, so a text is first cut after each run of other characters;
the ids of short cuts are remembered in tables of a bounded number of bytes.  Between tasks a worker process, which may stand
idle for long, keeps a small part of them: the answers it needed first, which are mostly those it needs most.

Null and empty texts have no ids.  Every id decodes to its bytes; the decoded bytes are those of the text.
"""

from __future__ import annotations

import base64
import hashlib
import re
import sys
import types
from array import array
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lumenpath.llm.packing import tidied
from lumenpath.llm.words import slices

#: Unicode white space, as a character class.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Bytes of remembered answers: of cuts, of cuts that follow one space, and of matches.  Each table has two generations of that size.
REMEMBERED = (32 << 20, 160 << 20, 64 << 20)
KEPT = 0.4  # of a generation, at most, that an idle worker keeps
ENTRY_BYTES = 200  # of an answer, besides its characters and ids
SHORT = 48  # characters of a cut that is remembered
TOGETHER = 256  # new words that are merged in one pass
_ENDS = ".,;:!?)\"'"
_ONES = [1 << k for k in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a vocabulary file: a line has the token in base 64 and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class RankQueue:
    """Positions by rank.  ``words`` has a bit for each filled rank, 256 ranks a word; ``summary`` has a bit for each word."""

    def __init__(self, ranks: int):
        self.words = [0] * ((ranks >> 8) + 1)
        self.summary = 0
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.buckets[rank] = [position]
            self.words[rank >> 8] |= 1 << (rank & 255)
            self.summary |= 1 << (rank >> 8)
        else:
            heappush(bucket, position)

    def pop(self) -> tuple[int, int]:
        """The lowest rank and its leftmost position."""
        high = (self.summary & -self.summary).bit_length() - 1
        word = self.words[high]
        rank = high << 8 | ((word & -word).bit_length() - 1)
        bucket = self.buckets[rank]
        position = heappop(bucket)
        if not bucket:
            del self.buckets[rank]
            self.words[high] = word & (word - 1)
            if not self.words[high]:
                self.summary &= self.summary - 1
        return rank, position


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        self.cut = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+").findall
        self.long_space = re.compile(f"[{SPACE}]{{2}}").search
        self.queue = RankQueue(max(ranks.values(), default=0) + 1)
        self.bits = max(ranks.values(), default=0).bit_length()
        self.bytes = [ranks.get(bytes([k])) for k in range(256)]
        #: For each two tokens that make a third its rank, which is also its id.
        self.pairs = {
            ranks[token[:k]] << self.bits | ranks[token[k:]]: rank
            for token, rank in ranks.items() for k in range(1, len(token)) if token[:k] in ranks and token[k:] in ranks
        }
        cuts, spaced, matches = REMEMBERED
        self.cuts: dict[str, bytes] = _Memory(self._encode_cut, cuts)
        self.spaced: dict[str, bytes] = _Memory(lambda cut: self._encode_cut(" " + cut), spaced)  # by what follows the space
        self.matches: dict[str, bytes] = _Memory(self._encode_part, matches)

    def rest(self) -> None:
        """Forgets most answers; called at the end of a task."""
        for table in (self.cuts, self.spaced, self.matches):
            table.shrink(int(table.limit * KEPT))

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self.long_space(text):
            return b"".join(map(self.cuts.__getitem__, self.cut(text)))
        # No two white spaces side by side: a line end is a match, and each space begins one.
        lines = []
        for line in text.split("\n"):
            first, *rest = line.split(" ")
            lines.append((self.cuts[first] if first else b"") + b"".join(map(self.spaced.__getitem__, rest)))
        return lines[0] if len(lines) == 1 else self.cuts["\n"].join(lines)

    def _encode_cut(self, cut: str) -> bytes:
        if cut.isalpha() or (cut[:1] == " " and cut[1:].isalpha()):
            # The whole cut is remembered, so its one match need not be; but it may be, as a part of another cut.
            found = self.matches.get(cut)
            return self._encode_match(cut) if found is None else found
        return b"".join(map(self.matches.__getitem__, self.split(cut)))

    def _encode_part(self, match: str) -> bytes:
        """One match of a cut; a word may be known as a cut of its own."""
        found = self.spaced.get(match[1:]) if match[0] == " " and match[1:].isalpha() else self.cuts.get(match) if match.isalpha() else None
        return self._encode_match(match) if found is None else found

    def _encode_match(self, match: str) -> bytes:
        return array("I", self.merge(match.encode())).tobytes()

    def learn(self, texts: list[str | None]) -> None:
        """Remembers the words of some texts that are new, merged together: one pass of the queue serves them all."""
        new: set[str] = set()
        for text in texts:
            if text and not self.long_space(text):
                for line in text.split("\n"):
                    new.update(line.split(" ")[1:])
        words = {word for word in (cut.rstrip(_ENDS) for cut in new.difference(self.spaced)) if 0 < len(word) <= SHORT and word.isalpha()}
        words = [word for word in words if word not in self.spaced and word not in self.spaced.old and " " + word not in self.matches]
        for at in range(0, len(words), TOGETHER):
            some = words[at : at + TOGETHER]
            for word, ids in zip(some, self.merge_all([(" " + word).encode() for word in some])):
                self.spaced.put(word, ids)

    def merge_all(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of several matches, each as little-endian unsigned 32-bit integers."""
        ids: list[int] = []
        for piece in pieces:
            whole = self.ranks.get(piece)
            if whole is None:
                ids.extend(map(self.bytes.__getitem__, piece))
            else:
                ids.append(whole)
            ids.append(-1)  # makes no pair with anything
        merged = np.array(self._merged(ids), np.int64)
        ends = np.flatnonzero(merged < 0)
        data = merged.astype("<u4").tobytes()
        return [data[4 * a : 4 * b] for a, b in zip([0, *(ends[:-1] + 1).tolist()], ends.tolist())]

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one match."""
        whole = self.ranks.get(piece)
        return [whole] if whole is not None else self._merged(list(map(self.bytes.__getitem__, piece)))

    def _merged(self, ids: list[int]) -> list[int]:
        """The steps of the queue's ``push`` and ``pop`` are written out here; calls would double the time.

        The positions of the lowest rank are taken together, from the left, unless one makes a pair of a lower rank.
        """
        get, bits, words, buckets, ones = self.pairs.get, self.bits, self.queue.words, self.queue.buckets, _ONES
        n, summary = len(ids), 0
        after, before = list(range(1, n + 2)), list(range(-1, n))
        pair = [get(a << bits | b) for a, b in zip(ids, ids[1:])]
        pair.append(None)
        for i, rank in enumerate(pair):
            if rank is None:
                continue
            if rank in buckets:
                buckets[rank].append(i)
            else:
                buckets[rank] = [i]
                high = rank >> 8
                words[high] |= ones[rank & 255]
                summary |= 1 << high
        while summary:
            high = (summary & -summary).bit_length() - 1
            word = words[high]
            rank = high << 8 | ((word & -word).bit_length() - 1)
            bucket = buckets[rank]
            if len(bucket) > 1:
                bucket.sort(reverse=True)
            lower = False
            while bucket and not lower:
                i = bucket.pop()
                if pair[i] != rank:
                    continue  # stale
                gone = after[i]
                follows = after[i] = after[gone]
                ids[i], ids[gone], pair[gone] = rank, None, None
                if follows < n:
                    before[follows] = i
                    new = pair[i] = get(rank << bits | ids[follows])
                    if new is not None:
                        lower = new < rank
                        if new in buckets:
                            buckets[new].append(i)
                        else:
                            buckets[new] = [i]
                            words[new >> 8] |= ones[new & 255]
                            summary |= 1 << (new >> 8)
                else:
                    pair[i] = None
                i = before[i]
                if i >= 0:
                    new = pair[i] = get(ids[i] << bits | rank)
                    if new is not None:
                        lower = lower or new < rank
                        if new in buckets:
                            buckets[new].append(i)
                        else:
                            buckets[new] = [i]
                            words[new >> 8] |= ones[new & 255]
                            summary |= 1 << (new >> 8)
            if not bucket:
                del buckets[rank]
                words[high] ^= ones[rank & 255]
                if not words[high]:
                    summary ^= 1 << high
        return [i for i in ids if i is not None]


class Decoder:
    """The bytes of all tokens, one after the other, and where each token's lie."""

    def __init__(self, ranks: dict[bytes, int]):
        size = max(ranks.values(), default=-1) + 1
        tokens = [b""] * size
        for token, rank in ranks.items():
            tokens[rank] = token
        self.length = np.array([len(t) for t in tokens], np.int64)
        self.begin = np.append(0, np.cumsum(self.length))[:-1]
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def decode(self, ids: bytes) -> bytes:
        numbers = np.frombuffer(ids, "<u4")
        length = self.length[numbers]
        ends = np.cumsum(length)
        return self.data[np.repeat(self.begin[numbers] - ends + length, length) + np.arange(ends[-1] if len(ends) else 0)].tobytes()


class _Memory(dict):
    """Answers for short keys, in two generations: when the young one holds ``limit`` bytes it becomes the old one."""

    def __init__(self, answer, limit: int):
        super().__init__()
        self.answer, self.limit, self.held, self.old = answer, limit, 0, {}

    def __missing__(self, key: str) -> bytes:
        found = self.old.get(key)
        if found is None:
            found = self.answer(key)
        if len(key) <= SHORT:
            self.put(key, found)
        return found

    def put(self, key: str, found: bytes) -> None:
        self.held += ENTRY_BYTES + 2 * len(key) + len(found)
        if self.held > self.limit:
            self.old = dict(self)
            self.clear()
            self.held = ENTRY_BYTES + 2 * len(key) + len(found)
        self[key] = found

    def shrink(self, limit: int) -> None:
        """Keeps the first answers of the young generation, up to so many bytes."""
        kept, self.held, self.old = [], 0, {}
        for key, found in self.items():
            size = ENTRY_BYTES + 2 * len(key) + len(found)
            if self.held + size > limit:
                break
            self.held += size
            kept.append((key, found))
        self.clear()
        self.update(kept)


def _of_this_process(name: str, build):
    """One object a worker process, which outlives the task."""
    kept = sys.modules.setdefault("lumenpath_kept", types.ModuleType("lumenpath_kept"))
    if not hasattr(kept, name):
        setattr(kept, name, build())
    return getattr(kept, name)


def _shared(docs: DataFrame, path: str):
    with open(path, "rb") as file:
        content = file.read()
    return docs.sparkSession.sparkContext.broadcast(read_ranks(path)), hashlib.sha256(content).hexdigest()


def encode(docs: DataFrame, path: str, pattern: str, decoded: bool = False) -> DataFrame:
    """The documents with ``ids`` (binary, little-endian unsigned 32-bit) and ``n_tokens``; the driver reads the file at ``path``.

    With ``decoded`` also the bytes that the ids stand for, as ``decode`` gives them: the worker that has encoded a document decodes its
    ids, so that a task keeps one worker process and not two, each of which would come to hold an encoder.
    Columns of these names that the documents bring are replaced.
    """
    docs = docs.drop("ids", "n_tokens", *["decoded"] * decoded)
    ranks, vocabulary = _shared(docs, path)
    name = "encoder_" + hashlib.sha256((vocabulary + pattern).encode()).hexdigest()
    schema = T.StructType([*docs.schema.fields, T.StructField("ids", T.BinaryType()), T.StructField("n_tokens", T.LongType())])
    if decoded:
        schema = schema.add("decoded", T.BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _of_this_process(name, lambda: Encoder(ranks.value, pattern))
        decoder = _of_this_process("decoder_" + vocabulary, lambda: Decoder(ranks.value)) if decoded else None
        try:
            for batch in batches:
                for part in slices(batch, "text"):
                    texts = part.column("text").to_pylist()
                    encoder.learn(texts)
                    ids = [encoder.encode(text) for text in texts]
                    counts = [len(x) // 4 for x in ids]
                    columns = [*part.columns, pa.array(ids, pa.binary()), pa.array(counts, pa.int64())]
                    if decoder:
                        columns.append(pa.array([decoder.decode(x) if x else b"" for x in ids], pa.binary()))
                    yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())
        finally:
            encoder.rest()

    return docs.mapInArrow(tidied(run), schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The rows with ``decoded`` (binary), the bytes that their ``ids`` stand for; a column of that name is replaced."""
    encoded = encoded.drop("decoded")
    ranks, name = _shared(encoded, path)
    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _of_this_process("decoder_" + name, lambda: Decoder(ranks.value))
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [decoder.decode(ids) if ids else b"" for ids in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.binary())], names=schema.fieldNames())

    return encoded.mapInArrow(tidied(run), schema)
