"""Language identification by rank-order profiles.

A text is read as words of letters, lower-cased, with a blank at both ends of each; its n-grams are the runs of 1 to 3
characters in them, the lone blank left out.  A profile lists a language's ``TOP`` most frequent n-grams by rank; ties go to
the smaller n-gram.  A document's own ``TOP`` most frequent n-grams are compared with each profile: the out-of-place distance
sums how far each n-gram's rank lies from its rank in the profile, or ``TOP`` for one that the profile lacks.

The nearest language is the answer (ties: the smaller name).  Its score is 1 less the ratio of its distance to the runner-up's,
or to the largest possible distance if there is one language only.  Texts without a letter, null among them, are ``und`` with
score 0, and so is every text if nothing was learned.  Training texts without a language teach nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenpath.llm.words import slices

TOP = 300
ORDERS = 3
FLUSH = 2_000_000  # n-grams that a training task counts before it writes them out
UNKNOWN = "und"


def _letters() -> np.ndarray:
    """For every code point itself if it is a letter, else 0."""
    table = np.zeros(0x110000, np.uint32)
    table[[c for c in range(0x110000) if chr(c).isalpha()]] = 1
    return table * np.arange(0x110000, dtype=np.uint32)


def ngrams(text: str, letters: np.ndarray) -> np.ndarray:
    """Codes of all n-grams of a text: 21 bits a character, 1 for the blank at a word's end."""
    points = letters[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)]
    points = np.concatenate([[0], points, [0]]).astype(np.int64)
    points = points[np.append(True, (points[1:] != 0) | (points[:-1] != 0))]  # one blank between words
    if len(points) < 3:
        return np.zeros(0, np.int64)
    points = np.maximum(points, 1)
    found, gram = [points[points > 1]], points
    for n in range(2, ORDERS + 1):
        gram = (gram[:-1] << 21) | points[n - 1 :]
        inner = points[1 : len(points) - 1] if n == 3 else None
        found.append(gram if inner is None else gram[inner > 1])  # no n-gram spans two words
    return np.concatenate(found)


def _ranked(grams: np.ndarray, top: int) -> np.ndarray:
    """The most frequent n-grams, in order of rank."""
    found, counts = np.unique(grams, return_counts=True)
    if len(found) > top:
        least = np.partition(counts, len(counts) - top)[len(counts) - top]
        found, counts = found[counts >= least], counts[counts >= least]
    return found[np.argsort(-counts, kind="stable")][:top]


def learn(docs: DataFrame, top: int = TOP) -> dict[str, list[int]]:
    """The profile of each language in ``lang`` over all documents ``text``, ``lang``; its size is bounded by top x languages."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = _letters()
        held: dict[str, list[np.ndarray]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, grams in held.items():
                found, counts = np.unique(np.concatenate(grams), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found)), pa.array(found), pa.array(counts)], names=["lang", "gram", "seen"])

        for batch in batches:
            for part in slices(batch, "text"):
                for text, lang in zip(part.column("text").to_pylist(), part.column("lang").to_pylist()):
                    grams = ngrams(text, letters)
                    held.setdefault(lang, []).append(grams)
                    size += len(grams)
                if size >= FLUSH:
                    yield from flush()
                    held, size = {}, 0
        yield from flush()

    counted = docs.where("text is not null and lang is not null").select("text", "lang").mapInArrow(count, "lang string, gram bigint, seen bigint")
    counted = counted.groupBy("lang", "gram").agg(F.sum("seen").alias("seen"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("seen"), "gram"))
    rows = counted.withColumn("place", place).where(F.col("place") <= top).collect()
    profiles: dict[str, list[int]] = {}
    for row in sorted(rows, key=lambda r: (r["lang"], r["place"])):
        profiles.setdefault(row["lang"], []).append(row["gram"])
    return profiles


class Judge:
    def __init__(self, profiles: dict[str, list[int]], top: int = TOP):
        self.names, self.top, self.letters = sorted(profiles), top, _letters()
        self.known = np.unique(np.array([g for grams in profiles.values() for g in grams], np.int64))
        self.ranks = np.full((len(self.names), len(self.known) + 1), -1, np.int64)
        for k, name in enumerate(self.names):
            self.ranks[k, np.searchsorted(self.known, profiles[name])] = np.arange(len(profiles[name]))

    def judge(self, text: str | None) -> tuple[str, float]:
        grams = ngrams(text, self.letters) if text else ()
        if not len(grams) or not self.names:
            return UNKNOWN, 0.0
        mine = _ranked(grams, self.top)
        at = np.minimum(np.searchsorted(self.known, mine), len(self.known) - 1)
        theirs = np.where(self.known[at] == mine, self.ranks[:, at], -1)
        apart = np.where(theirs >= 0, np.abs(theirs - np.arange(len(mine))), self.top).sum(axis=1)
        order = np.argsort(apart, kind="stable")
        most = apart[order[1]] if len(order) > 1 else self.top * len(mine)
        return self.names[order[0]], float(1 - apart[order[0]] / most) if most else 0.0


def identify(docs: DataFrame, profiles: dict[str, list[int]], top: int = TOP) -> DataFrame:
    """The documents with ``lang_pred`` and ``score``, from ``text`` alone; columns of these names are replaced."""
    docs = docs.drop("lang_pred", "score")
    shared = docs.sparkSession.sparkContext.broadcast(profiles)
    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(shared.value, top)
        for batch in batches:
            for part in slices(batch, "text"):
                found = [judge.judge(text) for text in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())], names=schema.fieldNames()
                )

    return docs.mapInArrow(run, schema)
