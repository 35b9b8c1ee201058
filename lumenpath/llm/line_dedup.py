"""Line deduplication with levelled sorted runs of line hashes.

A line's key is the line without ASCII blanks at its ends, A-Z lower-cased.  Batches of documents arrive in descending
order of their ids.  A batch's keys are merge-joined with the runs written so far: a key that no run knows is new, and the
largest id of the batch that holds it keeps it; a key that some run knows only adds to its count.  The batch is then written
as a sorted run of its own.  When ``fan_in`` runs stand on a level, they are compacted to one run on the next level.
Runs are bucketed and sorted by hash in the shared folder, so a join with them moves only the new batch.

Keys of at least ``min_chars`` code points found in at least ``min_docs`` documents lose all their lines, except in the
document with the largest id.  Documents are told apart by their id: rows that share one are one document, and all of
them keep the line if theirs is the largest id.  Rows without an id neither count nor lose lines.  A null or empty text is
one empty line.  Keys are compared by 128-bit hashes.
"""

from __future__ import annotations

import hashlib
import uuid
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenpath.llm.packing import tidied
from lumenpath.llm.words import slices
from lumenpath.sources.staging import Stage, shared_folder

BLANKS = " \t\n\x0b\x0c\r"
MIN_CHARS, MIN_DOCS = 40, 5
BATCHES, FAN_IN = 4, 3
SALTS = 16


def line_key(line: str, min_chars: int = MIN_CHARS) -> tuple[int, int] | None:
    """128 bits of the key's hash; none for a shorter key."""
    key = line.strip(BLANKS)
    if len(key) < min_chars:
        return None
    found = hashlib.blake2b(key.encode().lower(), digest_size=16).digest()
    return int.from_bytes(found[:8], "little", signed=True), int.from_bytes(found[8:], "little", signed=True)


class LineRuns:
    """Sorted runs ``h1, h2, n_docs, keeper``; ``keeper`` is set in the one run that saw the key first.

    All runs are partitions of one bucketed table, so reading several of them is one scan that keeps the buckets together.
    """

    def __init__(self, spark: SparkSession, fan_in: int = FAN_IN):
        self.spark, self.fan_in = spark, fan_in
        self.name = f"line_runs_{uuid.uuid4().hex[:12]}"
        self.folder = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{self.name}"
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: dict[int, list[int]] = defaultdict(list)  # numbers of the runs on each level
        self._written = 0

    def read(self, runs: list[int] | None = None) -> DataFrame:
        wanted = [run for level in self.levels.values() for run in level] if runs is None else runs
        return self.spark.table(self.name).where(F.col("run").isin(wanted)).drop("run")

    def merged(self, runs: list[int] | None = None) -> DataFrame:
        return self.read(runs).groupBy("h1", "h2").agg(F.sum("n_docs").alias("n_docs"), F.max("keeper").alias("keeper"))

    def add(self, batch: DataFrame) -> None:
        """Adds distinct ``h1, h2, doc_id`` rows, whose ids all lie below those added before."""
        own = batch.groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("keeper"))
        if self._written:
            known = self.read().where("keeper is not null").select("h1", "h2", F.lit(True).alias("known"))
            own = own.join(known.hint("merge"), ["h1", "h2"], "left")
            own = own.select("h1", "h2", "n_docs", F.when(F.col("known").isNull(), F.col("keeper")).alias("keeper"))
        self.levels[0].append(self._write(own))
        self._compact()

    def _compact(self) -> None:
        level = 0
        while len(self.levels[level]) >= self.fan_in:
            self.levels[level + 1].append(self._write(self.merged(self.levels[level])))
            self.levels[level] = []
            level += 1

    def _write(self, run: DataFrame) -> int:
        number, self._written = self._written, self._written + 1
        writer = run.withColumn("run", F.lit(number)).repartition(self.buckets, "h1").write.mode("append")
        writer = writer.partitionBy("run").bucketBy(self.buckets, "h1").sortBy("h1", "h2")
        writer.format("parquet").option("path", f"{self.folder}").saveAsTable(self.name)
        return number


def _holders(docs: DataFrame, min_chars: int) -> DataFrame:
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                rows = set()
                for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    if doc is not None and text:
                        rows.update((*key, doc) for line in set(text.split("\n")) if (key := line_key(line, min_chars)))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], names=["h1", "h2", "doc_id"])

    return docs.select("doc_id", "text").mapInArrow(tidied(keys), "h1 bigint, h2 bigint, doc_id bigint").distinct()


def _doomed(docs: DataFrame, min_chars: int, min_docs: int, batches: int, fan_in: int) -> DataFrame:
    """For each document the hashes of the lines it loses, in two arrays."""
    spark = docs.sparkSession
    shares = [1 - (k + 1) / batches for k in range(batches - 1)]
    bounds = docs.agg(F.percentile_approx("doc_id", shares or [0.5], 1000)).first()[0] or []
    number = sum([F.when(F.col("doc_id") <= bound, 1).otherwise(0) for bound in bounds[: batches - 1]], F.lit(0)).alias("batch")
    held = Stage(spark, "line_dedup").keep("holders", lambda: _holders(docs, min_chars).withColumn("batch", number), ("batch",))
    runs = LineRuns(spark, fan_in)
    for k in range(batches):
        runs.add(held.where(F.col("batch") == k).select("h1", "h2", "doc_id"))
    # A line may stand in a third of all documents: its holders meet its one row in several tasks.
    lost = runs.merged().where(F.col("n_docs") >= min_docs).select("h1", "h2", "keeper", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = held.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    lost = salted.join(lost, ["h1", "h2", "salt"]).where("doc_id != keeper")
    return lost.groupBy("doc_id").agg(F.collect_list(F.struct("h1", "h2")).alias("lost")).select("doc_id", "lost.h1", "lost.h2")


def dedup_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES, fan_in: int = FAN_IN
) -> DataFrame:
    """The documents (``doc_id``, ``text`` and any others) with ``text`` cut, then ``n_lines`` and ``n_dropped``.

    Columns of the last two names that the documents bring are replaced.
    """
    docs = docs.drop("n_lines", "n_dropped")
    lost = _doomed(docs, min_chars, min_docs, batches, fan_in)
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row")
    joined = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), others, "text")
    joined = joined.join(lost, "doc_id", "left").select("row", "text", "h1", "h2")
    schema = T.StructType([f for f in joined.schema.fields if f.name in ("row", "text")])
    schema = schema.add("n_lines", T.LongType()).add("n_dropped", T.LongType())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                texts, n_lines, n_dropped = part.column("text").to_pylist(), [], []
                for k, (h1, h2) in enumerate(zip(part.column("h1").to_pylist(), part.column("h2").to_pylist())):
                    dropped = 0
                    n_lines.append((texts[k] or "").count("\n") + 1)
                    if h1:
                        gone = set(zip(h1, h2))
                        lines = texts[k].split("\n")
                        kept = [line for line in lines if line_key(line, min_chars) not in gone]
                        dropped = len(lines) - len(kept)
                        texts[k] = "\n".join(kept)
                    n_dropped.append(dropped)
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), pa.array(texts, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
                    names=["row", "text", "n_lines", "n_dropped"],
                )

    done = joined.mapInArrow(tidied(cut), schema)
    return done.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns], "n_lines", "n_dropped")
