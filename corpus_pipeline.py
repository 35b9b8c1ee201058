"""Cleans the documents of a corpus and turns them into token ids.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the one before kept; ``run`` writes each stage's documents as
Parquet in the shared folder and reads them again for the next.  All stages but the last return the columns of documents, with
``n_chars`` brought up to date where the text changed.  Rows without an id pass the stages that compare documents by id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumenpath.llm import bpe, decontaminate, jaccard, line_dedup
from lumenpath.llm import quality as quality_network
from lumenpath.sources.staging import Stage

LEAST_QUALITY = 0.7
MOST_COVERAGE = 0.5
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _counted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality network gives at least ``LEAST_QUALITY``.

    It learns from labelled documents whose id, as text, has a crc32 that leaves no remainder of 2 modulo 4.
    """
    learned = F.crc32(F.col("doc_id").cast("string")) % 4 != 2
    labels = _table(spark, sf_dir, "labels").where(learned).select("doc_id", F.col("quality").alias("label"))
    scored = quality_network.score(docs, quality_network.fit(docs, labels), "quality_score")
    return scored.where(F.col("quality_score") >= LEAST_QUALITY).drop("quality_score")


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that at least five of them hold, but for the last holder."""
    return _counted(line_dedup.dedup_lines(docs).drop("n_lines", "n_dropped"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: the one with the smallest id, or without an id if none has one.

    Rows are told apart by a 64-bit hash of id and text, whatever they share of it.  Rows without words are no copies: those that
    repeat an id and text stay as one row, those without an id all stay.
    """
    key = F.xxhash64(F.col("doc_id").cast("string"), F.lit(0), "text")
    keyed = docs.select("*", key.alias("near_duplicates_key"))
    named = keyed.select(F.col("near_duplicates_key").alias("doc_id"), "text")
    groups = jaccard.jaccard_groups(named).select(F.col("doc_id").alias("near_duplicates_key"), "component_id", "n_shingles").distinct()
    found = Stage(spark, "near_duplicates").keep("groups", lambda: groups)
    doc_id = F.col("doc_id").cast("bigint")
    ids = keyed.select(doc_id.alias("doc_id"), "near_duplicates_key").distinct().join(found, "near_duplicates_key")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "near_duplicates_key")).alias("first")
    kept = ids.groupBy("component_id").agg(first, F.max("n_shingles").alias("near_duplicates_size"))
    kept = kept.select("first.near_duplicates_key", "near_duplicates_size")
    row = F.row_number().over(Window.partitionBy("near_duplicates_key").orderBy(F.xxhash64("text")))
    chosen = keyed.join(kept, "near_duplicates_key").withColumn("near_duplicates_row", row)
    return chosen.where("near_duplicates_row = 1 or (doc_id is null and near_duplicates_size = 0)").select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words they share with benchmark items; those made of such words by more than half go."""
    return _counted(decontaminate.decontaminate(docs, _table(spark, sf_dir, "benchmark"), MOST_COVERAGE))


def tokenization(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``lang``, ``source``, ``n_tokens``, ``ids`` and ``intact``: whether the ids decode to the text."""
    import public_tokenizers

    path = public_tokenizers.path(VOCABULARY)
    decoded = bpe.encode(docs, path, public_tokenizers.PATTERN, decoded=True)
    intact = (F.col("decoded") == F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("intact")
    return decoded.select("doc_id", *[c for c in ("lang", "source") if c in docs.columns], "n_tokens", "ids", intact)


STAGES = [
    ("quality classifier", quality_filter),
    ("line dedup", line_deduplication),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("byte-level BPE", tokenization),
]

#: SQL cannot express the first stage; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = Stage(spark, "corpus_pipeline")
    docs = _table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage.keep(name.replace(" ", "_"), lambda done=step(spark, docs, sf_dir): done)
    return STAGES[-1][1](spark, docs, sf_dir)
