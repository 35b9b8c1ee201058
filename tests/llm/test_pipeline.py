"""The pipeline against the brute-force versions of its operators, and the registered queries."""

import hashlib
import os
import random
import zlib

import pytest
import test_decontaminate
import test_jaccard
import test_line_dedup
from pyspark.sql import functions as F

import corpus_pipeline
from lumenpath.llm import quality
from lumenpath.llm.queries import LLM_ORACLES, LLM_QUERIES
from workload.compare import compare, open_duck

SF_DIR = os.environ.get("LUMENPATH_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Small tables with copies, shared lines, benchmark passages and poor texts."""
    rnd = random.Random(12)
    path = str(tmp_path_factory.mktemp("tables"))
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    line = "this very line is common to a good many documents of the corpus"
    docs, labels = [], []
    for k in range(160):
        poor = k % 5 == 0
        text = "\n".join(" ".join(rnd.choice(["the", "and", "here", "stand", "words", f"w{rnd.randint(0, 400)}"]) + ("$$$" if poor else "") for _ in range(12))
                         for _ in range(rnd.randint(1, 6)))
        if k % 7 == 1:
            text += "\n" + line
        if k % 11 == 2:
            text += "\nsome words before " + item + " and after"
        if k % 8 == 3 and docs:
            text = docs[-2][1]
        docs.append((k, text, "en", f"src{k % 3}", len(text)))
        labels.append((k, int(not poor), 0))
    docs += [(500, None, None, None, None), (501, "", "en", "s", 0), (502, item, "en", "s", 1), (1, docs[1][1], "en", "src1", 5)]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None), (3, "")], "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def bag(frame, *columns):
    return sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=str)


def test_stages_equal_brute_force(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    inputs = []
    for k, (name, step) in enumerate(corpus_pipeline.STAGES):
        inputs.append(docs)
        step(spark, docs, folder).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        assert k == 4 or docs.columns == columns
    outputs = [*inputs[1:], docs]

    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    learned = labels.where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2)
    net = quality.fit(inputs[0], learned)
    kept = {r["doc_id"] for r in quality.score(inputs[0], net).where("score >= 0.7").collect()}
    assert bag(outputs[0], "doc_id", "text") == bag(inputs[0].where(F.col("doc_id").isin(*kept)), "doc_id", "text")
    held_out = [k for k in range(160) if zlib.crc32(str(k).encode()) % 4 == 2]
    assert sum((k in kept) == (k % 5 > 0) for k in held_out) >= 0.9 * len(held_out)

    data = [(r["doc_id"], r["text"]) for r in inputs[1].collect()]
    wanted = [(doc, text) for doc, _, _, text in test_line_dedup.brute(data, 40, 5)]
    assert [(d, t or "") for d, t in bag(outputs[1], "doc_id", "text")] == wanted
    assert all(r["n_chars"] == len(r["text"]) for r in outputs[1].collect() if r["text"] is not None)

    data = [(r["doc_id"], r["text"]) for r in inputs[2].collect()]
    stays = {doc for doc, _, component in test_jaccard.brute(data) if doc == component}
    assert [d for d, in bag(outputs[2], "doc_id")] == sorted(stays, key=str) and len(stays) < len(data)

    items = [("1", "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu")]
    before, after = dict(bag(inputs[3], "doc_id", "text")), dict(bag(outputs[3], "doc_id", "text"))
    for doc, text in before.items():
        n, hit, _ = test_decontaminate.brute(text, items, 10)
        assert (doc in after) == (len(hit) <= n / 2)
        if doc in after:
            words = test_decontaminate.words(text)
            assert test_decontaminate.words(after[doc]) == [w for i, w in enumerate(words) if i not in set(hit)]
            assert hit or after[doc] == text
    assert any(after[d] != before[d] for d in after)

    assert all(r["intact"] for r in outputs[4].collect()) and outputs[4].count() == inputs[4].count()
    whole = corpus_pipeline.run(spark, folder)
    assert bag(whole, "doc_id", "n_tokens", "ids") == bag(outputs[4], "doc_id", "n_tokens", "ids")


def test_each_group_keeps_one_row_whatever_its_id(spark, rows):
    one, two, three, four = ("alpha beta gamma delta epsilon zeta", "one two three four five six", "red green blue black white grey", "a b c d e f g")
    data = [(1, one), (2, one), (2, two), (3, two), (3, three), (3, three), (None, three), (None, four), (None, four), (None, None), (None, None), (4, ""), (4, "")]
    found = corpus_pipeline.near_duplicates(spark, rows(data, "doc_id bigint, text string").repartition(3), "")
    wanted = [(1, one), (2, two), (3, three), (None, four), (None, None), (None, None), (4, "")]
    assert bag(found, "doc_id", "text") == sorted(wanted, key=str)


def test_empty_tables(spark, folder, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").where("false").write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test data not present")
@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_queries_equal_their_sql(spark, name):
    assert compare(LLM_QUERIES[name](spark, SF_DIR), open_duck(SF_DIR), LLM_ORACLES[name]) == []


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test data not present")
def test_queries_without_sql_on_the_given_tables(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    items = [(str(r["item_id"]), r["text"]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    run = lambda name: {r["doc_id"]: r for r in LLM_QUERIES[name](spark, SF_DIR).collect()}
    found = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in run("op4_ngram_jaccard_join").values()]
    assert sorted(found, key=str) == test_jaccard.brute(list(docs.items()))
    for doc, row in run("op9_benchmark_decontamination").items():
        n, hit, found = test_decontaminate.brute(docs[doc], items, 10)
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        assert tuple(row) == (doc, n, len(hit), len(found), digest, bool(hit))
    for doc, row in run("op5_byte_level_bpe").items():
        assert row["decoded_sha256"] == hashlib.sha256(docs[doc].encode()).hexdigest()
    found = run("op6_language_id")
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    held_out = [doc for doc, row in found.items() if row["held_out"]]
    assert all(row["held_out"] == (zlib.crc32(str(doc).encode()) % 4 == 2) for doc, row in found.items())
    assert sum(found[d]["lang_pred"] == truth[d] for d in held_out) >= 0.9 * len(held_out)
    scores = run("op3_lm_scoring")
    unseen = [row for row in scores.values() if row["held_out"]]
    assert unseen and sum(r["score"] for r in unseen) > sum(r["base_score"] for r in unseen)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    judged = [(row["predicted"], labels[d]) for d, row in run("op7_quality_classifier").items() if row["held_out"] and d in labels]
    assert sum(a == b for a, b in judged) >= 0.8 * len(judged)
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()
    texts = LLM_QUERIES["op2_html_extraction"](spark, SF_DIR).collect()
    assert len(texts) == len(pages) and all(r["text"] and r["n_chars"] == len(r["text"]) and "<" not in r["text"] for r in texts)
    assert LLM_QUERIES["op1_url_filter"](spark, SF_DIR).count() == len(pages)
