"""Quality network, language profiles and language model."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from lumenpath.llm import language as lang
from lumenpath.llm import language_model as lm
from lumenpath.llm import quality as q
from lumenpath.llm.words import text_bytes

# ---- quality ----------------------------------------------------------------------------------------


def brute_score(net, text):
    """The network's answer for one text, place by place."""
    data = text.encode()
    places = max(1, -(-len(data) // q.STRIDE))
    padded = data + bytes(places * q.STRIDE + q.KERNEL - len(data))
    answers = [sum(net.table[k][padded[p * q.STRIDE + k]].astype(float) for k in range(q.KERNEL)) + net.bias for p in range(places)]
    step = q.HOP // q.STRIDE
    runs = -(-places // step)
    chunks = [np.maximum(np.max(answers[i * step : (i + 2) * step], axis=0), 0) for i in range(max(1, runs - 1))]
    features = np.concatenate([np.mean(chunks, axis=0), np.max(chunks, axis=0)])
    return 1 / (1 + math.exp(-(features @ net.out[:-1] + net.out[-1])))


def test_whole_texts_are_covered_by_overlapping_chunks():
    random_ = np.random.default_rng(1)
    net = q.Network(random_.normal(size=(q.KERNEL, 256, q.FILTERS)).astype(np.float32), random_.normal(size=q.FILTERS).astype(np.float32),
                    random_.normal(0, 0.02, 2 * q.FILTERS + 1).astype(np.float32), 0.5)
    import pyarrow as pa

    texts = ["", "a", "abcd", "abcde", "x" * 255, "x" * 256, "yz" * 200, "é" * 700, "word " * 2000 + "end", None, "tail " * 3]
    got = net.scores(*text_bytes(pa.array(texts)))
    assert np.allclose(got, [brute_score(net, t or "") for t in texts], atol=1e-4)
    alone = [net.scores(*text_bytes(pa.array([t], pa.string())))[0] for t in texts]
    assert got.tolist() == alone


def sample(rnd, n):
    good = lambda: " ".join(rnd.choice(["the", "and", "here", "stand", "words"]) for _ in range(rnd.randint(5, 200)))
    bad = lambda: " ".join(rnd.choice(["the", "and$$$", "here%%%", "###"]) for _ in range(rnd.randint(5, 200)))
    return [(k, good() if k % 3 else bad(), int(k % 3 > 0)) for k in range(n)]


def test_network_learns_from_labels_and_is_repeatable(rows):
    rnd = random.Random(4)
    data = sample(rnd, 400)
    docs = rows([(k, t, "x") for k, t, _ in data] + [(1000, None, "x"), (1001, "", "x"), (None, "a b", "x"), (1, data[1][1], "x")], "doc_id bigint, text string, score string")
    labels = rows([(k, y) for k, _, y in data if k < 300] + [(None, 1), (5, None), (9999, 0), (2, data[2][2])], "doc_id bigint, label int")
    net = q.fit(docs, labels)
    scored = q.score(docs, net)
    assert scored.columns == ["doc_id", "text", "score"]
    got = {r["doc_id"]: r["score"] for r in scored.collect()}
    right = [(got[k] >= 0.7) == (y == 1) for k, _, y in data if k >= 300]
    assert sum(right) >= 0.95 * len(right)
    assert got[1000] == got[1001] and all(0 <= s <= 1 for s in got.values())
    again = {r["doc_id"]: r["score"] for r in q.score(docs.repartition(3), q.fit(docs.repartition(5), labels)).collect()}
    assert again == got


def test_without_labels_or_with_one_class(rows):
    docs, none = rows([(1, "a"), (2, None)], "doc_id bigint, text string"), rows([], "doc_id bigint, label int")
    assert [r["score"] for r in q.score(docs, q.fit(docs, none)).collect()] == [0.5, 0.5]
    ones = rows([(1, 1), (2, 1)], "doc_id bigint, label int")
    assert [r["score"] for r in q.score(docs, q.fit(docs, ones)).collect()] == [0.75, 0.75]
    assert q.score(docs.where("false"), q.fit(docs, ones)).count() == 0


# ---- languages --------------------------------------------------------------------------------------


def brute_grams(text):
    words = re.findall(r"[^\W\d_]+", text.lower())
    out = Counter()
    for word in words:
        out.update(word)
        for n in (2, 3):
            padded = f" {word} "
            out.update(padded[i : i + n] for i in range(len(padded) - n + 1))
    return out


def brute_rank(counter, top):
    code = lambda g: [1 if c == " " else ord(c) for c in g]
    value = lambda g: sum(x << 21 * (len(g) - 1 - i) for i, x in enumerate(code(g)))
    return sorted(counter, key=lambda g: (-counter[g], value(g)))[:top]


def brute_judge(profiles, text, top):
    mine = brute_rank(brute_grams(text or ""), top)
    if not mine:
        return "und"
    apart = {name: sum(abs(p.index(g) - k) if g in p else top for k, g in enumerate(mine)) for name, p in profiles.items()}
    return min(sorted(apart), key=apart.get)


LANGS = [
    ("en", "the quick brown fox jumps over the lazy dog and then this thing"), ("en", "With the other, that there! 42 is their thing"),
    ("de", "der schnelle braune Fuchs springt über den faulen Hund"), ("de", "Straße und Übung sind schöne Wörter, nicht?"),
    ("fr", "le renard brun rapide saute par-dessus le chien paresseux"), ("fr", "où êtes-vous, élève? l'été est là"), (None, "zzz zzz"), ("en", None),
]


@pytest.mark.parametrize("top", [5, 40, 300])
def test_languages_equal_brute_force(rows, top):
    docs = rows([(k, t, name, "x") for k, (name, t) in enumerate(LANGS)], "doc_id bigint, text string, lang string, score string")
    profiles = lang.learn(docs, top)
    wanted = {name: brute_rank(sum((brute_grams(t) for n, t in LANGS if n == name and t), Counter()), top) for name in ("en", "de", "fr")}
    assert sorted(profiles) == ["de", "en", "fr"] and all(len(profiles[n]) == len(wanted[n]) for n in wanted)
    tests = ["the fox", "der Hund und", "l'élève saute", "", None, "12 !? 3", "x", "Übung " * 3000, "ǅ İstanbul 日本"]
    found = lang.identify(rows([(k, t, "x") for k, t in enumerate(tests)], "doc_id bigint, text string, lang_pred string"), profiles, top)
    for row in found.collect():
        assert row["lang_pred"] == brute_judge(wanted, tests[row["doc_id"]], top)
        assert 0 <= row["score"] <= 1 and (row["lang_pred"] != "und" or row["score"] == 0)


def test_nothing_learned(rows):
    docs = rows([(1, "text", None)], "doc_id bigint, text string, lang string")
    assert lang.learn(docs) == {}
    assert [(r["lang_pred"], r["score"]) for r in lang.identify(docs, {}).collect()] == [("und", 0.0)]
    assert lang.identify(docs.where("false"), {}).count() == 0


# ---- language model ---------------------------------------------------------------------------------


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group(0).lower(), text or "")), "</s>"]


def brute_model(training, texts):
    """Exact counts in place of the filter's: levels of counts that reach the least of their order."""
    count = [Counter(), Counter(), Counter()]
    for text in training:
        seq = ["<s>", "<s>", *tokens(text)]
        for i in range(2, len(seq)):
            for n in (1, 2, 3):
                count[n - 1][tuple(seq[i - n + 1 : i + 1])] += 1
    whole, distinct = sum(count[0].values()), len(count[0])

    def seen(gram):
        c = count[len(gram) - 1][gram]
        if c < lm.LEAST[len(gram) - 1] or c == 0:
            return 0.0
        level = 1 + int(math.log2(c))
        return (2 ** (level - 1) + 2**level - 1) / 2

    for text in texts:
        seq, base, score = ["<s>", "<s>", *tokens(text)], 0.0, 0.0
        for i in range(2, len(seq)):
            a, b, c = seq[i - 2 : i + 1]
            base += math.log10((count[0][c,] + 1) / (whole + distinct + 1))
            before = len(training) if b == "<s>" else seen((b,))
            pair = len(training) if b == "<s>" else seen((a, b))
            p = (seen((c,)) + 1) / (whole + distinct + 1)
            for weight, context, found in zip(lm.WEIGHT, (before, pair), (seen((b, c)), seen((a, b, c)))):
                p = (1 - weight) * p + weight * found / max(context, found) if context else p
            score += math.log10(p)
        yield len(seq) - 2, sum(count[0][t,] > 0 for t in seq[2:]), whole, base, score


@pytest.mark.parametrize("round_bytes,frequent,shard_entries", [(lm.ROUND_BYTES, lm.FREQUENT, lm.SHARD_ENTRIES), (300, 5, 100), (1, 0, 50)])
def test_scores_equal_exact_counts(rows, monkeypatch, round_bytes, frequent, shard_entries):
    monkeypatch.setattr(lm, "BITS_PER_ENTRY", 64)  # hardly a false answer
    rnd = random.Random(6)
    say = lambda: " ".join(rnd.choice(["The", "the", "a", "b", "of", "Cat", "dog"]) + rnd.choice(["", "", "s", "ed"]) for _ in range(rnd.randint(0, 40)))
    training = [say() for _ in range(30)] + [None, "", "the cat the cat the cat"]
    texts = training[:10] + [say() + " unseen words unseen" for _ in range(10)] + [None, "", " \n"]
    docs = rows([(k, t, 1.0) for k, t in enumerate(texts)], "doc_id bigint, text string, uid double")
    found = lm.score(docs, rows([(t,) for t in training], "text string"), round_bytes, frequent, shard_entries)
    wanted = list(brute_model(training, texts))
    got = {r["doc_id"]: r for r in found.collect()}
    assert len(got) == len(texts)
    for k, (n, known, whole, base, score) in enumerate(wanted):
        assert (got[k]["n_tokens"], got[k]["n_known"], got[k]["train_tokens"]) == (n, known, whole)
        assert got[k]["base_score"] == pytest.approx(base, rel=1e-9) and got[k]["score"] == pytest.approx(score, rel=0.02)


def test_a_passage_seen_once_is_known(rows, monkeypatch):
    monkeypatch.setattr(lm, "BITS_PER_ENTRY", 64)
    passage = "some words that stand here only once"
    training = ["some other words", "words that stand", "stand here", "here only", "only once", "that stand"]
    docs = rows([(1, passage)], "doc_id bigint, text string")
    score = lambda texts: lm.score(docs, rows([(t,) for t in texts], "text string")).first()["score"]
    assert score([*training, passage]) == pytest.approx(list(brute_model([*training, passage], [passage]))[0][-1], rel=0.02)
    assert score([passage]) > -5  # -4.36; without the trigrams -5.86


def test_nothing_to_learn_from_or_to_score(rows):
    docs, none = rows([(None, "a b"), (2, None)], "doc_id bigint, text string"), rows([], "text string")
    assert sorted((r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in lm.score(docs, none).collect()) == [(1, 0, 0, 0.0), (3, 0, 0, 0.0)]
    assert lm.score(docs.where("false"), docs).count() == 0


def test_filter_finds_all_and_little_else():
    rnd = np.random.default_rng(3)
    hashes = rnd.integers(0, 2**63, 60_000, dtype=np.uint64) * np.uint64(2)
    counts = rnd.geometric(0.4, 30_000)
    held = lm.Filter(8, bytearray())
    shard, ids = lm.Filter.split(hashes[:30_000], 8)
    for s in range(8):
        held.add(s, lm.Filter.part(ids[shard == s], lm._levels(counts[shard == s])))
    assert (held.levels(hashes[:30_000]) >= lm._levels(counts)).all()
    assert (held.levels(hashes[30_000:]) > 0).mean() < 0.03
    assert (held.levels(hashes[:30_000]) > lm._levels(counts)).mean() < 0.03


def test_rounds_leave_one_table_of_documents(spark, rows):
    import glob

    from lumenpath.sources.staging import shared_folder

    there = lambda: set(glob.glob(f"{shared_folder(spark).removeprefix('file://')}/{spark.sparkContext.applicationId}/language_model-*/round*"))
    before = there()
    texts = [f"word{k} word{k + 1} word{k + 2} again" for k in range(40)]
    docs = rows([(k, t) for k, t in enumerate(texts)], "doc_id bigint, text string")
    found = lm.score(docs, docs.select("text"), 1, 0, 50)
    assert len(found.collect()) == 40
    left = there() - before
    assert len(left) == 1 and not left.pop().endswith("round0")
