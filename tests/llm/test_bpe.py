import base64
import random

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
import tiktoken

from lumenpath.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.read_ranks(PATH), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(encoder):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=encoder.ranks, special_tokens={})


def ids(encoder, text):
    return np.frombuffer(encoder.encode(text), "<u4").tolist()


def test_texts_encode_as_the_library_does(encoder, library):
    rnd = random.Random(1)
    pieces = ["the", "ing", " ", "  ", "\n", "'s", "'ll", "é", "ß", "Ö", "123", "!!", "a", "b", "zz", "\t", "\x1c", "\xa0", "日本", "👍", " of", " ", "\x85"]
    for _ in range(1500):
        text = "".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 30)))
        assert ids(encoder, text) == library.encode_ordinary(text)


def test_code_points_split_as_in_the_library(encoder, library):
    for c in [*range(0, 0x3100), *range(0x3100, 0xD800, 97), *range(0xE000, 0x20000, 211)]:
        text = f"a{chr(c)}b1{chr(c)} {chr(c)}  {chr(c)}{chr(c)}x's\n \n{chr(c)}"
        assert ids(encoder, text) == library.encode_ordinary(text)


def test_very_long_matches(encoder, library):
    for text in ("ab" * 8000, "é" * 5000, "x" * 7001, " " * 4000, "abéa" * 3000 + " end"):
        assert ids(encoder, text) == library.encode_ordinary(text)
    assert not encoder.queue.summary and not encoder.queue.buckets


def test_queue_gives_lowest_rank_and_leftmost_position():
    rnd, queue, held = random.Random(2), bpe.RankQueue(5000), []
    for _ in range(3000):
        if held and rnd.random() < 0.5:
            held.sort()
            assert queue.pop() == held.pop(0)
        else:
            held.append((rnd.randrange(5000) if rnd.random() < 0.7 else 17, rnd.randrange(100)))
            queue.push(*held[-1])


def test_merging_order_is_by_rank_then_place():
    ranks = {bytes([k]): 100 + k for k in range(256)} | {b"ab": 1, b"bc": 0, b"aa": 2, b"abc": 3}
    encoder = bpe.Encoder(ranks, r"[\s\S]+")
    assert encoder.merge(b"abc") == [3]  # a whole token
    assert encoder.merge(b"abcd") == [3, 200]
    assert encoder.merge(b"aaaaa") == [2, 2, 197]


def merged_by_queue(encoder, piece):
    """Ids of one match, merged with nothing but the queue and whole lists."""
    ranks, parts, queue = encoder.ranks, [bytes([b]) for b in piece], bpe.RankQueue(max(encoder.ranks.values()) + 1)
    if piece in ranks:
        return [ranks[piece]]
    follows = lambda i: next((j for j in range(i + 1, len(parts)) if parts[j]), None)
    pair = lambda i: ranks.get(parts[i] + parts[follows(i)]) if parts[i] and follows(i) is not None else None
    for i in range(len(parts)):
        if pair(i) is not None:
            queue.push(pair(i), i)
    while queue.summary:
        rank, i = queue.pop()
        if pair(i) != rank:
            continue
        j = follows(i)
        parts[i], parts[j] = parts[i] + parts[j], b""
        before = [k for k in range(i) if parts[k]][-1:]
        for k in [i, *before]:
            if pair(k) is not None:
                queue.push(pair(k), k)
    return [ranks[p] for p in parts if p]


def test_merge_equals_merging_by_the_queue(encoder):
    rnd = random.Random(3)
    for _ in range(300):
        piece = "".join(rnd.choice(["a", "b", "th", "ing", "é", "er", "st", "zq", "on"]) for _ in range(rnd.randint(1, 25))).encode()
        assert encoder.merge(piece) == merged_by_queue(encoder, piece)


def test_remembered_answers_are_bounded_and_mostly_forgotten_after_a_task(encoder, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", (20_000, 20_000, 20_000))
    small = bpe.Encoder(encoder.ranks, public_tokenizers.PATTERN)
    text = " ".join(f"wörd{k}x {k % 7}" for k in range(3000))
    assert small.encode(text) == encoder.encode(text) == small.encode(text)
    for table in (small.cuts, small.spaced, small.matches):
        for generation in (table, table.old):
            assert sum(bpe.ENTRY_BYTES + 2 * len(k) + len(v) for k, v in generation.items()) <= 20_000
    small.rest()
    assert all(t.held <= 8_000 and not t.old for t in (small.cuts, small.spaced, small.matches)) and small.spaced
    assert small.encode(text) == encoder.encode(text)


def test_rows_come_back(rows, encoder):
    texts = ["hello  world", None, "", " \n", "é" * 3000, "same", "same"]
    frame = rows([(k, t, "x", 0) for k, t in enumerate(texts)] + [(None, "x", None, None)], "doc_id bigint, text string, ids string, decoded int")
    out = bpe.decode(bpe.encode(frame, PATH, public_tokenizers.PATTERN), PATH)
    assert sorted(out.columns) == ["decoded", "doc_id", "ids", "n_tokens", "text"]
    for row in out.collect():
        assert bytes(row["decoded"]).decode() == (row["text"] or "")
        assert bytes(row["ids"]) == encoder.encode(row["text"]) and row["n_tokens"] == len(row["ids"]) // 4
    assert bpe.encode(frame.where("false"), PATH, public_tokenizers.PATTERN).count() == 0


def test_encoding_and_decoding_share_one_worker_a_task(rows):
    frame = rows([(k, t, "x", 0) for k, t in enumerate(["hello  world", None, "", "é" * 3000, "same"])], "doc_id bigint, text string, ids string, decoded int")
    out = bpe.encode(frame, PATH, public_tokenizers.PATTERN, decoded=True)
    two = bpe.decode(bpe.encode(frame, PATH, public_tokenizers.PATTERN), PATH)
    assert out.columns == two.columns and sorted(map(tuple, out.collect()), key=str) == sorted(map(tuple, two.collect()), key=str)
    for made in (out, corpus_pipeline.tokenization(frame.sparkSession, frame, "")):
        assert made._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert bpe.encode(frame, PATH, public_tokenizers.PATTERN).schema["decoded"].dataType.typeName() == "integer"


def test_vocabulary_file_is_read_line_by_line(tmp_path):
    file = tmp_path / "ranks"
    file.write_bytes(base64.b64encode(b"a") + b" 0\n" + base64.b64encode(b" b") + b" 7\n\n")
    assert bpe.read_ranks(str(file)) == {b"a": 0, b" b": 7}


def test_new_words_of_a_slice_are_merged_in_one_pass(encoder, library, monkeypatch):
    rnd = random.Random(5)
    words = ["".join(rnd.choice("abcdeéßио") for _ in range(rnd.randint(1, 14))) for _ in range(700)]
    pieces = [(" " + word).encode() for word in words]
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.merge_all(pieces)] == [library.encode_ordinary(" " + word) for word in words]
    assert not any(encoder.queue.words) and not encoder.queue.buckets
    own = bpe.Encoder(encoder.ranks, public_tokenizers.PATTERN)
    passes, run = [], own._merged
    monkeypatch.setattr(own, "_merged", lambda ids: passes.append(len(ids)) or run(ids))
    texts = ["first " + " ".join(words), None, "", "a  b", "\n".join(f"x {w}, {w}." for w in words)]
    own.learn(texts)
    learnt = len(passes)
    assert [ids(own, t) for t in texts if t] == [library.encode_ordinary(t) for t in texts if t]
    assert learnt <= 4 and len(passes) < 20  # not one for each word


def test_a_merge_that_makes_a_lower_rank_goes_on_with_it():
    # ab (rank 300) makes abc, of rank 299, before the other ab is merged.
    ranks = {bytes([k]): k for k in range(256)} | {b"ab": 300, b"abc": 299, b"abcab": 298}
    own = bpe.Encoder(ranks, r"[\s\S]+")
    assert own.merge(b"abcabcab") == [298, 99, 300]
    assert [np.frombuffer(x, "<u4").tolist() for x in own.merge_all([b"abcab", b"abcabcab", b"zab"])] == [[298], [298, 99, 300], [122, 300]]
