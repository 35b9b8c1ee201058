import random
import re

import pytest

from lumenpath.llm import decontaminate as d

DOCS = "doc_id bigint, text string, n_words string, extra int"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group(0).lower(), text or ""))


def brute(text, items, window):
    mine, hit, found = words(text), set(), set()
    for item, other in items:
        theirs = words(other)
        k = min(window, len(theirs))
        runs = {tuple(theirs[a : a + k]) for a in range(len(theirs) - k + 1)} if k else set()
        for a in range(len(mine) - k + 1) if runs else ():
            if tuple(mine[a : a + k]) in runs:
                hit.update(range(a, a + k))
                found.add(item)
    return len(mine), sorted(hit), sorted(found)


def flat(spans):
    return sorted(x for a, b in zip(spans[::2], spans[1::2]) for x in range(a, b))


@pytest.mark.parametrize("block_words", [1_000_000, 12])
def test_matches_equal_brute_force(rows, block_words):
    rnd = random.Random(5)
    say = lambda n, letters="abc": " ".join(rnd.choice(letters) for _ in range(n))
    items = [(i, say(rnd.randint(0, 9))) for i in range(12)] + [(3, say(6)), (None, say(5)), (50, None), (51, "é É"), (9, "a.b,c")]
    texts = [say(rnd.randint(0, 40)) for _ in range(40)] + [None, "", "  .", "É é x", "A-B C a", say(4) + " zz " + say(30)]
    data = [(i, t, "x", 1) for i, t in enumerate(texts)] + [(0, texts[0], "x", 1), (None, say(20), None, None)]
    known = [(str(i), t) for i, t in items if i is not None and t is not None]
    found = d.matches(rows(data, DOCS), rows(items, "item_id bigint, text string"), window=4, block_words=block_words)
    found = found.select("doc_id", "extra", "n_words", "spans", "items", d.n_hit()).collect()
    assert len(found) == len(data)
    by_id = {}
    for doc, text, _, _ in data:
        by_id.setdefault(doc, []).append(brute(text, known, 4))
    for row in found:
        wanted = by_id[row["doc_id"]][0]
        assert (row["n_words"], flat(row["spans"]), row["items"]) == wanted
        assert row["n_hit"] == len(wanted[1])


def test_windows_leave_the_text(rows):
    items = rows([(1, "one two three four"), (2, "alpha beta gamma delta")], "item_id bigint, text string")
    data = [
        (1, "keep this; One, two  three FOUR! and that, and more words here", "x", 1), (2, "one two three four five", "x", 2), (3, None, None, None),
        (4, "", None, None), (5, "clean text\n stays  as it is", "x", 5),
    ]
    found = {r["doc_id"]: r for r in d.decontaminate(rows(data, DOCS), items, 0.5, window=4).collect()}
    assert set(found) == {1, 3, 4, 5}
    assert found[1]["text"] == "keep this; ! and that, and more words here" and found[1]["n_words"] == "x"
    assert found[5]["text"] == data[4][1] and found[3]["text"] is None and found[4]["text"] == ""


@pytest.mark.parametrize("block_words", [1_000_000, 4])
def test_items_without_an_id_are_hit(rows, block_words):
    items = rows([(None, "one two three four"), (None, "one two"), (2, "alpha beta gamma delta"), (None, None)], "item_id bigint, text string")
    docs = rows([(1, "so one two three four and alpha beta gamma delta end", "x", 1)], DOCS)
    found = d.matches(docs, items, window=4, block_words=block_words, unnamed=True).first()
    assert flat(found["spans"]) == [1, 2, 3, 4, 6, 7, 8, 9] and found["items"] == ["2"]
    assert d.decontaminate(docs, items, 0.9, window=4).first()["text"] == "so  and  end"


def test_texts_are_scanned_and_cut_by_one_worker_a_task(rows, monkeypatch):
    items = rows([(1, "one two three four"), (2, "alpha beta gamma delta")], "item_id bigint, text string")
    docs = rows([(1, "é One two three four, then alpha beta gamma delta ö end of it all", "x", 1), (2, None, "x", 1)], DOCS)
    found = d.decontaminate(docs, items, 0.9, window=4)
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    wanted = [(1, "é , then  ö end of it all", "x", 1), (2, None, "x", 1)]
    assert sorted(map(tuple, found.collect())) == wanted
    # The items of several blocks are cut together, in the last scan.
    matches = d.matches
    monkeypatch.setattr(d, "matches", lambda *a, **b: matches(*a, **b, block_words=4))
    assert sorted(map(tuple, d.decontaminate(docs, items, 0.9, window=4).collect())) == wanted


def test_empty_tables(rows):
    docs, none = rows([(1, "a b", "x", 1)], DOCS), rows([], "item_id bigint, text string")
    assert [tuple(r) for r in d.matches(docs, none).select("n_words", "spans", "items").collect()] == [(2, [], [])]
    assert d.matches(rows([], DOCS), none).count() == 0
    assert d.decontaminate(docs, none).columns == docs.columns
