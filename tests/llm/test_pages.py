"""URL rules and page text."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lumenpath.llm import page_text as p
from lumenpath.llm import url_filter as u
from lumenpath.llm.queries import LISTED

# ---- urls -------------------------------------------------------------------------------------------

URLS = {
    "https://Blog.Example.ORG/en/12?x=1#y": ("blog.example.org", "/en/12", "example.org/en/1", "block"),
    "http://example.org": ("example.org", "", None, "allow"),
    "http://example.org/en/2": ("example.org", "/en/2", "org/", "allow"),
    "http://notexample.org/es/": ("notexample.org", "/es/", "org/", "allow"),
    "http://example.org/ES/": ("example.org", "/ES/", "org/", "allow"),
    "https://a.com/de/x": ("a.com", "/de/x", "com/de/", "block"),
    "https://a.com/fr/x": ("a.com", "/fr/x", "com/fr/", "allow"),
    "a://b.com?/de/": ("b.com", "", None, "allow"),
    "a://b.com#/de/": ("b.com", "", None, "allow"),
    "x://first.org/a://second.com/de/": ("first.org", "/a://second.com/de/", "org/", "allow"),
    "no scheme.org/en": ("", "", None, "allow"),
    "://": ("", "", None, "allow"),
    "": ("", "", None, "allow"),
    None: ("", "", None, "allow"),
    "s://ÄB.org/\nü": ("Äb.org", "/\nü", "org/", "allow"),
}


def test_hosts_paths_and_listed_rules(rows):
    data = [(k, url, "x", "y") for k, url in enumerate([*URLS, "http://example.org"])]
    found = u.judge(rows(data, "page_id bigint, url string, host string, rule string"), [], LISTED)
    assert found.columns == ["page_id", "url", "host", "path", "rule", "verdict", "mined_rule"]
    for row in found.collect():
        assert (row["host"], row["path"], row["rule"], row["verdict"]) == URLS[row["url"]], row


def test_mined_rules_equal_counting(rows):
    rnd = random.Random(3)
    data = []
    for _ in range(400):
        host, section, name = rnd.choice(["good", "spam", "mixed"]), rnd.choice(["a", "b"]), rnd.randint(1, 500)
        bad = host == "spam" or (host == "mixed" and section == "b" and rnd.random() < 0.9) or rnd.random() < 0.05
        data.append((f"https://www.{host}.com/{section}/{name}", "block" if bad else "allow"))
    labelled = rows([*data, (None, "block"), ("x", None)], "url string, label string")
    rules = u.mine(labelled, min_support=0.02, min_confidence=0.8)
    lists = {url: items for url, items in labelled.select("url", u.tokens(labelled["url"]).alias("t")).collect()}
    for items, label, confidence, support in rules:
        inside = [known for url, known in data if set(items) <= set(lists[url])]
        assert support == inside.count(label) and confidence == pytest.approx(support / len(inside)) and support >= 0.02 * len(data)
    said = {items: label for items, label, *_ in rules}
    assert said[("host1:spam",)] == "block" and ("host1:spam", "path0:a") not in said
    assert any(set(items) == {"host1:mixed", "path0:b"} for items, label in said.items() if label == "block")
    tests = ["http://www.spam.com/q", "http://www.mixed.com/b/77?z", "http://www.good.com/a/1", None]
    index = u.RuleIndex(rules)
    found = u.judge(rows([(t,) for t in tests], "url string"), rules).collect()
    assert [r["verdict"] for r in found] == ["block", "block", "allow", "allow"]
    lists = [r[0] for r in rows([(t,) for t in tests], "url string").select(u.tokens(F.col("url"))).collect()]
    for row, items in zip(found, lists):
        fits = [k for k, rule in enumerate(index.rules) if set(rule[0]) <= set(items)]
        assert index.match(items) == (min(fits) if fits else None)
        assert row["mined_rule"] == (" ".join(index.rules[min(fits)][0]) if fits else None)


def test_nothing_to_mine(rows):
    assert u.mine(rows([], "url string, label string")) == []
    assert u.judge(rows([], "url string"), []).collect() == []


# ---- pages ------------------------------------------------------------------------------------------

PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body><nav><ul><li><a>Home</a></li></ul></nav>"
    '<!-- ad <p>x</p> --><div class="ad">Buy {n}</div><article><header><h1>Head &amp; {n}</h1></header><p><b>One\n  two<br><p>x &lt;b&gt;\xa0y'
    '<div class="comments"><p>first!</p></div><p class="cookie-notice">ok?<p>shared <i>li</i>ne</p><form><p>mail</p></form></article>'
    "<aside>side</aside><footer>&copy; site {n}</footer>"
)
TEXT = "Head & {n}\nOne two\nx <b> y\nshared line"


def test_article_without_the_site(rows):
    data = [(k, f"http://h.org/a/{k % 7}", PAGE.replace("{n}", str(k % 9)), "x") for k in range(40)]
    data += [(100, None, None, "x"), (101, "http://h.org/b", "", "x"), (102, "http://h.org/c", "<p>plain", "x"), (103, None, "just text &amp", "x"), data[0]]
    frame = rows(data, "page_id bigint, url string, html string, text string").repartition(5)
    found = p.extract(frame)
    assert found.columns == ["page_id", "url", "text"]
    got = found.collect()
    assert len(got) == len(data)
    for row in got:
        wanted = {100: "", 101: "", 102: "plain", 103: "just text &"}.get(row["page_id"], TEXT.replace("{n}", str((row["page_id"] or 0) % 9)))
        assert row["text"] == wanted


def test_lines_shared_with_the_nearest_page_go(rows):
    page = lambda *lines: "".join(f"<div>{x}</div>" for x in lines)
    data = [
        ("http://a.org/x/1", page("site", "menu", "own one", "bottom")), ("http://a.org/x/2", page("site", "menu", "own two", "menu", "bottom")),
        ("http://a.org/y/1", page("other", "own three")), ("http://a.org/y/2", page("other", "own four")), ("http://b.org/x/1", page("site", "menu", "alone")),
    ]
    found = {r["url"]: r["text"] for r in p.extract(rows(data, "url string, html string").repartition(3)).collect()}
    assert list(found[url] for url, _ in data) == ["own one", "own two\nmenu", "own three", "own four", "site\nmenu\nalone"]


def test_differencing_decides_inside_an_article(rows):
    page = lambda own, *out: "".join(f"<div>{x}</div>" for x in out) + f"<main><p>Follow us</p><p>{own}</p><div class=ad>buy</div></main>"
    data = [("http://a.org/x/1", page("text of the first page", "site", "only here")), ("http://a.org/x/2", page("another text on the second", "site")),
            ("http://b.org/x", page("alone on its host", "site"))]
    found = {r["url"]: r["text"] for r in p.extract(rows(data, "url string, html string")).collect()}
    assert [found[url] for url, _ in data] == ["only here\ntext of the first page", "another text on the second", "Follow us\nalone on its host"]


def test_copies_of_an_article_keep_its_text(rows):
    page = lambda *own: "<article><p>Follow us</p>" + "".join(f"<p>{x}</p>" for x in own) + "</article>"
    copy = "a long line that all the copies have", "and another one"
    data = [(f"http://a.org/{k}", page(*copy, f"copy {k}")) for k in range(1, 6)] + [("http://a.org/6", page("quite another article on the host"))]
    found = {r["url"]: r["text"] for r in p.extract(rows(data, "url string, html string").repartition(4)).collect()}
    assert [found[url] for url, _ in data] == ["\n".join([*copy, f"copy {k}"]) for k in range(1, 6)] + ["quite another article on the host"]


def test_neighbours_do_not_depend_on_partitions(spark, rows):
    rnd = random.Random(5)
    page = lambda k: "".join(f"<p>{rnd.choice('abcdefg')}</p>" for _ in range(6)) + f"<p>own {k}</p>"
    data = [(f"http://h{rnd.randint(1, 3)}.org/{rnd.choice('xyz')}/{k}", page(k)) for k in range(60)]
    frame = rows(data, "url string, html string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        texts = []
        for n in (1, 2, 7, 40):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            texts.append(sorted(tuple(r) for r in p.extract(frame).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert texts.count(texts[0]) == 4
    order = sorted((p.Page(u_.split("/")[2], "/" + "/".join(u_.split("/")[3:]), 0, [x for x, _ in p.page_lines(h)]) for u_, h in data), key=lambda x: (x.host, x.path))
    wanted = []
    for k, one in enumerate(order):
        shared = set(one.shared(order[k - 1] if k else None, order[k + 1] if k + 1 < len(order) else None))
        wanted.append("\n".join(x for i, x in enumerate(one.lines) if i not in shared))
    assert sorted(t for _, t in texts[0]) == sorted(wanted)


def test_all_equal_pages_of_a_run_lose_the_site(spark, rows):
    page = lambda *lines: "".join(f"<div>{x}</div>" for x in lines)
    data = [("http://a.org/a/0", page("menu", "first", "bottom"))] + [(f"http://a.org/b/{k // 2:02d}?{k}", page("menu", "copied", "bottom")) for k in range(30)]
    data += [("http://a.org/b/zz", page("menu", "last")), ("http://b.org/b/1", page("menu", "copied", "bottom"))]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (1, 2, 9):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            found = {r["url"]: r["text"] for r in p.extract(rows(data, "url string, html string").repartition(5)).collect()}
            # The path of /b/zz begins alike for longer than that of /a/0.
            assert [found[url] for url, _ in data] == ["first"] + ["copied\nbottom"] * 30 + ["last", "menu\ncopied\nbottom"]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=14), st.lists(st.integers(0, 4), max_size=14))
def test_common_is_a_longest_common_subsequence(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for k, y in enumerate(b):
            table[i + 1][k + 1] = table[i][k] + 1 if x == y else max(table[i][k + 1], table[i + 1][k])
    found = [a[i] for i in sorted(p.common(a, b))]
    rest = iter(b)
    assert len(found) == table[-1][-1] and all(x in rest for x in found)


def test_markup_that_is_left_open():
    lines = lambda page: [x for x, place in p.page_lines(page) if place == p.PAGE]
    assert lines("<nav><ul><li>a<article><p>b</article><p>c") == ["b"]
    assert lines('<main><div class="comments"><article>no</article></div>yes</main>') == ["yes"]
    assert lines("<article>a<!-- never ends <p>b") == ["a"]
    assert lines('<article><a title="x > y" href=\'<p>\'>a</a> b <script>c') == ["a b"]
    assert lines('<article><p>a <span class="ad">no</span> b</article>') == ["a", "b"]
    assert p.page_lines(None) == [] and lines("<article>1 < 2 &unknown; &#233;</article>") == ["1 < 2 &unknown; é"]


def test_empty_table(rows):
    assert p.extract(rows([], "url string, html string")).collect() == []


@pytest.mark.parametrize("broken", ["<a " * 350_000, "<script '" * 110_000, "<!" * 500_000, "<a \"'<b ''<c \"" * 70_000, "<div>" * 200_000, "<!-- " * 200_000])
def test_a_broken_page_of_a_megabyte_takes_seconds(broken):
    import time

    start = time.process_time()
    assert p.page_lines("<p>before</p>" + broken)[:1] == [("before", p.OPEN)]
    assert time.process_time() - start < 20


def test_a_long_address_that_comes_again_and_again_is_mined(rows):
    long = "https://a.b.example.net/" + "/".join(f"part-{chr(97 + k % 26)}{chr(97 + k // 26)}x" for k in range(30)) + "?q=1"
    data = [(long, "block")] * 30 + [(f"https://other.example.com/{k}", "allow") for k in range(40)]
    rules = u.mine(rows(data, "url string, label string").repartition(2))
    held = [items for items, label, _, _ in rules if label == "block"]
    assert len(held) >= 60 and all(len(items) == 1 for items in held)
