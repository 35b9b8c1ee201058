"""URL filter by association rules over URL tokens.

A URL's tokens are its scheme, the labels of its host by level, its host's ending, the segments of its path by place with
digits folded, words within segments, and the names of its query parameters.  FP-growth mines, over all labelled URLs,
which combinations of at most ``MAX_TOKENS`` tokens go with a label.  A combination becomes a rule when enough URLs support
it and its confidence lies above both the limit and the share of the label among all labelled URLs; a rule that a shorter
rule of the same label with at least its confidence already covers is pruned.

Rules match by inverted index: each rule stands under each of its tokens, and a URL fulfils a rule when it has counted all of
them.  Of the rules a URL fulfils the most confident decides, then the larger support, then the rule's text; without any,
the default does.  Listed rules of hosts and paths come first and are kept apart from the mined ones.

The number of rules is bounded by the number of frequent token sets, at most C(tokens of a URL, <= 3) / min_support,
whatever the number of URLs; they are broadcast.  Very long URLs: tokens that stand in the very same URLs are mined as one, so a long
address that is repeated costs no more than a short one; URLs that share more than about 25 frequent tokens in many different
combinations are still listed set by set, which takes twice as long with each such token.  Null URLs and URLs without ``://`` have no host, path or tokens and
get the default.  Repeated URLs are judged alike.  Without labels nothing is mined.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import pyarrow as pa
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MIN_SUPPORT, MIN_COUNT, MIN_CONFIDENCE, MAX_TOKENS = 0.002, 20, 0.6, 3
ALLOW, BLOCK = "allow", "block"
LABEL = "label="
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def tokens(url: Column) -> Column:
    """The distinct tokens of a URL."""
    labels = F.reverse(F.split(host(url), r"\."))
    segments = F.filter(F.split(path(url), "/"), lambda x: x != "")
    folded = F.transform(segments, lambda x: F.regexp_replace(F.translate(x, UPPER, LOWER), "[0-9]+", "0"))
    names = F.filter(F.split(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\?([^#]*)", 1), "&"), lambda x: x != "")
    words = F.flatten(F.transform(folded, lambda x: F.filter(F.split(x, r"[^\p{L}\p{N}]+"), lambda w: w != "")))
    every = F.concat(
        F.array(F.concat(F.lit("scheme:"), F.regexp_extract(url, r"(?s)^(.*?)://", 1))),
        F.transform(labels, lambda x, i: F.concat(F.lit("host"), i.cast("string"), F.lit(":"), x)),
        F.transform(folded, lambda x, i: F.concat(F.lit("path"), i.cast("string"), F.lit(":"), x)),
        F.transform(words, lambda x: F.concat(F.lit("word:"), x)),
        F.transform(names, lambda x: F.concat(F.lit("query:"), F.regexp_extract(x, "^([^=]*)", 1))),
    )
    return F.when(F.instr(url, "://") > 0, F.array_distinct(every)).otherwise(F.array().cast("array<string>"))


def _interchangeable(baskets: DataFrame, least: float) -> dict[str, list[str]]:
    """Tokens that stand in the very same URLs, by the first of them; of tokens that are frequent alone, which support bounds in number."""
    mark = lambda k: F.sum(F.xxhash64(F.lit(k), "items").cast("decimal(20,0)")).alias(f"mark{k}")
    seen = baskets.select(F.explode("items").alias("token"), "items").where(~F.col("token").startswith(LABEL))
    same = seen.groupBy("token").agg(F.count("*").alias("n"), mark(1), mark(2)).where(F.col("n") >= least)
    groups = same.groupBy("n", "mark1", "mark2").agg(F.array_sort(F.collect_list("token")).alias("tokens")).where(F.size("tokens") > 1)
    return {row.tokens[0]: row.tokens for row in groups.select("tokens").collect()}


def mine(
    labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, max_tokens: int = MAX_TOKENS, min_count: int = MIN_COUNT
) -> list[tuple]:
    """Rules (tokens, label, confidence, support) from all rows ``url``, ``label``.

    A rule is supported by a share of ``min_support`` of all labelled URLs and by ``min_count`` of them.
    """
    baskets = labelled.where("url is not null and label is not null").select(
        F.concat(tokens(F.col("url")), F.array(F.concat(F.lit(LABEL), "label"))).alias("items")
    )
    shares = {r["label"]: r["count"] for r in labelled.where("url is not null and label is not null").groupBy("label").count().collect()}
    total = sum(shares.values())
    if not total:
        return []
    support = max(min_support, min(1.0, min_count / total))
    # Tokens that never part, such as those of one address that comes again and again, are mined as one: FP-growth lists every
    # frequent set, and sets of such tokens alone would double with each of them while no longer set of them says more.
    alike = _interchangeable(baskets, support * total)
    spare = [token for tokens in alike.values() for token in tokens[1:]]
    if spare:
        baskets = baskets.select(F.array_except("items", F.array(*[F.lit(t) for t in spare])).alias("items"))
    sets = FPGrowth(itemsCol="items", minSupport=support, minConfidence=0.0).fit(baskets).freqItemsets
    sets = sets.withColumn("label", F.get(F.filter("items", lambda x: x.startswith(LABEL)), F.lit(0)))
    sets = sets.withColumn("tokens", F.array_sort(F.filter("items", lambda x: ~x.startswith(LABEL))))
    sets = sets.where(F.size("tokens").between(1, max_tokens)).select("tokens", "label", "freq")
    plain = sets.where("label is null").select("tokens", F.col("freq").alias("all"))
    found = sets.where("label is not null").join(plain, "tokens").withColumn("confidence", F.col("freq") / F.col("all"))
    rules = found.where(F.col("confidence") >= min_confidence).collect()
    strong = [
        (frozenset(r["tokens"]), r["label"].removeprefix(LABEL), r["confidence"], r["freq"]) for r in rules
        if r["confidence"] > shares[r["label"].removeprefix(LABEL)] / total
    ]
    best: dict[tuple, float] = {}
    kept = []
    for rule in sorted(strong, key=lambda r: (len(r[0]), sorted(r[0]))):
        items, label, confidence, _ = rule
        shorter = [items - {x} for x in items] + [frozenset({x}) for x in items] if len(items) > 1 else []
        if all(best.get((some, label), 0) < confidence for some in shorter):
            kept.append(rule)
        best[items, label] = max([confidence, *(best.get((some, label), 0) for some in shorter)])
    each = [
        (tuple(sorted(named)), label, confidence, freq) for items, label, confidence, freq in kept for named in product(*(alike.get(x, [x]) for x in items))
    ]
    return sorted(each, key=lambda r: (len(r[0]), r[0]))


class RuleIndex:
    """Mined rules by token."""

    def __init__(self, rules: list[tuple]):
        self.rules = sorted(rules, key=lambda r: (-r[2], -r[3], r[0], r[1]))
        self.lists: dict[str, list[int]] = {}
        for k, (items, *_) in enumerate(self.rules):
            for item in items:
                self.lists.setdefault(item, []).append(k)
        self.needs = [len(r[0]) for r in self.rules]

    def match(self, items: list[str]) -> int | None:
        """The number of the best rule whose tokens are all there."""
        seen: dict[int, int] = {}
        best = None
        for item in items:
            for k in self.lists.get(item, ()):
                seen[k] = seen.get(k, 0) + 1
                if seen[k] == self.needs[k] and (best is None or k < best):
                    best = k
        return best


def listed(host_: Column, path_: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Text and verdict of the longest listed rule (verdict, host, start of the path) that fits; null if none does.

    A rule fits its host and all hosts below it.  Of two rules of one length the smaller text wins.
    """
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, name, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), [-ord(c) for c in r[1] + r[2]])):
        fits = ((host_ == name) | host_.endswith("." + name)) & path_.startswith(start)
        text, verdict = F.when(fits, F.lit(name + start)).otherwise(text), F.when(fits, F.lit(kind)).otherwise(verdict)
    return text, verdict


def judge(pages: DataFrame, mined: list[tuple], rules: list[tuple[str, str, str]] = (), default: str = ALLOW) -> DataFrame:
    """The rows, which have ``url``, with ``host``, ``path``, ``rule``, ``verdict`` and ``mined_rule``.

    Columns of these names that the rows bring are replaced.  ``mined_rule`` is the mined rule a URL fulfils, if any.
    """
    pages = pages.drop("host", "path", "rule", "verdict", "mined_rule")
    url = F.col("url")
    named = pages.select("*", host(url).alias("host"), path(url).alias("path"), tokens(url).alias("__tokens"))
    index = pages.sparkSession.sparkContext.broadcast(mined)
    schema = T.StructType([f for f in named.schema.fields if f.name != "__tokens"])
    schema = T.StructType([*schema.fields, T.StructField("mined_rule", T.StringType()), T.StructField("mined_verdict", T.StringType())])
    kept = [f.name for f in schema.fields[:-2]]

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = RuleIndex(index.value)
        for batch in batches:
            found = [held.match(items) for items in batch.column("__tokens").to_pylist()]
            texts = [" ".join(held.rules[k][0]) if k is not None else None for k in found]
            verdicts = [held.rules[k][1] if k is not None else None for k in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + [pa.array(texts, pa.string()), pa.array(verdicts, pa.string())], names=schema.fieldNames()
            )

    rule, verdict = listed(F.col("host"), F.col("path"), list(rules))
    return named.mapInArrow(match, schema).select(
        *[f"`{c}`" for c in kept], rule.alias("rule"), F.coalesce(verdict, "mined_verdict", F.lit(default)).alias("verdict"), "mined_rule"
    )
