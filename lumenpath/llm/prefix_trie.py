"""Prefix trie of conversations, with subtree sums from balanced parentheses.

Turns are numbered within their conversation, which may first borrow the head of another one (``borrow_heads``).  A node is a
sequence of first turns that some conversation has; its 128-bit name is the exclusive or of hashes of (place, turn), so names of
long conversations are put together from names of blocks of ``BLOCK`` turns and no conversation has to fit one task.

Nodes with the same smallest member and the same number of members are a chain without branches: an edge.  The path of edges of
every smallest member, which is shorter than the square root of twice the number of turns, is dealt to shards in trie order.  A shard
writes its paths as balanced parentheses with the least excess of each block and of pairs, fours, ... of blocks above:
``findclose`` delimits a subtree, the rank of pairs ``()`` counts its leaves and a cumulative array sums its savings.  Edges on
the spines that several shards share have a part of their sums in each; the parts are added up by edge.

Turns are ordered by ``turn`` (null first), then by the MD5 of role and text.  Repeated rows are turns of their own.  Null roles and
texts are empty; rows without a ``conv_id`` are left out; other columns are not read.  No rows give no nodes, not even a root.
Turns are taken for equal when their MD5 is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenpath.llm.packing import cuts
from lumenpath.sources.staging import Stage

BLOCK = 4096  # turns of a conversation, or nodes of an edge, that are worked on together
RUN = 1 << 16  # edges of a shard; a longer path is a shard of its own
CHUNK = 1 << 16  # ids of a piece of a member list
ONE_WORD = r"[^\x20\x09-\x0D]+"
NODE = ("p1", "p2", "depth")


def number_turns(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``place`` (from 1), ``key`` and ``words`` of each turn, from ``conv_id``, ``turn``, ``role``, ``text``.

    A range sort deals even the turns of one conversation to many tasks; what comes before a task is added afterwards.
    """
    stage = Stage(turns.sparkSession, "turns")
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn",
        F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text))).alias("key"),
        F.regexp_count(text, F.lit(ONE_WORD)).cast("bigint").alias("words"), F.monotonically_increasing_id().alias("tie"),
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("key"), F.col("tie")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "key", "words", F.spark_partition_id().alias("part"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, passed = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("conv_id").to_numpy()
            begin = cuts(ids)
            place = np.arange(1, len(ids) + 1) - np.repeat(begin[:-1], np.diff(begin))
            if ids[0] == last:
                place[: begin[1]] += passed
            last, passed = ids[-1], int(place[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place, pa.int64())], names=[*batch.schema.names, "place"])

    found = stage.keep("ordered", lambda: rows.mapInArrow(number, "conv_id bigint, key binary, words bigint, part int, place bigint"))
    sizes = found.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    earlier = F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    # Only the first conversation of a part can have begun in an earlier one, so this has no more rows than there are parts.
    begun = stage.keep("begun", lambda: sizes.select("conv_id", "part", earlier.alias("earlier")).where("earlier > 0"))
    place = F.col("place") + F.coalesce("earlier", F.lit(0))
    return found.join(F.broadcast(begun), ["conv_id", "part"], "left").select("conv_id", place.alias("place"), "key", "words")


def _block(place: Column) -> Column:
    return F.floor((place - 1) / BLOCK)


def borrow_heads(numbered: DataFrame, lender: Column, heads: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with the first ``heads`` (at most ``most``) turns of another one and go on with their own turns after these.

    ``lender`` and ``heads`` are columns of ``conv_id``.  Returns the turns (``conv_id``, ``depth``, ``block``, ``key``, ``words``,
    ``is_last``) and the conversations (``conv_id``, ``n_turns``), those without turns included.
    """
    stage = Stage(numbered.sparkSession, "heads")
    sizes = stage.keep("sizes", lambda: numbered.groupBy("conv_id").agg(F.count("*").alias("n")))
    plan = sizes.select("conv_id", "n", lender.alias("lender"), heads.alias("heads"))
    lent = sizes.select(F.col("conv_id").alias("lender"), F.col("n").alias("lent"))
    plan = plan.join(lent, "lender", "left").withColumn("taken", F.least("heads", F.coalesce("lent", F.lit(0))))
    own = F.greatest(F.col("n") - F.col("heads"), F.lit(0))
    plan = stage.keep("plan", lambda: plan.select("conv_id", "n", "lender", "heads", "taken", (F.col("taken") + own).alias("n_turns")))

    first = numbered.where(F.col("place") <= most).select(F.col("conv_id").alias("lender"), F.col("place").alias("depth"), "key", "words")
    columns = ["conv_id", "depth", "block", "key", "words", (F.col("depth") == F.col("n_turns")).alias("is_last")]
    begin = plan.where("taken > 0").join(first, "lender").where("depth <= taken").withColumn("block", F.lit(0).cast("bigint"))
    blocks = plan.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), _block(F.col("n")))))
    rest = numbered.withColumn("block", _block(F.col("place"))).join(blocks, ["conv_id", "block"]).where("place > heads")
    rest = rest.withColumn("depth", F.col("place") - F.col("heads") + F.col("taken"))
    return begin.select(*columns).unionByName(rest.select(*columns)), plan.select("conv_id", "n_turns")


def _named(turns: DataFrame, stage: Stage) -> DataFrame:
    """The turns with the name of the node they lead to (``p1``, ``p2``), that of its parent (``q1``, ``q2``), and all words up to it."""
    place = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    hashed = turns.withColumns({"h1": F.xxhash64("key", "depth"), "h2": F.xxhash64(F.lit(1), "depth", "key")})
    within = hashed.select(
        "conv_id", "block", "depth", "h1", "h2", "words", "is_last", F.bit_xor("h1").over(place).alias("b1"), F.bit_xor("h2").over(place).alias("b2"),
        F.sum("words").over(place).alias("said"), F.row_number().over(Window.partitionBy("conv_id", "block").orderBy(F.desc("depth"))).alias("left"),
    )
    within = stage.keep("within", lambda: within)
    # What full blocks add to the next ones: one row for each BLOCK turns of a long conversation.
    passed = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    ends = within.where("left = 1 and not is_last").select(
        "conv_id", (F.col("block") + 1).alias("block"), F.bit_xor("b1").over(passed).alias("a1"), F.bit_xor("b2").over(passed).alias("a2"), F.sum("said").over(passed).alias("a3"),
    )
    ends = stage.keep("blocks", lambda: ends)
    zero = F.lit(0).cast("bigint")
    whole = within.join(ends, ["conv_id", "block"], "left")
    p1, p2 = F.col("b1").bitwiseXOR(F.coalesce("a1", zero)), F.col("b2").bitwiseXOR(F.coalesce("a2", zero))
    return whole.select(
        "conv_id", "block", "depth", "words", "is_last", p1.alias("p1"), p2.alias("p2"), p1.bitwiseXOR(F.col("h1")).alias("q1"),
        p2.bitwiseXOR(F.col("h2")).alias("q2"), (F.col("said") + F.coalesce("a3", zero)).alias("said"),
    )


class Parentheses:
    """Balanced parentheses; ``lows`` has the least excess of each block, and of pairs, fours, ... of blocks."""

    WIDTH = 64

    def __init__(self, opens: np.ndarray):
        self.opens = opens
        excess = np.cumsum(np.where(opens, 1, -1)).astype(np.int32)
        padded = np.full(-(-max(len(excess), 1) // self.WIDTH) * self.WIDTH, np.iinfo(np.int32).max, np.int32)
        padded[: len(excess)] = excess
        self.excess, self.blocks = excess, padded.reshape(-1, self.WIDTH)
        self.lows = [self.blocks.min(axis=1)]
        while len(self.lows[-1]) > 1:
            low = self.lows[-1]
            low = np.append(low, np.iinfo(np.int32).max) if len(low) % 2 else low
            self.lows.append(low.reshape(-1, 2).min(axis=1))

    def findclose(self, at: np.ndarray) -> np.ndarray:
        """Where the parentheses opened at ``at`` are closed: the first place after with an excess that is lower by one."""
        target, block, column = self.excess[at] - 1, at // self.WIDTH, np.arange(self.WIDTH)
        hit = (self.blocks[block] <= target[:, None]) & (column > (at % self.WIDTH)[:, None])
        inside = hit.any(axis=1)
        close = block * self.WIDTH + hit.argmax(axis=1)
        far = np.flatnonzero(~inside)
        if len(far):
            node, target = block[far], target[far]
            level, climbing = np.zeros(len(far), np.int64), np.ones(len(far), bool)
            for height, low in enumerate(self.lows):
                right = np.minimum(node + 1, len(low) - 1)
                stop = climbing & (node % 2 == 0) & (node + 1 < len(low)) & (low[right] <= target)
                node, level, climbing = np.where(stop, node + 1, np.where(climbing, node // 2, node)), np.where(stop, height, level), climbing & ~stop
            for height in range(len(self.lows) - 1, 0, -1):
                down = level == height
                left = np.where(down, node * 2, 0)
                child = left + (self.lows[height - 1][left] > target)
                node, level = np.where(down, child, node), np.where(down, height - 1, level)
            close[far] = node * self.WIDTH + (self.blocks[node] <= target[:, None]).argmax(axis=1)
        return close

    def within(self, at: np.ndarray, close: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Sums of values, given by place, between each opening and its close."""
        total = np.append(0, np.cumsum(values))
        return total[close + 1] - total[at]


def _subtrees(paths: list[tuple[int, list[tuple[int, int]], list[int | None], bool]]) -> list[tuple]:
    """Sums of a shard for (conv_id, top) of each edge on its paths, and for the root.

    A path: its conversation, the edges as (top, conv_id), the savings of those that are its own, and whether it ends in a leaf.
    """
    opens, edges, saved, leaf, above, stack, before = [True], [(0, None)], [0], [False], [None], [0], []
    for conv_id, way, own, ends in paths:
        shared = 0
        while shared < min(len(way), len(before)) and way[shared] == before[shared]:
            shared += 1
        opens += [False] * (len(before) - shared) + [True] * (len(way) - shared)
        del stack[shared + 1 :]
        for k in range(shared, len(way)):
            stack.append(len(edges))
            edges.append(way[k])
            saved.append(0)
            leaf.append(False)
            above.append(None)
        for k, amount in enumerate(own):
            if amount is not None:
                saved[stack[k + 1]], above[stack[k + 1]] = amount, way[k - 1][1] if k else None
        leaf[stack[-1]] = ends
        before = way
    opens += [False] * (len(before) + 1)
    trie = Parentheses(np.array(opens))
    at = np.flatnonzero(trie.opens)
    close = trie.findclose(at)
    weights, pairs = np.zeros(len(opens), np.int64), np.zeros(len(opens), np.int64)
    weights[at] = saved
    pairs[at] = np.array(leaf) & (close == at + 1)
    return [
        (conv_id, top, n_leaves, total, parent)
        for (top, conv_id), n_leaves, total, parent in zip(edges, trie.within(at, close, pairs).tolist(), trie.within(at, close, weights).tolist(), above)
    ]


def _shards(paths: DataFrame) -> DataFrame:
    """``edge_conv`` (null for the root), ``top``, ``n_leaves``, ``saved``, ``above``: parts of the sums of each edge."""
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    names = ["edge_conv", "top", "n_leaves", "saved", "above"]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*_subtrees(held)), kinds)], names=names)

        for batch in batches:
            for conv_id, way, own, ends in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "way", "own", "ends"))):
                if held and size + len(way) > RUN:
                    yield flush()
                    held, size = [], 0
                held.append((conv_id, [(e["top"], e["edge_conv"]) for e in way], own, ends))
                size += len(way)
        if held:
            yield flush()

    return paths.mapInArrow(sums, ", ".join(f"{n} bigint" for n in names))


def _member_digests(ends: DataFrame) -> DataFrame:
    """``ends_sha256`` by node: the digest of the sorted ids, joined by commas, of the conversations that end there.

    Ids are sorted over all tasks and travel in pieces of text; the digest itself is taken piece by piece.
    """
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ids = None, []
        for batch in batches:
            out = []
            for p1, p2, depth, conv_id in zip(*(batch.column(c).to_pylist() for c in (*NODE, "conv_id"))):
                if (p1, p2, depth) != held or len(ids) >= CHUNK:
                    if ids:
                        out.append((*held, ids[0], ",".join(map(str, ids)).encode()))
                    held, ids = (p1, p2, depth), []
                ids.append(conv_id)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kinds)], names=[*NODE, "first", "piece"])
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((*held, ids[0], ",".join(map(str, ids)).encode()), kinds)], names=[*NODE, "first", "piece"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, state = None, None
        for batch in batches:
            out = []
            for p1, p2, depth, piece in zip(*(batch.column(c).to_pylist() for c in (*NODE, "piece"))):
                if (p1, p2, depth) == held:
                    state.update(b"," + piece)
                    continue
                if held:
                    out.append((*held, state.hexdigest()))
                held, state = (p1, p2, depth), hashlib.sha256(piece)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), [*kinds[:3], pa.string()])], names=[*NODE, "ends_sha256"])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((*held, state.hexdigest()), [*kinds[:3], pa.string()])], names=[*NODE, "ends_sha256"])

    key = "p1 bigint, p2 bigint, depth bigint"
    found = ends.repartitionByRange(*NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id").mapInArrow(pieces, f"{key}, first bigint, piece binary")
    return found.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInArrow(digests, f"{key}, ends_sha256 string")


def prefix_trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` (words that members of the subtree's nodes need not store again) and ``ends_sha256``.

    ``turns`` and ``conversations`` are as ``borrow_heads`` returns them.
    """
    spark = turns.sparkSession
    stage = Stage(spark, "prefix_trie")
    all_of = conversations.agg(F.min("conv_id").alias("least"), F.count("*").alias("n")).first()
    least, total = F.lit(all_of.least).cast("bigint"), F.lit(all_of.n).cast("bigint")
    named = _named(turns, stage)
    nodes = stage.keep("nodes", lambda: named.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("words").alias("words"), F.max("said").alias("said"),
        F.max("q1").alias("q1"), F.max("q2").alias("q2"),
    ))
    name, parent = F.struct("p1", "p2"), F.struct("q1", "q2")
    edges = stage.keep("edges", lambda: nodes.groupBy("conv_id", "n_convs").agg(
        F.min("depth").alias("top"), F.max("depth").alias("bottom"), F.max("said").alias("said"), F.min(F.col("said") - F.col("words")).alias("heard"),
        F.min_by(name, "depth").alias("first"), F.max_by(name, "depth").alias("last"), F.min_by(parent, "depth").alias("parent"),
    ))
    children = edges.groupBy(F.col("parent.q1").alias("p1"), F.col("parent.q2").alias("p2"), (F.col("top") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    children = stage.keep("children", lambda: children)
    bottoms = edges.select("*", F.col("last.p1").alias("p1"), F.col("last.p2").alias("p2"), F.col("bottom").alias("depth"))
    grown = bottoms.join(children, [*NODE], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("bigint"))).drop(*NODE)
    grown = stage.keep("grown", lambda: grown)

    # The path of each smallest member: edges of smaller ones down to where its own begin, then its own.
    begins = grown.groupBy("conv_id").agg(F.min("top").alias("begin")).where("begin > 1")
    # Place minus depth is the number of turns that were not borrowed: block 0 and one more block cover it.
    reach = begins.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), _block(F.col("begin")) + 1)))
    shared = named.select("conv_id", "block", *NODE).join(reach, ["conv_id", "block"]).where("depth < begin")
    tops = edges.select(F.col("first.p1").alias("p1"), F.col("first.p2").alias("p2"), F.col("top").alias("depth"), F.col("conv_id").alias("edge_conv"))
    none = F.lit(None).cast("bigint")
    upper = shared.join(tops, [*NODE]).select("conv_id", F.col("depth").alias("top"), "edge_conv", none.alias("own"), F.lit(False).alias("ends"))
    saving = (F.col("n_convs") - 1) * (F.col("said") - F.col("heard"))
    lower = grown.select("conv_id", "top", F.col("conv_id").alias("edge_conv"), saving.alias("own"), (F.col("n_children") == 0).alias("ends"))
    steps = F.array_sort(F.collect_list(F.struct("top", "edge_conv", "own", "ends")))
    paths = upper.unionByName(lower).groupBy("conv_id").agg(steps.alias("steps")).select(
        "conv_id", F.transform("steps", lambda s: F.struct(s.top.alias("top"), s.edge_conv.alias("edge_conv"))).alias("way"),
        F.transform("steps", lambda s: s.own).alias("own"), F.element_at("steps", -1).ends.alias("ends"),
    )
    parts = _shards(paths.repartitionByRange("way").sortWithinPartitions("way"))
    sums = stage.keep("sums", lambda: parts.groupBy("edge_conv", "top").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"), F.max("above").alias("above")))

    whole = grown.join(sums.withColumnRenamed("edge_conv", "conv_id"), ["conv_id", "top"])
    whole = whole.withColumn("piece", F.explode(F.sequence(F.floor(F.col("top") / BLOCK), F.floor(F.col("bottom") / BLOCK))))
    whole = whole.select("conv_id", "n_convs", "piece", "top", "bottom", "heard", "n_children", "n_leaves", "saved", "above")
    heard = F.col("said") - F.col("words") - F.col("heard")  # words of the nodes above on the same edge
    found = nodes.withColumn("piece", F.floor(F.col("depth") / BLOCK)).join(whole, ["conv_id", "n_convs", "piece"]).select(
        *NODE, "conv_id", F.when(F.col("depth") == F.col("top"), F.coalesce("above", least)).otherwise(F.col("conv_id")).alias("parent_conv_id"), "n_convs",
        F.when(F.col("depth") == F.col("bottom"), F.col("n_children")).otherwise(F.lit(1)).cast("bigint").alias("n_children"), "n_leaves",
        (F.col("saved") - (F.col("n_convs") - 1) * heard).alias("saved_tokens"),
    )
    zero = F.lit(0).cast("bigint")
    at_root = spark.range(1).where(total > 0).select(*[F.col("id").alias(name) for name in NODE])
    root = at_root.join(children, [*NODE], "left").join(sums.where("top = 0").withColumnRenamed("top", "depth"), "depth", "left").select(
        *NODE, least.alias("conv_id"), none.alias("parent_conv_id"), total.alias("n_convs"), F.coalesce("n_children", zero).alias("n_children"),
        F.coalesce("n_leaves", F.lit(1).cast("bigint")).alias("n_leaves"), F.coalesce("saved", zero).alias("saved_tokens"),
    )
    ends = named.where("is_last").select(*NODE, "conv_id")
    ends = ends.unionByName(conversations.where("n_turns = 0").select(zero.alias("p1"), zero.alias("p2"), zero.alias("depth"), "conv_id"))
    digest = F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")
    return found.unionByName(root).join(_member_digests(ends), [*NODE], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", digest
    )
