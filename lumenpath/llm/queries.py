"""The registered query of each operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenpath.llm import block_neighbours, bpe, decontaminate, hamming, jaccard, language, language_model, lexical, line_dedup, page_text, prefix_trie, quality, url_filter

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    LLM_QUERIES[build.__name__] = build
    return build


def remainder(n: int):
    """crc32 of a document's id as text, modulo n; rows without an id get null."""
    return F.crc32(F.col("doc_id").cast("string")) % n


LISTED = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


@query
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path and verdict of every page's URL.

    A page's label is the verdict of the listed rule that fits it, or else follows from ``labels`` of the document whose
    number ends its path: block if it is toxic or of poor quality.
    """
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    bad = F.max(((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")) == 1
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.when(bad, "block").otherwise("allow").alias("known"))
    url = F.col("url")
    named = pages.select("url", F.expr("try_cast(regexp_extract(split(split(url, '[?]')[0], '#')[0], '/([0-9]+)[^0-9/]*/?$', 1) as bigint)").alias("doc_id"))
    verdict = url_filter.listed(url_filter.host(url), url_filter.path(url), LISTED)[1]
    labelled = named.join(labels, "doc_id", "left").select("url", F.coalesce(verdict, "known").alias("label"))
    judged = url_filter.judge(pages, url_filter.mine(labelled), LISTED)
    return judged.select("page_id", "host", "path", "rule", "verdict", "mined_rule")


@query
def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    texts = page_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return texts.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


@query
def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model of those whose remainder is not 2."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(remainder(7) == 2, F.lit(False))
    scored = language_model.score(docs, docs.where(~held_out))
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents that share at least 80 of 100 word shingles with another one of the group."""
    return jaccard.jaccard_groups(table(spark, sf_dir, "documents"))


@query
def op5_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of each text and the bytes they decode to."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    decoded = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path, public_tokenizers.PATTERN, decoded=True)
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by profiles of those whose remainder is not 2."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(remainder(4) == 2, F.lit(False))
    profiles = language.learn(docs.where(~held_out))
    found = language.identify(docs.select("doc_id", "text"), profiles)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability that a document is of good quality; documents with remainder 2 are not learned from."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(remainder(4) != 2).select("doc_id", F.col("quality").alias("label"))
    scored = quality.score(docs, quality.fit(docs, labels))
    held_out = F.coalesce(remainder(4) == 2, F.lit(False)).alias("held_out")
    return scored.select("doc_id", held_out, "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each document, and how many of them go because other documents hold them too."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    return line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", kept)


LLM_ORACLES["op8_line_dedup"] = r"""
with lines as (
    select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as place
    from documents
), keys as (
    select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
    from lines
), spread as (
    select key, max(doc_id) as keeper from keys where length(key) >= 40
    group by key having count(distinct doc_id) >= 5
), judged as (
    select k.*, s.key is not null and k.doc_id <> s.keeper as gone from keys k left join spread s on k.key = s.key
)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by place) filter (where not gone), '')) as kept_sha256
from judged group by doc_id
"""


@query
def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that lie inside windows of benchmark items, and the items they come from."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.matches(docs, table(spark, sf_dir, "benchmark"), unnamed=True)
    return found.select(
        "doc_id", "n_words", decontaminate.n_hit(), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )


@query
def op10_exact_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors, by Hamming distance of sign codes, of every vector whose id is divisible by 20."""
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return hamming.nearest(vectors, vectors.where(F.col("id") % 20 == 0), k=10)


LLM_ORACLES["op10_exact_topk_search"] = """
with codes as (
    select distinct vec_id as id, list_transform(embedding, lambda x: case when x > 0 then 1 else 0 end) as code
    from embeddings where vec_id is not null and len(embedding) = 64
), pairs as (
    select q.id as query_id, q.code as query, d.id as neighbor_id, d.code as code,
           cast(list_sum(list_transform(list_zip(q.code, d.code), lambda p: case when p[1] <> p[2] then 1 else 0 end)) as integer) as distance
    from codes q, codes d where q.id % 20 = 0 and not (q.id = d.id and q.code = d.code)
), ranked as (
    select *, cast(row_number() over (partition by query_id, query order by distance, neighbor_id, code) as integer) as rank from pairs
)
select query_id, rank, neighbor_id, distance from ranked where rank <= 10
"""


@query
def op11_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nodes of the trie of conversations that begin with up to three turns of another one."""
    numbered = prefix_trie.number_turns(table(spark, sf_dir, "conversations"))
    conv_id = F.col("conv_id")
    turns, conversations = prefix_trie.borrow_heads(numbered, conv_id - conv_id % 20, F.crc32(conv_id.cast("string")) % 4, most=3)
    return prefix_trie.prefix_trie(turns, conversations)


LLM_ORACLES["op11_conversation_prefix_trie"] = r"""
with recursive shifts(byte, step, value) as (
    select range, 0, range from range(256)
    union all
    select byte, step + 1, case when value & 1 = 1 then xor(value >> 1, 3988292384) else value >> 1 end from shifts where step < 8
), crc_table as (
    select byte, value from shifts where step = 8
), crc(conv_id, digits, place, value) as (
    select distinct conv_id, cast(conv_id as varchar), 0, 4294967295 from conversations where conv_id is not null
    union all
    select c.conv_id, c.digits, c.place + 1, xor(c.value >> 8, t.value)
    from crc c join crc_table t on t.byte = xor(c.value, ascii(substr(c.digits, c.place + 1, 1))) & 255 where c.place < length(c.digits)
), heads as (
    select conv_id, conv_id - conv_id % 20 as lender, xor(value, 4294967295) % 4 as heads from crc where place = length(digits)
), texts as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null
), hashed as (
    select conv_id, turn, md5(length(role) || ':' || role || text) as key, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) as words from texts
), numbered as (
    select *, row_number() over (partition by conv_id order by turn nulls first, key) as place from hashed
), lent as (
    select h.conv_id, n.place as depth, n.key, n.words from heads h join numbered n on n.conv_id = h.lender where n.place <= h.heads
), taken as (
    select h.conv_id, h.heads, count(l.depth) as taken from heads h left join lent l on l.conv_id = h.conv_id group by all
), rebuilt as (
    select * from lent
    union all
    select n.conv_id, n.place - t.heads + t.taken, n.key, n.words from numbered n join taken t on t.conv_id = n.conv_id where n.place > t.heads
), named as (
    select conv_id, depth, words, string_agg(key, '') over (partition by conv_id order by depth rows unbounded preceding) as node from rebuilt
    union all
    select conv_id, 0, 0, '' from heads
), linked as (
    select *, lag(node) over (partition by conv_id order by depth) as parent, lead(node) over (partition by conv_id order by depth) is null as is_end from named
), nodes as (
    select node, depth, min(conv_id) as conv_id, any_value(parent) as parent, count(*) as n_convs, max(words) as words,
           sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (where is_end), '')) as ends_sha256
    from linked group by node, depth
), children as (
    select parent, count(*) as n_children from nodes where parent is not null group by parent
), grown as (
    select n.*, coalesce(c.n_children, 0) as n_children from nodes n left join children c on c.parent = n.node
), sums as (
    select a.node, count(*) filter (where g.n_children = 0) as n_leaves, cast(sum((g.n_convs - 1) * g.words) as bigint) as saved_tokens
    from grown g join named a on a.conv_id = g.conv_id and a.depth <= g.depth group by a.node
)
select g.conv_id, cast(g.depth as bigint) as depth, p.conv_id as parent_conv_id, g.n_convs, g.n_children, s.n_leaves, s.saved_tokens, g.ends_sha256
from grown g join sums s on s.node = g.node left join nodes p on p.node = g.parent
"""


@query
def op12_approximate_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors, by Euclidean distance, of every vector whose id is divisible by 100."""
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return block_neighbours.nearest(vectors, vectors.where(F.col("id") % 100 == 0), k=10)


LLM_ORACLES["op12_approximate_nearest_neighbours"] = """
with vectors as (
    select distinct vec_id, cast(embedding as double[]) as vector from embeddings
    where vec_id is not null and len(embedding) > 0 and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))
      and list_bool_or(list_transform(embedding, lambda x: x <> 0))
), pairs as (
    select q.vec_id as query_id, q.vector as query, d.vec_id, list_distance(q.vector, d.vector) as score
    from vectors q join vectors d on len(q.vector) = len(d.vector) and (q.vec_id <> d.vec_id or q.vector <> d.vector) where q.vec_id % 100 = 0
), ranked as (
    select *, cast(row_number() over (partition by query_id, query order by score, vec_id) as integer) as rank from pairs
)
select query_id, rank, vec_id, score from ranked where rank <= 10
"""


@query
def op13_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 documents that score highest for each benchmark item."""
    return lexical.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


LLM_ORACLES["op13_ranked_lexical_search"] = r"""
with words as (
    select row_number() over () as doc, doc_id,
           unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from documents
), counts as (
    select doc, doc_id, term, count(*) as tf from words group by doc, doc_id, term
), lengths as (
    select doc, cast(sum(tf) as bigint) as n from counts group by doc
), corpus as (
    select count(*) as docs, cast(sum(n) as bigint) as terms from lengths
), spread as (
    select term, count(*) as df from counts group by term
), asked as (
    select item, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from (select row_number() over () as item, item_id, text from (select distinct item_id, text from benchmark))
), weighed as (
    select a.item, a.item_id, a.term, cast(floor(1000 * ln((2 * c.docs + 2) / (2 * s.df + 1))) as bigint) as w
    from asked a join spread s on s.term = a.term cross join corpus c
), scored as (
    select w.item, w.item_id, t.doc, t.doc_id,
           cast(sum(w.w * ((1000000000 * t.tf) // (1000 * t.tf + 8 * (25 + (75 * l.n * c.docs) // c.terms)))) as bigint) as score
    from weighed w join counts t on t.term = w.term join lengths l on l.doc = t.doc cross join corpus c group by all
), ranked as (
    select *, cast(row_number() over (partition by item order by score desc, doc_id nulls last) as integer) as rank from scored where score > 0
)
select item_id, rank, doc_id, score from ranked where rank <= 10
"""
