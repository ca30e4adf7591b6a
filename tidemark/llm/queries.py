"""The registered queries of the operators, and their SQL where SQL can say them."""

from __future__ import annotations

import functools
import zlib

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import (
    divergence, exact, language, minhash, mixing, neighbours, perplexity, pieces, prefix_trie, quality, substring, token_counts, token_files,
)
from tidemark.llm.text import bounded_batches
from tidemark.session import scratch_path

QUERIES = {}
CHECKS: dict[str, str] = {}


def _query(build):
    @functools.wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        bounded_batches(spark)
        return build(spark, sf_dir)

    QUERIES[build.__name__] = run
    return run


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of near-duplicates of all documents; the smallest id of a class stays."""
    return minhash.near_duplicates(_table(spark, sf_dir, "documents")).select(
        "doc_id", "class_id", F.expr("doc_id <=> class_id").alias("kept"))


_PRIVATE = [(r"[^\s@]+@[^\s@]+", "<email>"), (r"\+?\d[\d .-]{7,}\d", "<number>")]


@_query
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents, before and after addresses and long numbers are replaced by a word."""
    counter = token_counts.load_counter(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return token_counts.recount(_table(spark, sf_dir, "documents"), token_counts.replacements(_PRIVATE), counter)


@_query
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, read back: where each starts, how long it is, and the checksum of its ids."""
    manifest = token_files.write_token_files(
        _table(spark, sf_dir, "documents"), scratch_path(spark, "token-files"),
        public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return token_files.fold_documents(
        spark, manifest, lambda ids: zlib.crc32(ids.astype("<u4").tobytes()), pa.int64(), "ids_crc32", "long")


@_query
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents, learned from the labels that are not held out."""
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed by source weights 1, 2, 3 to as many words as there are."""
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@_query
def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces and back: how many pieces, a hash of their ids, and whether decoding gives the text."""
    vocab = pieces.load(public_tokenizers.path("piece_bpe_32k.model"))
    coded = pieces.encode(_table(spark, sf_dir, "documents"), vocab)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), F.xxhash64("ids").alias("ids_hash"),
                        (pieces.decode("ids", vocab) == F.coalesce("text", F.lit(""))).alias("same_text"))


@_query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents, learned from those that are not held out."""
    return language.identify(_table(spark, sf_dir, "documents"))


@_query
def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings with a cosine of 0.98 or more within a label."""
    return neighbours.link_vectors(_table(spark, sf_dir, "embeddings"))


@_query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repetition rules and perplexity bands of all documents."""
    return perplexity.judge(_table(spark, sf_dir, "documents"))


@_query
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of all documents without the 50-word windows of smaller documents."""
    return substring.remove_repeats(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@_query
def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts over all documents; the largest id of a group stays."""
    return exact.exact_copies(_table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


CHECKS["op13_exact_dedup"] = f"""
with t as (select doc_id, sha256(translate(coalesce(text, ''), '{exact._UPPER}', '{exact._LOWER}')) as text_sha256 from documents)
select doc_id, first_value(doc_id) over o as keep_id, count(*) over (partition by text_sha256) as group_size,
  row_number() over o = 1 as kept, text_sha256
from t window o as (partition by text_sha256 order by doc_id desc nulls last)"""


@_query
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of a language lie apart, over all documents, and the terms that set each one off."""
    return divergence.audit(_table(spark, sf_dir, "documents"))


CHECKS["op12_source_divergence"] = f"""
with d as (select coalesce(text, '') as text, coalesce(lang, '') as lang, coalesce(source, '') as source,
    row_number() over () as id from documents),
w as (select lang, source, id, unnest(regexp_extract_all(translate(text, '{exact._UPPER}', '{exact._LOWER}'),
    '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term from d),
k as (select lang, term, count(*) as n from w group by all having count(distinct id) >= {divergence.MIN_DOCS}),
l as (select lang, sum(n) as total, count(*) as v from k group by all),
g as (select distinct lang, source from d),
c as (select w.lang, w.source, w.term, count(*) as n from w join k using (lang, term) group by all),
s as (select lang, source, sum(n) as total from c group by all),
p as (select g.lang, g.source, k.term, coalesce(c.n, 0) as n,
    1 + 1000000000 * (coalesce(c.n, 0) + 2)::hugeint // (coalesce(s.total, 0) + 2 * l.v)::hugeint as p,
    1 + 1000000000 * (k.n + 2)::hugeint // (l.total + 2 * l.v)::hugeint as q
  from g join k using (lang) join l using (lang) left join c using (lang, source, term) left join s using (lang, source)),
f as (select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value
  from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
r as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(f.value, 0) as value
  from g a join g b on a.lang = b.lang and a.source <> b.source
  left join f on f.lang = a.lang and f.source = a.source and f.item = b.source
  union all select lang, source, 'term', term, (p - q) * (p - q) // (p + q) from p where n > 0 and p > q),
o as (select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from r)
select lang, source, part, item, value::bigint as value, rank::int as rank from o
where part = 'pair' or rank <= {divergence.TOP_TERMS}"""


@_query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of the prefixes of all conversations, with what sharing a prefix saves."""
    return prefix_trie.conversation_trie(_table(spark, sf_dir, "conversations"))


# crc32 of a decimal number, bit by bit; a prefix is the list of its turns, and an ancestor is a shorter list at its front
CHECKS["op11_prefix_trie"] = """
with recursive c as (select distinct conv_id as c from conversations where conv_id is not null),
h as (select c, xor(4294967295, list_reduce(list_concat([4294967295::bigint], list_transform(string_split(c::varchar, ''), lambda x: ascii(x)::bigint)),
    lambda crc, b: list_reduce(list_concat([xor(crc, b)], range(8)), lambda r, i: xor(r >> 1, 3988292384 * (r & 1))))) % 9 as h from c),
t as (select conv_id as c, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first, role nulls first, text nulls first) as place
  from conversations where conv_id is not null),
s as (select h.c, list(struct_pack(role := t.role, text := t.text) order by t.part, t.place) filter (t.place is not null) as turns
  from h left join (select c, 1 as part, place, role, text, c as own from t union all select null, 0, place, role, text, c from t) t
    on (t.part = 1 and t.c = h.c and t.place > h.h) or (t.part = 0 and t.own = h.c - h.c % 5 and t.place <= h.h) group by h.c),
p as (select c, d as depth, turns[1:d] as prefix, len(turns) = d as ends from (select c, coalesce(turns, []) as turns from s), range(len(turns) + 1) r(d)),
n as (select depth, prefix, min(c) as conv_id, count(*) as n_convs,
    sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (ends), '')) as ends_sha256 from p group by depth, prefix),
x as (select n.*, u.conv_id as parent_conv_id, case when n.depth = 0 then 0 else (n_convs - 1) * strlen(n.prefix[n.depth].text) end as own
  from n left join (select conv_id, depth, prefix from n) u on u.depth = n.depth - 1 and u.prefix = n.prefix[1:n.depth - 1]),
k as (select parent_conv_id as conv_id, depth - 1 as depth, count(*) as n from x where depth > 0 group by all),
y as (select x.*, coalesce(k.n, 0) as n_children from x left join k using (conv_id, depth)),
a as (select y.conv_id, y.depth, y.n_children, y.own, unnest(range(y.depth + 1)) as up, prefix from y),
z as (select v.conv_id, v.depth, count(*) filter (a.n_children = 0) as n_leaves, sum(a.own) as saved_tokens
  from a join n v on v.depth = a.up and v.prefix = a.prefix[1:a.up] group by v.conv_id, v.depth)
select conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens::bigint as saved_tokens, ends_sha256 from y join z using (conv_id, depth)"""
