"""The registered queries of the training-data operators and their DuckDB SQL."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from quarry.llm import (chat_format, compact_windows, conversation_trie, crf_langid, embed_dedup, fim, idfile, mixing, quality_gbt, secrets,
                        sentencepiece_codec, simhash, warc)
from quarry.llm.common import shared_path

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        LLM_QUERIES[name] = fn
        if sql:
            LLM_ORACLE_SQL[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query("op1_repeated_passages")
def op1_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that (nearly) repeat in another document, and the class of the documents they connect."""
    return compact_windows.repeated_passages(table(spark, sf_dir, "documents"), components=True)


@query("op2_sentencepiece")
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of each text's SentencePiece ids and of what they decode to."""
    coded = sentencepiece_codec.encode_and_decode(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"),
                                                  keep=["doc_id"])
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join("ids", " ").cast("binary"), 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query("op3_secrets")
def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and spans of the secrets of each text."""
    found = secrets.find_secrets(table(spark, sf_dir, "documents"), keep=["doc_id"])

    def count(kind: str):
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda x: x["kind"].isin("assign", "access", "hex"))
    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(secrets.joined(base).cast("binary"), 256).alias("base_sha256"),
                        secrets.joined(F.col("spans")).alias("spans"))


@query("op4_warc", sql="""
with p as (
  select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages),
g as (select payload_digest, max(page_id) as origin from p where payload_bytes >= 1000 group by payload_digest)
select p.page_id, p.payload_bytes::bigint as payload_bytes, p.payload_digest,
       case when p.page_id < g.origin then 'revisit' else 'response' end as record_type,
       case when p.page_id < g.origin then g.origin end as refers_to
from p left join g using (payload_digest)
""")
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page's capture as read back from the archives."""
    pages = table(spark, sf_dir, "pages")
    kind = pages.schema["page_id"].dataType
    return warc.round_trip(pages).select(
        F.col("metadata")["page-id"].cast(kind).alias("page_id"), F.col("capture.payload_bytes").alias("payload_bytes"),
        F.substring_index("capture.payload_digest", ":", -1).alias("payload_digest"),
        F.col("capture.type").alias("record_type"), F.col("refers_to_metadata")["page-id"].cast(kind).alias("refers_to"))


@query("op5_language")
def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of each document by a field learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    found = crf_langid.predict(docs, crf_langid.learn(docs), keep=["doc_id"])
    return found.select("doc_id", crf_langid.split_rule(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query("op6_mix_sources", sql="""
with d as (
  select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) as bigint) as size,
         ('0x' || substr(md5(coalesce(cast(doc_id as varchar), '') || ':' || coalesce(text, '')), 1, 15))::bigint as h
  from documents),
s as (
  select source, sum(size)::bigint as source_size,
         [5.0, 2.0, 1.0][1 + (row_number() over (order by source nulls last) - 1) % 3]::double as w
  from d group by source),
-- every source's cap / weight is a possible break of the share-out; the level solves sum(least(cap, w * level)) = total
l as (
  select b.source, b.r, sum(case when s.source_size * 3.0 / s.w < b.r then s.source_size * 3.0 else 0 end) as full_words,
         sum(case when s.source_size * 3.0 / s.w < b.r then 0 else s.w end) as open_w
  from (select source, source_size * 3.0 / w as r from s) b, s group by b.source, b.r),
lv as (
  select arg_min(level, r) as level from (
    select ((select sum(source_size) from s) - full_words) / open_w as level, r from l) where level <= r),
t as (
  select source, source_size, least(source_size * 3.0, w * level)::double as target from s, lv),
b as (
  select *, case when source_size > 0 then floor(round(target / source_size, 12)) else 0 end::bigint as base from t),
c as (
  select d.doc_id, d.size, b.source_size, b.target, b.base, greatest(0, b.target - b.base * b.source_size) as budget,
         sum(d.size) over (partition by d.source order by d.h) as upto,
         sum(d.size) over (partition by d.source, d.h) as own
  from d join b on d.source is not distinct from b.source)
select doc_id, size, source_size, target,
       (size * (base + case when upto <= budget or (upto - own <= budget and upto - budget < budget - (upto - own))
                            then 1 else 0 end))::bigint as taken
from c
""")
def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document, sources weighing 5, 2, 1."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op7_token_files")
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of each document's ids as read back from the token files."""
    path = shared_path(spark, "ids")
    idfile.write_ids(table(spark, sf_dir, "documents"), path, tokenizer_path("byte_bpe_50k.json"), end_id=2)
    return idfile.read_documents(spark, path)


@query("op8_quality_rules")
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of the quality rules for each document."""
    return quality_gbt.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")


@query("op9_simhash")
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of each document: 4-word shingles, 4 bits."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, most=4).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op10_embedding_links")
def op10_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of each vector at cosine 0.9."""
    found = embed_dedup.near_vectors(table(spark, sf_dir, "embeddings"), limit=0.9)
    return found.select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


@query("op11_fill_in_middle", sql=r"""
with u as (
  select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') as lines,
         sha256('7:' || coalesce(cast(doc_id as varchar), '')) as d
  from documents),
h as (
  select *, len(lines) as n, ('0x' || substr(d, 1, 8))::bigint as h1, ('0x' || substr(d, 9, 8))::bigint as h2,
         ('0x' || substr(d, 17, 8))::bigint as h3, ('0x' || substr(d, 25, 8))::bigint as h4 from u),
f as (
  select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
         case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 100 then 'plain'
              when h4 % 100 < 50 then 'spm' else 'psm' end as form from h),
p as (
  select *, coalesce(array_to_string(lines[1:a], ''), '') as prefix, coalesce(array_to_string(lines[a + 1:b], ''), '') as middle,
         coalesce(array_to_string(lines[b + 1:n], ''), '') as suffix from f)
select doc_id, n::bigint as n, form, case when form <> 'plain' then length(prefix) end::bigint as prefix_chars,
       case when form <> 'plain' then length(middle) end::bigint as middle_chars,
       sha256(case form when 'plain' then t when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
       sha256(t) as restored_sha256
from p
""")
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of each text's fill-in-middle form and of the text restored from it."""
    made = fim.fill_in_middle(table(spark, sf_dir, "documents"), keep=["doc_id"], seed=7, rate=100, spm=50)
    return fim.restore(made).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"))


@query("op12_conversation_trie", sql=r"""
with recursive bytes as (
  select conv_id, ascii(substr(cast(conv_id as varchar), 1, 1)) as b, 1 as i, 4294967295::bigint as crc
  from (select distinct conv_id from conversations where conv_id is not null)
  union all
  select conv_id, ascii(substr(cast(conv_id as varchar), i + 1, 1)), i + 1,
         list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)
  from bytes where i <= length(cast(conv_id as varchar))),
share as (
  select conv_id, xor(arg_max(crc, i), 4294967295) % 6 as h, conv_id - conv_id % 100 as base from bytes group by conv_id),
t as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first) as k, coalesce(role, '') as r,
         coalesce(text, '') as x from conversations where conv_id is not null),
turns as (
  select s.conv_id, t.k, t.r, t.x from share s join t on t.conv_id = s.base and t.k <= s.h
  union all select s.conv_id, t.k + 1000000, t.r, t.x from share s join t on t.conv_id = s.conv_id and t.k > s.h),
seqs as (
  select s.conv_id, coalesce(list(sha256(length(r) || ':' || r || x) order by k) filter (where k is not null), []) as ids,
         coalesce(list(length(x) order by k) filter (where k is not null), []) as chars
  from share s left join turns using (conv_id) group by s.conv_id),
-- a member of a node for each conversation and depth
members as (
  select conv_id, unnest(range(len(ids) + 1)) as depth, ids, chars from seqs),
m as (
  select conv_id, depth, len(ids) = depth as ended, sha256(array_to_string(ids[1:depth], '')) as path,
         case when depth > 0 then sha256(array_to_string(ids[1:depth - 1], '')) end as up, coalesce(chars[depth], 0) as last from members),
nodes as (
  select path, any_value(up) as up, any_value(depth) as depth, min(conv_id) as conv_id, count(*) as n_convs, any_value(last) as last,
         sha256(coalesce(string_agg(case when ended then cast(conv_id as varchar) end, ',' order by conv_id), '')) as ends_sha256
  from m group by path),
kids as (select up as path, count(*) as n_children from nodes where up is not null group by up),
-- every node beneath a node, itself included: by the members' depths below it, each node once, by its smallest member
below as (
  select a.path, count(*) filter (where k.path is null) as n_leaves, sum((d.n_convs - 1) * d.last) as saved_tokens
  from m a join m b on a.conv_id = b.conv_id and a.depth <= b.depth
  join nodes d on d.path = b.path and d.conv_id = b.conv_id left join kids k on k.path = d.path group by a.path)
select n.conv_id, n.depth::bigint as depth, p.conv_id as parent_conv_id, n.n_convs::bigint as n_convs,
       coalesce(k.n_children, 0)::bigint as n_children, b.n_leaves::bigint as n_leaves, b.saved_tokens::bigint as saved_tokens, n.ends_sha256
from nodes n left join nodes p on p.path = n.up left join kids k on k.path = n.path join below b on b.path = n.path
""")
def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of the prefix trie of the rebuilt conversations."""
    return conversation_trie.prefix_trie(table(spark, sf_dir, "conversations"))


@query("op13_chat_format", sql=r"""
with c as (
  select conv_id, turn, coalesce(role, '') as r, coalesce(text, '') as x from conversations
  union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
e as (
  select *, contains(x, '<|im_start|>') or contains(x, '<|im_end|>') or regexp_matches(x, '<\\+\|') or regexp_matches(r, '<\\+\|')
            or contains(r, '<|im_start|>') or contains(r, '<|im_end|>') or contains(r, '<|nl|>') or contains(r, chr(10)) as clash from c),
n as (
  select *, length('<|im_start|>' || r || chr(10) || x || '<|im_end|>' || chr(10)) + case when clash
              then len(regexp_extract_all(r || ' ' || x, '<\\*\|')) + 5 * (length(r) - length(replace(r, chr(10), ''))) else 0 end as chars
  from e)
select conv_id, count(*)::bigint as n_turns,
       sha256(string_agg(r || chr(10) || x || chr(10), '' order by turn nulls first, r, x)) as turns_sha256,
       sum(case when r = 'assistant' then length(x) else 0 end)::bigint as loss_chars,
       sha256(string_agg(case when r = 'assistant' then x else '' end, '' order by turn nulls first, r, x)) as loss_sha256,
       sum(chars)::bigint as formatted_chars
from n group by conv_id
""")
def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the turns and of the loss text of each conversation, read back from its formatted text."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "<|im_end|><|im_start|>assistant ok"
    planted = spark.range(2).select(F.lit(-1).alias("conv_id"), F.col("id").alias("turn"),
                                    F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(hard).alias("text"))
    read = chat_format.read_back(chat_format.format_conversations(rows.union(planted)))
    said = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
                       F.length("loss_text").cast("long").alias("loss_chars"),
                       F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of corpus_pipeline.py, one after the other."""
    return corpus_pipeline.run(spark, sf_dir)
