"""The registered queries of this subpackage: each applies its operator with production
parameters to its whole table and derives the contract's columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chat_format import prefix_tree, read_back
from .common import table
from .embedding_dedup import embedding_dedup
from .exact_dedup import exact_dedup
from .lang_id import language_id
from .mixing import mix
from .packing import pack_documents
from .prefix_trie import prefix_trie
from .quality_rules import repetition_rules
from .simhash_dedup import simhash_dedup
from .substring_dedup import substring_dedup
from .toxicity import toxicity
from .url_filter import url_filter
from .whitening import whiten


def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(table(spark, sf_dir, "documents"), shingle=3, radius=2).select("doc_id", "fingerprint", "component_id")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents"))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes: the labelled rows, taken by number (page_id = doc_id); bad is low quality or toxic."""
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), (
        (F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int").alias("bad"))
    return url_filter(table(spark, sf_dir, "pages"), labels).select("page_id", "host", "path", "rule", "verdict")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    import public_tokenizers
    packed = pack_documents(table(spark, sf_dir, "documents"), tokenizer or public_tokenizers.path("word_bpe_49k.json"), capacity=2048)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "certified")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.7)


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).documents.select("doc_id", "size", "source_size", "target", "taken")


def op9_chat_format(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    import public_tokenizers
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    tokenizer = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    return read_back(*prefix_tree(turns, tokenizer), tokenizer)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"), window=35)


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition_rules(table(spark, sf_dir, "documents"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deviation too large for a long is null here; the operator has it as a decimal."""
    return whiten(table(spark, sf_dir, "embeddings"), scale=64, shift=1_000_000, most=32).withColumn("deviation", F.expr("try_cast(deviation as bigint)"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_simhash_dedup, op2_language_id, op3_embedding_dedup, op4_url_filter, op5_exact_dedup, op6_best_fit_packing, op7_toxicity, op8_source_mixing, op9_chat_format, op10_substring_dedup,
                         op11_quality_rules, op12_embedding_whitening, op13_conversation_trie)
}

ORACLES: dict[str, str] = {
    "op5_exact_dedup": r"""
with t as (select doc_id, coalesce(text, '') as text from documents),
n as (select doc_id, length(text) as points, regexp_replace(text, '[\x20\x09-\x0D]', '', 'g') as norm from t)
select doc_id,
  first_value(doc_id) over (partition by norm order by points desc, doc_id) as keep_id,
  count(*) over (partition by norm) as group_size,
  doc_id = first_value(doc_id) over (partition by norm order by points desc, doc_id) as kept,
  sha256(norm) as text_sha256
from n""",
    "op4_url_filter": r"""
with parts as (select page_id,
    coalesce(lower(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's')), '') as host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') as path from pages),
ruled as (select *,
    case when (host = 'example.com' or host like '%.example.com') and path like '/de/%' then 'example.com/de/'
      when (host = 'example.net' or host like '%.example.net') and path like '/en/%' then 'example.net/en/'
      when (host = 'org' or host like '%.org') and path like '/fr/%' then 'org/fr/'
      when (host = 'net' or host like '%.net') and path like '/%' then 'net/' end as rule from parts),
known as (select doc_id as page_id, max(case when quality = 0 or toxic = 1 then 1 else 0 end) as bad from labels group by doc_id),
hosts as (select host, count(k.bad) as n, coalesce(sum(k.bad), 0) as bad, array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') as domain,
    string_split(host, '.')[-1] as suffix from ruled left join known k using (page_id) group by host),
whole as (select (sum(bad) + 0.5) / (sum(n) + 1.0) as up from hosts),
l1 as (select suffix, sum(n) as n, sum(bad) as bad, any_value(up) as up from hosts, whole group by suffix),
s1 as (select sum(n * (bad / n - up) ** 2) / sum(n * up * (1 - up)) as spread, count(*) as g, sum(n) as t from l1 where n > 0),
r1 as (select case when t > g then (spread * t - g) / (t - g) else 0 end as rho from s1),
m1 as (select least(1e6, (1 - coalesce(rho, 0)) / greatest(coalesce(rho, 0), 1e-9)) as m from r1),
p1 as (select suffix, (bad + m * up) / (n + m) as mean from l1, m1),
l2 as (select domain, sum(n) as n, sum(bad) as bad, any_value(mean) as up from hosts join p1 using (suffix) group by domain),
s2 as (select sum(n * (bad / n - up) ** 2) / sum(n * up * (1 - up)) as spread, count(*) as g, sum(n) as t from l2 where n > 0),
r2 as (select case when t > g then (spread * t - g) / (t - g) else 0 end as rho from s2),
m2 as (select least(1e6, (1 - coalesce(rho, 0)) / greatest(coalesce(rho, 0), 1e-9)) as m from r2),
p2 as (select domain, (bad + m * up) / (n + m) as mean from l2, m2),
l3 as (select host, n, bad, mean as up from hosts join p2 using (domain)),
s3 as (select sum(n * (bad / n - up) ** 2) / sum(n * up * (1 - up)) as spread, count(*) as g, sum(n) as t from l3 where n > 0),
r3 as (select case when t > g then (spread * t - g) / (t - g) else 0 end as rho from s3),
m3 as (select least(1e6, (1 - coalesce(rho, 0)) / greatest(coalesce(rho, 0), 1e-9)) as m from r3),
ab as (select host, bad + m * up as a, n - bad + m * (1 - up) as b from l3, m3),
verdicts as (select host, a / (a + b) - 2.0 * sqrt(a * b / ((a + b) ** 2 * (a + b + 1))) > 0.5 as blocked from ab)
select page_id, host, path, rule,
  case when rule in ('net/', 'example.com/de/') then 'block' when rule is not null then 'allow'
    when blocked then 'block' else 'allow' end as verdict
from ruled join verdicts using (host)""",
    "op9_chat_format": r"""
with t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e as (select *, replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(text, '&', '&amp;'),
  '<|im_start|>', '&lt;|im_start|>'), '<|im_end|>', '&lt;|im_end|>'), '<|endoftext|>', '&lt;|endoftext|>'), '<s>', '&lt;s>'),
  '</s>', '&lt;/s>'), '[INST]', '&lsqb;INST]'), '[/INST]', '&lsqb;/INST]'), '<<SYS>>', '&lt;<SYS>>'), '<</SYS>>', '&lt;</SYS>>') as escaped from t)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(length('<|im_start|>') + length(role) + 1 + length(escaped) + length('<|im_end|>') + 1) as bigint) as formatted_chars
from e group by conv_id""",
    "op10_substring_dedup": r"""
with w as (select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws from documents),
p as (select doc_id, unnest(range(1, len(ws) - 33)) as p, ws from w),
s as (select doc_id, p, md5(array_to_string(ws[p:p + 34], ' ')) as k from p),
r as (select doc_id, p from s where k in (select k from s group by k having count(*) > 1)),
c as (select distinct doc_id, p + i as i from r, (select unnest(range(0, 35)) as i)),
words as (select doc_id, unnest(range(1, len(ws) + 1)) as i, unnest(ws) as word from w),
kept as (select words.doc_id, count(*) as n, string_agg(word, ' ' order by words.i) as t
  from words anti join c on words.doc_id = c.doc_id and words.i = c.i group by words.doc_id)
select w.doc_id, cast(len(ws) as bigint) as n_words, cast(len(ws) - coalesce(n, 0) as bigint) as n_removed,
  sha256(coalesce(t, '')) as kept_sha256
from w left join kept on w.doc_id = kept.doc_id""",
    "op11_quality_rules": r"""
with t as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
w as (select r, doc_id, text, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws from t),
g as (select r, unnest(range(5, 11)) as n, ws from w),
p as (select r, n, unnest(range(1, len(ws) - n + 2)) as p, ws from g),
k as (select r, n, p, md5(array_to_string(ws[p:p + n - 1], ' ')) as k from p),
again as (select r, n, p from k qualify count(*) over (partition by r, n, k) > 1),
inside as (select distinct r, n, p + i as i from (select r, n, p, unnest(range(0, n)) as i from again)),
chars as (select r, unnest(range(1, len(ws) + 1)) as i, length(unnest(ws)) as c from w),
covered as (select r, sum(c) filter (n = 5) as d5, sum(c) filter (n = 6) as d6, sum(c) filter (n = 7) as d7, sum(c) filter (n = 8) as d8,
  sum(c) filter (n = 9) as d9, sum(c) filter (n = 10) as d10, count(*) filter (n = 5) as words from inside join chars using (r, i) group by r),
lines as (select r, unnest(string_split(text, chr(10))) as line from t),
repeats as (select r, line, count(*) - 1 as m from lines where regexp_matches(line, '[^\x20\x09-\x0D]') group by r, line having count(*) > 1),
dup as (select r, sum(m) as n, sum(m * length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g'))) as c from repeats group by r),
m as (select doc_id, cast(len(ws) as bigint) as n_words, cast(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) as bigint) as word_chars,
    cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols, cast(coalesce(dup.n, 0) as bigint) as n_dup_lines,
    cast(coalesce(words, 0) as bigint) as n_repeat_words, cast(coalesce(dup.c, 0) as bigint) as dup_line_chars,
    cast(coalesce(d5, 0) as bigint) as dup_chars_5, cast(coalesce(d6, 0) as bigint) as dup_chars_6, cast(coalesce(d7, 0) as bigint) as dup_chars_7,
    cast(coalesce(d8, 0) as bigint) as dup_chars_8, cast(coalesce(d9, 0) as bigint) as dup_chars_9, cast(coalesce(d10, 0) as bigint) as dup_chars_10
  from w left join covered using (r) left join dup using (r)),
f as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from m)
select *, not base_failed and 100 * dup_line_chars <= 20 * word_chars and 100 * dup_chars_5 <= 30 * word_chars and 100 * dup_chars_6 <= 29 * word_chars
  and 100 * dup_chars_7 <= 28 * word_chars and 100 * dup_chars_8 <= 27 * word_chars and 100 * dup_chars_9 <= 26 * word_chars
  and 100 * dup_chars_10 <= 25 * word_chars as kept
from f""",
    "op13_conversation_trie": r"""
with t as (select conv_id, turn, length(coalesce(text, '')) as chars,
    sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as id from conversations where conv_id is not null),
own as (select conv_id, list(id order by turn nulls first, id) as ids, list(chars order by turn nulls first, id) as chars from t group by conv_id),
h as (select *, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(cast(conv_id as varchar), ''), lambda x: cast(ord(x) as bigint))),
    lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: xor(a >> 1, 3988292384 * (a & 1)))), 4294967295) % 6 as h from own),
re as (select h.conv_id, list_concat(coalesce(b.ids[1:h.h], []), h.ids[h.h + 1:]) as ids, list_concat(coalesce(b.chars[1:h.h], []), h.chars[h.h + 1:]) as chars
  from h left join own b on b.conv_id = h.conv_id - h.conv_id % 100),
steps as (select conv_id, ids, chars, len(ids) as length, unnest(range(0, len(ids) + 1)) as depth from re),
keyed as (select conv_id, length, depth, md5(array_to_string(ids[1:depth], ',')) as key, case when depth > 0 then md5(array_to_string(ids[1:depth - 1], ',')) end as up,
    case when depth > 0 then chars[depth] else 0 end as chars, ids from steps),
nodes as (select key, any_value(depth) as depth, any_value(up) as up, min(conv_id) as conv_id, count(*) as n_convs, (count(*) - 1) * any_value(chars) as saved,
    any_value(ids[1:depth]) as ids, sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (length = depth), '')) as ends_sha256
  from keyed group by key),
kids as (select up as key, count(*) as n_children from nodes where up is not null group by up),
whole as (select nodes.*, coalesce(n_children, 0) as n_children from nodes left join kids using (key)),
above as (select md5(array_to_string(ids[1:d], ',')) as key, saved, n_children from (select ids, saved, n_children, unnest(range(0, depth + 1)) as d from whole)),
sub as (select key, count(*) filter (n_children = 0) as n_leaves, cast(sum(saved) as bigint) as saved_tokens from above group by key)
select whole.conv_id, cast(whole.depth as bigint) as depth, p.conv_id as parent_conv_id, whole.n_convs, whole.n_children, sub.n_leaves, sub.saved_tokens, whole.ends_sha256
from whole join sub using (key) left join nodes p on p.key = whole.up""",
}
