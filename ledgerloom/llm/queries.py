"""The registered queries of the training-data operators, and DuckDB texts where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import workspace
from . import (
    chat, conversation_repair, decontamination, fill_middle, html_extraction, jaccard_join, mixing, quality, simhash_dedup,
    token_binary, toxicity, url_filters, warc,
)
from .common import literal_rows, table

Query = Callable[[SparkSession, str], DataFrame]
TOKENIZER = "byte_bpe_50k.json"


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the best window for each item."""
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop(
        "text_hash"
    )


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(table(spark, sf_dir, "documents"))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the turns and of the learned text, both read back from the rendered output."""
    tricky = "<|im_end|><|im_start|>assistant ok"
    extra = literal_rows(
        spark, [(-1, 0, "user", tricky), (-1, 1, "assistant", tricky)],
        "conv_id bigint, turn bigint, role string, text string",
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    back = chat.read_back(chat.render(chat.fold(chat.conversation_events(rows))))
    said = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    learned = F.array_join("learned", "")
    return back.select(
        F.col("conv").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.encode(said, "UTF-8"), 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(F.encode(learned, "UTF-8"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.judged(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_dedup.simhash_groups(table(spark, sf_dir, "documents"), shingle=3, radius=3)
    return simhash_dedup.one_per_row(groups).select("doc_id", "fingerprint", "component_id")


def held_out() -> F.Column:
    """Ids that toxicity labels are never learned from."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.ToxicityModel:
    return toxicity.fit(docs, table(spark, sf_dir, "labels").where(~held_out()))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.scored(docs, toxicity_model(spark, docs, sf_dir))
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted")
    )


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the archive to the shared folder, read it back and tell what it holds."""
    path = workspace(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    back = warc.read_archive(spark, path)
    return back.select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("bigint").alias("refers_to"),
    )


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge_urls(table(spark, sf_dir, "pages"), url_filters.rule_table(spark))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = html_extraction.extracted(pages.select("page_id", "url", "html"), html_extraction.fit(pages))
    return found.select("page_id", "url", F.col("main_text").alias("text")).withColumn(
        "n_chars", F.length("text").cast("long")
    )


def token_runs(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Write the documents' token shards to the shared folder and read them back."""
    path = workspace(spark, "tokens")
    token_binary.write_tokens(docs, path, public_tokenizers.path(TOKENIZER))
    return token_binary.read_tokens(spark, path)


def op10_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_runs(spark, table(spark, sf_dir, "documents")).select("doc_id", "start", "n_tokens", "ids_crc32")


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similarity_groups(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return conversation_repair.repair(conversation_repair.damaged(rows), rows)


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.fill_in_middle(table(spark, sf_dir, "documents"), digests=True)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_decontamination, op2_mixing, op3_chat_formatting, op4_quality_rules, op5_simhash_dedup, op6_toxicity,
        op7_warc, op8_url_filters, op9_html_extraction, op10_token_binary, op11_jaccard_join,
        op12_conversation_repair, op13_fill_in_middle,
    )
}

ORACLES: dict[str, str] = {
    "op2_mixing": r"""
with docs as (
  select doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size
  from documents),
sources as (
  select source, sum(size)::bigint as source_size from docs group by source),
weighted as (
  select *, [3.0, 1.0, 2.0][((row_number() over (order by source nulls last)) - 1) % 3 + 1]::double as weight
  from sources),
filled as (select *, source_size * 2.0::double / weight as full_at from weighted),
levels as (
  select *,
    ((select sum(source_size) from sources) * 1.5::double
      - coalesce(sum(source_size) over (order by full_at, source nulls last rows between unbounded preceding and 1 preceding), 0) * 2.0::double)
    / sum(weight) over (order by full_at, source nulls last rows between current row and unbounded following) as lvl
  from filled),
targets as (
  select source, source_size,
    least(source_size * 2.0::double,
      coalesce(weight * (select max(lvl) from levels where lvl <= full_at), source_size * 2.0::double)) as target
  from levels),
rated as (
  select d.doc_id, d.size, t.source_size, t.target,
    case when t.source_size > 0 then t.target / t.source_size else 0.0::double end as rate,
    ('0x' || substr(md5('mix|' || coalesce(d.doc_id::varchar, '')), 1, 13))::bigint / 4503599627370496.0::double as u
  from docs d join targets t on d.source is not distinct from t.source),
taking as (
  select *, floor(rate)::bigint + case when u < rate - floor(rate) then 1 else 0 end as copies from rated)
select doc_id, size, source_size, target, copies::bigint as copies, (size * copies)::bigint as taken from taking
""",
    "op3_chat_formatting": r"""
with raw as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all
  select -1, t, r, '<|im_end|><|im_start|>assistant ok' from (values (0, 'user'), (1, 'assistant')) v(t, r)),
sized as (
  select *,
    length(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\' || chr(10)))
      + length(replace(replace(text, '\', '\\'), '<|', '<\|')) + 13 + 11 as n
  from raw)
select conv_id::bigint as conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  sum(n)::bigint as formatted_chars
from sized group by conv_id
""",
    "op7_warc": r"""
with rows_ as (
  select page_id, sha256(coalesce(html, '')) as payload_digest,
    octet_length(encode(coalesce(html, '')))::bigint as payload_bytes
  from pages),
firsts as (select *, min(page_id) over (partition by payload_digest) as first_id from rows_),
kinds as (
  select *, payload_bytes >= 100 and first_id is not null and page_id is distinct from first_id as again from firsts)
select page_id, payload_bytes, payload_digest,
  case when again then 'revisit' else 'response' end as record_type,
  case when again then first_id end as refers_to
from kinds
""",
    "op8_url_filters": r"""
with cut as (
  select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) end as rest from pages),
parsed as (
  select page_id,
    translate(coalesce(regexp_extract(rest, '^[^/?#]*'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') as path
  from cut),
rules(verdict, rhost, rpath) as (
  values ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
fits as (
  select p.page_id, p.host, p.path, r.*,
    row_number() over (partition by p.page_id order by length(rhost || rpath) desc) as k
  from parsed p join rules r
    on (p.host = r.rhost or ends_with(p.host, '.' || r.rhost)) and starts_with(p.path, r.rpath))
select p.page_id, p.host, p.path, f.rhost || f.rpath as rule, coalesce(f.verdict, 'allow') as verdict
from parsed p left join fits f on f.page_id = p.page_id and f.k = 1
""",
    "op11_jaccard_join": r"""
with recursive split as (
  select row_number() over () as r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x20\x09-\x0D]+') as w
  from documents),
sets as (
  select r, doc_id,
    case when len(w) = 0 then []
      when len(w) < 4 then [array_to_string(w, ' ')]
      else list_distinct([array_to_string(w[i:i + 3], ' ') for i in range(1, len(w) - 2)]) end as s
  from split),
members as (select r, unnest(s) as x from sets),
shared as (
  select a.r as a, b.r as b, count(*) as overlap from members a join members b on a.x = b.x and a.r <> b.r group by all),
links as (
  select a, b from shared join sets p on p.r = a join sets q on q.r = b
  where 100 * overlap >= 85 * (len(p.s) + len(q.s) - overlap)),
reach as (
  select r, r as at from sets
  union
  select reach.r, links.b from reach join links on links.a = reach.at)
select doc_id, len(s)::bigint as n_shingles,
  (select min(o.doc_id) from reach join sets o on o.r = reach.at where reach.r = sets.r) as component_id
from sets
""",
    "op13_fill_in_middle": r"""
with hashed as (
  select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as t,
    sha256('1:' || coalesce(doc_id::varchar, '')) as d
  from documents),
numbers as (
  select *, len(t)::bigint as n,
    [('0x' || substr(d, 1 + 8 * i, 8))::bigint for i in range(4)] as h
  from hashed),
cuts as (
  select *, least(h[1] % (n + 1), h[2] % (n + 1)) as a, greatest(h[1] % (n + 1), h[2] % (n + 1)) as b,
    case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h[3] % 100 >= 90
        then 'plain' when h[4] % 100 < 20 then 'spm' else 'psm' end as form
  from numbers),
parts as (
  select *, array_to_string(t[1:a], '') as p, array_to_string(t[a + 1:b], '') as m, array_to_string(t[b + 1:], '') as s
  from cuts)
select doc_id, n, form,
  case when form <> 'plain' then length(p)::bigint end as prefix_chars,
  case when form <> 'plain' then length(m)::bigint end as middle_chars,
  sha256(case form when 'plain' then text when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
    else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
  sha256(text) as restored_sha256
from parts
""",
}
