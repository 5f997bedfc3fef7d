"""Queries of the corpus operators and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txsieve.llm import (
    alignment, chat, html, langid, mixing, packing, productquant, quality, rangecoder, setsketch, sharding, vectorcodes, winnow,
)
from txsieve.llm.common import table
from txsieve.session import materialize, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = function
        if oracle:
            ORACLES[name] = oracle
        return function

    return register


@query(
    "op1_quality_rules",
    rf"""
    with d as (
      select doc_id, coalesce(text, '') as text, coalesce('=' || source, '') as host,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
      from documents),
    lines as (
      select doc_id, host, text, trim(regexp_replace(lower(l), '[\x20\x09-\x0D]+', ' ', 'g')) as line, l
      from (select doc_id, host, text, unnest(string_split(text, chr(10))) as l from d)),
    worded as (select * from lines where line <> ''),
    dup as (
      select doc_id, count(*) - count(distinct l) as n_dup_lines from worded group by doc_id),
    digests as (select doc_id, list_sort(list_distinct(list(md5(line)))) as m from worded group by doc_id),
    counts as (
      select host, line,
             count(distinct coalesce(case when md5(line) = m[1] then m[2] else m[1] end, '')) as n
      from worded join digests using (doc_id) group by host, line),
    hosts as (select host, count(distinct text) as h from d group by host),
    common as (
      select host, line from counts join hosts using (host)
      where n >= {quality.COMMON_DOCUMENTS}
         or (n >= {quality.MIN_LINE_DOCUMENTS} and n * 100 > h * {quality.MAX_LINE_PERCENT})),
    taken as (
      select doc_id, cast(sum(len(string_split(line, ' '))) as bigint) as common_words
      from worded join common using (host, line) group by doc_id),
    pos as (select doc_id, w, unnest(generate_series(1, len(w) - 2)) as i from d where len(w) >= 3),
    windows as (
      select doc_id, i, count(*) over (partition by doc_id, w[i], w[i + 1], w[i + 2]) as n from pos),
    repeated as (
      select doc_id, count(distinct i + k) as n_repeat_words
      from windows, (values (0), (1), (2)) as o(k) where n > 1 group by doc_id),
    base as (
      select doc_id, cast(len(w) as bigint) as n_words,
             cast(length(array_to_string(w, '')) as bigint) as word_chars,
             cast(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) as bigint) as n_symbols,
             coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words,
             coalesce(common_words, 0) as common_words
      from d left join dup using (doc_id) left join taken using (doc_id) left join repeated using (doc_id)),
    judged as (
      select *, n_words < {quality.MIN_WORDS}
             or 100 * n_repeat_words > {quality.MAX_REPEATED_PERCENT} * n_words as base_failed
      from base)
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           not (base_failed or (n_words - common_words < {quality.MIN_LEFT_WORDS}
             and (n_words - common_words) * 100 < {quality.MIN_LEFT_PERCENT} * n_words)
             or (n_words - common_words) * 100 < {quality.LEAST_LEFT_PERCENT} * n_words) as kept,
           common_words
    from judged
    """,
)
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"))


@query(
    "op10_mixing",
    f"""
    with d as (
      select doc_id, md5(coalesce(text, '')) as of_text, coalesce('=' || source, '') as key,
             cast(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as bigint) as size
      from documents),
    s as (select key, cast(sum(size) as bigint) as source_size from d group by key),
    r as (
      select *, [3, 1, 2][(row_number() over (order by key = '', key) - 1) % 3 + 1] as weight,
             source_size * {mixing.MAX_REPEATS} as room
      from s),
    p as (
      select *, sum(source_size) over () as all_size, sum(weight) over () as all_weight,
             coalesce(sum(room) over before, 0) as room_before,
             coalesce(sum(weight) over before, 0) as weight_before
      from r
      window before as (order by room / weight, key = '', key rows between unbounded preceding and 1 preceding)),
    f as (
      select *, (all_size::double * {mixing.SHARE_PERCENT / 100}::double - room_before::double)
                / (all_weight - weight_before)::double as level from p),
    t as (select *, room <= level * weight as stops from f),
    targets as (
      select key, source_size,
             case when stops then room::double
                  else (select arg_min(level, room_before) from t where not stops) * weight end as target
      from t),
    planned as (
      select doc_id, size, source_size, target,
             case when source_size > 0 then target / source_size else 0 end as rate,
             ('0x' || substr(md5('mix:' || coalesce(doc_id::varchar, 'null') || ':' || of_text), 1, 13))::bigint
               / 4503599627370496.0::double as u
      from d join targets using (key)),
    copied as (
      select *, cast(floor(rate) + case when u < rate - floor(rate) then 1 else 0 end as bigint) as copies
      from planned)
    select doc_id, size, source_size, target, copies, cast(copies * size as bigint) as taken from copied
    """,
)
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(table(spark, sf_dir, "documents")).drop("row")


@query("op5_language_id")
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


@query(
    "op2_near_duplicates",
    r"""
    with recursive w as (
      select doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') as w from documents),
    s as (
      select distinct doc_id, case when len(w) < 5 then array_to_string(w, ' ')
        else array_to_string(w[i:i + 4], ' ') end as s
      from (select doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) as i from w where len(w) > 0)),
    n as (select doc_id, count(*) as n from s group by doc_id),
    p as (select x.doc_id as a, y.doc_id as b, count(*) as k
      from s x join s y on x.s = y.s and x.doc_id < y.doc_id group by 1, 2),
    l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b
      where 100 * k >= 75 * (x.n + y.n - k)),
    e as (select a, b from l union all select b, a from l),
    r as (select doc_id as d, doc_id as c from documents union select r.d, e.b from r join e on e.a = r.c)
    select doc_id, coalesce(n, 0) as n_shingles, c as component_id, doc_id = c as kept
    from documents left join n using (doc_id)
    join (select d, min(c) as c from r group by d) on d = doc_id
    """,
)
def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(table(spark, sf_dir, "documents"))


@query("op6_packing")
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_digest(table(spark, sf_dir, "documents"))


@query("op9_token_files")
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    rangecoder.write_ids(table(spark, sf_dir, "documents"), path)
    ids = rangecoder.read_ids(spark, path)
    return ids.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


#: A conversation whose texts look like the marks of a template.
HOSTILE = "\\### Assistant: </turn> ok"


@query(
    "op4_chat_windows",
    rf"""
    with t as (
      select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
      union all select -7, 0, 'user', '{HOSTILE}' union all select -7, 1, 'assistant', '{HOSTILE}'),
    c as (
      select *, row_number() over o - 1 as i,
             len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) + {chat.OVERHEAD} as cost,
             length(regexp_replace(role || text, '([\\#<])', '..', 'g')) + {len(chat.OPEN + chat.MIDDLE + chat.CLOSE)} as chars
      from t window o as (partition by conv_id order by turn nulls first, role, text)),
    b as (
      select *, sum(cost) over (partition by conv_id order by i) - cost as before,
             max((i = 0 and role = 'system')::int) over (partition by conv_id) as has_system,
             max(case when i = 0 and role = 'system' then cost else 0 end) over (partition by conv_id) as system_cost,
             max(case when i = 0 and role = 'system' then chars else 0 end) over (partition by conv_id) as system_chars
      from c),
    s as (
      select *, before // greatest({chat.LEAST_NEW}, {chat.BUDGET - chat.HISTORY} - system_cost) as span from b),
    w as (
      select conv_id, span, min(i) as first, min(before) as begins, sum(cost) as new_cost,
             sum(chars) as new_chars, any_value(has_system) as has_system,
             any_value(system_cost) as system_cost, any_value(system_chars) as system_chars
      from s group by conv_id, span),
    h as (
      select w.conv_id, w.span, sum(s.chars) as chars
      from w join s on s.conv_id is not distinct from w.conv_id and s.i < w.first and s.i >= w.has_system
        and w.begins - s.before <= least({chat.HISTORY}, {chat.BUDGET} - w.new_cost - w.system_cost)
      group by all),
    f as (
      select w.conv_id, cast(sum(new_chars + coalesce(h.chars, 0)
               + case when w.first > 0 then system_chars else 0 end) as bigint) as formatted_chars
      from w left join h on h.conv_id is not distinct from w.conv_id and h.span = w.span group by all),
    d as (
      select conv_id, count(*) as n_turns,
             sha256(string_agg(role || chr(10) || text || chr(10), '' order by i)) as turns_sha256,
             coalesce(string_agg(text, '' order by i) filter (where role = 'assistant'), '') as learned
      from c group by conv_id)
    select d.conv_id, n_turns, turns_sha256, cast(length(learned) as bigint) as loss_chars,
           sha256(learned) as loss_sha256, formatted_chars
    from d join f on d.conv_id is not distinct from f.conv_id
    """,
)
def op4_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    hostile = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(HOSTILE).alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(hostile)
    return chat.digest(chat.read_windows(materialize(chat.format_windows(turns), "chat")))


@query("op7_winnowing")
def op7_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.edited_likeness(table(spark, sf_dir, "documents"))


@query(
    "op8_shards",
    f"""
    with d as (
      select doc_id, cast(coalesce(octet_length(encode(text)), 0) as bigint) as n_bytes,
             ('0x' || substr(md5(coalesce(doc_id::varchar, 'null')), 1, 15))::bigint as bits
      from documents),
    nodes as (
      select cast(depth as int) as depth, bits >> (60 - depth)::int as prefix, sum(n_bytes) as n, count(distinct bits) as c
      from d, generate_series(0, 59) as g(depth) group by 1, 2),
    splits as (select depth, prefix from nodes where n > {sharding.LIMIT} and c > 1),
    deep as (
      select d.doc_id, d.n_bytes, d.bits, cast(coalesce(max(s.depth) + 1, 0) as int) as depth
      from d left join splits s on s.prefix = d.bits >> (60 - s.depth)::int group by all),
    placed as (select *, bits >> (60 - depth)::int as prefix from deep)
    select doc_id, n_bytes, depth,
           case when depth = 0 then '' else lpad(bin(prefix), depth, '0') end as shard,
           cast(sum(n_bytes) over (partition by depth, prefix) as bigint) as shard_bytes
    from placed
    """,
)
def op8_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = materialize(
        sharding.shard_documents(table(spark, sf_dir, "documents"), keep=["doc_id"]).select(
            "row.doc_id", "n_bytes", "depth", "shard"
        ),
        "placed",
    )
    sizes = placed.groupBy("shard").agg(F.sum("n_bytes").alias("shard_bytes"))
    return placed.join(sizes, "shard").select("doc_id", "n_bytes", "depth", "shard", "shard_bytes")


@query("op3_html_text")
def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(table(spark, sf_dir, "pages"))


@query("op11_vector_codes", vectorcodes.oracle())
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectorcodes.encode(table(spark, sf_dir, "embeddings"))


@query("op12_token_alignment")
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"))


@query("op13_near_vectors")
def op13_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return productquant.near_vectors(table(spark, sf_dir, "embeddings"))
