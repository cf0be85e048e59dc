"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import bpe, compression, decontam, dialogue, extract, lines, pii, setsketch, shards, spans, spelling, toxicity, warc
from barloom.llm.frames import table
from barloom.sources.scratch import materialize, new_path

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary() -> bpe.Vocabulary:
    return bpe.Vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = setsketch.Near(size=3, percent=85)
    return setsketch.near_duplicates(table(spark, sf_dir, "documents"), near)


def op3_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary()).drop("text")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    measured = materialize(compression.measure(docs).drop("text"), "measured")
    return compression.judge(measured, compression.bands(measured))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.scan(docs, table(spark, sf_dir, "benchmark")).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
    )


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detect(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def n(kind: str):
        return F.size(F.filter("base_spans", lambda c: c["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[n(kind) for kind in pii.BASE],
        F.sha2(pii.listed(F.col("base_spans")), 256).alias("base_sha256"),
        pii.listed(F.col("all_spans")).alias("spans"),
    )


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).drop("html")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 1
    return shards.assign(docs, size, shards=8).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), path)
    return warc.captures(spark, path)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.keep_bitmaps(docs, kept_sha256="kept_sha256").drop("keep")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling.variants(spelling.count_words(docs, spell=spelling.misspell(every=97)))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dialogue.damage(table(spark, sf_dir, "conversations"))
    return dialogue.digests(rows, dropped="dropped").withColumnRenamed("conv", "conv_id")


#: Near-duplicate links by brute force over all pairs that share a shingle, then the least id reachable.
OP1_SQL = """
with recursive w as (
  select doc_id, string_split_regex(trim(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13),
    'abcdefghijklmnopqrstuvwxyz     ')), ' +') as a
  from documents
), s as (
  select doc_id, case when len(a) = 1 and a[1] = '' then []
    when len(a) <= 3 then [array_to_string(a, ' ')]
    else list_distinct([a[i] || ' ' || a[i + 1] || ' ' || a[i + 2] for i in range(1, len(a) - 1)]) end as sh
  from w
), e as (select doc_id, len(sh) as n, unnest(sh) as x from s),
common as (
  select a.doc_id as u, b.doc_id as v, a.n as nu, b.n as nv, count(*) as shared
  from e a join e b on a.x = b.x and a.doc_id <> b.doc_id
  group by all
), link as (select u, v from common where 100 * shared >= 85 * (nu + nv - shared)),
reach as (
  select doc_id as u, doc_id as v from documents
  union
  select reach.u, link.v from reach join link on reach.v = link.u
), least as (select u, min(v) as component_id from reach group by u)
select s.doc_id, cast(len(sh) as bigint) as n_shingles, component_id, s.doc_id = component_id as kept
from s join least on s.doc_id = least.u
"""

#: Windows of 13 words (or an item's fewer) met by equality; the words they cover are counted.
OP5_SQL = """
with dw as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from documents
), iw as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from benchmark
), win as (
  select distinct item_id, k, array_to_string(w[i:i + k - 1], ' ') as x from (
    select item_id, w, least(13, len(w)) as k, unnest(range(1, greatest(len(w) - 13, 0) + 2)) as i
    from iw where len(w) > 0)
), sizes as (select distinct k from win),
dwin as (
  select doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') as x from (
    select doc_id, w, k, unnest(range(1, len(w) - k + 2)) as i from dw, sizes)
), met as (select doc_id, item_id, k, i from dwin join win using (k, x)),
hit as (select doc_id, count(distinct p) as n from (
  select doc_id, unnest(range(i, i + k)) as p from met) group by doc_id),
items as (select doc_id, count(id) as n, string_agg(id, ',' order by id) as ids from (
  select distinct doc_id, cast(item_id as varchar) as id from met) group by doc_id)
select dw.doc_id, cast(len(w) as bigint) as n_words, coalesce(hit.n, 0) as n_hit, coalesce(items.n, 0) as n_items,
  sha256(coalesce(ids, '')) as items_sha256,
  coalesce(hit.n, 0) > 0 and 20 * coalesce(hit.n, 0) >= len(w) as contaminated
from dw left join hit using (doc_id) left join items using (doc_id)
"""

#: The SHA-1 in hex, five digits at a time, as four letters of base 32.
OP9_SQL = """
with p as (
  select page_id, octet_length(encode(coalesce(html, ''))) as n, sha1(coalesce(html, '')) as h from pages
), d as (
  select *, array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    cast((cast('0x' || substr(h, 1 + 5 * (i // 4), 5) as bigint) >> cast(15 - 5 * (i % 4) as bigint)) & 31 as integer) + 1, 1)
    for i in range(0, 32)], '') as b
  from p
), f as (select *, max(page_id) over (partition by b) as first from d)
select page_id, cast(n as bigint) as payload_bytes, b as payload_digest,
  case when page_id < first then 'revisit' else 'response' end as record_type,
  case when page_id < first then first end as refers_to
from f
"""

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

#: Lines by their stripped, lower-cased text; those of shared keys stay in the largest id.
OP11_SQL = f"""
with d as (
  select row_number() over () as r, doc_id, string_split(coalesce(text, ''), chr(10)) as a from documents
), l as (
  select r, doc_id, unnest(range(1, len(a) + 1)) as i, unnest(a) as line from d
), k as (
  select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), {_LOWER}) as key from l
), shared as (
  select key, max(doc_id) as stays from k
  where length(key) >= 40 group by key having count(distinct doc_id) >= 5
), marked as (
  select r, i, line, coalesce(doc_id < stays, false) as gone from k left join shared using (key)
)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by i) filter (where not gone), '')) as kept_sha256
from marked join d using (r) group by r, doc_id
"""

#: CTE ``crc`` (the table of CRC-32), and the CRC-32 of a text expression by it.
_CRC = """crc as (
  select list_transform(range(256), lambda i: list_reduce(range(8),
    lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i)) as t
)"""


def _crc32(text: str) -> str:
    return f"""xor(list_reduce(list_transform(range(octet_length(encode({text}))),
      lambda i: cast('0x' || substr(hex(encode({text})), cast(2 * i + 1 as bigint), 2) as bigint)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"""


#: Words met by what is left when one code point goes; near are those with the same rest at the same place, or a rest.
OP12_SQL = f"""
with recursive {_CRC}, runs as (
  select doc_id, run, count(*) as k from (
    select doc_id, unnest(regexp_extract_all(translate(text, {_LOWER}), '[a-z\u00C0-\u00FF]+')) as run from documents)
  group by all
), coded as (
  select *, {_crc32("coalesce(cast(doc_id as varchar), '') || ':' || run")} as h from runs, crc
), spelt as (
  select k, case when h % 97 = 0 then left(run, h % length(run)) || substr(run, h % length(run) + 2) else run end as word
  from coded
), words as (
  select word, cast(sum(k) as bigint) as n from spelt where length(word) >= 5 group by word having sum(k) >= 3
), rests as (
  select word, n, i, left(word, i - 1) || substr(word, i + 1) as rest
  from (select word, n, unnest(range(1, length(word) + 1)) as i from words)
), near as (
  select a.word, b.word as other, b.n from rests a join rests b using (i, rest) where a.word <> b.word
  union select r.word, w.word, w.n from rests r join words w on r.rest = w.word
  union select w.word, r.word, r.n from rests r join words w on r.rest = w.word
), best as (
  select word, count(*) as n_near, max(n) as most,
    (array_agg(other order by n desc, encode(other)))[1] as other
  from near group by word
), formed as (
  select w.word, w.n, coalesce(n_near, 0) as n_near,
    case when most >= 2 * w.n then other end as form, case when most >= 2 * w.n then most end as form_n
  from words w left join best using (word)
), chain as (
  select word, word as root from words
  union all
  select chain.word, formed.form from chain join formed on chain.root = formed.word where formed.form is not null
)
select word, form, root, n, n_near, form_n
from formed join (select chain.word, chain.root from chain join formed on chain.root = formed.word where formed.form is null)
  using (word)
"""



def _edit(weight: str, cost: str, letter: str) -> str:
    """A weight, its cost in 12 digits and its audit as one string, after another edit; null stays null."""
    return f"lpad(cast(cast(left({weight}, 12) as bigint) + {cost} as varchar), 12, '0') || substr({weight}, 13) || '{letter}'"


def _edits() -> str:
    """Weights w[1..4] of the states (nothing, system, user, assistant) after one more turn of code c."""
    truncated = "(case when c in ('S', 'U', 'A', 'X') then 5 else 0 end)"
    into_user = "least(w[1], w[2], w[4])"

    def when(condition: str, weight: str, cost: str, letter: str) -> str:
        return f"case when {condition} then {_edit(weight, cost, letter)} end"

    kept = "ascii(c) > 57"
    return f"""[
      {_edit("w[1]", "2", "D")},
      least({_edit("w[2]", "2", "D")}, {when("lower(c) = 's'", "w[1]", truncated, "K")}),
      least({_edit("w[3]", "2", "D")}, {when("lower(c) = 'u'", into_user, truncated, "K")},
        {when(kept, into_user, f"1 + {truncated}", "R")}),
      least({_edit("w[4]", "2", "D")}, {when("lower(c) = 'a'", "w[3]", truncated, "K")},
        {when(kept, "w[3]", f"1 + {truncated}", "R")})]"""


_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

#: The lightest audit into each state, turn by turn; inserted turns are never cheapest and left out.
OP13_SQL = f"""
with {_CRC}, hashed as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    {_crc32("coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ')")} % 20 as f
  from conversations, crc
), damaged as (
  select conv_id, turn, case when f = 4 then 'user' else role end as role,
    case f when 1 then '' when 2 then translate(text, '.!?', '') else text end as text,
    unnest(range(case when f = 3 then 2 else 1 end)) as copy
  from hashed where f <> 0
), placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, md5(text), copy) as i,
    right(rtrim(text, {_BLANKS}), 1) as ending,
    case when left(role, 1) in ('s', 'u', 'a') then left(role, 1) else 'x' end as initial
  from damaged
), numbered as (
  select *, row_number() over (partition by conv_id, role, text order by i) as nth from placed
), coded as (
  select *, ending = '' as blank, ending <> '' and nth > 1 as duplicate,
    ending <> '' and nth = 1 and ending not in ('.', '!', '?') as truncated,
    coalesce(lag(initial) over (partition by conv_id order by i) || initial not in ('su', 'ua', 'au'), false) as illegal,
    case when ending = '' then translate(initial, 'suax', '0123') when nth > 1 then translate(initial, 'suax', '4567')
      when ending not in ('.', '!', '?') then upper(initial) else initial end as code
  from numbered
), counted as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (where blank) as blank,
    count(*) filter (where duplicate) as duplicate, count(*) filter (where truncated) as truncated,
    count(*) filter (where illegal) as illegal, array_agg(code order by i) as codes
  from coded group by conv_id
), folded as (
  select *, list_reduce(list_transform(codes, lambda c: [c]), lambda w, x: list_transform(x, lambda c: {_edits()})[1],
    ['000000000000', null, null, null]) as w
  from counted
), audited as (
  select *, cast(left(least(w[1], w[4]), 12) as bigint) as cost, substr(least(w[1], w[4]), 13) as audit,
    length(replace(substr(least(w[1], w[4]), 13), 'D', '')) % 2 as odd
  from folded
), edited as (
  select coded.conv_id, i, text, role, odd, substr(audit, i, 1) as edit,
    row_number() over (partition by coded.conv_id order by i) - 1 - odd as place
  from coded join audited on coded.conv_id is not distinct from audited.conv_id
  where substr(audit, i, 1) <> 'D'
), joined as (
  select conv_id, string_agg(case when edit = 'K' then role when place % 2 = 0 then 'user' else 'assistant' end || ':' || text,
    chr(10) order by i) as whole
  from edited group by conv_id
)
select o.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
  coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(cost, 0) as cost, coalesce(audit, '') as audit,
  sha256(coalesce(whole, '')) as repaired_sha256
from (select distinct conv_id from conversations) o
  left join audited a on o.conv_id is not distinct from a.conv_id left join joined j on o.conv_id is not distinct from j.conv_id
"""

QUERIES: dict[str, Query] = {
    "op1_minhash_near_dedup": op1_minhash_near_dedup,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_byte_level_bpe": op3_byte_level_bpe,
    "op4_quality_rules": op4_quality_rules,
    "op5_decontamination": op5_decontamination,
    "op6_pii": op6_pii,
    "op7_html_extraction": op7_html_extraction,
    "op8_sharding": op8_sharding,
    "op9_warc": op9_warc,
    "op10_toxicity": op10_toxicity,
    "op11_line_dedup": op11_line_dedup,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLES = {
    "op1_minhash_near_dedup": OP1_SQL,
    "op5_decontamination": OP5_SQL,
    "op9_warc": OP9_SQL,
    "op11_line_dedup": OP11_SQL,
    "op12_spelling_variants": OP12_SQL,
    "op13_conversation_repair": OP13_SQL,
}
