"""Registered queries of this subpackage and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimtide.llm import (bytepair, kdtree, language, lattice, merkle, mixing, packing, phrases, quantized, sharding,
                           simhash, toxicity, warc)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# The jump as a recursion over (state, last shard, next jump); the CRC by a table made from its rule, byte after byte.
CRC_TABLE = """select list(crc order by n) as crcs from (
  with recursive t(n, c, k) as (select range, range, 0 from range(256)
    union all select n, xor(c >> 1, 3988292384 * (c & 1)), k + 1 from t where k < 8)
  select n, c as crc from t where k = 8)"""


@register("op7_jump_shards", f"""
with recursive keys as (select distinct coalesce(doc_id, 0) as k from documents),
walk(k, s, b, j) as (
  select k, cast(k as hugeint) + case when k < 0 then 18446744073709551616 else 0 end, cast(-1 as bigint), cast(0 as bigint) from keys
  union all
  select k, n, j, cast(floor(cast(j + 1 as double) * (2147483648.0::double / cast(n // 8589934592 + 1 as double))) as bigint)
  from (select k, j, (s * 2862933555777941757 + 1) % 18446744073709551616 as n from walk where j < 9)),
first as (select k, n as state from (select k, (case when k < 0 then cast(k as hugeint) + 18446744073709551616 else k end
    * 2862933555777941757::hugeint + 1) % 18446744073709551616 as n from keys)),
shards as (select k, cast(max(b) filter (where b < 8) as int) as shard, cast(max(b) as int) as grown_shard from walk group by k),
crcs as ({CRC_TABLE}),
sized as (select doc_id, strlen(coalesce(text, '')) + 1 as size, xor(list_reduce(
    list_prepend(4294967295::bigint, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
      lambda b: cast(('0x' || b) as bigint))),
    lambda c, x: xor(c >> 8, crcs[1 + cast(xor(c, x) & 255 as int)])), 4294967295) as text_crc32
  from documents, crcs)
select doc_id, size, text_crc32, 'key' as law, shard, row_number() over (partition by shard order by state, doc_id, size, text_crc32) - 1
  as slot, grown_shard
from sized join shards on coalesce(doc_id, 0) = shards.k join first on first.k = shards.k""")
def op7(spark, sf_dir):
    return sharding.shard_documents(table(spark, sf_dir, "documents"), 8)


# The dynamic programme of op3 step by step: costs of all bounds but the last come from the step before.  The tables that
# this runs on have more than 16 lengths.
STEPS = "\n".join(f"""
d{k} as materialized (select c.j, min({{'cost': p.best.cost + c.longest * (c.docs - q.docs) - (c.words - q.words), 'i': p.j}}) as best
  from c join d{k - 1} p on p.j < c.j and p.j >= {k - 1} join c q on q.j = p.j group by c.j),""" for k in range(2, 17))
BACK = ",\n".join(f"b{k} as (select best.i as j from d{k + 1} join b{k + 1} using (j))" for k in range(15, 0, -1))


@register("op3_length_buckets", f"""
with l as (select doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as length from documents),
h as (select length as longest, count(*) as n, sum(length) as w from l group by length),
c as materialized (select longest, row_number() over (order by longest) as j, cast(sum(n) over (order by longest) as bigint) as docs,
  cast(sum(w) over (order by longest) as bigint) as words from h),
d1 as materialized (select j, {{'cost': longest * docs - words, 'i': cast(0 as bigint)}} as best from c),{STEPS}
b16 as (select max(j) as j from c),
{BACK},
bounds as (select list(longest order by longest) as bs from c where j in ({' union all '.join(f'select j from b{k}' for k in range(1, 17))})),
placed as (select doc_id, length, len(list_filter(bs, lambda x: x < length)) as bucket, bs from l, bounds),
slots as (select doc_id, length, bucket, bs[cast(bucket as int) + 1] as bound, row_number() over (partition by bucket
  order by md5(coalesce(cast(doc_id as varchar), '') || '|' || length), doc_id) - 1 as slot from placed)
select doc_id, length, cast(bucket as int) as bucket, bound, slot // holds as batch, cast(slot % holds as int) as place,
  bound - length as padding
from (select *, greatest(1, 65536 // greatest(bound, 1)) as holds from slots)""")
def op3(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"))


# A value that can't be taken for two others or for none: its bytes and itself, or a stroke for NULL.
FRAMED = "case when {0} is null then '-' else strlen(cast({0} as varchar)) || ':' || {0} end"
# Capping, reshared by weight, and single documents nearest to what is missing: a round each.
SHARES = "\n".join(f"""
t{k} as (select * replace (case when not capped and unit * weight > 3 * source_size then true else capped end as capped)
  from (select source, source_size, weight, capped, (total - coalesce(sum(3 * source_size) filter (where capped) over (), 0))
    / coalesce(sum(weight) filter (where not capped) over (), 1) as unit,
    (total - coalesce(sum(3 * source_size) filter (where capped) over (), 0)) as rest,
    coalesce(sum(weight) filter (where not capped) over (), 1) as shared, total
  from t{k - 1})),""" for k in range(1, 5))
NEAREST = "\n".join(f"""
e{k} as (select s.source, min({{'off': abs(p.size - s.short), 'pos': p.pos, 'size': p.size}}) as best from placed p join s{k - 1} s
  on p.source is not distinct from s.source where s.short > 0 and p.size > 0 and p.pos + p.size > p.missing
  and abs(p.size - s.short) < s.short and not list_contains(s.had, p.pos) group by s.source),
s{k} as (select s.source, case when e.best is null then 0 else s.short - e.best.size end as short,
  case when e.best is null then s.had else list_append(s.had, e.best.pos) end as had
  from s{k - 1} s left join e{k} e on s.source is not distinct from e.source),""" for k in range(1, 4))


@register("op4_mix_sources", f"""
with d as materialized (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as size,
  md5({' || '.join(FRAMED.format(c) for c in mixing.KEY)}) as row_key from documents),
t0 as (select source, cast(sum(size) as bigint) as source_size, false as capped, cast(sum(sum(size)) over () as bigint) as total,
  [5, 2, 1][1 + cast((row_number() over (order by source nulls last) - 1) % 3 as int)] as weight from d group by source),{SHARES}
goals as (select source, source_size, target, least(3, case when source_size = 0 then 0 else floor(target / source_size) end) as passes,
    target - case when source_size = 0 then 0 else floor(target / source_size) end * source_size as missing
  from (select source, source_size, case when capped then cast(3 * source_size as double)
    else cast(rest * weight as double) / shared end as target from t4)),
placed as materialized (select d.*, source_size, target, passes, missing, coalesce(cast(sum(size) over (partition by d.source
    order by row_key, doc_id rows between unbounded preceding and 1 preceding) as bigint), 0) as pos
  from d join goals g on d.source is not distinct from g.source),
s0 as (select source, any_value(missing) - coalesce(max(pos + size) filter (where pos + size <= missing), 0) as short,
  cast([] as bigint[]) as had from placed group by source),{NEAREST}
done as (select source, had from s3)
select doc_id, size, source_size, target, cast(size * (passes + case when passes < 3 and (pos + size <= missing
  or (size > 0 and list_contains(had, pos))) then 1 else 0 end) as bigint) as taken
from placed p join done f on p.source is not distinct from f.source""")
def op4(spark, sf_dir):
    """What every document gives to the mix: one share of its words for each shard that drew it."""
    plan = mixing.plan_mix(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target",
                       (F.size("shards") * F.col("size")).cast("long").alias("taken"))


@register("op6_simhash_groups")
def op6(spark, sf_dir):
    groups = simhash.group_near_duplicates(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


BASE32 = """array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + (cast('0x' || substr(x, cast(1 + 5 * (i // 4) as int), 5) as int) // [32768, 1024, 32, 1][1 + i % 4]) % 32, 1)), '')"""


@register("op10_warc_round_trip", f"""
select page_id, strlen(body) as payload_bytes, {BASE32} as payload_digest,
  case when page_id is distinct from head then 'revisit' else 'response' end as record_type,
  case when page_id is distinct from head then head end as refers_to
from (select page_id, body, sha1(body) as x, max(page_id) over (partition by body) as head
  from (select page_id, coalesce(html, '') as body from pages))""")
def op10(spark, sf_dir):
    folder, manifest = warc.archive_pages(table(spark, sf_dir, "pages"))
    return warc.read_archives(spark, folder, manifest).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


VALID = """select vec_id, row_number() over () as row, {vector} as v from embeddings where len(embedding) > 0
  and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0{more}"""
TOP = """with e as materialized ({valid})
select query_id, cast(rank as int) as rank, vec_id, score from (
  select q.vec_id as query_id, c.vec_id, {score} as score,
    row_number() over (partition by q.row order by {score} desc, c.vec_id nulls last) as rank
  from e q join e c on q.vec_id % 50 = 0 and q.row <> c.row and len(q.v) = len(c.v)) where rank <= 5"""


@register("op2_kdtree_top_k", TOP.format(
    valid=VALID.format(vector="list_transform(embedding, lambda x: floor(cast(x as double) * 256))", more=""),
    score="cast(list_dot_product(q.v, c.v) as bigint)"))
def op2(spark, sf_dir):
    return kdtree.exact_top_k(table(spark, sf_dir, "embeddings"))


@register("op8_int8_block_join", TOP.format(
    valid=VALID.format(vector="cast(embedding as double[])", more=" and list_max(list_transform(cast(embedding as double[]), lambda x: abs(x))) > 0"),
    score="list_dot_product(q.v, c.v) / (sqrt(list_dot_product(q.v, q.v)) * sqrt(list_dot_product(c.v, c.v)))"))
def op8(spark, sf_dir):
    return quantized.nearest_by_cosine(table(spark, sf_dir, "embeddings"))


@register("op9_language_kernel")
def op9(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language.identify(docs).select("doc_id", "held_out", "lang_pred", "score")


@register("op5_toxicity_ngrams")
def op5(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.classify(docs, table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


@register("op1_subword_lattice")
def op1(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lattice.score_corpus(docs).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


LEAF = "sha256(" + " || ".join(FRAMED.format(f) for f in merkle.FIELDS) + ")"
SHOWN = "sha256(" + " || ".join(FRAMED.format("(n_chars::hugeint + struck)" if f == "n_chars" else f) for f in merkle.FIELDS) + ")"
# Levels from the leaves up, and the way of each leaf through them: ``fold`` is made from what is shown.
LEVELS = """{nodes}(label, lvl, pos, h, n) as (select label, 0, pos, h, n from {leaves}
  union all select label, lvl + 1, pos // 2, sha256(string_agg(h, '' order by pos)), (n + 1) // 2 from {nodes} where n > 1
  group by label, lvl, pos // 2, n),
{walk}(id, label, lvl, pos, n, proof, fold) as (select id, label, 0, pos, n, proof, fold from {starts}
  union all select w.id, w.label, w.lvl + 1, w.pos // 2, (w.n + 1) // 2, w.proof || coalesce(s.h, ''),
    sha256(case when s.pos < w.pos then s.h || w.fold else w.fold || coalesce(s.h, '') end)
  from {walk} w left join {nodes} s on s.label = w.label and s.lvl = w.lvl and s.pos = xor(w.pos, 1) where w.n > 1)"""


@register("op11_merkle_manifest", f"""
with recursive crcs as materialized ({CRC_TABLE}),
struck as (select *, cast(doc_id is not null and xor(list_reduce(list_prepend(4294967295::bigint,
    list_transform(regexp_extract_all(hex(encode(coalesce(cast(doc_id as varchar), ''))), '..'), lambda b: cast(('0x' || b) as bigint))),
    lambda c, x: xor(c >> 8, crcs[1 + cast(xor(c, x) & 255 as int)])), 4294967295) % 7 = 0 as int) as struck from documents, crcs),
hashed as (select doc_id, case when lang is null then '' else '+' || lang end as label, {LEAF} as h, {SHOWN} as fold from struck),
leaves as materialized (select *, '' as proof, row_number() over () as id, count(*) over (partition by label) as n,
  row_number() over (partition by label order by doc_id nulls first, h) - 1 as pos from hashed),
{LEVELS.format(nodes="nodes", walk="walk", leaves="leaves", starts="leaves")},
subs as materialized (select '' as label, label as lang, h, row_number() over (order by label) - 1 as pos, count(*) over () as n
  from nodes where n = 1),
starts as (select w.id, s.label, s.pos, s.n, w.proof, w.fold from walk w join subs s on s.lang = w.label where w.n = 1),
{LEVELS.format(nodes="tops", walk="ways", leaves="subs", starts="starts")}
select doc_id, l.h as leaf, s.h as subroot, r.h as root, sha256(w.proof) as proof_sha256, w.fold as folded_root, w.fold = r.h as verified
from leaves l join ways w on w.id = l.id and w.n = 1 join subs s on s.lang = l.label join tops r on r.n = 1""")
def op11(spark, sf_dir):
    found = merkle.verify_documents(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.proof(F.col("steps")), 256).alias("proof_sha256"),
                        "folded_root", "verified")


@register("op13_byte_bpe")
def op13(spark, sf_dir):
    encoded = bytepair.encode_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), packed=True)
    return bytepair.decode_documents(encoded).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"))


CUT = """select p.lang, p.phrase, p.a, {k} as k, h.f as l, t.f as r, (2000000::hugeint * p.a) // (h.f::hugeint + t.f) as score
  from f p join f h on h.lang = p.lang and h.phrase = array_to_string(p.w[1:{k}], ' ')
  join f t on t.lang = p.lang and t.phrase = array_to_string(p.w[{k} + 1:], ' ') where len(p.w) > {k}"""


@register("op12_phrase_stripes", f"""
with pieces as materialized (select coalesce(lang, 'und') as lang, regexp_extract_all(unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') as w from documents),
f as materialized (select lang, w, array_to_string(w, ' ') as phrase, count(*) as f, count(*) as a from (
    {' union all '.join(f"select lang, unnest(list_transform(range(1, len(w) - {m} + 2), lambda i: w[i:i + {m} - 1])) as w from pieces where len(w) >= {m}" for m in range(1, 5))})
  group by lang, w having count(*) >= 30),
total as (select lang, cast(sum(len(w)) as bigint) as n from pieces group by lang),
longer as (select lang, phrase, max(f) as most from (
    select lang, array_to_string(w[1:-2], ' ') as phrase, f from f where len(w) > 2
    union all select lang, array_to_string(w[2:], ' '), f from f where len(w) > 2) group by lang, phrase),
cuts as ({' union all '.join(CUT.format(k=k) for k in range(1, 4))}),
scored as (select lang, phrase, any_value(a) as a, min({{'score': score, 'k': k, 'l': l, 'r': r}}) as b from cuts group by lang, phrase),
ranked as (select s.lang, s.phrase, s.a, s.b.l as l, s.b.r as r, n, cast(s.b.score as bigint) as score,
    row_number() over (partition by s.lang order by s.b.score desc, s.a desc, s.phrase) as rank
  from scored s join total using (lang) left join longer g on g.lang = s.lang and g.phrase = s.phrase
  where 100::hugeint * coalesce(g.most, 0) < 80::hugeint * s.a)
select lang, rank, phrase, a, l, r, n, score from ranked where rank <= 2000""")
def op12(spark, sf_dir):
    found = phrases.mine_phrases(table(spark, sf_dir, "documents"))
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
