"""Registered queries of the package: each applies one operator to its whole table."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from salesmart.llm import clustering, decontaminate, katz, langid, mixing, packing, phrases, pii, secrets, sharding, simhash, vectors, warc
from salesmart.llm.common import table


# Folder of the public tokenizers' files.
TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits().alias("fingerprint"), "component_id")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    return pii.span_digests(found, {kind: f"n_{kind}" for kind in pii.BASE_KINDS})


def op4_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    return pii.span_digests(found, {kind: f"n_{kind}" for kind in secrets.BASE_KINDS})


def op6_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score(table(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.plan(table(spark, sf_dir, "documents"))
    return planned.orderBy("place", "doc_id").drop("source", "h", "repeats", "number", "place", "places")


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.train(docs))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.round_trip(table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster(table(spark, sf_dir, "embeddings"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_digests(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/byte_bpe_50k.json")


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_simhash": op2_simhash,
    "op3_pii": op3_pii,
    "op4_vectors": op4_vectors,
    "op5_secrets": op5_secrets,
    "op6_katz": op6_katz,
    "op7_sharding": op7_sharding,
    "op8_mixing": op8_mixing,
    "op9_langid": op9_langid,
    "op10_warc": op10_warc,
    "op11_phrases": op11_phrases,
    "op12_clusters": op12_clusters,
    "op13_packing": op13_packing,
}

ORACLE: dict[str, str] = {}

_WORDS = r"coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)"

ORACLE["op8_mixing"] = rf"""
with sized as (
  select doc_id, source, cast({_WORDS} as bigint) as size,
    cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), '') || '|' || md5(coalesce(text, ''))), 1, 16) as ubigint) as u
  from documents),
keyed as (
  select doc_id, source, size,
    cast(case when u >= 9223372036854775808 then cast(u as hugeint) - 18446744073709551616 else u end as bigint) as h
  from sized),
totals as (
  select source, cast(sum(size) as bigint) as source_size,
    row_number() over (order by source nulls last) - 1 as rk from keyed group by source),
weighted as (select *, rk % 3 + 1 as weight, cast(source_size * 3 as double) as room from totals),
levels as (
  select *, (sum(cast(source_size as double)) over () - coalesce(sum(room) over earlier, 0.0))
    / (sum(weight) over () - coalesce(sum(weight) over earlier, 0)) as level
  from weighted
  window earlier as (order by room / weight, rk rows between unbounded preceding and 1 preceding)),
targets as (
  select source, source_size, (weight - 2) * cast(0.4 as double) as slope,
    least(room, max(level) over () * weight) as target from levels),
streams as (
  select k.doc_id, k.size, t.source_size, t.slope, t.target, cast(round(t.target) as bigint) as demand,
    cast(coalesce(sum(k.size) over (partition by k.source order by h, k.doc_id, k.size
      rows between unbounded preceding and 1 preceding), 0) as bigint) as start
  from keyed k join targets t on k.source is not distinct from t.source),
epochs as (
  select *, least(greatest(demand - start, 0), size) as e0,
    least(greatest(demand - (source_size + start), 0), size) as e1,
    least(greatest(demand - (source_size * 2 + start), 0), size) as e2,
    case when target > 0 then start / target end as share,
    case when target > 0 then (source_size + start) / target end as share_2,
    case when target > 0 then (source_size * 2 + start) / target end as share_3
  from streams)
select doc_id, size, source_size, target, cast(e0 + e1 + e2 as bigint) as taken,
  cast((e0 > 0 and e0 * 2 >= size) as integer) + cast((e1 > 0 and e1 * 2 >= size) as integer)
    + cast((e2 > 0 and e2 * 2 >= size) as integer) as copies,
  case when e0 > 0 then 2.0 * share / ((1.0 - slope) + sqrt((1.0 - slope) * (1.0 - slope) + 4.0 * slope * share)) end
    as position,
  case when e1 > 0 and e1 * 2 >= size
    then 2.0 * share_2 / ((1.0 - slope) + sqrt((1.0 - slope) * (1.0 - slope) + 4.0 * slope * share_2)) end as position_2,
  case when e2 > 0 and e2 * 2 >= size
    then 2.0 * share_3 / ((1.0 - slope) + sqrt((1.0 - slope) * (1.0 - slope) + 4.0 * slope * share_3)) end as position_3
from epochs
"""

ORACLE["op11_phrases"] = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
worded as materialized (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
totals as (select lang, cast(sum(len(w)) as bigint) as n from worded group by lang),
grams as (
  select lang, m as words, array_to_string(w[i:i + m - 1], ' ') as phrase
  from (select lang, w, m, unnest(generate_series(1, len(w) - m + 1)) as i
        from (select lang, w, unnest([1, 2, 3]) as m from worded))),
f as materialized (select lang, words, phrase, count(*) as a from grams group by all having count(*) >= 10),
candidates as materialized (select *, string_split(phrase, ' ') as parts from f where words > 1),
cuts as (
  select lang, phrase, a, k, array_to_string(parts[1:k], ' ') as head, array_to_string(parts[k + 1:words], ' ') as tail
  from (select *, unnest(generate_series(1, words - 1)) as k from candidates)),
scored as (
  select c.lang, c.phrase, c.a, c.k, l.a as l, r.a as r,
    cast((1000000::hugeint * c.a * c.a) // (l.a::hugeint * r.a) as bigint) as score
  from cuts c join f l on l.lang = c.lang and l.phrase = c.head join f r on r.lang = c.lang and r.phrase = c.tail),
worst as (select *, row_number() over (partition by lang, phrase order by score, k) as nth from scored),
around as (
  select lang, phrase, max(a) as around from (
    select lang, a, unnest([array_to_string(parts[1:2], ' '), array_to_string(parts[2:3], ' ')]) as phrase
    from candidates where words = 3) group by all),
ranked as (
  select s.lang, s.phrase, s.a, s.l, s.r, s.score,
    row_number() over (partition by s.lang order by s.score desc, s.a desc, s.phrase) as rank
  from worst s left join around o on o.lang = s.lang and o.phrase = s.phrase
  where s.nth = 1 and (o.around is null or 100 * o.around < 50 * s.a))
select x.lang, x.rank, x.phrase, x.a, x.l, x.r, t.n, x.score from ranked x join totals t using (lang) where x.rank <= 2000
"""


def _cluster_sql(rounds: int = 10) -> str:
    """The rounds written out one after the other: assignments a0, a1, ... and centroids c0, c1, ..."""
    parts = ["""kept as materialized (
  select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as q
  from embeddings
  where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64)""",
             "cells as materialized (select vec_id, unnest(q) as x, unnest(range(64)) as d from kept)",
             """c0 as materialized (
  select k, unnest(q) as x, unnest(range(64)) as d from (
    select q, row_number() over (order by sha256('3:' || vec_id), vec_id) - 1 as k from kept) where k < 8)"""]
    for i in range(rounds + 1):
        parts.append(f"""a{i} as materialized (
  select vec_id, arg_min(k, (distance, k)) as k, min(distance) as distance from (
    select v.vec_id, c.k, sum((v.x - c.x) * (v.x - c.x)) as distance from cells v join c{i} c using (d) group by all)
  group by vec_id)""")
        if i < rounds:
            parts.append(f"""c{i + 1} as materialized (
  select o.k, o.d, coalesce(n.x, o.x) as x from c{i} o left join (
    select a.k, v.d, cast((sum(v.x) - ((sum(v.x) % count(*)) + count(*)) % count(*)) // count(*) as bigint) as x
    from cells v join a{i} a using (vec_id) group by all) n on n.k = o.k and n.d = o.d)""")
    return f"""with {', '.join(parts)},
names as (select k, sha256(string_agg(cast(x as varchar), ',' order by d)) as centroid_sha256 from c{rounds} group by k)
select a.vec_id, cast(a.k as integer) as cluster, cast(a.distance as bigint) as distance,
  cast(sum(a.distance) over (partition by a.k) as bigint) as cluster_inertia, cast(sum(a.distance) over () as bigint) as inertia,
  names.centroid_sha256
from a{rounds} a join names using (k)"""


ORACLE["op12_clusters"] = _cluster_sql()
