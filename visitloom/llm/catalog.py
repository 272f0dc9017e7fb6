"""The queries of this subpackage: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitloom.llm import (
    chat, clustering, decontam, fingerprint, html_text, langid, license_scan, near_dup, packing, repeats, resampling,
    token_counts, url_rules,
)
from visitloom.llm.common import small_arrow_batches

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

# The rules of op4.
URL_RULES = """
select * from values
  ('com', '/', 'allow'),
  ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'),
  ('net', '/fr/', 'block')
as rules(host, path, verdict)
"""
# The conversation that op1 adds.
ADDED_CONVERSATION = r"""
select -7L as conv_id, turn, role, r'\### Assistant: </turn> ok' as text
from values (0L, 'user'), (1L, 'assistant') as added(turn, role)
"""


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_arrow_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    formatted = chat.format_conversations(said.unionByName(spark.sql(ADDED_CONVERSATION)), vocabulary)
    return chat.digest_formatted(formatted, vocabulary)


@query
def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), spark.sql(URL_RULES))


ORACLE_SQL["op4_url_filters"] = """
with parts as (
  select page_id,
    case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest
  from pages
), named as (
  select page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from parts
), judged as (
  select page_id, host, path,
    case
      when ('.' || host) like '%.www.example.com' and path like '/en/%' then 'www.example.com/en/'
      when ('.' || host) like '%.example.com' and path like '/en/%' then 'example.com/en/'
      when ('.' || host) like '%.net' and path like '/es/%' then 'net/es/'
      when ('.' || host) like '%.net' and path like '/fr/%' then 'net/fr/'
      when ('.' || host) like '%.com' and path like '/%' then 'com/'
    end as rule
  from named
)
select page_id, host, path, rule,
  case when rule in ('example.com/en/', 'net/es/', 'net/fr/') then 'block' else 'allow' end as verdict
from judged
"""


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    documents = documents.withColumn("held_out", held_out)
    # The crc32 of a null id is null, so it is not 2.
    model = langid.fit_languages(documents.where(~F.col("held_out")))
    found = langid.identify(documents, model)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op9_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_edits(table(spark, sf_dir, "documents"))


@query
def op10_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_text.extract_main_text(pages, html_text.fit_on_table(pages))


@query
def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# The reflected polynomial of CRC-32, the hash seed, the shares.
ORACLE_SQL["op11_importance_resampling"] = r"""
with crc_table as (
  select list(list_reduce(range(8), lambda c, i: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end, b) order by b) as t
  from range(256) as bytes(b)
), every_word as (
  select 'd' as kind, doc_id,
    unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as word
  from documents
  union all
  select 'b', null,
    unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'))
  from benchmark
), hashed as (
  select word, xor(4294967295, list_reduce(
    list_transform(range(1, octet_length(encode(word)) + 1),
      lambda i: cast(('0x' || substr(hex(encode(word)), 2 * i - 1, 2)) as bigint)),
    lambda c, x: xor(c // 256, t[1 + xor(c % 256, x)]), 4294967295)) % 10000 as bucket
  from (select distinct word from every_word), crc_table
), placed as (
  select kind, doc_id, bucket from every_word join hashed using (word)
), per_bucket as (
  select bucket, count(*) filter (where kind = 'd') as s, count(*) filter (where kind = 'b') as t from placed group by bucket
), totals as (
  select coalesce(sum(s), 0) as all_s, coalesce(sum(t), 0) as all_t from per_bucket
), gain as (
  select bucket, cast(floor(1000 * ln(cast(t + 1 as double) * cast(all_s + 10000 as double)
    / (cast(s + 1 as double) * cast(all_t + 10000 as double)))) as bigint) as gain
  from per_bucket, totals
), weighed as (
  select doc_id, count(bucket) as n_features, cast(coalesce(sum(gain), 0) as bigint) as weight
  from (select doc_id from documents) as ids left join (select * from placed where kind = 'd') using (doc_id)
    left join gain using (bucket)
  group by doc_id
), scored as (
  select doc_id, n_features, weight, weight + cast(floor(-1000 * ln(-ln(
    (cast(('0x' || substr(sha256('2024:' || doc_id), 1, 8)) as bigint) + 0.5::double) / 4294967296))) as bigint) as score
  from weighed
), fit as (
  select doc_id, row_number() over (order by score desc, doc_id) as rank, count(*) over () as n
  from scored where n_features >= 20
)
select doc_id, n_features, weight, score, case when rank <= n * 10 // 100 then rank end as rank
from scored left join fit using (doc_id)
"""


@query
def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan_licenses(table(spark, sf_dir, "documents"))
    told = {name: F.array_join(name, ",") for name in ("base_labels", "labels")}
    return found.withColumns(told).drop("expressions")


@query
def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    clustered = clustering.cluster(table(spark, sf_dir, "embeddings"))
    components = F.concat_ws(",", F.col("centroid").cast("array<string>"))
    return clustered.withColumn("centroid_sha256", F.sha2(components, 256)).drop("centroid")


def _clustering_sql(k: int = 16, rounds: int = 3) -> str:
    steps = [f"""
with whole as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as v
  from embeddings
  where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), c0 as (
  select row_number() over (order by h) - 1 as cluster, v as c
  from (select v, sha256('1:' || vec_id) as h from whole order by h limit {k})
)"""]  # fmt: skip
    nearest = """
a{n} as (
  select vec_id, v, unnest(best) from (
    select vec_id, any_value(v) as v, min({{'distance': distance, 'cluster': cluster}}) as best
    from (select vec_id, v, cluster, list_sum(list_transform(range(1, 65), lambda i: (v[i] - c[i]) * (v[i] - c[i]))) as distance
      from whole, c{n})
    group by vec_id)
)"""
    moved = """
c{next} as (
  select cluster, coalesce(m, c) as c
  from c{n} left join (
    select cluster, list(cast((total - ((total % size) + size) % size) // size as bigint) order by i) as m
    from (select cluster, i, sum(x) as total, count(*) as size
      from (select cluster, unnest(v) as x, unnest(range(1, 65)) as i from a{n}) group by cluster, i)
    group by cluster) using (cluster)
)"""
    for n in range(rounds):
        steps += [nearest.format(n=n), moved.format(n=n, next=n + 1)]
    steps.append(nearest.format(n=rounds))
    return ",".join(steps) + f"""
select vec_id, cast(cluster as integer) as cluster, cast(distance as bigint) as distance,
  cast(sum(distance) over (partition by cluster) as bigint) as cluster_inertia,
  cast(sum(distance) over () as bigint) as inertia,
  sha256(array_to_string(c, ',')) as centroid_sha256
from a{rounds} join c{rounds} using (cluster)
"""


ORACLE_SQL["op13_centroid_clustering"] = _clustering_sql()
