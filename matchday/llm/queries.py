"""Registered jobs of this package: the thin queries on the given tables and
their DuckDB twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchday.llm import (
    op01_secrets,
    op02_quality,
    op03_pieces,
    op04_mix,
    op05_language,
    op06_spotsigs,
    op07_jaccard,
    op08_shards,
    op09_embeddings,
    op10_lines,
    op11_repair,
    op12_toxicity,
    op13_negatives,
)
from matchday.llm.common import keep



def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finds in each document, and behind the layers of its text."""
    return op01_secrets.scan_secrets(_table(spark, sf_dir, "documents"))


def op2_quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of each document, learned from the labels not held out."""
    out = op05_language.held_out(F.col("doc_id"), 3, 1)
    return op02_quality.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), out)


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of each document, their counts and digest, round trip and parity."""
    return op03_pieces.encode_documents(_table(spark, sf_dir, "documents"), with_ids=True)


def op4_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document, and when."""
    rows = op04_mix.curriculum(_table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "size", "source_size", "target", "taken", "copies", F.round("position", 9).alias("position")
    )


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of each document, learned from those not held out."""
    return op05_language.predict_languages(_table(spark, sf_dir, "documents"))


def op6_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of each document, and likeness to its edited text and to the next document."""
    return op06_spotsigs.compare_with_next(_table(spark, sf_dir, "documents"))


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that share nine tenths of their 3-word shingles."""
    return op07_jaccard.jaccard_components(_table(spark, sf_dir, "documents"), words=3, percent=90)


def op8_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of each document."""
    rows = op08_shards.kd_shards(_table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of cosine 0.9 or more."""
    return op09_embeddings.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op10_site_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visible lines of each page without the boilerplate of its host."""
    pages = _table(spark, sf_dir, "pages").select(
        "page_id", op10_lines.host_of(F.col("url")).alias("host"), op10_lines.html_lines(F.col("html")).alias("text")
    )
    # written: the text is taken out of the HTML once, not for counting and again for dropping
    return op10_lines.drop_boilerplate(keep(pages, "pages"), "host", "text")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cheapest edits of each damaged conversation."""
    return op11_repair.repair(op11_repair.damaged(_table(spark, sf_dir, "conversations")))


def op12_toxicity_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of each document, learned from the labels not held out."""
    out = op05_language.held_out(F.col("doc_id"), 5, 0)
    return op12_toxicity.toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), out)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector and its nearest positives."""
    return op13_negatives.mine_embeddings(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_secret_scan, op2_quality_score, op3_sentencepiece, op4_curriculum_mix, op5_language_id, op6_spotsigs,
        op7_ngram_jaccard_join, op8_kd_shards, op9_embedding_neardup, op10_site_line_dedup, op11_conversation_repair,
        op12_toxicity_score, op13_hard_negatives,
    )
}

_MIX_SQL = r"""
with d as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size
  from documents),
s as (select source, sum(size)::bigint as source_size from d group by source),
w as (select source, source_size, (row_number() over (order by source nulls last) - 1) % 3 as cls from s),
c as (select *, cls + 1 as weight, 3 * source_size as cap from w),
o as (  -- sources in the order in which they reach their cap
  select *, coalesce(sum(cap) over p, 0) as capped, sum(weight) over () - coalesce(sum(weight) over p, 0) as open_w,
         sum(source_size) over () as total
  from c window p as (order by cap::double / weight, source rows between unbounded preceding and 1 preceding)),
f as (  -- the share of the first step whose next source stays below its cap
  select (total - capped)::double / open_w as share from o
  where (total - capped)::double / open_w < cap::double / weight order by cap::double / weight, source limit 1),
t as (select c.source, source_size, cls, least(cap::double, coalesce((select share from f), 1e300) * weight) as target from c),
h as (
  select d.doc_id, d.size, t.source_size, t.target, t.cls, round(t.target)::bigint as want,
         coalesce(sum(d.size) over (partition by d.source
           order by ('0x' || substr(md5(coalesce(d.doc_id::varchar, '') || '|mix'), 1, 8))::bigint >> 1, d.doc_id, d.size
           rows between unbounded preceding and 1 preceding), 0)::bigint as before
  from d join t on d.source is not distinct from t.source),
p as (
  select *, greatest(least(want - before, size), 0) as p0, greatest(least(want - source_size - before, size), 0) as p1,
         greatest(least(want - 2 * source_size - before, size), 0) as p2,
         (before::double + least(want - before, size) / 2e0) / want as share
  from h)
select doc_id, size, source_size, target, (p0 + p1 + p2)::bigint as taken,
       ((p0 > 0)::int + (p1 > 0)::int + (p2 > 0)::int)::int as copies,
       case when p0 > 0 then round(case cls
         when 0 then least(2e0 * share / (1.5e0 + sqrt(greatest(2.25e0 - 2e0 * share, 0e0))), 1e0)
         when 1 then least(share, 1e0)
         else least(2e0 * share / (0.5e0 + sqrt(greatest(0.25e0 + 2e0 * share, 0e0))), 1e0) end, 9) end as position
from p"""

_LINES_SQL = r"""
with x as (
  select page_id, nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '') as host,
    regexp_replace(regexp_replace(regexp_replace(html,
      '<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->', '', 'gis'),
      '<(?:br|hr)\s*/?>|</(?:p|div|li|ul|ol|h[1-6]|title|tr|td|th|table|section|article|nav|header|footer|blockquote|pre)>',
      chr(10), 'gi'), '<[^>]*>', '', 'g') as text
  from pages),
l as (select page_id, host, text, string_split(text, chr(10)) as parts,
        list_transform(string_split(text, chr(10)),
          lambda z: trim(regexp_replace(z, '[ \t\r\x0B\f]+', ' ', 'g'))) as keys from x),
t as (select host, count(*) as pages from x group by host),
e as (select page_id, host, unnest(list_distinct(list_filter(keys, lambda z: z <> ''))) as line from l),
b as (select e.host, e.line from e group by e.host, e.line having count(*) >= 2
        and count(*) > (select any_value(t.pages) from t where t.host is not distinct from e.host) * 0.1),
g as (select host, list(line) as drops from b group by host),
r as (
  select l.page_id, l.host, l.text, coalesce(len(list_filter(keys, lambda z: z <> '')), 0) as solid,
    len(list_filter(keys, lambda z: z <> '' and list_contains(coalesce(drops, []), z))) as gone,
    list_filter(list_zip(parts, keys), lambda z: z[2] = '' or not list_contains(coalesce(drops, []), z[2])) as rest
  from l left join g on l.host is not distinct from g.host)
select page_id, host,
  case when coalesce(gone, 0) = 0 or gone >= solid then text
       else array_to_string(list_transform(rest, lambda z: z[1]), chr(10)) end as text,
  solid::bigint as n_lines, (case when gone is null or gone >= solid then 0 else gone end)::bigint as n_dropped,
  coalesce(gone > 0 and gone >= solid, false) as all_boilerplate
from r"""

_NEGATIVES_SQL = """
with r as (
  select vec_id, (case when vec_id % 7 = 0 then (label + 1) % 10 else label end)::bigint as label,
         list_transform(embedding, lambda z: floor(256 * z::double)::bigint) as v
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda z: z is null or not isfinite(z))) = 0),
p as (
  select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same,
         list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2]))::bigint as score
  from r a join r b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id and len(a.v) = len(b.v)),
g as (
  select anchor_id, other_id as positive_id, score as positive_score from p where same
  qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5),
n as (
  select g.anchor_id, positive_id, positive_score, other_id as negative_id, score as negative_score,
         row_number() over (partition by g.anchor_id, positive_id order by score desc, other_id)::int as rank
  from g join p on p.anchor_id = g.anchor_id and not same
   and 80 * positive_score <= 100 * score and 100 * score <= 100 * positive_score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from n where rank <= 5"""

ORACLE_SQL: dict[str, str] = {
    "op4_curriculum_mix": _MIX_SQL,
    "op10_site_line_dedup": _LINES_SQL,
    "op13_hard_negatives": _NEGATIVES_SQL,
}
