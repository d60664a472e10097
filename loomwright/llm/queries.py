"""One query for each operator, over its whole table with production parameters, and SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import dedup, licenses, media, mixing, packing, pii, quality, sharding, toxicity, urlgraph
from .common import table


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxic(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.schedule(table(spark, sf_dir, "documents"))


def op6_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return media.sequences(pages, media.page_payloads(pages))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").where("quality = 1")
    return quality.scored(table(spark, sf_dir, "documents"), trusted).where("keep").select("doc_id", "score")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlgraph.filter_pages(table(spark, sf_dir, "pages"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_minhash_near_dedup, op2_best_fit_packing, op3_sharding, op4_toxicity, op5_mixing, op6_media_columns, op7_quality, op8_url_filter, op9_license_scan, op10_pii)}


def _mixing_sql() -> str:
    b, a = mixing.BLOCK, mixing.ALPHA
    return f"""
with d as (select doc_id, source, len(regexp_extract_all(text, '[^ \\t\\n\\f\\r]+')) as n_tokens, md5('mix' || coalesce(doc_id::varchar, '')) as h from documents),
p as (select *, (sum(n_tokens) over (partition by source order by h, doc_id, n_tokens rows between unbounded preceding and current row) - n_tokens)::bigint as begins from d where n_tokens > 0),
s as (select source, sum(n_tokens) as n, pow(sum(n_tokens), {a}) as w from p group by 1),
c as (select source, ceil(n / {b}) as blocks, sum(w) over (order by source nulls first) / sum(w) over () as hi, coalesce(sum(w) over (order by source nulls first rows between unbounded preceding and 1 preceding), 0) / sum(w) over () as lo from s),
e as (select source, blocks, round(lo * 4294967296)::bigint as lo, round(hi * 4294967296)::bigint as hi from c),
t as (select i as slot, (i * 2654435769) % 4294967296 as u from range((select sum(blocks)::bigint from e)) r(i)),
q as (select slot, source, blocks, row_number() over (partition by source order by slot) - 1 as block from t join e on u >= lo and u < hi),
k as (select coalesce(min(slot), 9223372036854775807) as stop from q where block >= blocks)
select slot, p.source, block, doc_id, n_tokens, begins from p join q on p.source is not distinct from q.source and p.begins // {b} = q.block where slot < (select stop from k)"""


def oracle_sql() -> dict[str, str]:
    return {"op5_mixing": _mixing_sql(), "op8_url_filter": urlgraph.sql(), "op9_license_scan": licenses.sql()}
