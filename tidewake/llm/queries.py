"""The ten queries, with production parameters over whole tables, and the SQL twins that exist."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewake.llm.decontamination import decontaminate
from tidewake.llm.embedding_join import embedding_join
from tidewake.llm.line_dedup import line_runs
from tidewake.llm.ngram_join import ngram_join
from tidewake.llm.packing import packing
from tidewake.llm.substring_dedup import substring_dedup
from tidewake.llm.suffix_dedup import suffix_dedup
from tidewake.llm.token_codec import token_codec
from tidewake.llm.toxicity import toxicity
from tidewake.llm.url_filter import url_filter


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lines(s, d):
    return line_runs(_table(s, d, "documents")).select("doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {
    "op1_token_codec": lambda s, d: token_codec(_table(s, d, "documents")).select("doc_id", "start", "n_tokens", "ids_crc32"),
    "op2_toxicity": lambda s, d: toxicity(_table(s, d, "documents"), _table(s, d, "labels")).select("doc_id", "held_out", "score", "predicted", "n_toxic_words"),
    "op3_url_filter": lambda s, d: url_filter(_table(s, d, "pages")).select("page_id", "host", "path", "rule", "verdict"),
    "op4_decontaminate": lambda s, d: decontaminate(_table(s, d, "documents"), _table(s, d, "benchmark")),
    "op5_line_dedup": _lines,
    "op6_ngram_join": lambda s, d: ngram_join(_table(s, d, "documents")),
    "op7_packing": lambda s, d: packing(_table(s, d, "documents")),
    "op8_substring_dedup": lambda s, d: substring_dedup(_table(s, d, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256"),
    "op9_suffix_dedup": lambda s, d: suffix_dedup(_table(s, d, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"),
    "op10_embedding_join": lambda s, d: embedding_join(_table(s, d, "embeddings")),
}

ORACLE = {
    # the links of the pages, their transitive closure and the spread verdicts, then the rules
    "op3_url_filter": r"""
with recursive rules as (select * from (values ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'), ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')) r(h, p, v)),
tags as (select url, list_concat(list_transform(regexp_extract_all(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>'), lambda x: regexp_extract(x, '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1)),
  list_transform(regexp_extract_all(html, '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>'), lambda x: regexp_extract(x, '(?is)\burl\s*=\s*["'']?([^"''\s>]+)', 1))) a from pages where url is not null and html is not null and contains(url, '://')),
targets as (select url, replace(t, '&amp;', '&') t, regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1) site, regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) own from (select url, unnest(a) t from tags) where t <> ''),
merged as (select *, string_split(case when starts_with(t, '/') then regexp_extract(t, '(?s)^[^?#]*') else case when own = '' then '/' else regexp_replace(own, '[^/]*$', '') end || regexp_extract(t, '(?s)^[^?#]*') end, '/') s from targets),
walked as (select *, list_reduce(list_transform(s, lambda x: [x]), lambda d, x: case when x[1] = '.' then d when x[1] = '..' then d[1 : greatest(len(d) - 1, 1)] else list_concat(d, x) end) w from merged),
links as (select distinct url, case when regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://') then t when regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*:') or starts_with(t, '#') then null when starts_with(t, '//') then 'http:' || t when starts_with(t, '?') then 'http://' || site || own || t
  else 'http://' || site || array_to_string(w, '/') || case when s[-1] in ('.', '..') or array_to_string(w, '/') = '' then '/' else '' end || regexp_extract(t, '(?s)^[^?#]*(.*)$', 1) end t from walked),
urls as (select distinct url u from pages where url is not null union select t from links where t is not null),
named as (select u, translate(regexp_extract(u, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host, regexp_extract(u, '(?s)^.*?://[^/?#]*([^?#]*)', 1) path, regexp_extract(u, '(?s)^.*?://[^/?#]*[^?#]*(\?[^#]*)', 1) query from urls),
judged as (select u, host, path, case when contains(u, '://') then host || path || query end node,
  (select arg_max([h || p, v], length(h || p)) from rules where (host = h or ends_with(host, '.' || h)) and starts_with(path, p)) m from named),
edges as (select distinct x.node a, y.node b from links l join judged x on x.u = l.url join judged y on y.u = l.t where x.node <> y.node),
both_ways as (select a, b from edges union select b, a from edges),
reach as (select a, b from both_ways union select r.a, e.b from reach r join both_ways e on r.b = e.a),
spread as (select r.a node, bool_or(j.m[2] = 'allow') al, bool_or(j.m[2] = 'block') bl from reach r join judged j on j.node = r.b group by 1)
select p.page_id, coalesce(j.host, '') as host, coalesce(j.path, '') as path, j.m[1] as rule, coalesce(j.m[2], case when s.al then 'allow' when s.bl then 'block' end, 'allow') as verdict
from pages p left join judged j on j.u = p.url left join spread s on s.node = j.node""",
    "op8_substring_dedup": r"""
with w as (select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') a from documents),
pos as (select doc_id, a, unnest(range(len(a) - 12)) i from w where len(a) >= 13),
win as (select doc_id, i, array_to_string(a[i + 1 : i + 13], ' ') s from pos),
hit as (select doc_id, i from (select doc_id, i, min(doc_id) over (partition by s) f from win) where f < doc_id),
gone as (select doc_id, list(distinct k) g from (select doc_id, unnest(range(i, i + 13)) k from hit) group by 1),
words as (select doc_id, unnest(a) x, unnest(range(len(a))) k from w),
kept as (select w.doc_id, coalesce(string_agg(x, ' ' order by k), '') t from words w left join gone g on g.doc_id = w.doc_id where g.g is null or not list_contains(g.g, k) group by 1)
select w.doc_id, len(a)::bigint as n_words, coalesce(len(g.g), 0)::bigint as n_removed, sha256(coalesce(t, '')) as kept_sha256 from w left join gone g using (doc_id) left join kept using (doc_id)""",
    "op10_embedding_join": """
with recursive v as (select vec_id, label, cast(embedding as double[]) e from embeddings),
ok as (select * from v where label is not null and len(e) > 0 and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0 and list_dot_product(e, e) > 0),
links as (select a.vec_id a, b.vec_id b from ok a join ok b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e) where list_dot_product(a.e, b.e) >= 0.98 * sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))),
reach as (select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a),
root as (select a, min(b) m from reach group by 1)
select vec_id, (select count(*) from links where a = vec_id) as n_links, least(vec_id, coalesce(m, vec_id)) as component_id, vec_id = least(vec_id, coalesce(m, vec_id)) as kept from v left join root on a = vec_id""",
}
