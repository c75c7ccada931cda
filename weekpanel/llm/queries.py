"""One query for each operator over its whole table, as the check and the comparison with SQL run it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontam, divergence, html_extract, langid, packing, quality, repair, secrets, simhash, substring, token_count, topk
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op2_quality")
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.score(docs, quality.train(docs, labels)).select("doc_id", "held_out", "score", "predicted")


@query("op3_bpe")
def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe.digests(docs).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query("op4_token_counts")
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_count.token_counts(docs).select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query("op6_secrets")
def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.find(docs).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


@query("op8_langid")
def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.train(docs)).select("doc_id", "held_out", "lang_pred", "score")


OP9_SQL = r"""
with item as (
  select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') w
  from benchmark where item_id is not null and text is not null),
win as (
  select item_id, least(len(w), 13) n, unnest(generate_series(1, greatest(len(w) - 12, 1))) s, w from item where len(w) > 0),
grams as (select distinct cast(item_id as varchar) item_id, n, array_to_string(w[s : s + n - 1], ' ') g from win),
sizes as (select distinct n from grams),
docs as (
  select row_number() over () r, doc_id,
    coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+'), []) w
  from documents),
spot as (select r, n, w, unnest(generate_series(1, len(w) - n + 1)) s from docs, sizes where len(w) >= n),
hits as (
  select spot.r, spot.s, spot.n, grams.item_id from spot join grams on grams.n = spot.n and grams.g = array_to_string(spot.w[spot.s : spot.s + spot.n - 1], ' ')),
hit_words as (select r, count(distinct p) n_hit from (select r, unnest(generate_series(s, s + n - 1)) p from (select distinct r, s, n from hits)) group by r),
hit_items as (
  select r, count(*) n_items, string_agg(item_id, ',' order by item_id) items from (select distinct r, item_id from hits) group by r)
select doc_id, cast(len(w) as bigint) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items,
  sha256(coalesce(items, '')) items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) contaminated
from docs left join hit_words using (r) left join hit_items using (r)
"""


@query("op9_decontamination", OP9_SQL)
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    return decontam.digests(found).select(*columns)


@query("op10_simhash")
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    fingerprint = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return marked.select("doc_id", fingerprint, "component_id")


OP7_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) q from embeddings
  where embedding is not null and len(embedding) > 0 and vec_id is not null
    and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)),
s as (
  select a.vec_id query_id, b.vec_id, cast(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) as bigint) score
  from v a join v b on a.vec_id % 20 = 0 and a.vec_id <> b.vec_id and len(a.q) = len(b.q)),
r as (select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) "rank", vec_id, score from s)
select * from r where "rank" <= 20
"""


@query("op7_topk", OP7_SQL)
def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op1_html_extraction")
def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


OP5_SQL = r"""
with docs as (
  select row_number() over () r, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) w from documents),
win as (select r, unnest(generate_series(1, len(w) - 34)) s, w from docs where len(w) >= 35),
keyed as (select r, s, md5(array_to_string(w[s : s + 34], ' ')) g from win),
again as (select g from keyed group by g having count(*) > 1),
starts as (select r, s from keyed where g in (select g from again)),
gone as (select distinct r, unnest(generate_series(s, s + 34)) p from starts),
word as (select r, unnest(w) word, unnest(generate_series(1, len(w))) p from docs),
kept as (
  select r, count(*) n, string_agg(word, ' ' order by p) k from word anti join gone using (r, p) group by r)
select doc_id, cast(len(w) as bigint) n_words, cast(len(w) - coalesce(n, 0) as bigint) n_removed, sha256(coalesce(k, '')) kept_sha256
from docs left join kept using (r)
"""


@query("op5_substring_dedup", OP5_SQL)
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring.remove(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op11_packing")
def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
    return packing.pack_documents(table(spark, sf_dir, "documents")).select(*columns)


OP12_SQL = r"""
with d as (
  select row_number() over () r, coalesce(lang, '') lang, coalesce(source, '') source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') w
  from documents),
occurs as (select r, lang, source, unnest(w) term from d),
counts as (select lang, source, term, count(*) n, count(distinct r) n_docs from occurs group by all),
kept as (select lang, term, sum(n)::bigint n from counts group by lang, term having sum(n_docs) >= 10),
size as (select lang, count(*) v, sum(n)::bigint n from kept group by lang),
grp as (
  select g.lang, g.source, coalesce(s.v, 0) v, coalesce(s.n, 0) lang_n, coalesce(sum(c.n), 0)::bigint n
  from (select distinct lang, source from d) g left join size s using (lang)
  left join (select counts.* from counts join kept using (lang, term)) c on c.lang = g.lang and c.source = g.source group by all),
grid as (
  select g.lang, g.source, k.term, coalesce(c.n, 0) c,
    (1 + (1000000000::hugeint * (coalesce(c.n, 0) + 2)) // (g.n + 2 * g.v))::bigint p,
    (1 + (1000000000::hugeint * (k.n + 2)) // (g.lang_n + 2 * g.v))::bigint q
  from grp g join kept k using (lang) left join counts c on c.lang = g.lang and c.source = g.source and c.term = k.term),
pairs as (
  select a.lang, a.source, b.source item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p))::bigint f
  from grid a join grid b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
parts as (
  select a.lang, a.source, 'pair' part, b.source item, coalesce(f, 0) as "value"
  from grp a join grp b on a.lang = b.lang and a.source <> b.source
  left join pairs p on p.lang = a.lang and p.source = a.source and p.item = b.source
  union all
  select lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) from grid where c > 0 and p > q),
ranked as (select *, cast(row_number() over (partition by lang, source, part order by "value" desc, item) as integer) "rank" from parts)
select lang, source, part, item, "value", "rank" from ranked where part = 'pair' or "rank" <= 10
"""


@query("op12_source_audit", OP12_SQL)
def op12_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


@query("op13_conversation_repair")
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(repair.damage(table(spark, sf_dir, "conversations")))
