"""Registered queries of the training-data operators, with SQL where SQL can say it."""

from __future__ import annotations

import zlib
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart.llm import bpe, hosts, lines, mixing, periods, phrases, quality, sharding, simhash, sketch, topk, toxicity, vectors
from tillmart.llm.common import WORD, held_out, stored, table, text_of

VOCABULARY = "byte_bpe_50k.json"


class Query(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _sha(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def mixed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = stored(table(spark, sf_dir, "documents").select("doc_id", "source", words().alias("size")), "sizes")
    mixed = mixing.mix(documents, F.col("size"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def text_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.fingerprints_with_edits(table(spark, sf_dir, "documents"))


def byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", text_of().alias("text"))
    encoded = bpe.encode(documents, vocabulary_path()).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        _sha(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_sha256"), "ids",
    )
    decoded = bpe.decode(encoded, vocabulary_path())
    return decoded.select("doc_id", "n_tokens", "ids_sha256", _sha(F.col("decoded")).alias("decoded_sha256"))


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = quality.score_quality(documents.select("doc_id", "text"), labels, held_out())
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= quality.LIMIT).cast("int").alias("predicted")
    )


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = toxicity.score_toxicity(documents.select("doc_id", "text"), labels, held_out())
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= toxicity.LIMIT).cast("int").alias("predicted")
    )


def simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("simhash")), 16, "0").alias("fingerprint"), "component_id")


def site_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return lines.drop_site_lines(documents).select("doc_id", "text", "n_lines", "n_dropped")


SITE_LINES_SQL = r"""
with d as (select doc_id, source, text, string_split(text, chr(10)) as ls from documents),
totals as (select source, count(*) as total from d group by source),
held as (
  select source, line, count(*) as n
  from (select source, unnest(list_distinct(list_filter(ls, lambda x: trim(x) <> ''))) as line from d)
  group by source, line having count(*) >= 5),
bad as (
  select h.source, list(h.line) as bl from held h join totals t on h.source is not distinct from t.source
  where h.n > 0.1 * t.total group by h.source),
cut as (
  select doc_id, text, ls, case when bl is null then ls else list_filter(ls, lambda x: not list_contains(bl, x)) end as kept
  from d left join bad on d.source is not distinct from bad.source)
select doc_id, case when text is null then null else coalesce(array_to_string(kept, chr(10)), '') end as text,
  coalesce(len(ls), 0) as n_lines, coalesce(len(ls) - len(kept), 0) as n_dropped
from cut
"""

#: The rules of the url query.
URL_RULES = (
    hosts.Rule("allow", "com", "/"),
    hosts.Rule("block", "example.com", "/en/"),
    hosts.Rule("allow", "www.example.com", "/en/"),
    hosts.Rule("block", "net", "/es/"),
    hosts.Rule("block", "net", "/fr/"),
)


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Hosts of the pages whose document is labelled; pages name their document by number in the path.

    A page is bad when its document is of low quality or toxic; a page labelled twice counts once.
    """
    named = pages.select(
        hosts.host_of().alias("host"), F.regexp_extract(hosts.path_of(), r"^/[a-z]+/([0-9]{1,18})", 1).alias("number")
    ).filter("number <> ''").select("host", F.col("number").cast("long").alias("doc_id"))
    bad = labels.groupBy("doc_id").agg(F.max(((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")).alias("bad"))
    return named.join(bad, "doc_id").select("host", (F.col("bad") == 1).alias("bad"))


def url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    outcomes = page_outcomes(pages, table(spark, sf_dir, "labels"))
    return hosts.judge(pages, outcomes, URL_RULES).drop("url")


URL_SQL = r"""
with p as (
  select page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') as path
  from pages),
rules (verdict, host, path) as (values
  ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
  ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
fit as (
  select u.host, u.path, arg_max(r.host || r.path, length(r.host || r.path)) as rule,
    arg_max(r.verdict, length(r.host || r.path)) as verdict
  from (select distinct host, path from p) u
  join rules r on (u.host = r.host or ends_with(u.host, '.' || r.host)) and starts_with(u.path, r.path)
  group by u.host, u.path),
marks as (select doc_id, max(case when quality = 0 or toxic = 1 then 1 else 0 end) as bad from labels group by doc_id),
bare as (
  select host, count(bad)::double as n, coalesce(sum(bad), 0)::double as k,
    regexp_replace(regexp_replace(host, '^[^@]*@', ''), ':[0-9]*$', '') as b
  from p left join marks m on m.doc_id = try_cast(nullif(regexp_extract(path, '^/[a-z]+/([0-9]{1,18})', 1), '') as bigint)
  group by host),
two as (select *, array_to_string(string_split(b, '.')[-2:], '.') as last2 from bare),
h as (
  select host, n, k,
    case when last2 in ('co.uk','org.uk','ac.uk','com.au','co.jp','com.br','co.nz','co.in','com.cn')
      then array_to_string(string_split(b, '.')[-3:], '.') else last2 end as domain,
    case when last2 in ('co.uk','org.uk','ac.uk','com.au','co.jp','com.br','co.nz','co.in','com.cn')
      then last2 else string_split(b, '.')[-1] end as suffix
  from two),
d as (select suffix, domain, sum(n) as n, sum(k) as k from h group by suffix, domain),
s as (select suffix, sum(n) as n, sum(k) as k from d group by suffix),
levels as (
  select 'h' as l, count(*) - 1 as f, sum(k * k / n) as k2, sum(n * n) as n2, sum(n) as n, sum(k) as k from h where n > 0 group by suffix, domain union all
  select 'd', count(*) - 1, sum(k * k / n), sum(n * n), sum(n), sum(k) from d where n > 0 group by suffix union all
  select 's', count(*) - 1, sum(k * k / n), sum(n * n), sum(n), sum(k) from s where n > 0),
sums as (
  select l, sum(k2 - k * k / n - f * v) as over, sum(v * (n - n2 / n - f)) as room
  from (select *, (k + 1) / (n + 2) * (1 - (k + 1) / (n + 2)) as v from levels) group by l),
w as (
  select l, case when coalesce(room, 0) <= 0 or over <= 0 then 10000.0 else least(greatest(room / over - 1, 1.0), 10000.0) end as m
  from sums),
wide as (
  select coalesce(max(m) filter (l = 'h'), 10000) as mh, coalesce(max(m) filter (l = 'd'), 10000) as md, coalesce(max(m) filter (l = 's'), 10000) as ms,
    (select (coalesce(sum(k), 0) + 1) / (coalesce(sum(n), 0) + 2) from s) as p0
  from w),
sr as (
  select suffix, n, (k + w * p0) / (n + w) as r
  from (select s.*, p0, least(ms, (select coalesce(sum(n), 0) from s) + 1) as w from s, wide)),
dr as (
  select suffix, domain, n, (k + w * r) / (n + w) as r
  from (select d.*, sr.r, least(md, sr.n + 1) as w from d join sr using (suffix), wide)),
hr as (
  select host, n, k, (k + w * r) / (n + w) as r, n + w as size
  from (select h.*, dr.r, least(mh, dr.n + 1) as w from h join dr on h.suffix = dr.suffix and h.domain = dr.domain, wide)),
judged as (select host, n, k, r - 1.645 * sqrt(r * (1 - r) / (size + 1)) > 0.5 as blocked from hr)
select p.page_id, p.host, p.path, fit.rule,
  coalesce(fit.verdict, case when judged.blocked then 'block' else 'allow' end) as verdict,
  coalesce(judged.n, 0)::bigint as host_pages, coalesce(judged.k, 0)::bigint as host_bad
from p left join fit on p.host = fit.host and p.path = fit.path left join judged on p.host = judged.host
"""

def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of the run query: of every tenth id, by its checksum, those from some word on repeat with a period."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    period = words[a:a + p]
    return words[:a] + (period * (-(-(n - a) // p)))[:n - a]


def word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periods.periodic_runs(table(spark, sf_dir, "documents"), prepare=planted)
    # The greatest length / period, compared exactly, and of equal ones the first.
    better = F.expr("""
        aggregate(runs, cast(null as struct<start: bigint, length: bigint, period: bigint>), (best, run) ->
          case when best is null or cast(run.length as decimal(19,0)) * best.period > cast(best.length as decimal(19,0)) * run.period
               then run else best end)""")
    listed = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.withColumn("best", better).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        _sha(listed).alias("runs_sha256"), _sha(F.col("collapsed")).alias("collapsed_sha256"),
    )


def phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


PHRASES_SQL = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(string_split_regex(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents where text is not null),
w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as ws from pieces),
grams as (
  select lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) as phrase
  from w, (select unnest(range(1, 6)) as k) where len(ws) >= k),
f as (select lang, k, phrase, count(*) as f from grams group by all),
total as (select lang, sum(f)::bigint as n from f where k = 1 group by lang),
often as (select * from f where f >= 100),
cuts as (
  select lang, phrase, k, f as a, string_split(phrase, ' ') as ws, unnest(range(1, k)) as cut from often where k > 1),
sized as (
  select c.lang, c.phrase, c.k, c.a, c.cut, x.f as l, y.f as r, n, (1000::hugeint * c.a * n) // (x.f::hugeint * y.f) as score
  from cuts c join often x on x.lang = c.lang and x.phrase = array_to_string(c.ws[1:c.cut], ' ')
  join often y on y.lang = c.lang and y.phrase = array_to_string(c.ws[c.cut + 1:], ' ')
  join total t on t.lang = c.lang),
low as (select * from sized qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
kept as (
  select * from low c where not exists (
    select 1 from low o where o.lang = c.lang and o.k > c.k and o.a >= c.a
      and contains(' ' || o.phrase || ' ', ' ' || c.phrase || ' ')))
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank,
  phrase, a, l, r, n, score::bigint as score
from kept qualify rank <= 2000
"""


def embedding_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding").filter(finite)
    rows = rows.select("vec_id", F.transform("embedding", lambda x: F.floor(64 * x.cast("double"))).alias("vector"))
    return topk.best_products(rows, F.col("vec_id") % 20 == 0)


PRODUCTS_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pairs as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
  from v q join v c on q.vec_id <> c.vec_id and len(q.v) = len(c.v) where q.vec_id % 20 = 0)
select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score
from pairs qualify rank <= 20
"""

QUERIES: dict[str, Query] = {
    "op1_mixing": Query(mixed_sources),
    "op2_bpe": Query(bpe_round_trip),
    "op3_quality": Query(quality_scores),
    "op4_fingerprints": Query(text_fingerprints),
    "op5_sharding": Query(byte_shards),
    "op6_embedding_dedup": Query(embedding_links),
    "op7_simhash": Query(simhash_groups),
    "op8_line_dedup": Query(site_lines, SITE_LINES_SQL),
    "op9_toxicity": Query(toxicity_scores),
    "op10_url_filter": Query(url_verdicts, URL_SQL),
    "op11_periods": Query(word_runs),
    "op12_phrases": Query(phrase_collocations, PHRASES_SQL),
    "op13_topk": Query(embedding_products, PRODUCTS_SQL),
}
