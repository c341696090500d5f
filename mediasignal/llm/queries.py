"""The operators as queries over the driver's tables, with DuckDB texts where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from mediasignal.llm.divergence import divergence
from mediasignal.llm.exact_dedup import exact_groups
from mediasignal.llm.license_scan import license_matches
from mediasignal.llm.manifest import audit
from mediasignal.llm.mixing import Mix, mixture
from mediasignal.llm.neighbours import Index
from mediasignal.llm.packing import packed
from mediasignal.llm.quality import fit, quality_scores
from mediasignal.llm.secret_scan import labelled_samples, secret_report, train
from mediasignal.llm.sharding import shard_rows
from mediasignal.llm.simhash import near_copies
from mediasignal.llm.token_counts import token_counts
from mediasignal.llm.url_filter import judge_urls

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def vocabulary(name: str) -> str:
    """Place of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op3_quality_classifier")
def _(spark, d):
    docs = table(spark, d, "documents")
    return quality_scores(docs, fit(docs, table(spark, d, "labels")))


@query("op5_source_mixing", r"""
with d as (
  select doc_id, case when substr(md5(coalesce(source, '')), 1, 1) < 'a' then 'web' else 'reference' end as domain,
    coalesce(lang, '') as lang, coalesce(source, '') as source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as tokens from documents),
n1 as (select domain, (sum(tokens) * 4)::bigint as room,
    case domain when 'web' then 6 when 'reference' then 4 else 1 end as weight,
    ((select sum(tokens) from d) * 800 // 1000)::bigint as given from d group by domain),
s1 as (select *, sum(room) over o * weight + room * (sum(weight) over () - sum(weight) over o)
    <= given * weight as is_full from n1
    window o as (order by room / weight, domain rows unbounded preceding)),
b1 as (select domain, case when is_full then room else weight * (given - coalesce(sum(room) filter (is_full) over (), 0))
    // sum(weight) filter (not is_full) over () end::bigint as budget from s1),
n2 as (select d.domain, lang, (sum(tokens) * 4)::bigint as room,
    case lang when 'en' then 5 when 'fr' then 2 when 'de' then 2 else 1 end as weight, any_value(budget) as given
    from d join b1 using (domain) group by d.domain, lang),
s2 as (select *, sum(room) over o * weight + room * (sum(weight) over (partition by domain) - sum(weight) over o)
    <= given * weight as is_full from n2
    window o as (partition by domain order by room / weight, lang rows unbounded preceding)),
b2 as (select domain, lang, case when is_full then room
    else weight * (given - coalesce(sum(room) filter (is_full) over p, 0)) // sum(weight) filter (not is_full) over p
    end::bigint as budget from s2 window p as (partition by domain)),
n3 as (select d.domain, d.lang, source, sum(tokens)::bigint as tokens, (sum(tokens) * 4)::bigint as room, 1 as weight,
    any_value(budget) as given from d join b2 on d.domain = b2.domain and d.lang = b2.lang group by d.domain, d.lang, source),
s3 as (select *, sum(room) over o * weight + room * (sum(weight) over (partition by domain, lang) - sum(weight) over o)
    <= given * weight as is_full from n3
    window o as (partition by domain, lang order by room / weight, source rows unbounded preceding)),
b3 as (select domain, lang, source, tokens, case when is_full then room
    else weight * (given - coalesce(sum(room) filter (is_full) over p, 0)) // sum(weight) filter (not is_full) over p
    end::bigint as budget from s3 window p as (partition by domain, lang)),
k as (select d.*, coalesce(case when b3.tokens > 0 then budget // b3.tokens end, 0) as whole,
    coalesce(case when b3.tokens > 0 then budget % b3.tokens end, 0) as rest
    from d join b3 on d.domain = b3.domain and d.lang = b3.lang and d.source = b3.source),
o as (select *, md5('mix-1:' || whole || ':' || coalesce(doc_id::varchar, '')) as key from k)
select doc_id, domain, lang, source, tokens,
  (whole + case when rest > 0 and sum(tokens) over (partition by domain, lang, source order by key) <= rest
    then 1 else 0 end)::int as copies from o""")
def _(spark, d):
    return mixture(table(spark, d, "documents"), Mix())


@query("op6_exact_dedup", r"""
with d as (select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as h from documents)
select doc_id, min(doc_id) over (partition by h) as keep_id, count(*) over (partition by h) as group_size,
  doc_id is not distinct from min(doc_id) over (partition by h) as kept, h as text_sha256 from d""")
def _(spark, d):
    return exact_groups(table(spark, d, "documents"))


@query("op7_simhash")
def _(spark, d):
    return near_copies(table(spark, d, "documents"))


@query("op8_packing")
def _(spark, d):
    return packed(table(spark, d, "documents"), vocabulary("word_bpe_49k.json"))


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


@query("op4_url_filter", r"""
with u as (select page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path from pages),
r(h, p, v) as (values ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'),
    ('org', '/fr/', 'allow')),
m as (select page_id, host, path, h || p as rule, v from u left join r
    on (host = h or ends_with(host, '.' || h)) and starts_with(path, p))
select page_id, host, path, rule, coalesce(v, 'allow') as verdict from m
qualify row_number() over (partition by page_id order by length(rule) desc nulls last) = 1""")
def _(spark, d):
    return judge_urls(table(spark, d, "pages"), spark.createDataFrame(RULES, "host string, path string, verdict string"))


@query("op10_token_counts")
def _(spark, d):
    return token_counts(table(spark, d, "documents"), vocabulary("piece_bpe_32k.model"))


@query("op1_secret_scan")
def _(spark, d):
    docs = table(spark, d, "documents")
    return secret_report(docs, train(labelled_samples(docs)))


@query("op9_nearest_neighbours")
def _(spark, d):
    vectors = table(spark, d, "embeddings")
    asked = vectors.where("pmod(vec_id, 20) = 0").withColumnRenamed("vec_id", "query_id")
    return Index(vectors).search(asked, 20)


@query("op2_license_scan")
def _(spark, d):
    return license_matches(table(spark, d, "documents"))


@query("op13_source_divergence", r"""
with d as (select row_number() over () as row, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as words from documents),
w as (select row, lang, source, unnest(words) as term from d),
k as (select lang, term, count(*)::hugeint as ln from w group by all having count(distinct row) >= 3),
l as (select lang, count(*)::hugeint as v, sum(ln)::hugeint as lt from k group by lang),
c as (select lang, source, term, count(*)::hugeint as n from w semi join k using (lang, term) group by all),
g as (select lang, source, coalesce(sum(n), 0)::hugeint as total from (select distinct lang, source from d)
    left join c using (lang, source) group by all),
gp as (select g.lang, g.source, k.term, coalesce(n, 0) as n, 1 + 1000000000 * (coalesce(n, 0) + 1) // (total + v) as p,
    1 + 1000000000 * (ln + 1) // (lt + v) as lp
    from g join k using (lang) join l using (lang) left join c on c.lang = g.lang and c.source = g.source and c.term = k.term),
pairs as (select a.lang, a.source, b.source as item from g a join g b on a.lang = b.lang and a.source <> b.source),
sums as (select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p)::bigint as value
    from gp a join gp b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
pv as (select lang, source, item, coalesce(value, 0)::bigint as value from pairs left join sums using (lang, source, item)),
tv as (select lang, source, term as item, ((p - lp) * (p - lp) // lp)::bigint as value from gp where n > 0 and p > lp)
select lang, source, 'pair' as part, item, value,
  row_number() over (partition by lang, source order by value desc, item)::int as rank from pv
union all
select * from (select lang, source, 'term' as part, item, value,
  row_number() over (partition by lang, source order by value desc, item)::int as rank from tv) where rank <= 200""")
def _(spark, d):
    return divergence(table(spark, d, "documents"))


@query("op11_merkle_manifest", r"""
with recursive f as (select doc_id, lang, coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-')
    || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
    || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') as head, text, xor(4294967295, list_reduce(
      list_prepend(4294967295::bigint, flatten(list_transform(range(1, length(doc_id::varchar) + 1),
        lambda i: [ord(substr(doc_id::varchar, i::bigint, 1))::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda c, x: case when x >= 0 then xor(c, x) else xor(c >> 1, case when c & 1 = 1 then 3988292384 else 0 end) end)) % 3 = 0
      as changed from documents),
leaves as (select doc_id, lang, leaf, claimed, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as rank
    from (select doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) as leaf,
      sha256(head || coalesce(strlen(text) || ':' || case when changed then
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') else text end, '-')) as claimed from f)),
up as (select coalesce('l' || lang, 'a') as tree, 0 as h, rank as pos, leaf as digest, '' as kids from leaves
    union all
    select tree, h + 1, pos // 8, sha256(string_agg(digest, '' order by pos)), string_agg(digest, '' order by pos)
    from (select *, count(*) over (partition by tree) as n from up) where n > 1 group by tree, h, pos // 8),
subs as (select tree, arg_max(digest, h) as digest, row_number() over (order by tree) - 1 as rank from up group by tree),
top as (select 0 as h, rank as pos, digest, '' as kids from subs
    union all
    select h + 1, pos // 8, sha256(string_agg(digest, '' order by pos)), string_agg(digest, '' order by pos)
    from (select *, count(*) over () as n from top) where n > 1 group by h, pos // 8),
seg as (select c.tree, c.h, c.pos, substr(p.kids, 1, 64 * (c.pos % 8)) || ':' || substr(p.kids, 64 * (c.pos % 8) + 65) as s
    from up c join up p on c.tree = p.tree and p.h = c.h + 1 and p.pos = c.pos // 8),
top_seg as (select c.h, c.pos, substr(p.kids, 1, 64 * (c.pos % 8)) || ':' || substr(p.kids, 64 * (c.pos % 8) + 65) as s
    from top c join top p on p.h = c.h + 1 and p.pos = c.pos // 8),
steps as (select tree, rank, h, s from (select distinct coalesce('l' || lang, 'a') as tree, rank from leaves) l
      join seg using (tree) where seg.pos = l.rank // (8 ** seg.h)::bigint
    union all
    select l.tree, l.rank, 1000 + h, s from (select distinct coalesce('l' || lang, 'a') as tree, rank from leaves) l
      join subs on subs.tree = l.tree join top_seg on top_seg.pos = subs.rank // (8 ** top_seg.h)::bigint),
paths as (select tree, rank, list(s order by h) as path from steps group by tree, rank),
folds as (select doc_id, leaf, subs.digest as subroot, (select digest from top order by h desc limit 1) as root,
    sha256(replace(coalesce(array_to_string(path, ''), ''), ':', '')) as proof_sha256,
    list_reduce(list_prepend(claimed, coalesce(path, [])), lambda a, x: sha256(split_part(x, ':', 1) || a || split_part(x, ':', 2)))
      as folded_root
    from leaves l join subs on subs.tree = coalesce('l' || lang, 'a')
    left join paths on paths.tree = subs.tree and paths.rank = l.rank)
select *, folded_root = root as verified from folds""")
def _(spark, d):
    return audit(table(spark, d, "documents"))


@query("op12_sharding")
def _(spark, d):
    return shard_rows(table(spark, d, "documents"))
