"""Every operator as a query over the driver's tables, with its DuckDB text."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from checks import oracle as o
from mediasignal import schemas
from mediasignal.functions import dates, text, themes, urls
from mediasignal.functions.html import add_main_text
from mediasignal.operators import articles as art
from mediasignal.operators import columns as col
from mediasignal.operators import dedupe, grid, quality
from mediasignal.operators import score as sc
from mediasignal.operators.entities import add_entities
from mediasignal.operators.language import add_language, add_language_name, language_basis
from mediasignal.operators.ngrams import LanguageModel, gram_weights
from mediasignal.operators.sentiment import (
    FAILED, KINDS, LABEL, SCORE, add_classifier_sentiment, add_no_content, add_sentiment, fit_text_classifier, log_loss,
)
from mediasignal.operators.translate import add_translation
from mediasignal.plans import enrich as en
from mediasignal.plans.collect import collect
from mediasignal.plans.runner import run_stages
from mediasignal.session import staging_root
from mediasignal.sources.datasets import Datasets
from mediasignal.sources.pages import join_pages, join_texts, page_texts
from mediasignal.sources.responses import hits
from mediasignal.streaming.incremental import enrich_new_files, read_enriched

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
CONFIG = fx.CONFIG
LABEL_Q, SCORE_Q = f'"{LABEL}"', f'"{SCORE}"'


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = o.sql(sql)
        return fn

    return register


def table_config(spark: SparkSession, sf_dir: str, **over) -> object:
    """The check configuration with every word table as a DataFrame, always joined."""
    tables = {"language_profile": "fx_profile", "language_names": "fx_names", "lexicon": "fx_lexicon",
              "polarity": "fx_polarity", "gazetteer": "fx_gazetteer"}
    frames = {k: fx.fixture(spark, sf_dir, v) for k, v in tables.items()}
    return replace(CONFIG, inline_entries=0, **{**frames, **over})


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{staging_root(spark)}/{name}-{uuid.uuid4().hex}"


# --------------------------------------------------------------------------- sources and sinks
@query("io_read", "select * replace (cast(o_orderdate as date) as o_orderdate) from orders")
def _(spark, d):
    return Datasets(spark, d).read("orders.parquet").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))


@query("io_read_projected", """
select l_orderkey, l_suppkey, l_quantity from (
  select *, row_number() over (partition by l_orderkey order by l_suppkey, l_quantity) as rn from lineitem) where rn = 1""")
def _(spark, d):
    return Datasets(spark, d).read("lineitem.parquet", columns=["l_orderkey", "absent", "l_suppkey", "l_quantity"],
                                   dedupe_on="l_orderkey")


@query("io_base_df", 'select "URL", "Date", "Title", "Country", "Domain", "Keywords" from base')
def _(spark, d):
    return en.base_articles(fx.articles(spark, d).withColumn("extra", F.lit(1)), CONFIG)


@query("io_responses", "select ord, pos, url, title, sourcecountry, coalesce(json_type(themes), 'NONE') as kind from hits")
def _(spark, d):
    kind = F.schema_of_variant("themes")
    name = (F.when(kind.startswith("ARRAY"), "ARRAY").when(kind == "STRING", "VARCHAR")
            .when(kind == "BIGINT", "UBIGINT").otherwise("NONE"))
    return hits(fx.responses(spark, d)).select("ord", "pos", "url", "title", "sourcecountry", name.alias("kind"))


@query("io_pages", """
select id, page_ok, text_full from (select ord as id, url from fx_articles) a
left join (select url as u, coalesce(page_ok, false) as ok, text from page_texts) p on a.url = p.u,
lateral (select coalesce(ok, false) as page_ok, case when ok then text else '' end as text_full)""")
def _(spark, d):
    arts = fx.fixture(spark, d, "fx_articles").selectExpr("ord as id", "url as URL")
    return join_pages(arts, fx.pages(spark, d)).select("id", "page_ok", "text_full")


@query("io_roundtrip", "select * from fx_responses")
def _(spark, d):
    store = Datasets(spark, new_folder(spark, "roundtrip"))
    store.write("raw", fx.responses(spark, d))
    store.write("raw", fx.responses(spark, d))
    return store.read("raw", schema=schemas.RESPONSE)


@query("io_overwrite_week", """
select ord, cast(date_trunc('week', day) as date) as run_week, code from fx_responses""")
def _(spark, d):
    rows = fx.responses(spark, d).withColumn("run_week", dates.week_start(F.col("day"))).select("ord", "code", "run_week")
    last = rows.agg(F.max("run_week").alias("run_week"))
    store = Datasets(spark, new_folder(spark, "weeks"))
    store.write("raw", rows, partition_by="run_week")
    store.write("raw", rows.join(F.broadcast(last), "run_week", "left_semi"), partition_by="run_week")
    return store.read("raw").select("ord", "run_week", "code")


@query("io_empty_policy", """
select 'skip' as policy, count(*) as n, false as wrote from orders union all select 'write', 0, true""")
def _(spark, d):
    orders = spark.read.parquet(f"{d}/orders.parquet")
    none = orders.where("o_totalprice < 0")
    store = Datasets(spark, new_folder(spark, "empty"))
    out = []
    for policy in ("skip", "write"):
        store.write(policy, orders)
        wrote = store.write(policy, none, on_empty=policy)
        out.append(store.read(policy, schema=orders.schema).agg(F.count(F.lit(1)).alias("n"))
                   .select(F.lit(policy).alias("policy"), "n", F.lit(wrote).alias("wrote")))
    return dedupe.union_rows(out)


@query("io_empty_input", 'select * from rollup where article_count < 0')
def _(spark, d):
    return sc.score(fx.scored(spark, d).where(F.col(f"`{SCORE}`") > 1), CONFIG, order=["Date", "ord"])


@query("io_incremental", 'select * from enriched')
def _(spark, d):
    landing, sink, mark = (new_folder(spark, n) for n in ("landing", "sink", "mark"))
    rows = fx.articles(spark, d)
    # Copies of an article land in date order, so the first landed is the first by date.
    early = F.col("Date") < "2024-01-08"
    for part in (rows.where(early), rows.where(~early)):
        part.repartition(3).write.mode("append").parquet(landing)
        enrich_new_files(spark, landing, fx.pages(spark, d), sink, mark, CONFIG, max_files=10)
    enrich_new_files(spark, landing, fx.pages(spark, d), sink, mark, CONFIG)
    return read_enriched(spark, sink)


# --------------------------------------------------------------------------- request grid
@query("gen_week", """
select distinct cast(o_orderdate as date) as run_date, cast(date_trunc('week', o_orderdate) as date) as week_start,
  cast(date_trunc('week', o_orderdate) as date) + 6 as week_end from orders""")
def _(spark, d):
    runs = spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_orderdate").cast("date").alias("run_date")).distinct()
    return grid.week_of(runs, "run_date")


def _weeks(spark, d):
    days = spark.read.parquet(f"{d}/events.parquet").select(F.col("ts").cast("date").alias("run_date"))
    return grid.week_of(days, "run_date").select("week_start", "week_end").distinct()


@query("gen_days", "select week_start, week_start + cast(k as int) as day from weeks, range(0, 7) r(k)")
def _(spark, d):
    return grid.week_days(_weeks(spark, d)).select("week_start", "day")


@query("gen_windows", "select distinct day, win, window_start, window_end from grid")
def _(spark, d):
    return grid.day_windows(grid.week_days(_weeks(spark, d)), CONFIG.window_hours).select(
        "day", "win", "window_start", "window_end")


@query("gen_countries", """
select c.code, count(r.ord) as landed from (select distinct code from fx_regions) c
left join fx_responses r on c.code = r.code group by 1""")
def _(spark, d):
    codes = grid.distinct_codes(grid.country_dimension(spark, CONFIG))
    landed = fx.responses(spark, d).groupBy("code").agg(F.count(F.lit(1)).alias("landed"))
    return codes.join(landed, "code", "left").fillna(0, ["landed"])


@query("gen_keyword_query", f"""
select day, {o.q(o.KEYWORD_QUERY)} as keyword_query, count(*) as landed from fx_responses group by 1""")
def _(spark, d):
    return (fx.responses(spark, d).groupBy("day").agg(F.count(F.lit(1)).alias("landed"))
            .select("day", grid.keyword_query(CONFIG).alias("keyword_query"), "landed"))


@query("gen_country_query", f"""
select code, {o.q(o.KEYWORD_QUERY)} || ' sourcecountry:' || code as country_query, count(*) as landed
from fx_responses group by 1""")
def _(spark, d):
    return (fx.responses(spark, d).groupBy("code").agg(F.count(F.lit(1)).alias("landed"))
            .select("code", grid.country_query(F.col("code"), CONFIG).alias("country_query"), "landed"))


@query("gen_grid", """
select g.*, count(r.ord) as landed from grid g left join fx_responses r on g.day = r.day and g.win = r.win and g.code = r.code
group by all""")
def _(spark, d):
    landed = fx.responses(spark, d).groupBy("day", "win", "code").agg(F.count(F.lit(1)).alias("landed"))
    return (grid.request_grid(_weeks(spark, d), CONFIG).join(landed, ["day", "win", "code"], "left")
            .fillna(0, ["landed"]))


@query("gen_request_url", f"""
select day, win, code, {o.request_url('code', 'window_start', 'window_end')} as url from grid""")
def _(spark, d):
    url = grid.request_url(F.col("code"), F.col("window_start"), F.col("window_end"), CONFIG)
    return grid.request_grid(_weeks(spark, d), CONFIG).select("day", "win", "code", url.alias("url"))


# --------------------------------------------------------------------------- projections
@query("prj_available", "select url, title from fx_articles")
def _(spark, d):
    return col.select_available(fx.fixture(spark, d, "fx_articles"), ["url", "absent", "title"])


@query("prj_rename", 'select ord as "Order", country as "COUNTRY", dt as "Year-Month" from fx_scored')
def _(spark, d):
    return col.rename(fx.fixture(spark, d, "fx_scored").select("ord", "country", "dt"),
                      {"ord": "Order", "country": "COUNTRY", "dt": "Year-Month"})


@query("prj_drop", "select * exclude (label) from fx_scored")
def _(spark, d):
    return fx.fixture(spark, d, "fx_scored").drop("label")


@query("prj_order", 'select * from rollup')
def _(spark, d):
    return sc.rollup(sc.clean(fx.scored(spark, d), CONFIG, ["Date", "ord"])).select(*[f"`{c}`" for c in sc.OUTPUT])


@query("prj_defaults", "select ord, pos, coalesce(title, '') as title, coalesce(nullif(sourcecountry, ''), 'Unknown') as country from hits")
def _(spark, d):
    return hits(fx.responses(spark, d)).select(
        "ord", "pos", text.default_text(F.col("title"), "").alias("title"),
        text.default_text(F.col("sourcecountry"), "Unknown").alias("country"))


@query("prj_alt_names", """
select id, coalesce(nullif(body, ''), nullif(title, ''), '') as "Title", lang from fx_texts""")
def _(spark, d):
    both = fx.fixture(spark, d, "fx_texts").toDF("id", "Title", "title", "lang")
    return col.merge_spellings(both, Title=("title", "Title"))


@query("prj_article_row", 'select * from article_rows')
def _(spark, d):
    return art.article_rows(art.drop_empty_url(hits(fx.responses(spark, d))))


# --------------------------------------------------------------------------- filters
@query("flt_empty_url", "select ord, pos, url from clean_hits")
def _(spark, d):
    return art.drop_empty_url(hits(fx.responses(spark, d))).select("ord", "pos", "url")


@query("flt_eligible_url", f"select ord, url from fx_articles where {o.eligible('url')}")
def _(spark, d):
    return fx.fixture(spark, d, "fx_articles").where(urls.eligible(F.col("url"))).select("ord", "url")


@query("flt_usable_response", "select distinct ord from hits")
def _(spark, d):
    return hits(art.usable_responses(fx.responses(spark, d))).select("ord").distinct()


@query("flt_score_present", "select ord, score from fx_scored where score is not null")
def _(spark, d):
    nan = F.when(F.col(f"`{SCORE}`").isNull(), float("nan")).otherwise(F.col(f"`{SCORE}`"))
    rows = fx.scored(spark, d).withColumn(SCORE, nan)
    return sc.drop_missing_score(rows).select("ord", F.col(f"`{SCORE}`").alias("score"))


@query("flt_date_parses", f"select ord, cast({o.parsed('dt')} as date) as day from fx_scored where {o.parsed('dt')} is not null")
def _(spark, d):
    return sc.drop_bad_date(fx.scored(spark, d)).select("ord", F.col("Date").cast("date").alias("day"))


@query("flt_confident", "select ord from fx_scored where score >= 0.70")
def _(spark, d):
    return sc.confident(fx.scored(spark, d), CONFIG).select("ord")


@query("flt_null_keys", 'select country as "COUNTRY", count(*) as n from fx_scored where country is not null group by 1')
def _(spark, d):
    return (fx.scored(spark, d).where(F.col("Country").isNotNull()).groupBy(F.col("Country").alias("COUNTRY"))
            .agg(F.count(F.lit(1)).alias("n")))


@query("flt_partials", 'select "URL", status from texts where ' + o.eligible('"URL"'))
def _(spark, d):
    wanted = en.base_articles(fx.articles(spark, d), CONFIG).where(urls.eligible(F.col("URL")))
    return en.add_status(join_pages(wanted, fx.pages(spark, d))).select("URL", F.col("_status").alias("status"))


# --------------------------------------------------------------------------- joins
@query("join_enriched_left", "select * from enriched")
def _(spark, d):
    base = en.base_articles(fx.articles(spark, d), CONFIG)
    return en.join_enriched(base, en.enrich_rows(base, fx.pages(spark, d), CONFIG))


def stored_by_url(spark, name, df):
    """The frame as a bucketed table, under a name of its own."""
    return Datasets(spark, staging_root(spark)).write_bucketed(f"{name}_{uuid.uuid4().hex}", df, "URL", 16)


@query("join_enriched_bucketed", "select * from enriched")
def _(spark, d):
    base = stored_by_url(spark, "base", en.base_articles(fx.articles(spark, d), CONFIG))
    results = stored_by_url(spark, "results", en.enrich_rows(base, fx.pages(spark, d), CONFIG))
    return en.join_enriched(base, results)


@query("join_pages_bucketed", 'select "URL", page_ok, text_full from joined')
def _(spark, d):
    base = stored_by_url(spark, "base", en.base_articles(fx.articles(spark, d), CONFIG))
    return join_texts(base, stored_by_url(spark, "texts", page_texts(fx.pages(spark, d)))).select("URL", "page_ok", "text_full")


@query("join_pages", """
select "URL", page_ok, text_full from joined""")
def _(spark, d):
    base = en.base_articles(fx.articles(spark, d), CONFIG)
    return join_pages(base, fx.pages(spark, d)).select("URL", "page_ok", "text_full")


@query("join_empty_right", """
select distinct replace(url, 'http', 'ftp') as "URL", 't' as "Title", cast(null as varchar) as "Translated Title",
  cast(null as varchar) as "Translated Text", cast(null as varchar) as "Language", cast(null as varchar) as "Model Sentiment Label",
  cast(null as double) as "Model Sentiment Score", cast(null as varchar) as "Enriched Keywords",
  cast(null as varchar) as "Enriched Domain" from fx_articles""")
def _(spark, d):
    none = fx.articles(spark, d).select(F.replace("URL", F.lit("http"), F.lit("ftp")).alias("URL"), F.lit("t").alias("Title"))
    return en.enrich(none, fx.pages(spark, d), CONFIG)


@query("join_lang_names", """
select t.id, coalesce(n.name, 'Unknown') as name from fx_texts t left join fx_names n on t.lang = n.code""")
def _(spark, d):
    rows = fx.fixture(spark, d, "fx_texts")
    return add_language_name(rows, "lang", "name", table_config(spark, d)).select("id", "name")


@query("score_sign", f"""
select ord, case {o.norm_label('label')} when 'bullish' then 1 when 'bearish' then -1 else 0 end as sign from fx_scored""")
def _(spark, d):
    return sc.with_normal_label(fx.scored(spark, d)).select("ord", sc.sign(F.col(f"`{LABEL}`")).alias("sign"))


# --------------------------------------------------------------------------- aggregations
def _rollup(spark, d):
    return sc.score(fx.scored(spark, d), CONFIG, order=["Date", "ord"])


@query("agg_country_month", "select * from rollup")
def _(spark, d):
    return _rollup(spark, d)


@query("agg_avg_sentiment", 'select "Year-Month", "COUNTRY", avg_sentiment from rollup')
def _(spark, d):
    return _rollup(spark, d).select("`Year-Month`", "COUNTRY", "avg_sentiment")


@query("agg_article_count", 'select "Year-Month", "COUNTRY", article_count from rollup')
def _(spark, d):
    return _rollup(spark, d).select("`Year-Month`", "COUNTRY", "article_count")


@query("agg_pos_neg_neu", 'select "Year-Month", "COUNTRY", pos_count, neg_count, neu_count from rollup')
def _(spark, d):
    return _rollup(spark, d).select("`Year-Month`", "COUNTRY", "pos_count", "neg_count", "neu_count")


@query("agg_majority", 'select "Year-Month", "COUNTRY", majority_sentiment from rollup')
def _(spark, d):
    return _rollup(spark, d).select("`Year-Month`", "COUNTRY", "majority_sentiment")


@query("agg_label_dist", f"select {o.norm_label('label')} as label, count(*) as n from fx_scored group by 1")
def _(spark, d):
    return quality.label_distribution(fx.scored(spark, d))


@query("agg_request_counts", """
select code, day, count(*) as requests, count(*) filter (usable) as usable
from replies group by 1, 2
union all select null, null, count(*), count(*) filter (usable) from replies""")
def _(spark, d):
    return quality.request_counts(fx.responses(spark, d))


@query("agg_dedupe_url", "select url, ord from (select *, row_number() over (partition by url order by dt, ord) as rn from fx_scored) where rn = 1")
def _(spark, d):
    return dedupe.keep_first(fx.fixture(spark, d, "fx_scored"), "url", ["dt", "ord"]).select("url", "ord")


@query("agg_sorted_set", """
select coalesce(country, 'none') as country, array_to_string(list_sort(list(distinct label)), ', ') as labels
from fx_scored where label is not null group by 1""")
def _(spark, d):
    rows = fx.fixture(spark, d, "fx_scored").groupBy(F.coalesce("country", F.lit("none")).alias("country"))
    return rows.agg(text.sorted_set(F.collect_set("label")).alias("labels"))


@query("agg_run_summary", """
select 'score' as stage, (select count(*) from fx_scored) as rows_in, (select count(*) from confident) as rows_out,
  cast((select count(*) from confident) as double) / greatest((select count(*) from fx_scored), 1) * 100 as percent""")
def _(spark, d):
    rows = fx.scored(spark, d)
    return quality.stage_summary("score", rows, sc.clean(rows, CONFIG, ["Date", "ord"]))


@query("agg_drop_counts", """
select a.n as rows_in, a.n - b.n as bad_score_or_date, b.n - c.n as duplicate_urls, c.n as rows_out
from (select count(*) as n from fx_scored) a, (select count(*) as n from scored_0 where dt is not null) b,
  (select count(*) as n from deduped) c""")
def _(spark, d):
    return quality.drop_counts(fx.scored(spark, d))


# --------------------------------------------------------------------------- limits, sorts, sets
@query("limit_per_window", """
select code, day, win, ord, pos from (
  select *, row_number() over (partition by code, day, win order by ord, pos) as rn from clean_hits) where rn <= 250""")
def _(spark, d):
    rows = art.drop_empty_url(hits(fx.responses(spark, d)))
    return dedupe.cap_per_group(rows, ["code", "day", "win"], ["ord", "pos"], CONFIG.max_records).select("code", "day", "win", "ord", "pos")


@query("sort_rollup", """
select "COUNTRY", "Year-Month", article_count from rollup order by "COUNTRY", "Year-Month" """)
def _(spark, d):
    return _rollup(spark, d).select("COUNTRY", "`Year-Month`", "article_count")


@query("set_union_codes", """
select distinct code from (select c_mktsegment as code from customer union all select p_brand from part
  union all select n_name from nation)""")
def _(spark, d):
    read = lambda t, c: spark.read.parquet(f"{d}/{t}.parquet").select(F.col(c).alias("code"))
    return grid.distinct_codes(read("customer", "c_mktsegment"), read("part", "p_brand"), read("nation", "n_name"))


@query("set_union_rows", """
select code, day, count(*) as n from (select code, day from fx_responses where win < 2
  union all select code, day from fx_responses where win >= 2) group by 1, 2""")
def _(spark, d):
    rows = fx.responses(spark, d).select("code", "day", "win")
    both = dedupe.union_rows([rows.where("win < 2"), rows.where("win >= 2").select("win", "day", "code")])
    return both.groupBy("code", "day").agg(F.count(F.lit(1)).alias("n"))


# --------------------------------------------------------------------------- scalar functions
def _texts(spark, d):
    return fx.fixture(spark, d, "fx_texts")


@query("sc_norm_label", f"select ord, {o.norm_label('label')} as label from fx_scored")
def _(spark, d):
    return fx.fixture(spark, d, "fx_scored").select("ord", text.norm_label(F.col("label")).alias("label"))


@query("sc_domain", f"select ord, pos, {o.domain('url')} as domain from clean_hits")
def _(spark, d):
    return art.drop_empty_url(hits(fx.responses(spark, d))).select("ord", "pos", urls.domain(F.col("url")).alias("domain"))


@query("sc_domain_nowww", f"select ord, {o.no_www('url')} as domain from fx_articles")
def _(spark, d):
    return fx.fixture(spark, d, "fx_articles").select("ord", urls.domain(F.col("url"), True).alias("domain"))


@query("sc_strip_url", f"select ord, pos, {o.strip('url')} as url from hits")
def _(spark, d):
    return hits(fx.responses(spark, d)).select("ord", "pos", text.strip(F.col("url")).alias("url"))


@query("sc_encode", f"select id, {o.quote_plus('title')} as encoded from fx_texts")
def _(spark, d):
    return _texts(spark, d).select("id", urls.quote_plus(F.col("title")).alias("encoded"))


@query("sc_run_date", "select o_orderkey, cast(o_orderdate as date) as run_date from orders")
def _(spark, d):
    rows = spark.read.parquet(f"{d}/orders.parquet")
    raw = F.date_format("o_orderdate", "yyyy-MM-dd")
    return rows.select("o_orderkey", dates.run_date(raw).alias("run_date"))


@query("sc_fmt_compact", "select event_id, strftime(ts, '%Y%m%d%H%M%S') as compact from events")
def _(spark, d):
    return spark.read.parquet(f"{d}/events.parquet").select("event_id", dates.compact(F.col("ts")).alias("compact"))


@query("sc_fmt_iso_day", f"select event_id, {o.iso_day('ts')} as day from events")
def _(spark, d):
    return spark.read.parquet(f"{d}/events.parquet").select(
        "event_id", dates.iso_day(F.col("ts").cast("date")).alias("day"))


@query("sc_month_iso", f"select o_orderkey, {o.iso_day('''date_trunc('month', o_orderdate)''')} as month from orders")
def _(spark, d):
    return spark.read.parquet(f"{d}/orders.parquet").select(
        "o_orderkey", dates.month_iso(F.col("o_orderdate")).alias("month"))


@query("score_signed", f"""
select ord, case {o.norm_label('label')} when 'bullish' then 1 when 'bearish' then -1 else 0 end * score as signed_score
from fx_scored where score is not null""")
def _(spark, d):
    rows = sc.drop_missing_score(sc.with_normal_label(fx.scored(spark, d)))
    return rows.select("ord", sc.signed_score(F.col(f"`{LABEL}`"), F.col(f"`{SCORE}`")).alias("signed_score"))


@query("score_avg_label", 'select "Year-Month", "COUNTRY", avg_sentiment_label from rollup')
def _(spark, d):
    return _rollup(spark, d).select("`Year-Month`", "COUNTRY", "avg_sentiment_label")


@query("sc_word_count", f"select id, {o.word_count('body')} as n from fx_texts")
def _(spark, d):
    return _texts(spark, d).select("id", text.word_count(F.col("body")).cast("long").alias("n"))


@query("sc_cap_text", "select id, left(body, 20000) as body from fx_texts")
def _(spark, d):
    return _texts(spark, d).select("id", text.cap(F.col("body"), 20_000).alias("body"))


@query("sc_chunks", f"""
select id, cast(i - 1 as int) as pos, cs[i] as piece from (
  select id, cs, unnest(range(1, len(cs) + 1)) as i from (select id, {o.chunks('body')} as cs from fx_texts))""")
def _(spark, d):
    pieces = text.chunks(F.col("body"), CONFIG.chunk_chars)
    return _texts(spark, d).select("id", F.posexplode(pieces).alias("pos", "piece"))


@query("sc_rejoin", f"select id, coalesce(array_to_string({o.chunks('body')}, ' '), '') as body from fx_texts")
def _(spark, d):
    return _texts(spark, d).select("id", text.rejoin(text.chunks(F.col("body"), CONFIG.chunk_chars)).alias("body"))


@query("sc_first_truthy", "select id, coalesce(nullif(body, ''), nullif(lang, ''), title) as chosen from fx_texts")
def _(spark, d):
    return _texts(spark, d).select("id", text.first_truthy(F.col("body"), F.col("lang"), F.col("title")).alias("chosen"))


@query("sc_themes", "select ord, pos, coalesce(keywords, '') as keywords from themed")
def _(spark, d):
    rows = art.drop_empty_url(hits(fx.responses(spark, d)))
    return rows.select("ord", "pos", themes.themes_text(F.col("themes")).alias("keywords"))


# --------------------------------------------------------------------------- text enrichment
def with_texts(body: str) -> str:
    return body.replace("__T__", "(select id as key, body as txt from fx_texts)")


@query("nlp_extract", "select url, page_ok, text from page_texts")
def _(spark, d):
    return page_texts(fx.pages(spark, d)).select(F.col("URL").alias("url"), "page_ok", F.col("text_full").alias("text"))


@query("nlp_extract_blocks", "select page_id, coalesce(text, '') as text from fx_bare_pages left join bare_texts using (page_id)")
def _(spark, d):
    return add_main_text(fx.fixture(spark, d, "fx_bare_pages"), "html", "text").select("page_id", "text")


@query("nlp_extract_raw", "select url, status, " + o.squeeze(o.unescape("h")) + " as text from page_2 where status < 400")
def _(spark, d):
    rows = fx.pages(spark, d).where("status < 400")
    return add_main_text(rows, "html", "text").select("url", "status", "text")


@query("nlp_lang_basis", "select id, case when length(body) > 50 then body else title end as basis from fx_texts")
def _(spark, d):
    return _texts(spark, d).select("id", language_basis(F.col("body"), F.col("title"), CONFIG).alias("basis"))


@query("nlp_language_confusion", "select f.lang, l.code, count(*) as n from fx_texts f join (" + with_texts(
    o.language("__T__")) + ") l on f.id = l.key group by 1, 2")
def _(spark, d):
    found = add_language(_texts(spark, d), "id", "body", "code", CONFIG)
    return found.groupBy("lang", "code").agg(F.count(F.lit(1)).alias("n"))


LANGUAGE_SQL = with_texts("select key as id, code from (" + o.language("__T__") + ")")


@query("nlp_language", LANGUAGE_SQL)
def _(spark, d):
    return add_language(_texts(spark, d), "id", "body", "code", CONFIG).select("id", "code")


@query("nlp_language_table", LANGUAGE_SQL)
def _(spark, d):
    return add_language(_texts(spark, d), "id", "body", "code", table_config(spark, d)).select("id", "code")


@query("nlp_language_salted", LANGUAGE_SQL)
def _(spark, d):
    config = table_config(spark, d, broadcast_rows=0)
    return add_language(_texts(spark, d), "id", "body", "code", config).select("id", "code")


def learned_language(spark, d):
    """The documents that the model isn't counted from, with its judgement."""
    docs = fx.table(spark, d, "documents")
    model = LanguageModel.of(gram_weights(docs.where("doc_id % 5 <> 0"), "text", "lang"))
    held_out = docs.where("doc_id % 5 = 0")
    return add_language(held_out, "doc_id", "text", "code", replace(CONFIG, language_model=model))


@query("nlp_language_learned", "select doc_id, code from learned_language")
def _(spark, d):
    return learned_language(spark, d).select("doc_id", "code")


@query("nlp_language_accuracy", """
select lang, count(*) as n, count(*) filter (code = lang) as right, count(*) filter (code = lang) >= 0.95 * count(*) as good
from documents join learned_language using (doc_id) group by lang""")
def _(spark, d):
    right = F.count_if(F.col("code") == F.col("lang"))
    return learned_language(spark, d).groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), right.alias("right"), (right >= F.lit(0.95) * F.count(F.lit(1))).alias("good"))


@query("nlp_translate_title", f"select id, coalesce(nullif({o.translated('title')}, ''), title) as title from fx_texts")
def _(spark, d):
    return add_translation(_texts(spark, d), "id", "title", "tt", CONFIG, chunked=False).select(
        "id", text.first_truthy(F.col("tt"), F.col("title")).alias("title"))


BODY_SQL = f"select id, {o.translated_chunks('body')} as body from fx_texts"


@query("nlp_translate_body", BODY_SQL)
def _(spark, d):
    return add_translation(_texts(spark, d), "id", "body", "out", CONFIG).select("id", F.col("out").alias("body"))


@query("nlp_translate_table", BODY_SQL)
def _(spark, d):
    return add_translation(_texts(spark, d), "id", "body", "out", table_config(spark, d)).select(
        "id", F.col("out").alias("body"))


# The best cover of a piece by runs of two and three words, from the last word to the first: b1, b2 and b3 are the worth
# (a million for a word covered, minus one for a run) of what begins 0, 1 and 2 words behind; then from the first word on.
PHRASE_SQL = f"""
select t.id, coalesce(f.body, t.body) as body from fx_texts t left join (
  with recursive runs as (select distinct array_to_string(w[i:i + k - 1], ' ') as src, k from (
      select w, unnest(range(1, len(w) + 1)) as i from (select string_split(text, ' ') as w from benchmark)),
      (values (2), (3)) as sizes(k) where i + k - 1 <= len(w)),
  cut as (select id, unnest(p) as piece, unnest(range(len(p))) as pos from (select id, {o.chunks('body')} as p from fx_texts)),
  pieces as materialized (select id, pos, string_split(piece, ' ') as w, len(w) as n from cut),
  places as (select id, pos, unnest(range(n)) as i from pieces),
  opts as materialized (select id, pos, i, bool_or(two.src is not null) as t2, bool_or(three.src is not null) as t3
    from places join pieces using (id, pos)
    left join runs two on two.k = 2 and i + 2 <= n and two.src = array_to_string(w[i + 1:i + 2], ' ')
    left join runs three on three.k = 3 and i + 3 <= n and three.src = array_to_string(w[i + 1:i + 3], ' ')
    group by id, pos, i),
  back as (select id, pos, n as i, 0::bigint as b1, 0::bigint as b2, 0::bigint as b3, 0 as take from pieces
    union all
    select id, pos, i, greatest(v1, v2, v3), v1, b2, case when v3 >= greatest(v1, v2) then 3 when v2 >= v1 then 2 else 0 end
    from (select b.id, b.pos, b.i - 1 as i, b1 as v1, if(t2, b2 + 1999999, -1) as v2, if(t3, b3 + 2999999, -1) as v3, b2
      from back b join opts o on o.id = b.id and o.pos = b.pos and o.i = b.i - 1)),
  taken as materialized (select id, pos, i, take from back),
  walk as (select id, pos, i, take from taken where i = 0
    union all
    select t.id, t.pos, t.i, t.take from walk v join taken t on t.id = v.id and t.pos = v.pos and t.i = v.i + greatest(v.take, 1)),
  done as (select id, pos, string_agg(if(take = 0, w[i + 1], array_to_string(w[i + 1:i + take], '_')), ' ' order by i) as part
    from walk join pieces using (id, pos) where i < n group by id, pos)
  select id, string_agg(part, ' ' order by pos) as body from done group by id) f on f.id = t.id"""


@query("nlp_translate_phrases", PHRASE_SQL)
def _(spark, d):
    """Phrases are all runs of two and three words of the benchmark passages, so that they overlap everywhere in a passage."""
    words = spark.read.parquet(f"{d}/benchmark.parquet").select(F.split("text", " ").alias("w"))
    each = words.select("w", F.posexplode("w").alias("i", "_")).select("w", "i", F.explode(F.array(F.lit(2), F.lit(3))).alias("k"))
    src = each.where(F.col("i") + F.col("k") <= F.size("w")).select(
        F.array_join(F.slice("w", F.col("i") + 1, F.col("k")), " ").alias("src")).distinct()
    table = src.withColumn("dst", F.replace("src", F.lit(" "), F.lit("_")))
    config = replace(CONFIG, lexicon=table, inline_entries=0)
    return add_translation(_texts(spark, d), "id", "body", "out", config).select("id", F.col("out").alias("body"))


SENTIMENT_SQL = with_texts(f"select key as id, label as {LABEL_Q}, score as {SCORE_Q} from (" + o.sentiment("__T__") + ")")


@query("nlp_sentiment", SENTIMENT_SQL)
def _(spark, d):
    return add_sentiment(_texts(spark, d), "id", "body", CONFIG).select("id", f"`{LABEL}`", f"`{SCORE}`")


@query("nlp_sentiment_table", SENTIMENT_SQL)
def _(spark, d):
    return add_sentiment(_texts(spark, d), "id", "body", table_config(spark, d)).select("id", f"`{LABEL}`", f"`{SCORE}`")


@query("nlp_sentiment_salted", SENTIMENT_SQL)
def _(spark, d):
    config = table_config(spark, d, broadcast_rows=0)
    return add_sentiment(_texts(spark, d), "id", "body", config).select("id", f"`{LABEL}`", f"`{SCORE}`")


def labelled_texts(spark, d):
    """Texts with a kind made of their two labels; those of every fifth document are for judging only."""
    labels = spark.read.parquet(f"{d}/labels.parquet")
    kind = F.when(F.col("toxic") == 1, "bearish").when(F.col("quality") == 1, "bullish").otherwise("neutral")
    return fx.table(spark, d, "documents").join(labels, "doc_id").select("doc_id", "text", kind.alias("kind"))


def learned_sentiment(spark, d):
    return fit_text_classifier(labelled_texts(spark, d).where("doc_id % 5 <> 0"), "text", "kind")


@query("nlp_sentiment_ml", f"""
select doc_id, not regexp_matches(text, '{o.NON_BLANK}') as failed, true as known_label, true as score_of_two_places from documents""")
def _(spark, d):
    found = add_classifier_sentiment(fx.table(spark, d, "documents").select("doc_id", "text"), "text", learned_sentiment(spark, d))
    label, score = F.col(f"`{LABEL}`"), F.col(f"`{SCORE}`")
    failed = label == FAILED
    two_places = score.between(0, 1) & (score == F.round(score * 100) / 100)
    return found.select("doc_id", failed.alias("failed"), F.when(failed, True).otherwise(label.isin(*KINDS)).alias("known_label"),
                        F.when(failed, score.isNull()).otherwise(F.coalesce(two_places, F.lit(False))).alias("score_of_two_places"))


@query("nlp_sentiment_ml_scores")
def _(spark, d):
    return add_classifier_sentiment(fx.table(spark, d, "documents").select("doc_id", "text"), "text", learned_sentiment(spark, d))


@query("nlp_sentiment_ml_loss")
def _(spark, d):
    held_out = labelled_texts(spark, d).where("doc_id % 5 = 0")
    return log_loss(held_out, "text", "kind", learned_sentiment(spark, d))


@query("nlp_no_content", f"""
select t."URL", {LABEL_Q}, {SCORE_Q}, r."Keywords" from texts t join results r on t."URL" = r."URL" where t.status = 'no_content'""")
def _(spark, d):
    rows = en.base_articles(fx.articles(spark, d), CONFIG).where(urls.eligible(F.col("URL")))
    done = en.add_texts(join_pages(rows, fx.pages(spark, d)), CONFIG)
    scored = en.add_signals(done, CONFIG).where("_status = 'no_content'")
    return scored.select("URL", f"`{LABEL}`", f"`{SCORE}`", F.col("Enriched Keywords").alias("Keywords"))


@query("nlp_no_content_rule", """
select id, 'no_content' as _status, '[failed - no content]' as "Model Sentiment Label", cast(null as double) as "Model Sentiment Score"
from fx_texts where body = ''
union all select id, 'ok', 'seen', 0.5 from fx_texts where body <> ''""")
def _(spark, d):
    status = F.when(F.col("body") == "", "no_content").otherwise("ok")
    rows = _texts(spark, d).select("id", status.alias("_status"), F.lit("seen").alias(LABEL), F.lit(0.5).alias(SCORE))
    return add_no_content(rows)


ENTITY_SQL = with_texts("select key as id, names from (" + o.entities("__T__", "fx_gazetteer", 4) + ")")
MENTION_SQL = "select key as id, names from (" + o.entities(
    "(select id as key, body as txt from fx_mentions)", "fx_known", 3) + ")"


@query("nlp_entities", ENTITY_SQL)
def _(spark, d):
    return add_entities(_texts(spark, d), "id", "body", "names", CONFIG).select("id", "names")


@query("nlp_entities_table", ENTITY_SQL)
def _(spark, d):
    return add_entities(_texts(spark, d), "id", "body", "names", table_config(spark, d)).select("id", "names")


@query("nlp_entities_known", MENTION_SQL)
def _(spark, d):
    config = table_config(spark, d, gazetteer=fx.fixture(spark, d, "fx_known"))
    return add_entities(fx.fixture(spark, d, "fx_mentions"), "id", "body", "names", config).select("id", "names")


@query("nlp_entities_salted", MENTION_SQL)
def _(spark, d):
    config = table_config(spark, d, gazetteer=fx.fixture(spark, d, "fx_known"), broadcast_rows=0)
    return add_entities(fx.fixture(spark, d, "fx_mentions"), "id", "body", "names", config).select("id", "names")


LONGEST_SQL = with_texts("select key as id, names from (" + o.longest_entities("__T__", "fx_gazetteer", 4) + ")")
LONGEST = dict(entity_longest=True, entity_kinds=("GPE", "ORG"))


@query("nlp_entities_longest", LONGEST_SQL)
def _(spark, d):
    return add_entities(_texts(spark, d), "id", "body", "names", replace(CONFIG, **LONGEST)).select("id", "names")


@query("nlp_entities_longest_salted", LONGEST_SQL)
def _(spark, d):
    config = table_config(spark, d, broadcast_rows=0, **LONGEST)
    return add_entities(_texts(spark, d), "id", "body", "names", config).select("id", "names")


@query("nlp_body_choice", 'select "URL", "Language", "Translated Title", "Translated Text", status from texts')
def _(spark, d):
    rows = join_pages(en.base_articles(fx.articles(spark, d), CONFIG), fx.pages(spark, d))
    return en.add_texts(rows, CONFIG).select(
        "URL", "Language", "`Translated Title`", "`Translated Text`", F.col("_status").alias("status"))


@query("nlp_status", "select status, count(*) as n from texts group by 1")
def _(spark, d):
    rows = join_pages(en.base_articles(fx.articles(spark, d), CONFIG), fx.pages(spark, d))
    return en.add_status(rows).groupBy(F.col("_status").alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query("enrich_full", "select * from enriched")
def _(spark, d):
    return en.enrich(fx.articles(spark, d), fx.pages(spark, d), CONFIG)


@query("enrich_full_table", "select * from enriched")
def _(spark, d):
    return en.enrich(fx.articles(spark, d), fx.pages(spark, d), table_config(spark, d))


# --------------------------------------------------------------------------- stages
@query("stage_collect", "select * from collected")
def _(spark, d):
    return collect(fx.responses(spark, d))


@query("stage_enrich", 'select "URL", "Language", "Model Sentiment Label", "Model Sentiment Score", "Enriched Keywords" from enriched')
def _(spark, d):
    store = Datasets(spark, new_folder(spark, "stages"))
    store.write(CONFIG.raw_dataset, fx.articles(spark, d))
    run_stages(store, pages=fx.pages(spark, d), config=CONFIG, stages=["enrich"], every_week=True)
    return store.read(CONFIG.enriched_dataset).select("URL", "Language", f"`{LABEL}`", f"`{SCORE}`", "`Enriched Keywords`")


@query("stage_run", f"""
select stage, rows_in, rows_out, cast(rows_out as double) / greatest(rows_in, 1) * 100 as percent, details from (
  select 'collect' as stage, (select count(*) from fx_articles) as rows_in, (select count(*) from base) as rows_out,
    'usable=' || (select count(*) from fx_articles) as details
  union all select 'enrich', (select count(*) from base), (select count(*) from results),
    (select string_agg(label || '=' || n, ', ' order by label || '=' || n) from (
      select {o.norm_label(LABEL_Q)} as label, count(*) as n from results group by 1))
  union all select 'score', (select count(*) from base), (select count(*) from run_rollup),
    'bad_score_or_date=' || (select count(*) from enriched where {SCORE_Q} is null) || ', duplicate_urls=0')""")
def _(spark, d):
    store = Datasets(spark, new_folder(spark, "stages"))
    return run_stages(store, fx.landed_articles(spark, d), fx.pages(spark, d), CONFIG, every_week=True, keep_weeks=True)


@query("stage_run_rollup", "select * from run_rollup")
def _(spark, d):
    """What landed before, then two more weeks one after another; the last run's rollup covers all of them."""
    landed, pages = fx.landed_articles(spark, d), fx.pages(spark, d)
    last = landed.agg(F.max("day")).first()[0]
    weeks = [last - datetime.timedelta(days=last.weekday() + 7 * k) for k in (1, 0)]
    store = Datasets(spark, new_folder(spark, "stages"))
    run_stages(store, landed.where(F.col("day") < F.lit(weeks[0])), pages, CONFIG, stages=["collect", "enrich"],
               every_week=True, keep_weeks=True)
    for week in weeks:
        run_stages(store, landed, pages, CONFIG, run_date=week, keep_weeks=True,
                   stages=["collect", "enrich", "score"][:3 if week == weeks[-1] else 2])
    return store.read(CONFIG.rollup_dataset)


@query("stage_collect_week", 'select "Date", "Title", "URL", "Domain", "Country", "Keywords" from week')
def _(spark, d):
    return collect(fx.responses(spark, d), datetime.date(2024, 1, 10))
