"""Stage inputs derived from the driver's tables.

Every text is one query that means the same in Spark and in DuckDB, so a check
can use it as a DataFrame here and as a CTE there. All rows of the tables are
used; irregular values (bad dates, failed replies, odd labels) replace regular
ones, and copies are added.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediasignal.config import PipelineConfig

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def values(rows, columns: str) -> str:
    """A literal table as a query."""
    def lit(x):
        return str(x) if isinstance(x, int) else "'" + str(x).replace("'", "''") + "'"

    body = ", ".join("(" + ", ".join(lit(x) for x in row) + ")" for row in rows)
    return f"select * from (values {body}) as v({columns})"


# Word tables made of words that occur in the test texts.
PROFILE = {
    "de": dict.fromkeys("der die und den von das".split(), 1),
    "en": dict.fromkeys("the of and to is that".split(), 1),
    "es": {**dict.fromkeys("la que el y se".split(), 1), "los": 2},
    "fr": {**dict.fromkeys("la le les des un".split(), 1), "et": 2},
}
NAMES = {"en": "English", "fr": "French", "de": "German", "es": "Spanish"}
LEXICON = {"der": "the", "die": "the", "und": "and", "le": "the", "les": "the", "et": "and",
           "los": "the", "el": "the", "y": "and", "la": "the", "de": "of", "von": "of"}
POLARITY = {**dict.fromkeys("that und el".split(), "bullish"),
            **dict.fromkeys("is die los".split(), "bearish"), "of": "neutral"}
GAZETTEER = {"The": "GPE", "of the": "ORG", "and the of": "ORG", "in": "PERSON", "La": "GPE",
             "de la": "GPE", "nicht mit": "ORG", "The of and the": "ORG", "This": "GPE"}

CONFIG = PipelineConfig(language_profile=PROFILE, language_names=NAMES, lexicon=LEXICON,
                        polarity=POLARITY, gazetteer=GAZETTEER)

SQL: dict[str, str] = {
    "fx_codes": values(enumerate(CONFIG.country_codes), "pos, code"),
    "fx_regions": values([(r, c) for r, cs in CONFIG.regions.items() for c in cs], "region, code"),
    "fx_names": values(NAMES.items(), "code, name"),
    "fx_profile": values([(lang, t, w) for lang, ws in PROFILE.items() for t, w in ws.items()],
                         "lang, token, weight"),
    "fx_lexicon": values(LEXICON.items(), "src, dst"),
    "fx_polarity": values(POLARITY.items(), "token, kind"),
    "fx_gazetteer": values(GAZETTEER.items(), "phrase, kind"),
    # Stage three input.
    "fx_scored": """
select o.o_orderkey as ord,
  'https://news.example/a/' || cast(case when o.o_orderkey % 20 = 7 then o.o_orderkey - 1 else o.o_orderkey end as string) as url,
  case when o.o_orderkey % 97 = 0 then 'not a date' else cast(cast(o.o_orderdate as date) as string) || 'T00:00:00.000Z' end as dt,
  case when o.o_orderkey % 61 = 0 then null else n.n_name end as country,
  case when o.o_orderkey % 211 = 0 then null
    else case o.o_orderstatus when 'F' then ' Bullish' when 'O' then 'BEARISH ' else 'Neutral' end end as label,
  case when o.o_orderkey % 50 = 0 then null else cast(50 + (o.o_orderkey * 37) % 51 as double) / 100 end as score
from orders o join customer c on o.o_custkey = c.c_custkey join nation n on c.c_nationkey = n.n_nationkey""",
    # Landed replies; each good body lists three hits.
    "fx_responses": """
select e.event_id as ord, cast(e.ts as date) as day, cast(floor(hour(e.ts) / 6) as int) as win, c.code as code,
  case when e.event_id % 40 = 0 then 500 else 200 end as status,
  case when e.event_id % 50 = 3 then 'not json' when e.event_id % 50 = 4 then '[{"articles":[{"url":"https://list.example/1"}]}]'
    when e.event_id % 50 = 6 then '{"articles":null}' when e.event_id % 50 = 7 then '{"articles":[{"url":"https://cut.example/' else
  case e.event_id % 11 when 1 then chr(10) when 2 then chr(9) when 3 then chr(13) || chr(10) else '' end
  || '{"articles":[{"url":" https://www.News.example/e/'
  || cast(case when e.event_id % 20 = 9 then e.event_id - 1 else e.event_id end as string)
  || ' ","title":"' || e.event_type || '"' || case when e.event_id % 21 = 0 then '' else ',"sourcecountry":"N' || cast(e.user_id % 25 as string) || '"' end
  || case e.event_id % 5 when 0 then ',"themes":["b","a","b",""]' when 1 then ',"themes":"x;y"' when 2 then ',"themes":7'
     when 3 then ',"themes":["T1",2,null,"Äb"]' else '' end || '},'
  || '{"url":"http://user:pw@M.example:8080/u/' || cast(e.user_id as string) || '?t=' || e.event_type || '","sourcecountry":""},'
  || case when e.event_id % 7 = 0 then '"odd",' else '' end
  || '{"url":"' || case when e.event_id % 3 = 0 then ' ' else '' end || '","title":"none"}]}' end as body
from events e join fx_codes c on e.user_id % 197 = c.pos""",
    # Stage two input: every page is hit on two days.
    "fx_articles": """
select 2 * p.page_id as ord, cast(date '2024-01-01' + cast(p.page_id % 7 as int) as string) || 'T00:00:00.000Z' as dt,
  regexp_extract(p.html, '<title>([^<]*)</title>', 1) as title,
  case when p.page_id % 31 = 0 then replace(p.url, 'http', 'ftp') when p.page_id % 29 = 0 then p.url || '/Video/1' else p.url end as url,
  case when p.page_id % 23 = 0 then 'Unknown' else n.n_name end as country, 'page' as keywords
from pages p join nation n on p.page_id % 25 = n.n_nationkey
union all
select 2 * p.page_id + 1, cast(date '2024-01-08' + cast(p.page_id % 7 as int) as string) || 'T00:00:00.000Z', 'seen again',
  p.url, n.n_name, 'page'
from pages p join nation n on p.page_id % 25 = n.n_nationkey
union all
select 10000000 + d.doc_id, cast(date '2024-01-01' + cast(d.doc_id % 60 as int) as string) || 'T00:00:00.000Z',
  split_part(d.text, chr(10), 1), 'https://www.news.example/d/' || cast(d.doc_id as string), n.n_name, d.source
from documents d join nation n on d.doc_id % 25 = n.n_nationkey
union all
select 20000000 + 1000 * t.conv_id + t.turn, '2024-02-01T00:00:00.000Z', t.role,
  'https://talk.example/c/' || cast(t.conv_id as string) || '/' || cast(t.turn as string), n.n_name, 'talk'
from conversations t join nation n on t.conv_id % 25 = n.n_nationkey""",
    # Landed pages: errors, moved pages, and a failed first try for each document.
    "fx_pages": """
select case when page_id % 17 = 0 then url || '#moved' else url end as url,
  case when page_id % 13 = 0 then 404 else 200 end as status, html from pages
union all
select 'https://www.news.example/d/' || cast(doc_id as string), 503, '<p>try later</p>' from documents
union all
select 'https://www.news.example/d/' || cast(doc_id as string), 200,
  '<html><head><title>d</title></head><body><nav>menu</nav><MAIN class="m"><p>' || replace(text, chr(10), '</p><p>')
  || '</p><!-- end --><aside>more</aside></MAIN><footer>f</footer></body></html>' from documents
union all
select 'https://talk.example/c/' || cast(conv_id as string) || '/' || cast(turn as string), 200, '<p><b>' || text || '</b>&nbsp;</p>'
from conversations""",
    # Pages that name neither article nor navigation.
    "fx_bare_pages": """
select page_id, replace(replace(replace(replace(html, '<article>', '<div class="c">'), '</article>', '</div>'),
  '<nav>', '<div class="m">'), '</nav>', '</div>') as html from pages""",
    # Plain texts; the benchmark items have a title and no body.
    "fx_texts": """
select 'd' || cast(doc_id as string) as id, split_part(text, chr(10), 1) as title, text as body, lang from documents
union all
select 'c' || cast(conv_id as string) || '-' || cast(turn as string), role, text, '' from conversations
union all
select 'b' || cast(item_id as string), text, '', '' from benchmark""",
    # One sentence per order that names a customer, a place and an amount.
    "fx_mentions": """
select 'o' || cast(o.o_orderkey as string) as id,
  c.c_name || ', based in ' || n.n_name || ', owes ' || case o.o_orderkey % 4 when 0 then '$5 million' when 1 then '€1,200.50'
    when 2 then 'USD ' || cast(cast(floor(o.o_totalprice) as bigint) as string) || ' bn' else 'nothing' end
  || '; ' || r.r_name || ' and ' || n.n_name || ' agree.' as body
from orders o join customer c on o.o_custkey = c.c_custkey join nation n on c.c_nationkey = n.n_nationkey
join region r on n.n_regionkey = r.r_regionkey""",
    # A phrase table that grows with the data.
    "fx_known": """
select c_name as phrase, 'ORG' as kind from customer union all select n_name, 'GPE' from nation
union all select r_name, 'GPE' from region union all select 'based in', 'PERSON' from region""",
}

_NEEDS = {name: [n for n in SQL if n != name and re.search(rf"\b{n}\b", text)] for name, text in SQL.items()}


# Tables with much work per row, and their keys.
SPREAD_KEYS = {"documents": ["doc_id"], "conversations": ["conv_id", "turn"], "pages": ["page_id"],
               "events": ["event_id"], "orders": ["o_orderkey"]}


#: Tables that a fixture joins row by row and that grow with it: never broadcast there, though their files are small.
MERGED = {"fx_mentions": ["customer"]}

_schemas: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. If it is read by fewer tasks than there are cores, its rows
    are spread over them; at scale it is left as it is."""
    path = f"{sf_dir}/{name}.parquet"
    reader = spark.read.schema(_schemas[path]) if path in _schemas else spark.read
    df = reader.parquet(path)
    _schemas[path] = df.schema
    if name in SPREAD_KEYS and df.rdd.getNumPartitions() < spark.sparkContext.defaultParallelism:
        df = df.repartition(spark.sparkContext.defaultParallelism, *SPREAD_KEYS[name])
    return df


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture, or a driver table, as a DataFrame."""
    if name in TABLES:
        return table(spark, sf_dir, name)
    text = SQL[name]
    for source in TABLES:
        if re.search(rf"\b{source}\b", text):
            df = table(spark, sf_dir, source)
            (df.hint("merge") if source in MERGED.get(name, ()) else df).createOrReplaceTempView(source)
    for need in _NEEDS[name]:
        fixture(spark, sf_dir, need).createOrReplaceTempView(need)
    return spark.sql(text)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fx_scored`` with the names of the enriched table, and ``ord``."""
    return fixture(spark, sf_dir, "fx_scored").toDF(
        "ord", "URL", "Date", "Country", "Model Sentiment Label", "Model Sentiment Score")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fx_articles`` with the names of the raw table."""
    return fixture(spark, sf_dir, "fx_articles").selectExpr(
        "dt as Date", "title as Title", "url as URL", "'' as Domain", "country as Country",
        "keywords as Keywords")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "fx_pages")


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "fx_responses")


def landed_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fx_articles`` as landed replies, one per article."""
    body = F.to_json(F.struct(F.array(F.struct(
        "url", "title", F.col("country").alias("sourcecountry"), F.array("keywords").alias("themes")))
        .alias("articles")))
    return fixture(spark, sf_dir, "fx_articles").select(
        "ord", F.to_date(F.left("dt", F.lit(10))).alias("day"), F.lit(0).alias("win"),
        F.lit("KE").alias("code"), F.lit(200).alias("status"), body.alias("body"))
