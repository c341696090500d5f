"""DuckDB texts of the checks: shared CTEs and a builder that adds those a query names."""

from __future__ import annotations

import re

from checks.fixtures import CONFIG, SQL
from mediasignal.config import SEARCH_URL

BLANK = r"[\s\x0B\x1C-\x1F\x85\p{Z}]"
NON_BLANK = r"[^\s\x0B\x1C-\x1F\x85\p{Z}]"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{BLANK}+|{BLANK}+$', '', 'g')"


def squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, '{BLANK}+', ' ', 'g'))"


def norm_label(x: str) -> str:
    return f"lower({strip(f'''coalesce({x}, 'nan')''')})"


def domain(x: str) -> str:
    return f"lower(regexp_extract({x}, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1))"


def no_www(x: str) -> str:
    return rf"regexp_replace({domain(x)}, '^www\.', '')"


def eligible(x: str) -> str:
    return f"coalesce(starts_with({x}, 'http') and not contains(lower({x}), 'video') and length({x}) >= 10, false)"


def iso_day(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%dT00:00:00.000Z')"


def parsed(x: str) -> str:
    return f"case when regexp_matches({x}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}') then try_cast({x} as timestamp) end"


def quote_plus(x: str) -> str:
    return f"replace(url_encode({x}), '%20', '+')"


def words(x: str) -> str:
    return rf"regexp_extract_all(lower({x}), '[\p{{L}}\p{{N}}]+')"


def word_count(x: str) -> str:
    return f"len(regexp_extract_all({x}, '{NON_BLANK}+'))"


def chunks(x: str, size: int = 4500) -> str:
    return (f"list_transform(range(0, cast(ceil(length({x}) / {size}.0) as bigint)), "
            f"lambda i: substring({x}, cast(i * {size} + 1 as bigint), {size}))")


LEXICON_MAP = "MAP {" + ", ".join(f"{q(a)}: {q(b)}" for a, b in CONFIG.lexicon.items()) + "}"


def translated(x: str) -> str:
    return (f"array_to_string(list_transform(string_split({x}, ' '), "
            f"lambda w: coalesce(map_extract({LEXICON_MAP}, w)[1], w)), ' ')")


def translated_chunks(x: str) -> str:
    return f"coalesce(array_to_string(list_transform({chunks(x)}, lambda c: {translated('c')}), ' '), '')"


def blocks(*tags: str) -> str:
    return "|".join(rf"<{t}(?:\s[^>]*)?>.*?</{t}\s*>" for t in tags)


def container(tag: str) -> str:
    return rf"nullif(regexp_extract(h, '(?is)<{tag}(?:\s[^>]*)?>(.*)</{tag}\s*>', 1), '')"


INLINE = (r"(?i)</?(?:a|abbr|b|cite|code|em|font|i|kbd|mark|q|s|small|span|strong|sub|sup|u)"
          r"(?:\s[^>]*)?/?>")


def unescape(x: str) -> str:
    for name, char in (("nbsp", " "), ("quot", '"'), ("lt", "<"), ("gt", ">"), ("copy", "©"),
                       ("middot", "·"), ("amp", "&")):
        x = f"replace({x}, '&{name};', {q(char)})"
    return x


KEYWORD_QUERY = "(" + " OR ".join(f'"{k}"' for k in CONFIG.keywords) + ")"
NAME = r"[\p{L}\p{N}#_]+(?:[&.''-][\p{L}\p{N}#_]+)*"
MONEY = (r"(?:[$€£¥]|\b(?:USD|EUR|GBP|JPY|CHF|CNY))\s?[0-9]+(?:,[0-9]{3})*(?:\.[0-9]+)?"
         r"(?:\s?(?:thousand|million|billion|trillion|bn|mn|tn|k|m)\b)?")


def language(source: str) -> str:
    """``key, code`` for a CTE ``source(key, txt)``."""
    return f"""
select s.key, coalesce(b.lang, 'unknown') as code from {source} s left join (
  select key, arg_min(lang, row(-score, lang)) as lang from (
    select t.key, p.lang, sum(p.weight) as score
    from (select key, unnest({words('txt')}) as token from {source}) t join fx_profile p on t.token = p.token
    group by 1, 2) group by key) b on s.key = b.key"""


def sentiment(source: str) -> str:
    """``key, label, score`` for a CTE ``source(key, txt)``."""
    return f"""
select key, case when blank then '[SENTIMENT FAILED]' when n = top then 'neutral' when b = top then 'bullish' else 'bearish' end as label,
  case when not blank then cast(((top + 1) * 200 + total) // (2 * total) as double) / 100 end as score
from (select *, greatest(b, r, n) as top, b + r + n + 3 as total from (
  select s.key, not regexp_matches(coalesce(s.txt, ''), '{NON_BLANK}') as blank, coalesce(c.b, 0) as b, coalesce(c.r, 0) as r, coalesce(c.n, 0) as n
  from {source} s left join (
    select t.key, count(*) filter (p.kind = 'bullish') as b, count(*) filter (p.kind = 'bearish') as r,
      count(*) filter (p.kind = 'neutral') as n
    from (select key, unnest({words('txt')}) as token from {source}) t join fx_polarity p on t.token = p.token
    group by 1) c on s.key = c.key))"""


def entities(source: str, table: str, longest: int, kinds: str = "'GPE', 'ORG'", money: bool = True) -> str:
    """``key, names`` for a CTE ``source(key, txt)`` and a phrase table."""
    amounts = (f" union all select key, unnest(regexp_extract_all(txt, '{MONEY}')) from {source}" if money else "")
    return f"""
select s.key, coalesce(f.names, '') as names from {source} s left join (
  select key, array_to_string(list_sort(list(distinct phrase)), ', ') as names from (
    select g.key, g.phrase from (
      select key, array_to_string(ws[i : i + n - 1], ' ') as phrase
      from (select key, ws, unnest(range(1, len(ws) + 1)) as i
            from (select key, regexp_extract_all(txt, '{NAME}') as ws from {source})),
        range(1, {longest + 1}) r(n) where i + n - 1 <= len(ws)) g
    join (select distinct phrase from {table} where kind in ({kinds})) k on g.phrase = k.phrase{amounts}) group by key) f
on s.key = f.key"""


def longest_entities(source: str, table: str, longest: int) -> str:
    """``key, names`` of the phrases that lie in no longer one, without amounts."""
    return f"""
select s.key, coalesce(f.names, '') as names from {source} s left join (
  select key, array_to_string(list_sort(list(distinct phrase)), ', ') as names from (
    select *, max(last) over (partition by key order by i rows between unbounded preceding and 1 preceding) as reach from (
      select g.key, g.i, max(g.i + g.n) as last, arg_max(g.phrase, g.n) as phrase from (
        select key, i, n, array_to_string(ws[i : i + n - 1], ' ') as phrase
        from (select key, ws, unnest(range(1, len(ws) + 1)) as i
              from (select key, regexp_extract_all(txt, '{NAME}') as ws from {source})),
          range(1, {longest + 1}) r(n) where i + n - 1 <= len(ws)) g
      join (select distinct phrase from {table} where kind in ('GPE', 'ORG')) k on g.phrase = k.phrase group by g.key, g.i))
  where reach is null or reach < last group by key) f
on s.key = f.key"""


def per_label(source: str) -> str:
    return f"""
select country, date_trunc('month', dt) as month, label, count(*) as n,
  sum(case label when 'bullish' then 1 when 'bearish' then -1 else 0 end * cast(cast(score as varchar) as decimal(28,18))) as units,
  min(row(dt, url)) as first_at
from ({source}) where country is not null group by 1, 2, 3"""


def rollup(source: str) -> str:
    return f"""
select {iso_day('month')} as "Year-Month", country as "COUNTRY", cast(sum(n) as bigint) as article_count,
  cast(coalesce(sum(n) filter (label = 'bullish'), 0) as bigint) as pos_count,
  cast(coalesce(sum(n) filter (label = 'bearish'), 0) as bigint) as neg_count,
  cast(coalesce(sum(n) filter (label = 'neutral'), 0) as bigint) as neu_count,
  arg_min(label, row(-n, first_at)) as majority_sentiment,
  case when sum(units) > 0 then 'bullish' when sum(units) < 0 then 'bearish' else 'neutral' end as avg_sentiment_label,
  cast(sum(units) as double) / cast(sum(n) as double) as avg_sentiment
from {source} group by country, month"""


CTES: dict[str, str] = {
    **SQL,
    # --- collect ---
    "hits": """
select ord, day, win, code, cast(i as int) as pos, a->>'$.url' as url, a->>'$.title' as title,
  a->>'$.sourcecountry' as sourcecountry, a->'$.themes' as themes
from (select *, json_extract(body, '$.articles[' || i || ']') as a from (
  select *, unnest(range(0, cast(json_array_length(body, '$.articles') as bigint))) as i
  from (select * from fx_responses where status = 200 and json_valid(body)) where json_type(body) = 'OBJECT'))
where json_type(a) = 'OBJECT'""",
    "replies": """
select *, status = 200 and case when json_valid(body) then json_type(body) = 'OBJECT' else false end as usable from fx_responses""",
    "clean_hits": f"select * replace ({strip('url')} as url) from hits where {strip('url')} <> ''",
    "themed": """
select *, case json_type(themes)
  when 'ARRAY' then array_to_string(list_sort(list_distinct(list_filter(list_transform(list_filter(
    json_extract(themes, '$[*]'), lambda x: json_type(x) = 'VARCHAR'), lambda x: x->>'$'), lambda x: x <> ''))), ', ')
  when 'VARCHAR' then themes->>'$' else '' end as keywords from clean_hits""",
    "article_rows": f"""
select {iso_day('day')} as "Date", coalesce(title, '') as "Title", url as "URL", {domain('url')} as "Domain",
  coalesce(nullif(sourcecountry, ''), 'Unknown') as "Country", coalesce(keywords, '') as "Keywords",
  day, win, code, ord, pos from themed""",
    "collected": """
select "Date", "Title", "URL", "Domain", "Country", "Keywords" from (
  select *, row_number() over (partition by "URL" order by "Date", win, code, ord, pos) as rn from article_rows)
where rn = 1""",
    # --- enrich ---
    "base": """
select url as "URL", dt as "Date", title as "Title", country as "Country", '' as "Domain", keywords as "Keywords"
from (select *, row_number() over (partition by url order by dt, title, country, keywords) as rn from fx_articles) where rn = 1""",
    "page_0": f"""
select url, status, regexp_replace(case when status < 400 then html else '' end,
  '(?is)<!--.*?-->|{blocks('script', 'style', 'noscript', 'template', 'svg')}', '', 'g') as h from fx_pages""",
    "page_1": f"select url, status, coalesce({container('article')}, {container('main')}, {container('body')}, h) as h from page_0",
    "page_2": f"""
select url, status, regexp_replace(regexp_replace(regexp_replace(h,
  '(?is){blocks('nav', 'footer', 'aside', 'form', 'button', 'select', 'iframe')}', '', 'g'), '{INLINE}', '', 'g'),
  '</?[A-Za-z][^>]*>|<![^>]*>', ' ', 'g') as h from page_1""",
    "page_texts": f"""
select url, status < 400 as page_ok, text from (
  select *, row_number() over (partition by url order by status, md5(text)) as rn from (
    select url, status, {squeeze(unescape('h'))} as text from page_2)) where rn = 1""",
    "bare_blocks": f"""
select page_id, i, replace(replace(b, chr(1), ''), chr(2), '') as txt, {word_count("replace(replace(b, chr(1), ''), chr(2), '')")} as w,
  list_sum(list_transform(regexp_extract_all(b, '\\x01([^\\x02]*)\\x02', 1), lambda x: {word_count('x')})) as linked
from (select page_id, unnest(bs) as b, generate_subscripts(bs, 1) as i from (
  select page_id, string_split(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
    coalesce({container('body')}, h), '(?is){blocks('nav', 'footer', 'aside', 'form', 'button', 'select', 'iframe')}', '', 'g'),
    '(?i)<a href=[^>]*>', chr(1), 'g'), '(?i)</a>', chr(2), 'g'), '{INLINE}', '', 'g'),
    '</?[A-Za-z][^>]*>|<![^>]*>', chr(3), 'g'), chr(3)) as bs
  from (select page_id, regexp_replace(html, '(?is)<!--.*?-->|{blocks('script', 'style', 'noscript', 'template', 'svg')}', '', 'g') as h
    from fx_bare_pages)))""",
    "bare_judged": """
select *, l <= cast(1 as double) / 3 and case when before_l > cast(5 as double) / 9 then w > 40 or next_w > 17
    else w > 16 or next_w > 15 or before_w > 4 end as good
from (select *, lag(l, 1, 0) over o as before_l, lag(w, 1, 0) over o as before_w, lead(w, 1, 0) over o as next_w
  from (select *, coalesce(linked, 0) / w as l from bare_blocks where w > 0) window o as (partition by page_id order by i))""",
    "bare_texts": f"""
select page_id, {squeeze(unescape("string_agg(txt, ' ' order by i)"))} as text from (
  select *, bool_or(good) over (partition by page_id) as some_good, bool_or(l <= cast(1 as double) / 3) over (partition by page_id) as some_plain
  from bare_judged) where case when some_good then good when some_plain then l <= cast(1 as double) / 3 else true end group by page_id""",
    # --- language model ---
    "doc_words": r"""
select doc_id, lang, word, count(*) as n from (
  select doc_id, lang, unnest(regexp_extract_all(lower(text), '\p{L}+')) as word from documents) group by all""",
    "lang_grams": """
select lang, gram, sum(n) as n from (
  select lang, n, unnest(list_transform(range(1, length(word) + 1), lambda i: substring(' ' || word || ' ', i::bigint, 3))) as gram
  from doc_words where doc_id % 5 <> 0 and lang is not null) group by all""",
    "lang_totals": "select lang, cast(sum(n) + count(*) as double) as total from lang_grams group by lang",
    "gram_weights": """
select lang, gram, cast(round(1000 * ln(cast(n + 1 as double) / total)) as bigint) as weight
from (select * from lang_grams qualify row_number() over (partition by lang order by n desc, gram) <= 20000)
  join lang_totals using (lang)""",
    "word_scores": """
select word, w.lang, sum(coalesce(weight, cast(round(1000 * ln(1 / total)) as bigint))) as score
from (select word, lang, total, unnest(list_transform(range(1, length(word) + 1),
    lambda i: substring(' ' || word || ' ', i::bigint, 3))) as gram
  from (select distinct word from doc_words where doc_id % 5 = 0), lang_totals) w
left join gram_weights g on g.lang = w.lang and g.gram = w.gram group by all""",
    "learned_language": """
select d.doc_id, coalesce(code, 'unknown') as code from (select doc_id from documents where doc_id % 5 = 0) d left join (
  select doc_id, arg_min(lang, row(-score, lang)) as code from (
    select w.doc_id, s.lang, sum(w.n * s.score) as score from doc_words w join word_scores s on w.word = s.word
    where w.doc_id % 5 = 0 group by all) group by doc_id) b on d.doc_id = b.doc_id""",
    "joined": """
select b.*, coalesce(p.page_ok, false) as page_ok, case when p.page_ok then p.text else '' end as text_full
from base b left join page_texts p on b."URL" = p.url""",
    "basis": """
select "URL" as key, case when length(text_full) > 50 then text_full else "Title" end as txt from joined""",
    "language": language("basis"),
    "texts_0": f"""
select j.*, l.code, coalesce(n.name, 'Unknown') as "Language", {translated('j."Title"')} as tt,
  text_full as body
from joined j join language l on j."URL" = l.key left join fx_names n on l.code = n.code""",
    "texts": f"""
select *, coalesce(nullif(tt, ''), "Title") as "Translated Title",
  case when page_ok then coalesce(nullif(case when code = 'en' then body else {translated_chunks('body')} end, ''), nullif(tt, ''), "Title")
    else coalesce(nullif(tt, ''), "Title") end as "Translated Text",
  case when page_ok then 'ok' else 'no_content' end as status
from texts_0""",
    "scored_texts": """select "URL" as key, case when status = 'ok' then "Translated Text" end as txt from texts""",
    "all_texts": """select "URL" as key, "Translated Text" as txt from texts""",
    "text_sentiment": sentiment("scored_texts"),
    "text_entities": entities("all_texts", "fx_gazetteer", 4),
    "results": f"""
select t."URL", "Translated Title", "Translated Text", "Language",
  case when status = 'no_content' then '[failed - no content]' else s.label end as "Model Sentiment Label",
  s.score as "Model Sentiment Score", e.names as "Keywords", {no_www('t."URL"')} as "Domain"
from texts t join text_sentiment s on t."URL" = s.key join text_entities e on t."URL" = e.key where {eligible('t."URL"')}""",
    "enriched": """
select b.*, "Translated Title", "Translated Text", "Language", "Model Sentiment Label", "Model Sentiment Score",
  r."Keywords" as "Enriched Keywords", r."Domain" as "Enriched Domain"
from base b left join results r on b."URL" = r."URL" """,
    "week": """
select * from (select *, row_number() over (partition by "URL" order by "Date", win, code, ord, pos) as rn
  from article_rows where day between date '2024-01-08' and date '2024-01-14') where rn = 1""",
    # --- score ---
    "scored_0": f"""
select ord, url, {parsed('dt')} as dt, country, {norm_label('label')} as label, score from fx_scored where score is not null""",
    "deduped": """
select * from (select *, row_number() over (partition by url order by dt, ord) as rn from scored_0 where dt is not null) where rn = 1""",
    "confident": "select * from deduped where score >= 0.70",
    "per_label": per_label("select dt, url, country, label, score from confident"),
    "rollup": rollup("per_label"),
    "run_scored": f"""
select {parsed('"Date"')} as dt, "URL" as url, "Country" as country, {norm_label('"Model Sentiment Label"')} as label,
  "Model Sentiment Score" as score from enriched where "Model Sentiment Score" >= 0.70""",
    "run_per_label": per_label("select * from run_scored"),
    "run_rollup": rollup("run_per_label"),
    # --- grid ---
    "weeks": """
select distinct cast(date_trunc('week', ts) as date) as week_start, cast(date_trunc('week', ts) as date) + 6 as week_end from events""",
    "grid": """
select d.day, w.win, strftime(d.day, '%Y%m%d') || lpad(cast(w.win * 6 as varchar), 2, '0') || '0000' as window_start,
  strftime(d.day, '%Y%m%d') || lpad(cast(w.win * 6 + 5 as varchar), 2, '0') || '5959' as window_end, c.code
from (select week_start + cast(k as int) as day from weeks, range(0, 7) r(k)) d,
  (select cast(k as int) as win from range(0, 4) r(k)) w, fx_codes c""",
}


def sql(body: str) -> str:
    """``body`` with all CTEs it needs, directly or through others."""
    order: list[str] = []

    def visit(text: str, own: str = "") -> None:
        for name in CTES:
            if name != own and name not in order and re.search(rf"\b{name}\b(?!\.)", text):
                visit(CTES[name], name)
                if name not in order:
                    order.append(name)

    visit(body)
    head = ",\n".join(f"{name} as ({CTES[name].strip()})" for name in order)
    return f"with {head}\n{body}" if order else body


def request_url(code: str, start: str, end: str) -> str:
    query = quote_plus(f"{q(KEYWORD_QUERY)} || ' sourcecountry:' || {code}")
    return (f"{q(SEARCH_URL)} || '?query=' || {query} || '&startdatetime=' || {start} || '&enddatetime=' || {end}"
            " || '&format=json&maxrecords=250&mode=artlist'")
