"""Request grid, landed replies and article rows."""

import datetime
import json
from urllib.parse import quote_plus

import pytest
from pyspark.sql import functions as F

from mediasignal import PipelineConfig, collect
from mediasignal.operators import dedupe, grid, quality
from mediasignal.operators.articles import article_rows, drop_empty_url, usable_responses
from mediasignal.schemas import ARTICLES_RAW, RESPONSE
from mediasignal.sources.responses import hits, read_responses

CONFIG = PipelineConfig()
DAY = datetime.date(2024, 1, 10)


def replies(spark, *bodies, **over):
    rows = []
    for i, body in enumerate(bodies):
        row = {"ord": i, "day": DAY, "win": 0, "code": "KE", "status": 200,
               "body": body if isinstance(body, (str, type(None))) else json.dumps(body)}
        rows.append(tuple({**row, **over}[f] for f in RESPONSE.fieldNames()))
    return spark.createDataFrame(rows, RESPONSE)


def weeks(spark, day="2025-08-06"):
    return grid.week_of(spark.createDataFrame([(day,)], "d string").select(F.col("d").cast("date").alias("d")), "d")


def test_default_grid_has_every_request(spark):
    g = grid.request_grid(weeks(spark), CONFIG)
    assert g.count() == g.distinct().count() == 7 * 4 * 197
    assert "Exchange" not in g._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("hours", range(1, 25))
def test_windows_tile_the_day(spark, hours):
    rows = grid.day_windows(weeks(spark).select(F.col("d").alias("day")), hours).orderBy("win").collect()
    parse = lambda s: datetime.datetime.strptime(s, "%Y%m%d%H%M%S")
    assert parse(rows[0].window_start) == datetime.datetime(2025, 8, 6)
    assert parse(rows[-1].window_end) == datetime.datetime(2025, 8, 6, 23, 59, 59)
    for a, b in zip(rows, rows[1:]):
        assert parse(b.window_start) - parse(a.window_end) == datetime.timedelta(seconds=1)


def test_five_hour_windows(spark):
    rows = grid.day_windows(weeks(spark).select(F.col("d").alias("day")), 5).orderBy("win").collect()
    assert len(rows) == 5 and rows[-1].window_start.endswith("200000") and rows[-1].window_end.endswith("235959")


def test_codes(spark):
    dim = grid.country_dimension(spark, CONFIG)
    assert dim.count() == 198
    codes = [r.code for r in grid.distinct_codes(dim).collect()]
    assert codes == sorted(set(codes)) == CONFIG.country_codes and len(codes) == 197
    assert dim.where("code = 'LT'").count() == 2


def test_request_url(spark):
    config = PipelineConfig(keywords=("Exchange Rate", "a~b*c"), search_url="https://s.example/doc", max_records=9)
    url = spark.range(1).select(grid.request_url(F.lit("UK"), F.lit("1"), F.lit("2"), config)).first()[0]
    query = quote_plus('("Exchange Rate" OR "a~b*c") sourcecountry:UK')
    assert url == f"https://s.example/doc?query={query}&startdatetime=1&enddatetime=2&format=json&maxrecords=9&mode=artlist"


GOOD = {"articles": [{"url": " https://www.A.example/x ", "title": None, "sourcecountry": "", "themes": ["b", "a", 1]},
                     {"url": "", "title": "none"}, {"title": "no url"}, {"url": "https://b.example", "sourcecountry": "Kenya",
                                                                       "title": "T", "themes": "x;y", "more": {"k": 1}}]}


def test_article_rows(spark):
    df = collect(replies(spark, GOOD))
    assert df.schema.fieldNames() == ARTICLES_RAW.fieldNames()
    assert sorted(map(tuple, df.collect())) == [
        ("2024-01-10T00:00:00.000Z", "", "https://www.A.example/x", "www.a.example", "Unknown", "a, b"),
        ("2024-01-10T00:00:00.000Z", "T", "https://b.example", "b.example", "Kenya", "x;y")]


@pytest.mark.parametrize("body", ["not json", "", None, "[1]", '[{"articles":[{"url":"https://x.example"}]}]', '{"articles":null}',
                                  '{"articles":[]}', '{"articles":"x"}', '{"other":1}', '{"articles":[{"url":"https://cut', "7"])
def test_unusable_bodies_give_nothing(spark, body):
    assert hits(replies(spark, body)).count() == 0


def test_failed_status_gives_nothing(spark):
    assert collect(replies(spark, GOOD, status=500)).count() == 0


def test_positions_follow_the_reply(spark):
    assert [(r.pos, r.url) for r in hits(replies(spark, GOOD)).orderBy("pos").collect()][3] == (3, "https://b.example")


def test_first_hit_of_a_url_wins_and_weeks_filter(spark):
    one = {"articles": [{"url": "https://u.example", "title": "late"}]}
    two = {"articles": [{"url": "https://u.example ", "title": "early"}]}
    late = replies(spark, one)
    early = replies(spark, two, day=datetime.date(2024, 1, 7))
    both = late.unionByName(early)
    assert [r.Title for r in collect(both).collect()] == ["early"]
    assert [r.Title for r in collect(both, DAY).collect()] == ["late"]
    assert collect(both, datetime.date(2024, 2, 1)).count() == 0


def test_hot_url_and_order_independence(spark):
    bodies = [{"articles": [{"url": "https://hot.example", "title": str(i)}, {"url": f"https://c.example/{i}", "title": "c"}]}
              for i in range(60)]
    want = sorted(map(tuple, collect(replies(spark, *bodies)).collect()))
    assert len(want) == 61 and ("0", "https://hot.example") in {(r[1], r[2]) for r in want}
    assert sorted(map(tuple, collect(replies(spark, *reversed(bodies)).withColumn("ord", 59 - F.col("ord")).repartition(5)).collect())) == want


def test_cap_per_window(spark):
    rows = hits(replies(spark, {"articles": [{"url": f"u{i}"} for i in range(400)]}))
    kept = dedupe.cap_per_group(rows, ["code", "day", "win"], ["ord", "pos"], CONFIG.max_records)
    assert [r.pos for r in kept.orderBy("pos").collect()] == list(range(250))
    assert "WindowGroupLimit" in kept._jdf.queryExecution().executedPlan().toString()


def test_request_counts(spark):
    df = replies(spark, GOOD, "not json", code="KE").unionByName(replies(spark, GOOD, code="GH", status=500))
    assert {tuple(r) for r in quality.request_counts(df).collect()} == {
        ("KE", DAY, 2, 1), ("GH", DAY, 1, 0), (None, None, 3, 1)}


def test_read_landed_folder(spark, tmp_path):
    replies(spark, GOOD, "not json").write.json(str(tmp_path / "r"))
    df = read_responses(spark, str(tmp_path / "r"))
    assert df.schema == RESPONSE and collect(df).count() == 2


@pytest.mark.parametrize("lead", ["", " ", "\n", "\t", "\r\n"])
def test_blanks_before_a_body(spark, lead):
    rows = replies(spark, lead + json.dumps({"articles": [{"url": "https://a.example/1"}]}))
    assert hits(rows).count() == 1 and quality.request_counts(rows).where("code is null").first().usable == 1


def test_an_odd_entry_costs_only_itself(spark):
    body = json.dumps({"articles": [{"url": "https://a.example/1", "title": 7}, "odd", None, 3, [{}], {"url": "https://a.example/2", "themes": {"a": 1}}]})
    assert [(r.pos, r.url, r.title) for r in hits(replies(spark, body)).orderBy("pos").collect()] == [
        (0, "https://a.example/1", "7"), (5, "https://a.example/2", None)]


def test_bodies_are_parsed_once(spark):
    rows = replies(spark, GOOD)
    found = drop_empty_url(hits(rows))
    for df in (hits(rows), usable_responses(rows), quality.request_counts(rows), article_rows(found),
               dedupe.cap_per_group(found, ["code", "day", "win"], ["ord", "pos"], 250), collect(rows)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("parseJson") == 1, plan
