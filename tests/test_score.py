"""The third stage: golden cases, properties, skew."""

import random

import pytest

from mediasignal import PipelineConfig, score
from mediasignal.operators import quality
from mediasignal.operators.sentiment import LABEL, SCORE
from mediasignal.schemas import COUNTRY_MONTH

CONFIG = PipelineConfig()
SCHEMA = f"URL string, Date string, Country string, `{LABEL}` string, `{SCORE}` double"


def table(spark, rows):
    """Rows ``(label, score)`` with optional ``url, date, country``."""
    out = []
    for i, row in enumerate(rows):
        label, value, *rest = row
        url, date, country = (list(rest) + [None] * 3)[:3] if rest else (f"https://n/{i:04}", "2025-08-04", "KE")
        out.append((url, date, country, label, value))
    return spark.createDataFrame(out, SCHEMA)


def run(spark, rows):
    return score(table(spark, rows), CONFIG).collect()


def test_zero_mean_is_neutral(spark):
    row, = run(spark, [("bullish", s) for s in (.71, .83, .94)] + [("bearish", s) for s in (.83, .71, .94)])
    assert (row.avg_sentiment, row.avg_sentiment_label) == (0.0, "neutral")
    assert (row.article_count, row.pos_count, row.neg_count, row.neu_count) == (6, 3, 3, 0)


def test_mean_and_schema(spark):
    df = score(table(spark, [("Bullish ", .8), ("BEARISH", .9), ("neutral", 1.0)]), CONFIG)
    row = df.first()
    assert row.avg_sentiment == pytest.approx(-0.1 / 3)
    assert row["Year-Month"] == "2025-08-01T00:00:00.000Z" and row.COUNTRY == "KE"
    assert row.avg_sentiment_label == "bearish"
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in COUNTRY_MONTH]


def test_nan_and_null_scores_and_bad_dates_drop(spark):
    rows = [("bullish", float("nan")), ("bullish", None), ("bullish", .9, "u", "garbage", "KE")]
    assert run(spark, rows) == []


def test_threshold(spark):
    row, = run(spark, [("bullish", .70), ("bullish", .69)])
    assert row.article_count == 1


def test_null_country_has_no_row(spark):
    assert run(spark, [("bullish", .9, "u", "2025-08-04", None)]) == []


def test_tie_goes_to_the_first_label(spark):
    row, = run(spark, [("bearish", .9), ("bullish", .9), ("bullish", .9), ("bearish", .9)])
    assert row.majority_sentiment == "bearish"


def test_odd_label_counts_only_as_article(spark):
    row, = run(spark, [(None, .9)])
    assert (row.article_count, row.pos_count + row.neg_count + row.neu_count, row.majority_sentiment) == (1, 0, "nan")


def test_missing_urls_are_copies_of_each_other(spark):
    row, = run(spark, [("bullish", .9, None, "2025-08-04", "KE"), ("bullish", .9, None, "2025-08-05", "KE")])
    assert row.article_count == 1


def test_first_row_of_a_url_decides(spark):
    rows = [("bullish", .60, "u", "2025-08-04", "KE"), ("bullish", .90, "u", "2025-08-05", "KE"),
            ("bearish", .90, "v", "2025-08-06", "KE")]
    row, = run(spark, rows)
    assert (row.article_count, row.neg_count) == (1, 1)


def test_dropped_row_does_not_hide_a_later_copy(spark):
    rows = [("bullish", None, "u", "2025-08-04", "KE"), ("bullish", .90, "u", "2025-08-05", "KE")]
    assert run(spark, rows)[0].article_count == 1


def test_no_url_column_means_no_dedupe(spark):
    df = table(spark, [("bullish", .9), ("bullish", .9)]).drop("URL")
    assert score(df, CONFIG).first().article_count == 2


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="Country"):
        score(spark.createDataFrame([("x",)], "Date string"), CONFIG)


def test_sorted_by_country_then_month(spark):
    rows = [("bullish", .9, f"u{i}", f"2025-{m:02}-01", c) for i, (m, c) in enumerate([(9, "B"), (8, "B"), (10, "A")])]
    assert [(r.COUNTRY, r["Year-Month"][:7]) for r in run(spark, rows)] == [
        ("A", "2025-10"), ("B", "2025-08"), ("B", "2025-09")]


def random_rows(n, seed):
    rng = random.Random(seed)
    hot = "https://hot/1"
    return [(rng.choice(["Bullish", "bearish ", "NEUTRAL", "other", None]),
             rng.choice([None, float("nan"), round(rng.uniform(.5, 1), 2)]) if rng.random() < .2 else round(rng.uniform(.5, 1), 2),
             hot if rng.random() < .3 else f"https://n/{rng.randrange(n)}",
             rng.choice(["2025-08-04", "2025-09-30T00:00:00.000Z", "bad"]), rng.choice(["KE", "GH", None]))
            for _ in range(n)]


def brute_force(rows):
    """The stage in plain Python."""
    kept = []
    for label, value, url, date, country in rows:
        label = "nan" if label is None else label.strip().lower()
        if value is None or value != value or date == "bad":
            continue
        kept.append((date[:10], -value, label, country or "", url, country))
    first = {}
    for r in sorted(kept, key=lambda r: (r[0], r[1], r[2], r[5] is not None, r[3])):
        first.setdefault(r[4], r)
    groups = {}
    for day, neg, label, _, url, country in first.values():
        if -neg >= .70 and country is not None:
            groups.setdefault((country, day[:7]), []).append((day, url, label, -neg))
    out = {}
    for key, items in groups.items():
        items.sort()
        labels = [i[2] for i in items]
        best = max(labels, key=lambda x: (labels.count(x), -labels.index(x)))
        cents = sum({"bullish": 1, "bearish": -1}.get(i[2], 0) * round(i[3] * 100) for i in items)
        out[key] = (len(items), labels.count("bullish"), labels.count("bearish"), labels.count("neutral"), best, cents)
    return out


@pytest.mark.parametrize("seed,parts", [(1, 1), (2, 7), (3, 4)])
def test_against_brute_force_in_any_order(spark, seed, parts):
    rows = random_rows(600, seed)
    want = brute_force(rows)
    random.Random(seed).shuffle(rows)
    got = score(table(spark, rows).repartition(parts), CONFIG).collect()
    assert {(r.COUNTRY, r["Year-Month"][:7]): (
        r.article_count, r.pos_count, r.neg_count, r.neu_count, r.majority_sentiment,
        round(r.avg_sentiment * r.article_count * 100)) for r in got} == want
    for r in got:
        assert r.pos_count + r.neg_count + r.neu_count <= r.article_count and abs(r.avg_sentiment) <= 1


def test_drop_counts_add_up(spark):
    rows = random_rows(400, 9)
    df = table(spark, rows)
    c = quality.drop_counts(df).first()
    good = [r for r in rows if r[1] is not None and r[1] == r[1] and r[3] != "bad"]
    assert c.rows_in == 400 and c.bad_score_or_date == 400 - len(good)
    assert c.rows_out == len({r[2] for r in good}) and c.duplicate_urls == len(good) - c.rows_out
    no_url = quality.drop_counts(df.drop("URL")).first()
    assert (no_url.duplicate_urls, no_url.rows_out) == (0, len(good))
    empty = quality.drop_counts(df.where("false")).first()
    assert tuple(empty) == (0, 0, 0, 0)


def test_copies_are_limited_before_the_shuffle(spark):
    plan = score(table(spark, [("bullish", .9)]), CONFIG)._jdf.queryExecution().executedPlan().toString()
    partial = plan.index("row_number(), 1, Partial")
    assert plan.index("hashpartitioning(URL") < partial
    assert "partial_count" in plan and "partial_sum" in plan


def test_label_distribution(spark):
    df = table(spark, [("A ", .9), ("a", .1), ("b", None)])
    assert [tuple(r) for r in quality.label_distribution(df).collect()] == [("a", 2), ("b", 1)]


def test_scores_beyond_six_digits(spark):
    (row,) = run(spark, [("bullish", 0.9000004), ("bearish", 0.9)])
    assert row["avg_sentiment"] > 0 and row["avg_sentiment_label"] == "bullish"


def test_rollup_reads_its_rows_once(spark):
    from mediasignal.operators.score import clean, rollup
    plan = rollup(clean(table(spark, [("bullish", 0.9)]), CONFIG))._jdf.queryExecution().executedPlan().toString()
    # One shuffle by URL, one by label and one by country and month.
    assert plan.count("Scan ExistingRDD") == 1 and plan.count("Exchange hashpartitioning") == 3
    assert "partial_count(1)" in plan and "partial_min(at" in plan
