"""Datasets, stage runner, incremental enrichment, staging."""

import datetime
import json
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from mediasignal import Datasets, PipelineConfig, enrich, run_stages
from mediasignal.schemas import ARTICLES_RAW, PAGES, RESPONSE
from mediasignal.session import staged, staging_root
from mediasignal.streaming.incremental import enrich_new_files, read_enriched

CONFIG = PipelineConfig(polarity={"gain": "bullish", "loss": "bearish"})
TEXT = "the gain of the " * 20


@pytest.fixture
def store(spark, tmp_path):
    return Datasets(spark, str(tmp_path / "data"))


def replies(spark, day, n=4, prefix="a"):
    body = json.dumps({"articles": [{"url": f"https://{prefix}.example/{i}", "title": f"t{i}", "sourcecountry": "Kenya"} for i in range(n)]})
    return spark.createDataFrame([(1, day, 0, "KE", 200, body)], RESPONSE)


def landed(spark, n=4, prefix="a"):
    return spark.createDataFrame([(f"https://{prefix}.example/{i}", 200, f"<p>{TEXT}</p>") for i in range(n)], PAGES)


def test_read_projects_and_dedupes(spark, store):
    df = spark.createDataFrame([(1, "b", "u"), (2, "a", "u"), (3, "c", None), (4, "c", None)], "n int, x string, URL string")
    store.write("d", df)
    got = store.read("d", columns=["URL", "absent", "x"], dedupe_on="URL", order=["x"])
    assert got.columns == ["URL", "x"] and sorted(map(tuple, got.collect()), key=str) == [("u", "a"), (None, "c")]
    assert store.read("d", dedupe_on="absent").count() == 4


def test_empty_policy(spark, store):
    df = spark.range(3)
    assert store.write("d", df)
    assert not store.write("d", df.where("false"), on_empty="skip") and store.read("d").count() == 3
    assert store.write("d", df.where("false")) and store.read("d", schema=df.schema).count() == 0
    with pytest.raises(ValueError):
        store.write("d", df, on_empty="maybe")


def test_only_present_partitions_are_replaced(spark, store):
    store.write("d", spark.createDataFrame([(1, "a"), (2, "b")], "n int, w string"), partition_by="w")
    store.write("d", spark.createDataFrame([(3, "b")], "n int, w string"), partition_by="w")
    assert sorted((r.n, r.w) for r in store.read("d").collect()) == [(1, "a"), (3, "b")]


def test_catalog_tables(spark, tmp_path):
    tables = Datasets(spark)
    spark.sql("drop table if exists ms_weeks")
    try:
        tables.write("ms_weeks", spark.createDataFrame([(1, "a"), (2, "b")], "n int, w string"), partition_by="w")
        tables.write("ms_weeks", spark.createDataFrame([("b", 3)], "w string, n int"), partition_by="w")
        assert sorted((r.n, r.w) for r in tables.read("ms_weeks").collect()) == [(1, "a"), (3, "b")]
    finally:
        spark.sql("drop table if exists ms_weeks")


def test_all_stages(spark, store):
    summary = run_stages(store, replies(spark, datetime.date(2024, 1, 10)), landed(spark), CONFIG, "2024-01-12")
    assert [(r.stage, r.rows_in, r.rows_out) for r in summary.collect()] == [("collect", 1, 4), ("enrich", 4, 4), ("score", 4, 1)]
    row = store.read(CONFIG.rollup_dataset).first()
    assert (row.COUNTRY, row["Year-Month"], row.article_count, row.majority_sentiment) == ("Kenya", "2024-01-01T00:00:00.000Z", 4, "bullish")
    again = run_stages(store, replies(spark, datetime.date(2024, 1, 10)), landed(spark), CONFIG, "2024-01-12")
    assert again.count() == 3 and store.read(CONFIG.rollup_dataset).count() == 1


def test_stages_can_be_picked(spark, store):
    run_stages(store, replies(spark, datetime.date(2024, 1, 10)), config=CONFIG, run_date=datetime.date(2024, 1, 10), stages=["collect"])
    got = run_stages(store, pages=landed(spark), config=CONFIG, stages=["enrich"])
    assert [(r.stage, r.rows_out) for r in got.collect()] == [("enrich", 4)]
    with pytest.raises(ValueError):
        run_stages(store, stages=["publish"])


def test_empty_week_is_not_written_but_an_empty_rollup_is(spark, store):
    run_stages(store, replies(spark, datetime.date(2024, 1, 10)), landed(spark), CONFIG, "2024-01-10")
    run_stages(store, replies(spark, datetime.date(2024, 1, 10)), landed(spark), CONFIG, "2024-03-10", stages=["collect", "enrich"])
    assert store.read(CONFIG.raw_dataset).count() == 4 and store.read(CONFIG.enriched_dataset).count() == 4
    spark.createDataFrame([], store.read(CONFIG.enriched_dataset).schema).write.mode("overwrite").parquet(store.path(CONFIG.enriched_dataset))
    run_stages(store, config=CONFIG, stages=["score"])
    assert store.read(CONFIG.rollup_dataset).count() == 0


def test_weeks_are_kept_apart(spark, store):
    for day, prefix in (("2024-01-10", "a"), ("2024-01-17", "b"), ("2024-01-17", "b")):
        rows = replies(spark, datetime.date.fromisoformat(day), prefix=prefix)
        s = run_stages(store, rows, landed(spark, prefix=prefix), CONFIG, day, stages=["collect", "enrich"], keep_weeks=True)
        assert [r.rows_out for r in s.collect()] == [4, 4]
    raw = store.read(CONFIG.raw_dataset)
    assert raw.count() == 8 and raw.select("run_week").distinct().count() == 2


def test_incremental_equals_batch(spark, tmp_path):
    landing, sink, mark = (str(tmp_path / n) for n in ("landing", "sink", "mark"))
    pages = landed(spark, 9)
    total = None
    for part in range(3):
        rows = [(f"2024-01-0{part + 1}", "t", f"https://a.example/{i}", "d", "Kenya", "k") for i in range(part * 2, part * 2 + 4)]
        rows += [(f"2024-01-0{part + 1}", "t", None, "d", "Kenya", "k")]
        df = spark.createDataFrame(rows, ARTICLES_RAW)
        df.coalesce(1).write.mode("append").parquet(landing)
        total = df if total is None else total.unionByName(df)
        enrich_new_files(spark, landing, pages, sink, mark, CONFIG)
        enrich_new_files(spark, landing, pages, sink, mark, CONFIG)
    got = sorted(map(str, read_enriched(spark, sink).collect()))
    assert got == sorted(map(str, enrich(total, pages, CONFIG).collect())) and len(got) == 9


def test_the_sink_is_read_once_a_checkpoint(spark, tmp_path, monkeypatch):
    from mediasignal.streaming import incremental

    landing, sink, mark = (str(tmp_path / n) for n in ("landing", "sink", "mark"))
    reads, read = [], incremental.stored
    monkeypatch.setattr(incremental, "stored", lambda *a: reads.append(a) or read(*a))
    for day in ("2024-01-05", "2024-01-06"):
        rows = [(day, t, u, "d", None, "k") for t in ("b", None, "a") for u in ("https://a.example/1", None, f"https://a.example/{day}")]
        spark.createDataFrame(rows, ARTICLES_RAW).coalesce(1).write.mode("append").parquet(landing)
        enrich_new_files(spark, landing, landed(spark), sink, mark, CONFIG)
    assert len(reads) == 1
    got = sorted(((r.URL or "", r.Date, r.Title) for r in read_enriched(spark, sink).collect()))
    assert got == [("", "2024-01-05", None), ("https://a.example/1", "2024-01-05", None),
                   ("https://a.example/2024-01-05", "2024-01-05", None), ("https://a.example/2024-01-06", "2024-01-06", None)]


def test_first_landed_copy_counts_and_new_checkpoints_keep_the_sink(spark, tmp_path):
    landing, sink = str(tmp_path / "landing"), str(tmp_path / "sink")
    pages = landed(spark, 9)

    def land(day, urls, mark):
        rows = [(day, f"title of {day}", f"https://a.example/{i}", "d", "Kenya", "k") for i in urls]
        spark.createDataFrame(rows, ARTICLES_RAW).coalesce(1).write.mode("append").parquet(landing)
        enrich_new_files(spark, landing, pages, sink, str(tmp_path / mark), CONFIG)

    land("2024-01-05", range(4), "mark")
    land("2024-01-02", range(2, 6), "mark")  # earlier dates in a late file
    land("2024-01-03", range(5, 8), "other")
    got = {r.URL[-1]: r.Date for r in read_enriched(spark, sink).collect()}
    assert got == dict.fromkeys("0123", "2024-01-05") | dict.fromkeys("45", "2024-01-02") | dict.fromkeys("67", "2024-01-03")
    assert read_enriched(spark, sink).count() == 8


def test_weeks_one_after_another_equal_one_run(spark, tmp_path):
    days = [datetime.date(2024, 1, d) for d in (3, 10, 17)]
    rows = [replies(spark, day, n=3 + i, prefix="ab"[i % 2]) for i, day in enumerate(days)]
    every = rows[0].unionByName(rows[1]).unionByName(rows[2])
    pages = landed(spark, 9).unionByName(landed(spark, 2, "b"))
    weekly, whole = (Datasets(spark, str(tmp_path / n)) for n in ("weekly", "whole"))
    for day in days:
        run_stages(weekly, every, pages, CONFIG, day, keep_weeks=True,
                   stages=["collect", "enrich", "score"][:3 if day == days[-1] else 2])
    run_stages(whole, every, pages, CONFIG, every_week=True)
    got, want = (sorted(map(str, s.read(CONFIG.rollup_dataset).collect())) for s in (weekly, whole))
    assert got == want and weekly.read(CONFIG.enriched_dataset).select("run_week").distinct().count() == 3


def test_summary_counts_the_week_and_what_was_enriched(spark, store):
    odd = spark.createDataFrame([(2, datetime.date(2024, 1, 10), 0, "KE", 200, json.dumps(
        {"articles": [{"url": "ftp://x.example/1"}]})), (3, datetime.date(2024, 1, 9), 0, "KE", 500, "{}")], RESPONSE)
    rows = replies(spark, datetime.date(2024, 1, 10)).unionByName(odd).unionByName(replies(spark, datetime.date(2024, 2, 10), prefix="z"))
    got = run_stages(store, rows, landed(spark), CONFIG, "2024-01-12", keep_weeks=True).collect()
    assert [tuple(r) for r in got] == [
        ("collect", 3, 5, 5 / 3 * 100, "usable=2"), ("enrich", 5, 4, 80.0, "bullish=4"),
        ("score", 5, 1, 20.0, "bad_score_or_date=1, duplicate_urls=0")]


def test_staged_table_cuts_lineage(spark):
    df = spark.range(5).withColumn("x", F.col("id") * 2)
    back = staged(df, "t")
    assert sorted(map(tuple, back.collect())) == [(i, 2 * i) for i in range(5)]
    assert "Range" not in back._jdf.queryExecution().optimizedPlan().toString()


def test_staged_tables_go_when_their_stage_is_written(spark, store, tmp_path):
    lexicon = spark.createDataFrame([("das", "the")], "src string, dst string")
    config = replace(CONFIG, lexicon=lexicon, inline_entries=0)
    root = staging_root(spark).removeprefix("file:").replace("//", "/")
    tables = lambda: {f for f in os.listdir(root) if f.startswith(("landed-", "pages-", "texts-", "translated-"))}
    before = tables()
    store.write(CONFIG.raw_dataset, spark.createDataFrame([], ARTICLES_RAW))
    assert run_stages(store, None, landed(spark), config, stages=["enrich"], every_week=True).first().rows_out == 0
    run_stages(store, replies(spark, datetime.date(2024, 1, 10)), landed(spark), config, every_week=True)
    assert store.read(CONFIG.enriched_dataset).count() == 4
    store.write("landing", store.read(CONFIG.raw_dataset))
    sink = str(tmp_path / "sink")
    enrich_new_files(spark, store.path("landing"), landed(spark), sink, str(tmp_path / "ckpt"), config)
    assert read_enriched(spark, sink).count() == 4
    assert tables() == before


def test_staging_follows_the_session(spark):
    class Conf:
        def get(self, key, default=None):
            return "hdfs://shared/ckpt/" if key == "spark.checkpoint.dir" else default

    class Session:
        conf = Conf()

    assert staging_root(Session()) == "hdfs://shared/ckpt"

    class Bare:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "yarn"

    with pytest.raises(RuntimeError):
        staging_root(Bare())


def test_bucketed_tables_meet_without_a_shuffle(spark, tmp_path):
    from mediasignal.plans.enrich import base_articles, enrich_rows, join_enriched
    from mediasignal.sources.pages import join_pages, join_texts, page_texts

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    store = Datasets(spark, str(tmp_path / "tables"))
    rows = [(f"2025-08-0{1 + i % 7}T00:00:00.000Z", f"t{i}", f"https://a.example/{i % 30}", "a.example", "KE", "k") for i in range(60)]
    arts = spark.createDataFrame(rows, "Date string, Title string, URL string, Domain string, Country string, Keywords string")
    pages = spark.createDataFrame([(f"https://a.example/{i % 20}", 200 + 300 * (i % 3 == 0), f"<p>page {i}</p>") for i in range(40)],
                                  "url string, status int, html string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        base = base_articles(store.write_bucketed("bucketed_articles", arts, "URL", 4), CONFIG)
        joined = join_texts(base, store.write_bucketed("bucketed_texts", page_texts(pages), "URL", 4))
        assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
        assert sorted(map(str, joined.collect())) == sorted(map(str, join_pages(base_articles(arts, CONFIG), pages).collect()))
        results = store.write_bucketed("bucketed_results", enrich_rows(base, pages, CONFIG), "URL", 4)
        both = join_enriched(base, results)
        assert "Exchange" not in plan(both) and both.count() == 30
        for name in ("bucketed_articles", "bucketed_texts", "bucketed_results"):
            assert len(list((tmp_path / "tables" / name).glob("part-*"))) <= 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("bucketed_articles", "bucketed_texts", "bucketed_results"):
            spark.sql(f"drop table if exists {name}")


def test_what_is_written_is_counted_while_it_is_written(spark, store, monkeypatch):
    reads = []
    read = Datasets.read
    monkeypatch.setattr(Datasets, "read", lambda self, name, *a, **k: reads.append(name) or read(self, name, *a, **k))
    summary = run_stages(store, replies(spark, datetime.date(2024, 1, 10)), landed(spark, 3), CONFIG, "2024-01-12", keep_weeks=True)
    assert reads == [CONFIG.raw_dataset, CONFIG.enriched_dataset]  # by the stages themselves
    for name in (CONFIG.raw_dataset, CONFIG.rollup_dataset):
        assert store.path(name) not in summary._jdf.queryExecution().optimizedPlan().toString()
    want = [("collect", 1, 4, 400.0, "usable=1"), ("enrich", 4, 4, 100.0, "[failed - no content]=1, bullish=3"),
            ("score", 4, 1, 25.0, "bad_score_or_date=1, duplicate_urls=0")]
    got = [tuple(r) for r in summary.collect()]
    assert got[0] == want[0] and got[1][:4] == want[1][:4] and got[2][:3] == want[2][:3], got


def test_labels_of_a_model_are_counted_from_the_table(spark, store):
    rows = replies(spark, datetime.date(2024, 1, 10))
    config = replace(CONFIG, sentiment_model=lambda: lambda texts: [("Upbeat", 0.9) for _ in texts])
    got = run_stages(store, rows, landed(spark), config, "2024-01-12").collect()
    assert tuple(got[1]) == ("enrich", 4, 4, 100.0, "upbeat=4")


def test_counts_of_an_empty_rollup(spark, store):
    run_stages(store, replies(spark, datetime.date(2024, 1, 10)), landed(spark), CONFIG, "2024-01-10", stages=["collect", "enrich"])
    none = store.read(CONFIG.enriched_dataset).where("URL = 'none'")
    schema = none.schema
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(store.path(CONFIG.enriched_dataset))
    got = run_stages(store, config=CONFIG, stages=["score"]).collect()
    assert [tuple(r) for r in got] == [("score", 0, 0, 0.0, "bad_score_or_date=0, duplicate_urls=0")]
