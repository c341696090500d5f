"""What a driver or a task holds doesn't grow with the tables."""

import tracemalloc
from dataclasses import replace

import pyarrow as pa
from pyspark.sql import functions as F

from checks import fixtures as fx
from mediasignal.config import PipelineConfig
from mediasignal.functions import html
from mediasignal.operators.entities import add_entities
from mediasignal.operators.lookup import lookup_join
from mediasignal.operators.phrases import phrase_runs
from mediasignal.operators.translate import add_translation
from mediasignal.session import staged

CONFIG = PipelineConfig()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ------------------------------------------------------------------ tables that Spark takes for small ones
def test_a_large_table_with_its_salts_is_not_broadcast(spark):
    facts = spark.createDataFrame([(i, f"w{i}") for i in range(40)], "id long, w string")
    table = staged(spark.range(3000).select(F.format_string("w%d", "id").alias("w"), F.col("id").alias("v")), "words")
    joined = lookup_join(facts, table, "w", "inner", ["id"], replace(CONFIG, broadcast_rows=0))
    assert "SortMergeJoin" in plan(joined) and "Broadcast" not in plan(joined)
    assert sorted(r.v for r in joined.collect()) == list(range(40))


def test_names_of_texts_are_not_broadcast(spark):
    known = spark.range(3000).select(F.format_string("Name%d", "id").alias("phrase"), F.lit("ORG").alias("kind"))
    texts = staged(spark.range(300).select("id", F.format_string("of Name%d and Name7 here", "id").alias("t")), "texts")
    for rows in (0, 10_000):
        config = replace(CONFIG, inline_entries=0, broadcast_rows=rows, gazetteer=known.unionByName(
            spark.createDataFrame([("Name7 here", "ORG")], known.schema)))
        named = add_entities(texts, "id", "t", "x", config)
        assert "Broadcast" not in plan(named)
        got = {r.id: r.x for r in named.collect()}
        assert len(got) == 300 and got[7] == "Name7, Name7 here" and got[12] == "Name12, Name7, Name7 here"


def test_customers_of_the_mentions_are_not_broadcast(spark, tmp_path):
    d = str(tmp_path)
    spark.sql("select 1L o_orderkey, 7L o_custkey, 10.5D o_totalprice").write.parquet(f"{d}/orders.parquet")
    spark.sql("select 7L c_custkey, 'Ann' c_name, 3 c_nationkey").write.parquet(f"{d}/customer.parquet")
    spark.sql("select 3 n_nationkey, 'PERU' n_name, 1 n_regionkey").write.parquet(f"{d}/nation.parquet")
    spark.sql("select 1 r_regionkey, 'AMERICA' r_name").write.parquet(f"{d}/region.parquet")
    rows = fx.fixture(spark, d, "fx_mentions")
    assert plan(rows).count("SortMergeJoin") == 1
    assert [tuple(r) for r in rows.collect()] == [("o1", "Ann, based in PERU, owes €1,200.50; AMERICA and PERU agree.")]


def test_starts_of_phrases_meet_their_texts_in_a_merge_join(spark):
    plans = {}

    def store(rows, name):
        plans[name] = plan(rows)
        return staged(rows, name)

    words = staged(spark.createDataFrame([("a", "x World Bank y".split()), ("b", ["World"])], "id string, words array<string>"), "words")
    table = spark.createDataFrame([("World Bank",), ("World",)], "phrase string")
    found, longest = phrase_runs(words, "id", table, replace(CONFIG, broadcast_rows=0), store)
    assert "SortMergeJoin" in plans["starts"] and "Broadcast" not in plans["starts"]
    assert longest == 2 and sorted(found.select("id", "pos", "n", "run").collect()) == [
        ("a", 1, 1, "World"), ("a", 1, 2, "World Bank"), ("b", 0, 1, "World")]


# ------------------------------------------------------------------ page texts
def test_page_texts_are_handed_on_in_pieces():
    seen = []

    def batches():
        for n in (2500, 0, 3):
            seen.append(n)
            yield pa.array([f"<p>{'long ' * 400_000 if i == 1200 else i}</p>" for i in range(n)], pa.string())

    texts = html._raw_texts(batches())
    first = next(texts)
    assert len(first) == 1000 and seen == [2500]  # handed on before the next batch is asked for
    sizes = [len(first), *(len(t) for t in texts)]
    assert sizes == [1000, 201, 1000, 299, 3] and seen == [2500, 0, 3]


def test_what_a_task_holds_of_page_texts_does_not_grow_with_the_rows_of_a_batch():
    def peak(rows):
        pages = pa.array([f"<p>{'long ' * 400}</p>"] * rows, pa.string())
        tracemalloc.start()
        try:
            texts = html._raw_texts(iter([pages]))
            assert sum(len(t) for t in texts) == rows
            return tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()

    peak(10)  # what is made once
    assert peak(6000) < 1.2 * peak(1500)


def test_page_texts_of_more_rows_than_a_batch(spark):
    pages = spark.range(0, 25_000, 1, 1).select("id", F.when(F.col("id") % 7 > 0, F.format_string("<p>t%d</p>", "id")).alias("html"))
    got = html.add_main_text(pages, "html", "x")
    wrong = got.where(F.col("x") != F.when(F.col("id") % 7 > 0, F.format_string("t%d", "id")).otherwise(""))
    assert got.count() == 25_000 and wrong.count() == 0


# ------------------------------------------------------------------ work per text
def test_a_text_is_cut_once_and_names_end_in_their_text(spark):
    df = spark.createDataFrame([("und of the", ), ("of",), ("of the of",), ("und xyz der",)], "t string")
    done = add_translation(df, "t", "t", "x", replace(CONFIG, chunk_chars=4))
    optimized = done._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("regexp_extract_all(") == 1
    assert [r.x for r in done.collect()] == ["and  of t he", "of", "of t he o f", "and  xyz  the"]
    config = replace(CONFIG, gazetteer={"of the": "ORG", "of": "GPE", "the of und": "ORG"})
    assert [r.x for r in add_entities(df, "t", "t", "x", config).collect()] == ["of, of the", "of", "of, of the", ""]
