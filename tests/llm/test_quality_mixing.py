import zlib

import pytest
from pyspark.sql import functions as F

from mediasignal.llm import mixing, quality


def labelled(make_docs, spark):
    good = [(i, f"The house of number {i} is near a small river. Many people walk there and talk of {i * 7} things.") for i in range(200)]
    bad = [(i, f"BUY!! NOW!! {i}### $$$ " * 5) for i in range(200, 300)]
    labels = spark.createDataFrame([(i, int(i < 200), 0) for i in range(300)], "doc_id long, quality int, toxic int")
    return make_docs(*good, *bad), labels


def test_held_out_accuracy(make_docs, spark):
    docs, labels = labelled(make_docs, spark)
    model = quality.fit(docs, labels)
    rows = quality.quality_scores(docs, model).collect()
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in range(300) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert all(r.predicted == int(r.doc_id < 200) and 0 <= r.score <= 1 for r in held)
    assert quality.keep_good(docs, model).count() == sum(r.predicted for r in rows)


def test_held_out_labels_are_not_read(make_docs, spark):
    docs, labels = labelled(make_docs, spark)
    swapped = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert quality.fit(docs, labels) == quality.fit(docs.repartition(7), swapped.repartition(3))


def test_odd_quality_inputs(make_docs, odd_docs, spark):
    docs, labels = labelled(make_docs, spark)
    for model in (quality.fit(docs, labels), quality.fit(docs, labels.limit(0)), quality.fit(docs.limit(0), labels)):
        scored = quality.quality_scores(odd_docs, model)
        assert scored.count() == odd_docs.count() and scored.where("score is null or not score between 0 and 1").isEmpty()
        assert quality.quality_scores(odd_docs.limit(0), model).isEmpty()
        assert quality.keep_good(odd_docs, model).columns == odd_docs.columns
    assert quality.fit(docs, labels.limit(0)).score([[0.0]] * 2).tolist() == [0.5, 0.5]
    both = labels.unionByName(labels.limit(300).withColumn("quality", 1 - F.col("quality")))
    assert not any(quality.fit(docs, both).weights)


def plain_budgets(tokens, mix):
    """Budgets by repeated rounds: tokens by (domain, lang, source)."""

    def divide(children, given):
        left, out = dict(children), {}
        while left:
            total = sum(w for w, _ in left.values())
            full = [k for k, (w, room) in left.items() if room * total <= w * given]
            if not full:
                return out | {k: w * given // total for k, (w, _) in left.items()}
            for k in full:
                out[k] = left.pop(k)[1]
                given -= out[k]
        return out

    def level(path, given):
        depth = len(path)
        if depth == 3:
            return {path: given}
        weights = [mix.domains, mix.langs, mix.sources][depth]
        children = {}
        for leaf, n in tokens.items():
            if leaf[:depth] == path:
                w, room = children.get(leaf[depth], (weights.get(leaf[depth], 1), 0))
                children[leaf[depth]] = (w, room + n * mix.epochs)
        found = {}
        for name, budget in divide(children, given).items():
            found |= level((*path, name), budget)
        return found

    return level((), sum(tokens.values()) * mix.share // 1000)


@pytest.mark.parametrize("share, epochs", [(800, 4), (300, 1), (1000, 1), (3500, 4), (5000, 4)])
def test_budgets(spark, share, epochs):
    tokens = {(d, la, s): 10 + 37 * i % 900 for i, (d, la, s) in enumerate(
        (d, la, s) for d in ("web", "reference", "other") for la in ("en", "fr", "xx") for s in "abcd")}
    mix = mixing.Mix(share=share, epochs=epochs, sources={"a": 5})
    leaves = spark.createDataFrame([(*k, n, 1) for k, n in tokens.items()], "domain string, lang string, source string, tokens long, rows long")
    got = {(r.domain, r.lang, r.source): r.budget for r in mixing.leaf_budgets(leaves, mix).collect()}
    want = plain_budgets(tokens, mix)
    assert set(got) == set(want)
    assert all(abs(got[k] - want[k]) <= 3 for k in want)  # whole tokens are rounded in another order
    assert sum(got.values()) <= sum(tokens.values()) * share // 1000


@pytest.mark.parametrize("range_rows", [1, 7, 10_000])
def test_fronts_don_t_depend_on_ranges(make_docs, range_rows):
    rows = [(i, "word " * (i % 13), ["en", "fr"][i % 2], f"s{i % 3 if i % 2 else 0}") for i in range(400)]
    docs, mix = make_docs(*rows), mixing.Mix(share=700, epochs=2)
    got = sorted(map(tuple, mixing.mixture(docs, mix, range_rows).collect()))
    assert got == sorted(map(tuple, mixing.mixture(docs.repartition(5), mix, 50).collect()))
    assert sum(r[4] * r[5] for r in got) <= sum(r[4] for r in got) * 7 // 10
    assert mixing.take_mixed(docs, mix, range_rows).count() == sum(r[5] for r in got)


def test_odd_mixing_inputs(odd_docs):
    mix = mixing.Mix()
    assert mixing.mixture(odd_docs, mix).count() == odd_docs.count()
    assert mixing.take_mixed(odd_docs, mix).columns == odd_docs.columns
    for empty in (odd_docs.limit(0), odd_docs.where("doc_id < 4")):
        assert mixing.take_mixed(empty, mix).count() == 0
    none = odd_docs.withColumns({"lang": F.lit(None).cast("string"), "source": F.lit(None).cast("string")})
    assert mixing.mixture(none, mix).where("lang <> '' or source <> ''").isEmpty()


def test_repeated_rows_are_learned_once(spark, make_docs):
    rows = [(i, "plain words of a text " * (i % 5 + 1) if i % 2 else "|||! $$ 12 " * (i % 7 + 1)) for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    once = quality.fit(make_docs(*rows), labels)
    assert any(once.weights) and quality.fit(make_docs(*rows, *rows[:1] * 500, *rows[1:2] * 7), labels) == once
