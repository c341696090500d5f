"""Translation by phrases, against every cut of a text in plain Python."""

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from mediasignal import PipelineConfig
from mediasignal.operators.translate import add_translation

LEXICON = {"banco": "bank", "banco central": "central bank", "central": "central", "central de": "heart of",
           "de la deuda": "of the debt", "deuda externa": "foreign debt", "la": "the", "tasa de cambio": "exchange rate",
           "x y": "", "y z w": "YZW", "z": "Z", "w v": "WV", "": "E"}


def every_cover(words, lexicon):
    """All ways to cut ``words`` into entries and words of their own, as lists of (n, text) with n = 0 for the latter."""
    if not words:
        yield []
        return
    for n in range(len(words), 0, -1):
        entry = " ".join(words[:n])
        if entry in lexicon:
            for rest in every_cover(words[n:], lexicon):
                yield [(n, lexicon[entry]), *rest]
    for rest in every_cover(words[1:], lexicon):
        yield [(0, words[0]), *rest]


def by_hand(text, lexicon):
    def worth(cover):
        starts, at = [], 0
        for n, _ in cover:
            starts.append((at, n))
            at += n or 1
        taken = dict(starts)
        return sum(n for n, _ in cover), -sum(n > 0 for n, _ in cover), [taken.get(i, 0) for i in range(at)]

    words = text.split(" ")
    return " ".join(t for _, t in max(every_cover(words, lexicon), key=worth)) or text


def forms(spark, lexicon):
    table = spark.createDataFrame(list(lexicon.items()), "src string, dst string")
    inline = PipelineConfig(lexicon=lexicon)
    joined = replace(inline, lexicon=table, inline_entries=0)
    return {"inline": inline, "broadcast": joined, "salted": replace(joined, broadcast_rows=0, lookup_salts=3)}


@pytest.mark.parametrize("form", ["inline", "broadcast", "salted"])
def test_best_cover_of_every_text(spark, form):
    rng = random.Random(7)
    words = "banco central de la deuda externa tasa cambio x y z w v".split()
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 9))) for _ in range(150)]
    texts += ["", " ", "banco  central", "x y", "x y z w v", " de la deuda externa", "banco central de la deuda externa ", "qué"]
    rows = [(None if i == 3 else i, t) for i, t in enumerate(texts)] + [(1000, None), (1001, "banco central de"), (1002, "banco central de")]
    df = spark.createDataFrame(rows, "id int, t string").repartition(3)
    got = add_translation(df.where("id is not null"), "id", "t", "x", forms(spark, LEXICON)[form], chunked=False).collect()
    assert len(got) == len(rows) - 1
    for r in got:
        assert r.x == by_hand(r.t or "", LEXICON), (r.t, r.x)


def test_a_small_random_language(spark):
    rng = random.Random(11)
    for _ in range(2):
        lexicon = {" ".join(rng.choice("abc") for _ in range(rng.randint(1, 4))): f"<{k}>" for k in range(12)} | {"a b": "<ab>"}
        texts = [" ".join(rng.choice("abcd") for _ in range(rng.randint(1, 8))) for _ in range(60)]
        df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
        results = [{r.id: r.x for r in add_translation(df, "id", "t", "x", c, chunked=False).collect()}
                   for c in forms(spark, lexicon).values()]
        assert results[0] == {i: by_hand(t, lexicon) for i, t in enumerate(texts)}
        assert results[0] == results[1] == results[2]


def test_pieces_are_cut_first_and_long_texts_pass(spark):
    short = spark.createDataFrame([(1, "banco central banco central")], "id int, t string")
    long = spark.createDataFrame([(2, "banco central de la deuda " * 4_000)], "id int, t string")
    results = []
    for config in forms(spark, LEXICON).values():
        got = add_translation(short, "id", "t", "x", replace(config, chunk_chars=13)).first().x
        assert got == "central bank E bank centra l"  # the second piece opens with an empty word and lacks a letter
        results.append(tuple(add_translation(long, "id", "t", "x", config).select(F.md5("x"), F.length("x")).first()))
    assert len(set(results)) == 1 and results[0][1] > 80_000
