import hashlib
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from mediasignal.llm import components, exact_dedup, simhash


def plain_groups(rows):
    digest = lambda t: hashlib.sha256(re.sub("[\x20\x09-\x0D]+", " ", t or "").encode()).hexdigest()
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(digest(text), []).append(doc_id)
    out = []
    for doc_id, text in rows:
        ids = groups[digest(text)]
        keep = min((i for i in ids if i is not None), default=None)
        out.append((doc_id, keep, len(ids), doc_id == keep, digest(text)))
    return sorted(map(str, out))


@pytest.mark.parametrize("support", [0.5, 0.05, 0.0005])
def test_exact_groups(make_docs, odd_docs, support):
    rows = [(i, "hot text" if i % 3 == 0 else f"text {i % 40}") for i in range(300)]
    for docs in (make_docs(*rows), odd_docs, odd_docs.limit(0)):
        got = exact_dedup.exact_groups(docs, support)
        assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
        assert sorted(map(str, map(tuple, got.collect()))) == plain_groups(docs.select("doc_id", "text").collect())


@pytest.mark.parametrize("support", [0.5, 0.05])
def test_drop_copies(make_docs, odd_docs, support):
    rows = [(i, "hot text" if i % 3 == 0 else f"text {i % 40}") for i in range(300)]
    kept = exact_dedup.drop_copies(make_docs(*rows), support)
    assert sorted(r.doc_id for r in kept.collect()) == sorted({t: i for i, t in reversed(rows)}.values())
    odd = exact_dedup.drop_copies(odd_docs, support)
    assert odd.columns == odd_docs.columns
    got = sorted(((r.doc_id, r.text) for r in odd.collect()), key=str)
    assert [i for i, _ in got] == [1, 3, 4, 5, 7, 8, 8]
    assert exact_dedup.drop_copies(odd_docs.limit(0)).count() == 0


def test_heavy_winners_are_bounded(spark):
    digests = spark.range(2000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(
        F.col("id").cast("string")).alias("digest"))
    heavy = exact_dedup.heavy_digests(digests, 0.01).collect()
    assert [(r.digest, r.keep_id, r.group_size) for r in heavy] == [("hot", 0, 667)]


def test_no_python_in_exact_dedup(make_docs, capsys):
    exact_dedup.exact_groups(make_docs((1, "a"))).explain()
    assert "Python" not in capsys.readouterr().out


def plain_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0D]+", text)
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) if hashes else 0


def plain_components(fps):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def test_near_copies(make_docs, odd_docs):
    for docs in (odd_docs, make_docs(*[(i, f"A b C {i % 7} D") for i in range(30)]), odd_docs.limit(0)):
        rows = docs.select("doc_id", "text").collect()
        fps = [plain_fingerprint(t) for _, t in rows]
        roots = plain_components(fps)
        best = {r: min((rows[i][0] for i, x in enumerate(roots) if x == r and rows[i][0] is not None), default=None) for r in roots}
        want = sorted(str((d, f"{f:016x}", best[r])) for (d, _), f, r in zip(rows, fps, roots))
        assert sorted(str(tuple(r)) for r in simhash.near_copies(docs).collect()) == want
        kept = simhash.drop_near_copies(docs)
        assert kept.columns == docs.columns
        assert kept.count() == len(set(roots))


def test_fingerprint_in_blocks(monkeypatch):
    text = " ".join(f"w{i * 7919 % 1013}" for i in range(5000))
    want = plain_fingerprint(text)
    monkeypatch.setattr(simhash, "_HASHES", 100)
    monkeypatch.setattr(simhash, "word_blocks", lambda b: __import__("mediasignal.llm.common", fromlist=["x"]).word_blocks(b, 50))
    assert simhash.fingerprint(text.encode()) % 2**64 == want


@pytest.mark.parametrize("cell_rows", [1, 3, 128])
def test_links_keep_components(spark, cell_rows):
    random = np.random.default_rng(1)
    fps = set()
    for _ in range(8):  # balls of fingerprints around centres, chains, and lone ones
        at = int(random.integers(2**63)) * 2
        for _ in range(40):
            fps.add(at)
            at ^= (1 << int(random.integers(64))) | (1 << int(random.integers(64)))
            if random.random() < 0.1:
                at ^= 7 << int(random.integers(60))
    fps = sorted(fps)
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    links = simhash.fingerprint_links(spark.createDataFrame([(f,) for f in signed], "fp long"), cell_rows)
    assert all(((u ^ v) % 2**64).bit_count() <= 2 for u, v in links.collect())
    got = {r.node: r.root for r in components.connected_components(links).collect()}
    roots = plain_components(fps)
    least = {r: min(s for s, x in zip(signed, roots) if x == r) for r in roots}
    assert [got.get(s, s) for s in signed] == [least[r] for r in roots]


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1200)] + [(5000, 5000)]
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(201)} | {i: 1000 for i in range(1000, 1200)}
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0
