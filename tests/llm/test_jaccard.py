"""The Jaccard join against all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakestar.llm import jaccard_join as module
from lakestar.llm.components import components
from lakestar.llm.jaccard_join import _leading, jaccard_join, keep_one_of_each
from lakestar.llm.shingles import shingle_set


def plain_sets(text):
    words = [w for w in (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split() if w]
    if not words:
        return frozenset()
    k = min(5, len(words))
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def plain_components(docs):
    """[(id, text)] -> sorted [(id, set size, component)] by comparing all pairs."""
    sets = [plain_sets(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                root[max(find(i), find(j))] = min(find(i), find(j))
    names = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            names[find(i)] = min(names.get(find(i), d), d)
    return [(d, len(s), names.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(docs, sets, strict=True))]


def words(rng, n, vocabulary=3000):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def planted(seed):
    """Copies, edited copies at all distances, chains, shared passages, short and odd texts."""
    rng = random.Random(seed)
    texts = []
    passage = words(rng, 60)
    for _ in range(12):
        base = words(rng, rng.choice([6, 20, 80, 200]))
        texts.append(base)
        for _ in range(rng.randrange(6)):
            copy = list(base)
            for _ in range(rng.randrange(1, 8)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(99999)}"
            texts.append(copy)
        chain = list(base)
        for _ in range(4):
            chain = chain[len(chain) // 12 :] + words(rng, len(chain) // 12)
            texts.append(chain)
    texts += [words(rng, rng.randrange(5, 60)) + passage + words(rng, rng.randrange(3, 60)) for _ in range(25)]
    texts += [passage + words(rng, 2 + k) for k in range(12)]
    out = [" ".join(t) for t in texts]
    out += [out[0], out[0].upper(), "  \n".join(out[1].split()), None, "", "   ", "a b", "A  b", "a b c", "é É", "a\x1cb c"]
    order = list(range(len(out)))
    rng.shuffle(order)
    return list(zip(order, out, strict=True))


def frame(spark, docs):
    return spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id bigint, text string, n string")


def run(spark, docs):
    return sorted((tuple(r) for r in jaccard_join(frame(spark, docs)).collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_all_pairs(spark, seed, monkeypatch):
    monkeypatch.setattr(module, "BLOCK", 4)
    monkeypatch.setattr(module, "STAR", 3)
    docs = planted(seed)
    assert run(spark, docs) == sorted(plain_components(docs), key=str)


def test_links_that_share_no_pivot_are_found(spark, monkeypatch):
    """With a single hash order, most links are left to the boundary regions."""
    monkeypatch.setattr(module, "_FACTORS", module._FACTORS[:1])
    docs = planted(3)
    assert run(spark, docs) == sorted(plain_components(docs), key=str)


def test_leading_parts_of_near_sets_meet():
    rng = np.random.default_rng(0)
    frequent = np.sort(rng.integers(1 << 60, size=50, dtype=np.uint64))
    counts = rng.integers(3, 9, size=50)
    for _ in range(300):
        n = int(rng.integers(1, 60))
        a = np.unique(np.concatenate([rng.integers(1 << 60, size=n, dtype=np.uint64), rng.choice(frequent, 5)]))
        b = np.unique(np.concatenate([a[rng.random(len(a)) > 0.2], rng.integers(1 << 60, size=n // 6, dtype=np.uint64)]))
        common = len(np.intersect1d(a, b))
        if 100 * common >= 75 * (len(a) + len(b) - common) and len(b):
            assert len(np.intersect1d(_leading(a, frequent, counts), _leading(b, frequent, counts)))


def test_rows_without_id_repeated_rows_and_no_rows(spark):
    docs = [(5, "a b c d e f"), (5, "a b c d e f"), (None, "a b c d e f"), (None, None), (7, None), (None, "q r s")]
    assert run(spark, docs) == sorted(
        [(5, 2, 5), (5, 2, 5), (None, 2, 5), (None, 0, None), (7, 0, 7), (None, 1, None)], key=str
    )
    assert run(spark, []) == []


def test_one_of_each_stays(spark):
    docs = planted(4)
    kept = keep_one_of_each(frame(spark, docs))
    assert kept.columns == ["doc_id", "text", "n"]
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in plain_components(docs)})
    odd = [(5, "a b c d e f"), (5, "a b c d e f"), (6, "A b c d e f"), (None, "a b c d e f"), (7, None), (7, None)]
    got = keep_one_of_each(frame(spark, odd)).collect()
    assert sorted(((str(r.doc_id), r.text) for r in got), key=str) == [("5", "a b c d e f"), ("7", None), ("None", "a b c d e f")]


def test_distinct_texts_under_one_id_stay_and_go_on_their_own(spark):
    one, two, three = "a b c d e f", "q r s t u v w", "k l m n o p"
    docs = [(1, one), (1, two), (2, one), (2, three), (2, three), (3, "Q r s t u v w"), (1, None), (4, "solo")]
    got = keep_one_of_each(frame(spark, docs).withColumnRenamed("n", "class"))
    assert got.columns == ["doc_id", "text", "class"]
    expected = [(1, one), (1, two), (1, None), (2, three), (4, "solo")]
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(expected, key=str)


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (1, 0)]
    got = components(spark.createDataFrame(edges, "a bigint, b bigint"))
    expected = [(i, 0) for i in range(1, 41)] + [(k, 100) for k in range(101, 140)]
    assert sorted((r.node, r.root) for r in got.collect()) == expected
    assert components(spark.range(0).select(F.col("id").alias("a"), F.col("id").alias("b"))).count() == 0


def test_sets():
    assert len(shingle_set("a b c d e f")) == 2
    assert len(shingle_set("a a a a a a a a")) == 1
    assert len(shingle_set("a b")) == 1
    assert shingle_set("A b c") == shingle_set("a\tb\nc")
    assert len(shingle_set("x " * 50_000)) == 1
