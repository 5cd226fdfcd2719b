"""Fingerprints against plain set arithmetic on paragraphs."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from lakestar.llm import fingerprints as module
from lakestar.llm.fingerprints import CELLS, PARAGRAPH, _subtract, differing, digests, fingerprint, peel, recovered, sketch, with_next

_PARAGRAPH = re.compile(PARAGRAPH.replace("\\\\", "\\"))


def likeness(a, b):
    a, b = set(_PARAGRAPH.findall(a)), set(_PARAGRAPH.findall(b))
    return len(a & b) / len(a | b) if a | b else 1.0


def plain(docs):
    ordered = sorted(((-(1 << 63) if d is None else d, t or ""), d) for d, t in docs)
    out = []
    for i, ((_, text), doc) in enumerate(ordered):
        nxt = ordered[i - 1][0][1]
        k = len(text) // 3
        edited = text[: len(text) - k] + nxt[:k]
        out.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), likeness(text, edited), likeness(text, nxt)))
    return sorted(out, key=str)


def made(rng, n):
    words = "the of thble onan ereaed Été 中文 😀 tion".split()
    return "".join(rng.choice(words) + rng.choice([" ", " ", " ", ". ", "\n", "! "]) for _ in range(n))


def docs(seed, n=60):
    rng = random.Random(seed)
    texts = [made(rng, rng.choice([0, 1, 3, 30, 200])) for _ in range(n)]
    texts += [texts[3], texts[3], None, "", "x" * 2500, made(rng, 9000)]
    ids = rng.sample(range(-500, 500), len(texts) - 1)
    return list(zip([*ids, None], texts, strict=True))


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "f", 0) for d, t in rows], "doc_id bigint, text string, fingerprint string, range int")


def run(df):
    out = [(r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in fingerprint(df).collect()]
    return sorted(out, key=str)


def same(got, expected):
    assert [g[:3] for g in got] == [e[:3] for e in expected]
    for g, e in zip(got, expected, strict=True):
        assert g[3:] == pytest.approx(e[3:])


@pytest.mark.parametrize("partitions", ["1", "4", "40"])
def test_against_sets(spark, conf, partitions):
    conf(spark__sql__shuffle__partitions=partitions)
    rows = docs(int(partitions))
    same(run(frame(spark, rows)), plain(rows))


def test_retries_larger_until_everything_is_recovered(spark, monkeypatch):
    monkeypatch.setattr(module, "SIZES", (2,))
    monkeypatch.setattr(module, "PER_SLICE", 64)
    rows = docs(9, 25)
    same(run(frame(spark, rows)), plain(rows))


def test_equal_texts_have_equal_fingerprints(spark):
    rows = [(i, "One. Two. Three.\nFour") for i in range(5)] + [(9, "One. Two. Three.\nFive")]
    got = fingerprint(frame(spark, rows)).collect()
    assert len({r.fingerprint for r in got}) == 2
    for r in got:
        assert (r.fingerprint == r.edited_fingerprint) == (r.near_edited == 1.0)


def test_peeling_recovers_few_differences_at_the_smallest_size(spark):
    df = spark.createDataFrame([("a. b. c. d.", "a. b. c. e."), ("a.", "a."), ("", "a.")], "x string, y string")
    df = df.select(F.expr(digests("x")).alias("x"), F.expr(digests("y")).alias("y"))
    small = peel(_subtract(sketch("x", CELLS), sketch("y", CELLS)), CELLS)
    got = df.selectExpr(f"{small} AS small", f"{differing('x', 'y')} AS whole").collect()
    assert [tuple(r) for r in got] == [(2, 2), (0, 0), (1, 1)]


def test_recovered_digests_are_those_that_differ(spark):
    rng = random.Random(5)
    pairs = [(made(rng, n), made(rng, n)) for n in (1, 30, 200)] + [("a. b. c. d.", "a. b. c. e."), ("", "")]
    df = spark.createDataFrame(pairs, "x string, y string")
    df = df.select(F.expr(digests("x")).alias("x"), F.expr(digests("y")).alias("y"))
    for r in df.select("x", "y", F.expr(recovered("x", "y")).alias("got")).collect():
        expected = {(1, k) for k in set(r.x) - set(r.y)} | {(-1, k) for k in set(r.y) - set(r.x)}
        assert len(r.got) == len(expected) and {tuple(g) for g in r.got} == expected


def test_fingerprints_can_be_subtracted_and_peeled(spark):
    texts = ["One. Two. Three. Four.", "One. Two. Tree. Four.", "", "a. " + "b" * 90 + ". c."]
    rows = fingerprint(frame(spark, list(enumerate(texts)))).select("doc_id", "fingerprint")
    got = rows.crossJoin(rows.toDF("other", "of")).withColumn("apart", F.expr(module.apart("fingerprint", "of"))).collect()
    hashes = {t: spark.range(1).select(F.xxhash64(F.lit(t))).first()[0] for text in texts for t in _PARAGRAPH.findall(text)}
    for r in got:
        a, b = (set(_PARAGRAPH.findall(texts[d])) for d in (r.doc_id, r.other))
        expected = [(1, hashes[t]) for t in a - b] + [(-1, hashes[t]) for t in b - a]
        assert sorted((x.n, x.k) for x in r.apart) == sorted(expected)


def test_few_rows_and_none(spark):
    same(run(frame(spark, [(4, "Only. One.")])), plain([(4, "Only. One.")]))
    same(run(frame(spark, [(4, "Same."), (4, "Same.")])), plain([(4, "Same."), (4, "Same.")]))
    assert run(frame(spark, [])) == []


def test_only_sql_functions(spark):
    plan = with_next(frame(spark, docs(1)))._jdf.queryExecution().toString()
    plan += fingerprint(frame(spark, docs(1)))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
