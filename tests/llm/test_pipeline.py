"""The pipeline, stage by stage, against plain versions on a small table."""

from __future__ import annotations

from pathlib import Path

import pytest
from test_jaccard import plain_components
from test_tokens import check_packing

import __spark_entry__
import corpus_pipeline
from lakestar.llm.common import labels, staged
from lakestar.llm.decontaminate import words_of
from lakestar.llm.quality import describe, train_quality
from lakestar.llm.secrets import Scanner

SMALL = "/root/testdata/sf0.001"


def test_contract():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier",
        "n-gram Jaccard join",
        "benchmark decontamination",
        "secret scans",
        "best-fit packing",
    ]
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run


def test_against_plain_versions(spark):
    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    before = {r.doc_id: r for r in table.collect()}
    stages = [table]
    for _, stage in corpus_pipeline.STAGES:
        stages.append(staged(stage(spark, stages[-1], SMALL), "test-stage"))
    good, single, clean, redacted, packed = ({r.doc_id: r for r in s.collect()} for s in stages[1:])

    model = train_quality(table, labels(spark, SMALL))
    scores = model.score([describe(r.text, r.n_chars) for r in before.values()], [(r.lang, r.source) for r in before.values()])
    assert set(good) == {d for d, s in zip(before, scores, strict=True) if s >= 0.5}
    assert 0 < len(good) < len(before)
    bad = [r.doc_id for r in labels(spark, SMALL).collect() if r.quality == 0]
    assert len([d for d in bad if d in good]) <= 0.05 * len(bad)

    groups = plain_components([(d, r.text) for d, r in good.items()])
    assert set(single) == {c for _, _, c in groups}

    windows = set()
    for item in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect():
        w = words_of(item.text)
        windows |= {tuple(w[i : i + 10]) for i in range(len(w) - 9)}

    def hit(text):
        w = words_of(text)
        return any(tuple(w[i : i + 10]) in windows for i in range(len(w) - 9))

    assert set(clean) == {d for d, r in single.items() if not hit(r.text)}
    assert set(clean) < set(single)

    assert set(redacted) == set(clean)
    scanner = Scanner()
    changed = {d for d in clean if redacted[d].text != clean[d].text}
    assert changed == {d for d, r in clean.items() if scanner.scan([r.text])[0]}
    for d, r in redacted.items():
        assert not scanner.scan([r.text])[0]
        assert r.asDict() | {"text": ""} == before[d].asDict() | {"text": ""}

    assert set(packed) == set(redacted)
    check_packing(stages[-1].collect(), [r.text for r in redacted.values()], list(redacted))


def test_odd_rows_and_columns(spark):
    rows = [
        (1, "a b c d e f.", "en", "s", 12, 1, [1]),
        (1, "a b c d e f.", "en", "s", 12, 1, [1]),
        (2, None, None, None, None, None, None),
        (None, "token: abcdefgh", None, None, None, None, None),
        (3, "", "en", "s", 0, 2, []),
        (4, "long " * 20_000, "en", "s", 100_000, 2, []),
    ]
    docs = spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words int, hit array<int>"
    )
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, SMALL)
        assert got.schema.names == docs.schema.names, name
        got.collect()
        assert stage(spark, docs.filter("false"), SMALL).collect() == [], name
    assert corpus_pipeline.packing(spark, docs, SMALL).count() > len(rows)
    assert corpus_pipeline.packing(spark, docs.filter("false"), SMALL).count() == 0
    kept = corpus_pipeline.secrets(spark, docs, SMALL).filter("doc_id IS NULL").first()
    assert kept.text == "[SECRET]"


def test_stages_leave_one_folder_behind(spark):
    shared = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:")) / "lakestar"
    before = set(shared.iterdir()) if shared.exists() else set()
    result = corpus_pipeline.run(spark, SMALL)
    left = {p.name.rpartition("-")[0] for p in set(shared.iterdir()) - before}
    assert left == {"stage-4"} and result.count() > 0


ON_OTHER_TABLES = ("op11_vector_codes", "op12_collision_search", "op13_prefix_trie")


@pytest.mark.parametrize("name", sorted(n for n in __spark_entry__.queries() if n.startswith("op") and n not in ON_OTHER_TABLES))
def test_registered_queries_give_a_row_or_more_per_document(spark, name):
    got = __spark_entry__.queries()[name](spark, SMALL)
    ids = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id")
    assert "doc_id" in got.columns
    assert got.select("doc_id").distinct().count() == ids.count()
