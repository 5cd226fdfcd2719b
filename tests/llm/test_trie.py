"""The prefix trie against a plain one."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict
from math import fmod

import pytest
from pyspark.sql import functions as F

from lakestar.llm import prefix_trie as module
from lakestar.llm.prefix_trie import ends_digest, prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def plain_trie(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(own)] for c, own in turns.items()}
    whole = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = tuple(turns.get(c - int(fmod(c, 100)), [])[:h] + own[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, own in whole.items():
        ends[own].append(c)
        for d in range(len(own) + 1):
            members[own[:d]].append(c)
    parents = [own[:-1] for own in members if own]
    leaves, saved = defaultdict(int), defaultdict(int)
    for own, convs in members.items():
        for d in range(len(own) + 1):
            leaves[own[:d]] += own not in parents
            saved[own[:d]] += (len(convs) - 1) * (len(own[-1][1]) if own else 0)
    return sorted(
        (
            (min(convs), len(own), min(members[own[:-1]]) if own else -1, len(convs), parents.count(own), leaves[own], saved[own])
            + (hashlib.sha256(",".join(map(str, sorted(ends[own]))).encode()).hexdigest(),)
            for own, convs in members.items()
        )
    )


def found(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    df = df.withColumn("key", F.lit("x")).withColumn("path", F.lit(1)).withColumn("depth", F.lit(2.5))
    got = [tuple(r) for r in prefix_trie(df).collect()]
    return sorted(tuple(-1 if i == 2 and v is None else v for i, v in enumerate(r)) for r in got)


def conversation(conv, texts):
    return [(conv, i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed", range(3))
def test_few_texts_make_shared_prefixes(spark, seed):
    rng = random.Random(seed)
    rows = []
    for conv in rng.sample(range(-150, 800), 60):
        rows += conversation(conv, [rng.choice("aabé\U0001f600") * rng.randint(1, 2) for _ in range(rng.randint(1, 9))])
    assert found(spark, rows) == plain_trie(rows)


def test_long_conversations_part_late(spark):
    rng = random.Random(4)
    base = [str(rng.random()) for _ in range(60)]
    rows = []
    for conv, cut in ((101, 60), (102, 60), (103, 41), (104, 40), (205, 23), (206, 7), (307, 1)):
        rows += conversation(conv, base[:cut] + [f"own {conv}"] * (conv % 3))
    rows += conversation(900, [str(rng.random()) for _ in range(150)])
    assert found(spark, rows) == plain_trie(rows)


def test_odd_rows(spark):
    rows = [
        (1, None, None, None),
        (1, 0, "", ""),
        (1, 0, "", ""),  # a repeated row
        (2, 5, "ab", "c"),
        (3, 5, "a", "bc"),  # not the same turn
        (None, 0, "user", "nobody's"),
        (100, 1, "user", "x" * 100_000),
        (164, 1, "user", None),
    ]
    assert found(spark, rows) == plain_trie(rows)


def test_no_turns_and_no_rows(spark):
    # 7's first turns would come from conversation 0, which is not there.
    alone = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 > 0)
    rows = [(alone, 0, "user", "gone")]
    assert found(spark, rows) == plain_trie(rows) == [(alone, 0, -1, 1, 0, 1, 0, hashlib.sha256(str(alone).encode()).hexdigest())]
    assert found(spark, []) == [] == found(spark, [(None, 0, "user", "a")])


def test_one_conversation_of_most(spark):
    rows = [r for c in range(300) for r in conversation(c, ["hello", "same"] if c % 3 else ["hello", "same", "twice", str(c)])]
    assert found(spark, rows) == plain_trie(rows)


def test_ids_of_an_end_are_in_numeric_order_across_ranges(spark, monkeypatch):
    monkeypatch.setattr(module, "IDS", 4)
    ids = [-9, -10, -1, 3, 4, 5, 8, 10, 9, 100, 11]
    ends = spark.createDataFrame([(i, b"a") for i in ids] + [(7, b"b")], "conv_id bigint, key binary").repartition(5)
    expected = {b"a": ",".join(map(str, sorted(ids))), b"b": "7"}
    got = {bytes(r.key): r.ends_sha256 for r in ends_digest(ends).collect()}
    assert got == {k: hashlib.sha256(v.encode()).hexdigest() for k, v in expected.items()}


def test_peeling_skips_what_nobody_shares(spark, monkeypatch):
    calls = []
    for name in ("strip", "group"):
        old = getattr(module._Peeling, name)
        monkeypatch.setattr(module._Peeling, name, lambda self, *a, f=old, n=name: (calls.append(n), f(self, *a))[1])
    rows = conversation(100, ["start", "x"]) + conversation(200, ["start", *map(str, range(200))])
    assert found(spark, rows) == plain_trie(rows)
    assert calls.count("group") <= 4 and calls.count("strip") <= 10
