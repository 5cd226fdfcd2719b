"""License scans: wording, differences, several licences, odd input."""

from __future__ import annotations

import random
import string

import pytest

from lakestar.llm.licenses import Scanner, align, scan_licenses
from lakestar.llm.license_templates import TEMPLATES

SCANNER = Scanner()
PROSE = " ".join(random.Random(1).choices("the of reader erst onan tion ingly thble and shore".split(), k=400))


def names(text):
    return [f[2] for f in SCANNER.scan(text)[1]]


@pytest.mark.parametrize(("name", "text"), TEMPLATES)
def test_every_template_is_found_in_prose(name, text):
    found = SCANNER.scan(f"{PROSE}\n{text}. {PROSE}")[1]
    assert name in [f[2] for f in found]
    exact = [f for f in found if f[2] == name and f[3] == 0]
    assert exact and text.startswith(f"{PROSE}\n{text}. {PROSE}"[exact[0][0] : exact[0][1]])


def test_wording_decides():
    assert names("Licensed under CC BY-NC 4.0.") == ["CC-BY-NC-4.0"]
    assert names("Licensed under CC BY 4.0.") == ["CC-BY-4.0"]
    assert names("This work is licensed under the GNU General Public License, version 3.") == ["GPL-3.0"]
    assert names("This work is licensed under the GNU General Public License, version 2.") == ["GPL-2.0"]
    assert names("A driving licence is no permission to speed, and all rights of way are reserved.") == []


def test_small_differences_are_counted():
    text = TEMPLATES[4][1].replace("free of charge", "free of any charge").replace("merge, ", "")
    found = SCANNER.scan(f"Copyright 2020. {text}")[1]
    assert [(f[2], f[3]) for f in found] == [("MIT", 2)]


def test_several_licences_and_long_text():
    text = f"{PROSE * 30}\nReleased under the MIT License.\n{PROSE}\nLicensed under CC BY-NC 4.0. All rights reserved."
    assert names(text) == ["MIT", "CC-BY-NC-4.0", "Proprietary"]
    start, end = SCANNER.scan(text)[1][0][:2]
    assert text[start:end] == "Released under the MIT License"
    assert names("license " * 2000 + "Released under the MIT License") == ["MIT"]


@pytest.mark.parametrize("cue", ["permission", "warranty", "copyright", "licence"])
def test_every_template_is_found_in_cue_dense_blocks(cue):
    rng = random.Random(cue)
    other = ["".join(rng.choices(string.ascii_lowercase, k=rng.randint(4, 9))) for _ in range(300)]
    for name, text in TEMPLATES:
        for at in (0, 200, 430):
            words = [cue if i % 60 == 0 else rng.choice(other) for i in range(600)]
            words[at:at] = [f"{text}."]
            assert name in names(" ".join(words)), (name, at)


@pytest.mark.parametrize("gap", ["\n", "  ", "\u00a0", "\r\n * ", "_"])
def test_every_template_is_found_wrapped_at_every_gap(gap):
    for name, text in TEMPLATES:
        words = text.split(" ")
        for i in range(1, len(words)):
            wrapped = " ".join(words[:i]) + gap + " ".join(words[i:])
            assert name in names(f"of the\n{wrapped}. and"), wrapped
        assert name in names(gap.join(words)), gap


def test_align_against_plain_dynamic_programming():
    rng = random.Random(3)
    for _ in range(200):
        wanted = [rng.choice("abc") for _ in range(rng.randint(1, 6))]
        words = [rng.choice("abcd") for _ in range(rng.randint(0, 9))]

        def distance(a, b):
            row = list(range(len(b) + 1))
            for i, x in enumerate(a, 1):
                last, row[0] = row[0], i
                for j, y in enumerate(b, 1):
                    last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
            return row[-1]

        n = len(words)
        best = min(distance(wanted, words[i:j]) for i in range(n + 1) for j in range(i, n + 1))
        differ, start, end = align(wanted, words)
        assert differ == best == distance(wanted, words[start:end])


def test_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, 1), (2, "", 1), (None, "All rights reserved", 1), (4, "All rights reserved", 2), (4, "All rights reserved", 2)],
        "doc_id bigint, text string, n_found int",
    )
    got = sorted((tuple(r) for r in scan_licenses(docs).collect()), key=str)
    hit = (1, 1, "Proprietary", "Proprietary:0:19:0")
    assert got == sorted([(1, 0, 0, "", ""), (2, 0, 0, "", ""), (None, *hit), (4, *hit), (4, *hit)], key=str)
    assert scan_licenses(docs.filter("false")).count() == 0
