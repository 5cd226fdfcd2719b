"""Token files and packing against the tokenizer used plainly."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lakestar.llm.packing import pack, plan_packing
from lakestar.llm.pfor import BLOCK, Segment, encode_segment
from lakestar.llm.token_files import read_token_files, write_token_files
from lakestar.llm.tokens import Encoder, merges_by_rank

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id bigint, text string, lang string, length int, part int"
TEXTS = [
    None,
    "",
    "a",
    "  two  spaces \n\n\n and\tlines\r\n    x \n\n y \x1c z!\x1c ! ",
    "It's   <|endoftext|> here     café é ́x İ ǅ 中文",
    "word " * 5000,
    "x" * 3000,
    "\n\n\n",
    "x <|endoftext|> y<|startoftext|>z <|ENDOFTEXT|> <|endoftext |>",
]


def docs(spark, texts=TEXTS, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", 7, 7) for i, t in zip(ids, texts, strict=True)], DOCS)


@cache
def loaded(path):
    return Tokenizer.from_file(path)


def plain(path, text):
    tokenizer = loaded(path)
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_pieces_give_the_ids_of_the_whole_text(path):
    for folds in (False, path == WORD):
        encoder = Encoder(path, folds)
        for _ in range(2):
            assert [list(x) for x in encoder.encode(TEXTS)] == [plain(path, t) for t in TEXTS]
            encoder.older, encoder.known = encoder.known, {}
        assert (encoder.quick is not None) == (path == BYTE)
        encoder.quick = None
        assert [list(x) for x in encoder.encode(TEXTS)] == [plain(path, t) for t in TEXTS]


def test_an_added_token_in_capitals_alone_is_plain_text():
    encoder = Encoder(WORD, True)
    for text in ("<|ENDOFTEXT|>", "a <|EndOfText|>. b"):
        assert list(encoder.encode([text])[0]) == plain(WORD, text)


class Counting:
    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, 0

    def encode_batch_fast(self, texts, **options):
        self.texts += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **options)


def test_words_are_given_to_the_library_many_at_once():
    words = [f"{a}{b}é{c}" for a in "xyzß" for b in "abÀn" for c in ("", "q", "Ü", "ŉ", "ſ")]
    texts = [" ".join(w + m for w in words) for m in ("", ".", "&&&", "'s", "'", "İ", "1", "\u0301", "$#")]
    encoder = Encoder(WORD, True)
    encoder.tokenizer = Counting(encoder.tokenizer)
    expected = [plain(WORD, t) for t in texts]
    assert [list(x) for x in encoder.encode(texts[:3])] == expected[:3]
    assert encoder.tokenizer.texts <= len(words) // 20 + 4  # each word in one line, and the marks
    assert [list(x) for x in encoder.encode(texts)] == expected
    encoder.known, encoder.ends = {}, ~encoder.ends  # ends that do not fit
    assert [list(x) for x in encoder.encode(texts)] == expected


def test_ranks_that_do_not_follow_the_merges_are_told_apart():
    one = {bytes([b]): b for b in range(256)}
    merges = [(b"a", b"b"), (b"b", b"c"), (b"ab", b"c")]
    assert merges_by_rank({**one, b"ab": 256, b"bc": 257, b"abc": 258}, merges)
    assert not merges_by_rank({**one, b"ab": 257, b"bc": 256, b"abc": 258}, merges)  # out of order
    assert not merges_by_rank({**one, b"ab": 256, b"bc": 257, b"abc": 258, b"x" * 3: 259}, merges)  # without a merge
    # By rank, a and b would be merged first, and the listed pair would never meet.
    assert not merges_by_rank({**one, b"ab": 256, b"bc": 257, b"abc": 258}, [*merges[:2], (b"a", b"bc")])


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=" \n\t\r \x1c'sAéΣ!1", max_size=20))
def test_any_white_space(text):
    for path in (BYTE, WORD):
        encoder = _encoders.setdefault(path, (Encoder(path, path == WORD), Tokenizer.from_file(path)))
        assert list(encoder[0].encode([text], None)[0]) == encoder[1].encode(text, add_special_tokens=False).ids


_encoders: dict = {}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 50), max_size=300), max_size=6))
def test_segment_round_trip(lists):
    ids = [np.array(x, "<u4") for x in lists]
    segment = Segment.open(encode_segment(np.arange(len(ids)), ids))
    assert segment.ids().tolist() == [v for x in lists for v in x]
    assert [segment.document(i).tolist() for i in range(len(ids))] == lists
    whole = segment.ids()
    for k in range(len(segment.least)):
        block = segment.blocks(np.array([k]))[0]
        assert block[: len(whole) - k * BLOCK].tolist() == whole[k * BLOCK : (k + 1) * BLOCK].tolist()


def test_outliers_are_patched():
    ids = np.full(BLOCK, 5, "<u4")
    ids[7] = 40_000
    segment = Segment.open(encode_segment(np.array([1]), [ids]))
    assert segment.width.tolist() == [0]
    assert len(segment.values) == 1
    assert segment.ids().tolist() == ids.tolist()


def test_token_files(spark, tmp_path):
    ids = [5, 3, 9, 1, 7, 0, 2, 3, 4]
    write_token_files(docs(spark, TEXTS, ids), str(tmp_path / "t"), WORD, True)
    got = read_token_files(spark, str(tmp_path / "t")).orderBy("start").collect()
    start, expected = 0, []
    for i, t in sorted(zip(ids, TEXTS, strict=True), key=lambda p: (p[0], p[1] is not None, p[1])):
        full = plain(WORD, t)
        expected.append((i, start, len(full), crc(full)))
        start += len(full)
    assert [tuple(r) for r in got] == expected


def test_token_files_without_id_or_rows(spark, tmp_path):
    write_token_files(docs(spark, ["b", "a"], [4, None]), str(tmp_path / "n"), WORD)
    got = read_token_files(spark, str(tmp_path / "n")).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, 4]
    write_token_files(docs(spark).filter("false"), str(tmp_path / "e"), WORD)
    assert read_token_files(spark, str(tmp_path / "e")).count() == 0


def check_packing(rows, texts, ids):
    full = defaultdict(list)
    for i, t in zip(ids, texts, strict=True):
        full[i].append(plain(BYTE, t))
    sequences = defaultdict(list)
    for r in rows:
        assert any(crc(f[r.start : r.start + r.length]) == r.ids_crc32 for f in full[r.doc_id])
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 1024
    assert sum(r.length for r in rows) == sum(len(f) for fs in full.values() for f in fs)
    for r in rows:
        assert r.length == 1024 or r.piece == 0
    return len(sequences)


def test_packing(spark):
    rows = pack(docs(spark), BYTE).collect()
    assert check_packing(rows, TEXTS, range(len(TEXTS))) >= 6
    assert Counter(r.doc_id for r in rows)[0] == 1
    repeated = docs(spark).union(docs(spark))
    check_packing(pack(repeated, BYTE).collect(), TEXTS * 2, [*range(len(TEXTS))] * 2)
    assert pack(docs(spark).filter("false"), BYTE).collect() == []


def test_packing_of_a_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [(r.doc_id, r.text) for r in table.collect()]
    rows = pack(table, BYTE).collect()
    n = check_packing(rows, [t for _, t in texts], [i for i, _ in texts])
    assert n <= 1.03 * sum(r.length for r in rows) / 1024


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 9), max_size=25))
def test_plan_uses_every_piece_once(counts):
    plan = plan_packing(counts, 40)
    used = Counter()
    for lengths, times in plan:
        assert times > 0
        assert sum(lengths) <= 40
        for length in lengths:
            used[length] += times
    assert used == counts


def test_exact_complements_fill_sequences():
    assert sorted(plan_packing({30: 2, 10: 2}, 40)) == [((30, 10), 2)]
    assert plan_packing({20: 5}, 40) == [((20, 20), 2), ((20,), 1)]
    assert plan_packing({25: 3, 9: 3, 6: 3}, 40) == [((25, 9, 6), 3)]
    assert [sum(x) for x, _ in plan_packing({13: 1, 12: 1, 9: 1, 6: 1}, 40)] == [40]
