"""Token ids of whole texts, from a tokenizer file of the tokenizers library.

A plain byte-level BPE is run by tiktoken, which gets its vocabulary and split pattern from that file and
gives the same ids in a third of the time. tiktoken merges by rank and knows no list of merges, so the file is
checked first: that its merges come in order of their ids, and that merging any token's own bytes by rank ends
with the very pair the list has for it. Any other tokenizer is run by the tokenizers library. Those used here
never let a token span a change from visible text to a space or line end, so a text is cut there and each
distinct piece is encoded once per worker. The pieces kept are bounded. A call of the library costs more than the
merges of one word, so pieces of letters alone are given to it many in a line; a tokenizer that marks the ends of
words says where each one's ids end. A text that spells out one of the added tokens is given to the tokenizers
library whole, which gives that token's id.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Sequence
from itertools import accumulate, chain

import numpy as np
import tiktoken

END_ID = 2
KEPT_PIECES = 300_000

# Fixed value: how a byte-level tokenizer splits text before merging.
BYTE_LEVEL_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

LINE = 20  # words given to the library at once

# Lines of a word of Latin letters that stay one letter each when they are lower-cased, and of the marks behind it,
# none of which may begin a contraction.
_ENDED = re.compile(r"^([a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]+)([!-&(-/:-@\[-`{-~]*)$", re.M)
_CUT = re.compile(r"(?<=\S)(?=[ \n])")
_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, folds: bool = False) -> Encoder:
    """One per worker process and file: later tasks of the worker find the pieces already encoded."""
    if (path, folds) not in _encoders:
        _encoders[path, folds] = Encoder(path, folds)
    return _encoders[path, folds]


def _byte_of() -> dict[str, int]:
    """Byte-level files spell bytes as printable characters: those that are, and the rest from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in shown}
    return byte_of | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(shown))}


def _quick(path: str, spec: dict):
    """The tiktoken encoding of a plain byte-level BPE file, or None for any other tokenizer."""
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    plain = (
        model.get("type") == "BPE"
        and spec.get("normalizer") is None
        and split.get("type") == "ByteLevel"
        and split.get("use_regex", True)
        and not split.get("add_prefix_space")
        and not any(model.get(k) for k in ("dropout", "end_of_word_suffix", "continuing_subword_prefix", "byte_fallback"))
    )
    if not plain:
        return None
    byte_of = _byte_of()
    special = {token["content"] for token in spec.get("added_tokens", ())}

    def raw(token: str) -> bytes:
        return bytes(map(byte_of.__getitem__, token))

    ranks = {raw(t): i for t, i in model["vocab"].items() if t not in special}
    pairs = [tuple(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    if not merges_by_rank(ranks, [(raw(a), raw(b)) for a, b in pairs]):
        return None
    return tiktoken.Encoding(path, pat_str=BYTE_LEVEL_SPLIT, mergeable_ranks=ranks, special_tokens={})


def merges_by_rank(ranks: dict[bytes, int], merges: Sequence[tuple[bytes, bytes]]) -> bool:
    """Whether merging the pair of least rank again and again does what the list of merges says."""
    made = [ranks.get(a + b, -1) for a, b in merges]
    in_order = all(a < b for a, b in zip([-1, *made], made, strict=False))
    if not in_order or len(ranks) != len(merges) + 256 or any(bytes([b]) not in ranks for b in range(256)):
        return False
    never = len(ranks) + max(ranks.values())
    for pair in merges:
        token = b"".join(pair)
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            found = [ranks.get(a + b, never) for a, b in zip(parts, parts[1:], strict=False)]
            at = min(range(len(found)), key=found.__getitem__)
            if found[at] >= ranks[token]:
                return False
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        if tuple(parts) != pair:
            return False
    return True


def _word_ends(spec: dict) -> np.ndarray | None:
    """Which ids end a word, of a BPE that has every byte inside and at the end of words; else None."""
    model = spec["model"]
    vocab, suffix = model["vocab"], model.get("end_of_word_suffix")
    if model.get("type") != "BPE" or not suffix or any(c not in vocab or c + suffix not in vocab for c in _byte_of()):
        return None
    ends = np.zeros(max(vocab.values()) + 1, bool)
    ends[[i for token, i in vocab.items() if token.endswith(suffix)]] = True
    return ends


class Encoder:
    """``folds`` says that the tokenizer lower-cases and drops white space, so that pieces may lose
    both before they are looked up."""

    def __init__(self, path: str, folds: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        if hasattr(self.tokenizer.model, "_resize_cache"):
            self.tokenizer.model._resize_cache(0)  # every piece comes once; its own cache only costs
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.quick = _quick(path, spec)
        self.ends = _word_ends(spec) if folds else None
        added = self.tokenizer.get_added_tokens_decoder().values()
        # Pieces that lose their case would turn into the token.
        either_case = re.I if folds or any(token.normalized for token in added) else 0
        self.added = re.compile("|".join(re.escape(token.content) for token in added) or "(?!)", either_case)
        self.type = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.folds = folds
        # Pieces seen lately, and those of the time before.
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _cut(self, text: str | None) -> list[str]:
        if not text:
            return []
        if self.folds:
            return text.encode().lower().decode().replace("\n", " ").split(" ")
        return _CUT.split(text)

    def _learn(self, new: set[str]) -> None:
        again = new & self.older.keys()
        for piece in again:
            self.known[piece] = self.older[piece]
        fresh, ended = new - again, []
        if self.folds:  # a word with marks behind it is the word and the marks
            found = _ENDED.findall("\n".join(fresh))
            ended = [(word + marks, word, marks) for word, marks in found if marks]
            words = {word for word, _ in found}
            fresh.difference_update(words, (p for p, _, _ in ended))
            fresh.update({marks for _, _, marks in ended}.difference(self.known))
            words = list(words.difference(self.known))
            learn = self._learn_each if self.ends is None else self._learn_words
            for i in range(0, len(words), 1000):
                learn(words[i : i + 1000])
        fresh = list(fresh)
        for i in range(0, len(fresh), 1000):
            self._learn_each(fresh[i : i + 1000])
        for piece, word, marks in ended:
            self.known[piece] = self.known[word] + self.known[marks]

    def _ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the pieces one behind the other, and where each one's end."""
        got = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(got), self.type), np.fromiter(accumulate(map(len, got)), np.int64)

    def _keep(self, pieces: list[str], ids: np.ndarray, ends: np.ndarray) -> None:
        raw, at = ids.tobytes(), (ends * self.type.itemsize).tolist()
        self.known.update(zip(pieces, [raw[a:b] for a, b in zip([0, *at], at, strict=False)], strict=True))

    def _learn_each(self, pieces: list[str]) -> None:
        self._keep(pieces, *self._ids(pieces))

    def _learn_words(self, words: list[str]) -> None:
        lines = [words[i : i + LINE] for i in range(0, len(words), LINE)]
        ids, line_ends = self._ids([" ".join(line) for line in lines])
        ends = np.flatnonzero(self.ends[ids]) + 1
        # As many ends in each line as words, the last one at its end; otherwise words are not what they seem.
        places = np.cumsum([len(line) for line in lines])
        if len(ends) == places[-1] and np.array_equal(ends[places - 1], line_ends):
            self._keep(words, ids, ends)
        else:
            self._learn_each(words)

    def encode(self, texts: Sequence[str | None], end: int | None = END_ID) -> list[np.ndarray]:
        """Ids of each text as little-endian unsigned 32-bit numbers; null is empty."""
        spelled = {i for i, text in enumerate(texts) if text and self.added.search(text)}
        if spelled:
            plain = self.encode(["" if i in spelled else text for i, text in enumerate(texts)], end)
            for i in spelled:
                ids = self.tokenizer.encode(texts[i], add_special_tokens=False).ids
                plain[i] = np.array([*ids, *([] if end is None else [end])], "<u4")
            return plain
        if self.quick is not None:
            tail = np.array([] if end is None else [end], "<u4")
            got = (self.quick.encode_to_numpy(text or "") for text in texts)
            return [np.concatenate([ids.astype("<u4", copy=False), tail]) for ids in got]
        if len(self.known) > KEPT_PIECES:
            self.older, self.known = self.known, {}
        cut = [self._cut(text) for text in texts]
        # Not minus its keys, which would go through all that are known.
        self._learn(set().union(*cut).difference(self.known))
        tail = b"" if end is None else np.array([end], self.type).tobytes()
        known = self.known.__getitem__
        return [np.frombuffer(b"".join(map(known, c)) + tail, self.type).astype("<u4") for c in cut]


def groups(texts: Sequence[str | None], chars: int = 500_000):
    """Slices of a batch of about so many characters; a longer text is a slice of its own."""
    first = size = 0
    for i, text in enumerate(texts):
        n = len(text or "")
        if i > first and size + n > chars:
            yield slice(first, i)
            first, size = i, 0
        size += n
    if len(texts) > first:
        yield slice(first, len(texts))
