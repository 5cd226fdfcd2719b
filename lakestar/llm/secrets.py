"""Secret scans with a trigram inverted index.

Documents are indexed in segments of a few megabytes, where they are read: a segment's postings give,
for each trigram that some rule asks for, the documents that hold it. Each rule's Boolean trigram
query is answered by intersecting and uniting postings, and its pattern runs on those candidates only.
A rule without mandatory trigrams (hexadecimal runs) is run on every document. No row is shuffled, a
lost executor costs its own segments, and memory is bounded by one segment or one document.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import slices
from .secret_rules import BASE, RULES, Query, Rule, trigram_query, trigrams

SEGMENT_BYTES = 4_000_000

Span = tuple[int, int, int]  # start, rank of the rule, end


def _code(gram: bytes) -> int:
    return gram[0] << 16 | gram[1] << 8 | gram[2]


class Scanner:
    def __init__(self, rules: Sequence[Rule] = RULES):
        self.rules = rules
        self.queries = [trigram_query(rule) for rule in rules]
        self.patterns = [re.compile(rule.pattern, rule.flags) for rule in rules]
        grams = sorted(set().union(*map(trigrams, self.queries)))
        self.grams = {g: i for i, g in enumerate(grams)}
        self.codes = np.array([_code(g.encode("ascii")) for g in grams], np.int32)  # ascending, as the grams
        self.begins = np.zeros(1 << 16, bool)  # the first two bytes of a wanted trigram
        self.begins[self.codes >> 8] = True

    def postings(self, texts: Sequence[str]) -> list[np.ndarray]:
        """For each wanted trigram the sorted positions of the texts that hold it."""
        raw = [text.encode().lower() for text in texts]
        ends = np.cumsum([len(r) + 1 for r in raw])
        # The separator is in no trigram of a rule, so none spans two texts.
        data = np.frombuffer(b"\x00".join(raw) + b"\x00\x00\x00", dtype=np.uint8)
        first = data[:-2].astype(np.uint16) << np.uint16(8)
        first |= data[1:-1]
        at = np.flatnonzero(self.begins[first])
        codes = first[at].astype(np.int32) << 8 | data[at + 2]
        gram = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1) if len(self.codes) else codes
        held = self.codes[gram] == codes if len(self.codes) else np.zeros(len(codes), bool)
        at, gram = at[held], gram[held]
        pairs = np.unique(gram.astype(np.int64) << 32 | np.searchsorted(ends, at, side="right"))
        grams, rows = pairs >> 32, pairs & 0xFFFFFFFF
        bounds = np.searchsorted(grams, np.arange(len(self.grams) + 1))
        return [rows[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]

    def candidates(self, query: Query, postings: list[np.ndarray], n: int) -> np.ndarray:
        if query is True:
            return np.arange(n)
        if isinstance(query, str):
            return postings[self.grams[query]]
        parts = [self.candidates(part, postings, n) for part in query[1:]]
        parts.sort(key=len)
        found = parts[0]
        for part in parts[1:]:
            found = (np.intersect1d if query[0] == "and" else np.union1d)(found, part)
        return found

    def scan(self, texts: Sequence[str]) -> list[list[Span]]:
        """Spans of every text in order of start, then rule."""
        postings = self.postings(texts)
        spans: list[list[Span]] = [[] for _ in texts]
        for rank, (rule, query, pattern) in enumerate(
            zip(self.rules, self.queries, self.patterns, strict=True)
        ):
            for i in self.candidates(query, postings, len(texts)):
                for m in pattern.finditer(texts[i]):
                    if m.end(rule.keep) - m.start(rule.keep) >= rule.least:
                        spans[i].append((m.start(), rank, m.end()))
        for found in spans:
            found.sort()
        return spans


def segments(texts: Sequence[str | None]) -> Iterator[tuple[int, list[str]]]:
    """Cuts a batch into runs of about ``SEGMENT_BYTES``; a longer text is a run of its own."""
    first, size, run = 0, 0, []
    for i, text in enumerate(texts):
        text = text or ""
        if run and size + len(text) > SEGMENT_BYTES:
            yield first, run
            first, size, run = i, 0, []
        run.append(text)
        size += len(text)
    if run:
        yield first, run


def _named(spans: Sequence[Span], rules: Sequence[Rule], kinds: Sequence[str] | None = None) -> str:
    return ",".join(
        f"{rules[rank].kind}:{start}:{end}"
        for start, rank, end in spans
        if kinds is None or rules[rank].kind in kinds
    )


def scan_secrets(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Returns doc_id, n_assign, n_access, n_hex, base_sha256 and spans of every row.

    A span is ``kind:start:end`` in code points, end exclusive, of the whole match. Null text is
    empty and has no spans; repeated rows stay repeated; only doc_id and text are read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for batch in slices(batches, 1, SEGMENT_BYTES):
            out: dict[str, list] = {"n_assign": [], "n_access": [], "n_hex": [], "base_sha256": [], "spans": []}
            for _, texts in segments(batch.column(1).to_pylist()):
                for found in scanner.scan(texts):
                    kinds = [rules[rank].kind for _, rank, _ in found]
                    for kind in BASE:
                        out[f"n_{kind}"].append(kinds.count(kind))
                    base = _named(found, rules, BASE)
                    out["base_sha256"].append(hashlib.sha256(base.encode()).hexdigest())
                    out["spans"].append(_named(found, rules))
            columns = [batch.column(0)]
            columns += [pa.array(out[f"n_{kind}"], pa.int64()) for kind in BASE]
            columns += [pa.array(out[name], pa.string()) for name in ("base_sha256", "spans")]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *out])

    schema = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def redact_secrets(docs: DataFrame, rules: Sequence[Rule] = RULES, mark: str = "[SECRET]") -> DataFrame:
    """All rows and columns of ``docs``, with the secrets in ``text`` replaced; null text stays null.

    Overlapping spans are replaced together.
    """
    at = docs.columns.index("text")

    def clean(text: str, spans: list[Span]) -> str:
        parts, done, cut = [], 0, 0
        for start, _, end in spans:
            if start >= cut:
                parts += [text[done:start], mark]
            cut = max(cut, end)
            done = cut
        return "".join([*parts, text[done:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for batch in slices(batches, at, SEGMENT_BYTES):
            texts = batch.column(at).to_pylist()
            for first, run_texts in segments(texts):
                for i, spans in enumerate(scanner.scan(run_texts), first):
                    if spans:
                        texts[i] = clean(texts[i], spans)
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, c.type) if i == at else c for i, c in enumerate(batch.columns)],
                schema=batch.schema,
            )

    return docs.mapInArrow(run, docs.schema)
