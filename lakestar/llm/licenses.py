"""License scans by conditional compression.

Words around a licence cue form a candidate block. The block is compressed alone and once with each
template as a raw zstandard dictionary: the more of the template's wording it holds, the more bytes
the dictionary saves. The reduction only ranks the templates: in a long block a short notice saves less
than the dictionary's noise. Those whose words are not all but few in the block are out, and the rest are
compared with it word by word: a template is confirmed if its wording stands in the block with few
enough differences, and of several the one with the fewest, then the higher ranked, wins. The words it
matched are taken out and the next one is looked for. Documents are scanned whole, where they are read; no row moves.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from .license_templates import TEMPLATES

BEFORE, AFTER = 60, 140  # words around a cue
LONGEST = 600  # words in a block; the next one then overlaps it by BEFORE + AFTER
ALLOWED = 0.1  # differing words, as a share of the template's words
KEPT_BLOCKS = 5_000

# Words of a cue may be apart by whatever the word cutter leaves out: line ends, several or other spaces.
_CUE = re.compile(
    r"licen[sc]|copyright|all[\W_]+rights[\W_]+reserved|permission|warrant|redistribut|public[\W_]+domain|unencumbered",
    re.I,
)
_WORD = re.compile(r"[^\W_]+(?:\.[^\W_]+)*")

Found = tuple[int, int, str, int, int]  # first word, end word, licence, differing words, bytes saved


@dataclass
class Template:
    name: str
    text: str
    words: list[str]
    count: Counter[str]
    compressor: zstandard.ZstdCompressor


def _plain(text: str) -> str:
    return " ".join(_WORD.findall(text.lower()))


def blocks_of(text: str) -> Iterator[list[tuple[str, int, int]]]:
    """Words (lower case, start, end in code points) around the cues of a text."""
    cues = [m.start() for m in _CUE.finditer(text)]
    if not cues:
        return
    words = [(m[0].lower(), m.start(), m.end()) for m in _WORD.finditer(text)]
    ends = np.array([end for _, _, end in words] or [0])
    near = np.minimum(np.searchsorted(ends, cues, side="right"), len(words) - 1)
    first = last = None
    for at in near.tolist():
        low, high = max(0, at - BEFORE), at + AFTER
        if first is not None and low <= last:
            last = high
        else:
            if first is not None:
                yield from _parts(words[first:last])
            first, last = low, high
    yield from _parts(words[first:last])


def _parts(words: list) -> Iterator[list]:
    step = LONGEST - BEFORE - AFTER
    for i in range(0, max(1, len(words) - BEFORE - AFTER), step):
        yield words[i : i + LONGEST]


def align(wanted: Sequence[str], words: Sequence[str]) -> tuple[int, int, int]:
    """(differences, start, end) of the stretch of ``words`` nearest to ``wanted``: words missing, added
    or replaced. Of equally near stretches the last one that is shortest counts."""
    n = len(words)
    cost = np.zeros(n + 1, np.int64)
    start = np.arange(n + 1)
    place = np.arange(n + 1)
    have = np.array(words, dtype=object)
    for i, word in enumerate(wanted, 1):
        same = np.concatenate([[False], have == word]) if n else np.zeros(1, bool)
        diagonal = np.concatenate([[i], cost[:-1] + ~same[1:]])
        come = np.concatenate([[0], start[:-1]])
        down = cost + 1 < diagonal
        new, begun = np.where(down, cost + 1, diagonal), np.where(down, start, come)
        # Added words: the cheapest earlier place plus the distance from it.
        base = new - place
        best = np.minimum.accumulate(base)
        source = np.maximum.accumulate(np.where(base == best, place, 0))
        cost, start = best + place, begun[source]
    end = n - int(np.argmin(cost[::-1] * (n + 1) + (place - start)[::-1])) if n else 0
    return int(cost[end]), int(start[end]), end


class Scanner:
    def __init__(self, templates: Sequence[tuple[str, str]] = TEMPLATES, level: int = 3):
        options = {"level": level, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
        self.alone = zstandard.ZstdCompressor(**options)
        self.templates = []
        for name, text in templates:
            plain = _plain(text)
            raw = zstandard.ZstdCompressionDict(plain.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.templates.append(
                Template(
                    name,
                    plain,
                    plain.split(),
                    Counter(plain.split()),
                    zstandard.ZstdCompressor(dict_data=raw, **options),
                )
            )
        self.known: dict[str, list[Found]] = {}

    def reductions(self, words: Sequence[str]) -> list[tuple[int, int]]:
        """(bytes saved, template number), most first."""
        raw = " ".join(words).encode()
        plain = len(self.alone.compress(raw))
        saved = [(plain - len(t.compressor.compress(raw)), i) for i, t in enumerate(self.templates)]
        return sorted(saved, key=lambda pair: (-pair[0], pair[1]))

    def scan_block(self, words: Sequence[str]) -> list[Found]:
        key = " ".join(words)
        if key not in self.known:
            if len(self.known) >= KEPT_BLOCKS:
                self.known.clear()
            self.known[key] = self._scan(list(words))
        return self.known[key]

    def _scan(self, words: list[str]) -> list[Found]:
        found: list[Found] = []
        ranked = self.reductions(words)
        while True:
            best, have = None, Counter(words)
            for saved, i in ranked:
                template = self.templates[i]
                most = ALLOWED * len(template.words)
                if sum(n - have[w] for w, n in template.count.items() if n > have[w]) > most:  # words missing
                    continue
                differ, start, end = align(template.words, words)
                if differ <= most:
                    rank = (differ / len(template.words), -len(template.words), -saved, i)
                    if best is None or rank < best[0]:
                        best = (rank, (start, end, template.name, differ, saved))
            if best is None:
                return sorted(found)
            start, end = best[1][:2]
            words[start:end] = [""] * (end - start)  # keeps the places of the other words
            found.append(best[1])

    def scan(self, text: str) -> tuple[int, list[tuple[int, int, str, int, int]]]:
        """Number of blocks, and (start, end in code points, licence, differences, bytes saved)."""
        n, found = 0, {}
        for block in blocks_of(text):
            n += 1
            for first, last, name, differ, saved in self.scan_block([w for w, _, _ in block]):
                span = block[first][1], block[last - 1][2]
                if (*span, name) not in found:
                    found[(*span, name)] = (differ, saved)
        return n, sorted((*key, *value) for key, value in found.items())


def scan_licenses(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """Returns doc_id, n_blocks, n_found, licenses and spans of every row.

    ``licenses`` are the distinct names found, sorted and comma-joined; a span is
    ``name:start:end:differences``, in order of start. Null and empty text hold nothing; repeated rows
    stay repeated; only doc_id and text are read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        for batch in batches:
            scanned = [scanner.scan(text or "") for text in batch.column(1).to_pylist()]
            spans = [",".join(f"{f[2]}:{f[0]}:{f[1]}:{f[3]}" for f in found) for _, found in scanned]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([n for n, _ in scanned], pa.int64()),
                    pa.array([len(found) for _, found in scanned], pa.int64()),
                    pa.array([",".join(sorted({f[2] for f in found})) for _, found in scanned], pa.string()),
                    pa.array(spans, pa.string()),
                ],
                ["doc_id", "n_blocks", "n_found", "licenses", "spans"],
            )

    schema = "doc_id bigint, n_blocks bigint, n_found bigint, licenses string, spans string"
    return docs.select("doc_id", "text").mapInArrow(run, schema)
