"""Benchmark decontamination with Wu-Manber multi-pattern search over words.

Every ten consecutive words of a benchmark item are a pattern; an item of fewer words is one pattern.
Patterns of one length are searched together: a shift table over blocks of two words says how far the
search may jump, so most words of a document are never looked at; where the shift is zero, the bucket
of that last block, narrowed by the first block, gives the patterns to compare word by word.

The benchmark is cut into blocks of bounded size and documents are searched for one block after the
other, so that a task holds the search tables of one block, in one worker. Documents are not shuffled.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator, Sequence
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from .common import SLICE_BYTES, slices

WINDOW = 10
# Characters of benchmark text in a block; the search tables of a block take about 100 times that.
BLOCK_CHARS = 1_000_000
MANY_BLOCKS_BYTES = 64_000_000  # of texts searched with one making of every block's tables

# Bytes of UTF-8: every character outside ASCII is made of bytes from 0x80 on.
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) runs of digits, letters and characters outside ASCII."""
    return _WORD.findall((text or "").encode().lower())


class WuManber:
    """Search for patterns (word lists) of one length, each standing for a set of items."""

    def __init__(self, patterns: dict[tuple[bytes, ...], set[str]]):
        self.length = m = len(next(iter(patterns)))
        self.block = b = min(2, m)
        self.far = m - b + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict = defaultdict(lambda: defaultdict(list))
        for pattern, items in patterns.items():
            for j in range(m - b + 1):
                block = pattern[j : j + b]
                self.shift[block] = min(self.shift.get(block, self.far), m - b - j)
            self.buckets[pattern[-b:]][pattern[:b]].append((list(pattern), items))

    def search(self, words: list[bytes]) -> Iterator[tuple[int, set[str]]]:
        """(start, items) of every occurrence."""
        m, b, far, shift = self.length, self.block, self.far, self.shift.get
        end, n = m, len(words)
        while end <= n:
            block = tuple(words[end - b : end])
            step = shift(block, far)
            if step:
                end += step
                continue
            start = end - m
            for pattern, items in self.buckets[block].get(tuple(words[start : start + b]), ()):
                if words[start:end] == pattern:
                    yield start, items
            end += 1


def searchers(items: Sequence[tuple[str, str | None]], window: int = WINDOW) -> list[WuManber]:
    by_length: dict[int, dict[tuple[bytes, ...], set[str]]] = defaultdict(lambda: defaultdict(set))
    for item, text in items:
        words = words_of(text)
        m = min(window, len(words))
        for i in range(len(words) - m + 1 if m else 0):
            by_length[m][tuple(words[i : i + m])].add(item)
    return [WuManber(dict(patterns)) for _, patterns in sorted(by_length.items())]


def benchmark_blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[str, str]]]:
    """The items as (id as text, text), one bounded block after the other; at least one block."""
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, ceil(chars / block_chars))
    for k in range(n):
        part = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k)
        yield [(row.item, row.text) for row in part.collect()]


def _search_all(text: str | None, tables: list[WuManber]) -> tuple[int, bytes | None, list[str]]:
    """Number of words, a mark per word that is hit (None if none is), items found."""
    words = words_of(text)
    hit, found = None, set()
    for table in tables:
        for start, items in table.search(words):
            if hit is None:
                hit = bytearray(len(words))
            hit[start : start + table.length] = b"\x01" * table.length
            found |= items
    return len(words), None if hit is None else bytes(hit), sorted(found)


def _either(a: bytes | None, b: bytes | None) -> bytes | None:
    if a is None or b is None:
        return a or b
    return (int.from_bytes(a) | int.from_bytes(b)).to_bytes(len(a))


def _marked(docs: DataFrame, benchmark: DataFrame, window: int, block_chars: int) -> tuple[DataFrame, list[str]]:
    """``docs`` with the number of words, the marks of those hit and the items found, and the names of these
    three columns, which are no names of ``docs``.

    A worker searches a batch for one block after the other and keeps the tables of one. A single block's are
    made once; with more of them, batches are put together, so that making tables costs less than searching.
    """
    context = docs.sparkSession.sparkContext
    at, width = docs.columns.index("text"), len(docs.columns)
    taken = {c.lower() for c in docs.columns}
    extra = []
    for name in ("n_words", "hit", "items"):
        name = f"#{name}"
        while name.lower() in taken:
            name += "#"
        extra.append(name)
    types = dict(zip(extra, (LongType(), BinaryType(), ArrayType(StringType())), strict=True))
    schema = StructType([*docs.schema.fields, *[StructField(n, t) for n, t in types.items()]])
    blocks = [context.broadcast(items) for items in benchmark_blocks(benchmark, block_chars)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only = searchers(blocks[0].value, window) if len(blocks) == 1 else None
        size = SLICE_BYTES if only is not None else MANY_BLOCKS_BYTES
        for batch in slices(batches, at, size):
            texts = batch.column(at).to_pylist()
            words, hits, found = [0] * len(texts), [None] * len(texts), [set() for _ in texts]
            for block in blocks:
                tables = only if only is not None else searchers(block.value, window)
                for i, text in enumerate(texts):
                    words[i], hit, items = _search_all(text, tables)
                    hits[i] = _either(hits[i], hit)
                    found[i].update(items)
            more = [
                pa.array(words, pa.int64()),
                pa.array(hits, pa.binary()),
                pa.array([sorted(items) for items in found], pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], *more], [*batch.schema.names[:width], *extra])

    return docs.mapInArrow(run, schema), extra


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """Returns doc_id, n_words, n_hit, n_items, items_sha256, contaminated and items of every row.

    Null or wordless text has no words and no hits; items without words are never found, items that
    share an id are one item, and an item without id is named by the empty text. Repeated rows stay
    repeated. Without items nothing is hit.
    """

    marked, (n_words, hit, items) = _marked(docs.select("doc_id", "text"), benchmark, window, block_chars)
    ones = F.length(F.col(hit)) - F.length(F.replace(F.col(hit).cast("string"), F.lit("\x01"), F.lit("")))
    return marked.select(
        "doc_id",
        F.col(n_words).alias("n_words"),
        F.coalesce(ones.cast("bigint"), F.lit(0).cast("bigint")).alias("n_hit"),
        F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", items).cast("binary"), 256).alias("items_sha256"),
        F.col(hit).isNotNull().alias("contaminated"),
        F.col(items).alias("items"),
    )


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """The rows of ``docs`` without any hit word, with all their columns."""
    marked, (_, hit, _) = _marked(docs, benchmark, window, block_chars)
    return marked.filter(F.col(f"`{hit}`").isNull()).select(*[F.col(f"`{c}`") for c in docs.columns])
