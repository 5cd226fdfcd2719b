"""Best-fit packing of token pieces by exact-complement hashing.

The work is planned on counts. Tasks tokenize and cut documents where they are read; the driver gets
one count per piece length (as many as a sequence has places), and decides how many sequences hold
which lengths: first combinations that fill a sequence exactly, found in indexes of single, pair and
triple length sums, then best fit for the rest. Pieces of one length are interchangeable, so a piece
finds its place from its rank among those of its length: ranks come from counts per task and length,
not from a sort of all pieces, and a length that a third of the pieces share costs no more.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged
from .tokens import encoder, groups

CAPACITY = 1024

Recipe = tuple[tuple[int, ...], int]  # lengths in one sequence, number of such sequences


class ComplementIndex:
    """Available lengths, with indexes that find one, two or three of them of a given sum.

    Availability only falls, so what an index has passed over never becomes useful again.
    """

    def __init__(self, counts: dict[int, int], capacity: int):
        self.left = [0] * (capacity + 1)
        for length, count in counts.items():
            self.left[length] = count
        # Pair sums: for each sum the smaller part from which on pairs may still be available.
        self.next_part = [max(1, -(-s // 2)) for s in range(capacity + 1)]

    def times(self, lengths: tuple[int, ...]) -> int:
        return min(self.left[x] // n for x, n in Counter(lengths).items())

    def take(self, lengths: tuple[int, ...], times: int) -> None:
        for x in lengths:
            self.left[x] -= times

    def pairs(self, total: int) -> Iterator[tuple[int, int]]:
        """Pairs (larger, smaller) of available lengths, most even first."""
        first = self.next_part[total]
        while first < total and not (self.left[first] and self.left[total - first]):
            first += 1
        self.next_part[total] = first
        for a in range(first, total):
            if self.left[a] and self.left[total - a]:
                yield a, total - a

    def fill(self, length: int, gap: int, most: int) -> Iterator[tuple[int, ...]]:
        """Combinations with ``length`` whose others, at most so many, sum to ``gap``."""
        if self.left[gap]:
            yield (length, gap)
        for a, b in self.pairs(gap) if most > 1 else ():
            yield (length, a, b)
            if not self.left[length]:
                return
        for a in range(min(length, gap - 2), 0, -1) if most > 2 else ():
            if self.left[a]:
                for b, c in self.pairs(gap - a):
                    if b <= a:
                        yield (length, a, b, c)
                        if not (self.left[length] and self.left[a]):
                            break
            if not self.left[length]:
                return


def plan_packing(counts: dict[int, int], capacity: int = CAPACITY) -> list[Recipe]:
    """How many sequences of which lengths; uses every counted piece once.

    Exact triples use up short pieces that best fit may need where pieces are few, so the plan is made
    with up to three, two and one complements, which costs the driver a moment, and the best one kept.
    """
    plans = [_plan(counts, capacity, most) for most in (3, 2, 1)]
    return min(plans, key=lambda plan: sum(times for _, times in plan))


def _plan(counts: dict[int, int], capacity: int, most: int) -> list[Recipe]:
    recipes: list[Recipe] = []
    index = ComplementIndex({k: v for k, v in counts.items() if k < capacity}, capacity)
    if counts.get(capacity):
        recipes.append(((capacity,), counts[capacity]))
    for length in range(capacity - 1, 0, -1):
        if index.left[length]:
            for lengths in index.fill(length, capacity - length, most):
                times = index.times(lengths)
                if times:
                    index.take(lengths, times)
                    recipes.append((lengths, times))
                if not index.left[length]:
                    break
    return recipes + _best_fit(index.left, capacity)


def _best_fit(left: list[int], capacity: int) -> list[Recipe]:
    """Longest first, each into the fullest open sequence that has room."""
    full: list[Recipe] = []
    bins: dict[int, list[Recipe]] = defaultdict(list)  # by free places
    free: list[int] = []

    def put(lengths: tuple[int, ...], times: int) -> None:
        room = capacity - sum(lengths)
        if not room:
            full.append((lengths, times))
            return
        if not bins[room]:
            insort(free, room)
        bins[room].append((lengths, times))

    for length in range(capacity - 1, 0, -1):
        count = left[length]
        while count:
            at = bisect_left(free, length)
            if at == len(free):
                each = capacity // length
                if count >= each:
                    put((length,) * each, count // each)
                if count % each:
                    put((length,) * (count % each), 1)
                break
            lengths, times = bins[free[at]].pop()
            if not bins[free[at]]:
                free.pop(at)
            used = min(count, times)
            if times > used:
                put(lengths, times - used)
            put((*lengths, length), used)
            count -= used
    return full + [recipe for room in free for recipe in bins[room]]


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: documents with their end id, cut into full pieces from
    their end, so that the first piece holds what is left over. Null text is only the end id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for some in groups(texts):
                rows, cells = [], []
                for row, got in enumerate(encode(texts[some]), some.start):
                    raw, n = memoryview(got.tobytes()), len(got)
                    first = (n - 1) % capacity + 1
                    start, stop, piece = 0, first, 0
                    while start < n:
                        rows.append(row)
                        cells.append((piece, start, stop - start, zlib.crc32(raw[4 * start : 4 * stop])))
                        start, stop, piece = stop, stop + capacity, piece + 1
                values = np.array(cells, np.int64).reshape(-1, 4)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(rows, pa.int64())),
                        pa.array(values[:, 0].astype(np.int32)),
                        *(pa.array(values[:, k]) for k in (1, 2, 3)),
                    ],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Returns the pieces of all rows with sequence_id and offset, their place in a sequence.

    Repeated rows are packed as often as they occur; an empty table gives no pieces.
    """
    spark = docs.sparkSession
    # Sorted inside each task, so that pieces of one length are neighbours; ``at`` is task and place.
    sorted_pieces = token_pieces(docs, tokenizer, capacity).sortWithinPartitions("length", "doc_id", "piece")
    pieces = staged(sorted_pieces.withColumn("at", F.monotonically_increasing_id()), "pieces")
    task = F.shiftright("at", 33)
    runs = staged(
        pieces.groupBy(task.alias("task"), "length").agg(F.min("at").alias("first"), F.count("*").alias("n")),
        "piece-runs",
    )
    counts = {row.length: row.n for row in runs.groupBy("length").agg(F.sum("n").alias("n")).collect()}

    places, used, sequence = [], Counter(), 0
    for lengths, times in plan_packing(counts, capacity):
        offset = 0
        for length in lengths:
            places.append((length, used[length], used[length] + times, sequence, offset))
            used[length] += times
            offset += length
        sequence += times
    # A few rows per length, whatever the number of pieces.
    where = spark.createDataFrame(places, "length bigint, lo bigint, hi bigint, sequence bigint, offset bigint")

    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    ranked = pieces.withColumn("task", task).join(runs, ["task", "length"])
    rank = F.col("at") - F.col("first") + F.col("before")
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", rank.alias("rank"))
    placed = ranked.join(
        F.broadcast(where), (ranked.length == where.length) & (ranked["rank"] >= where.lo) & (ranked["rank"] < where.hi)
    )
    return placed.select(
        "doc_id",
        "piece",
        "start",
        ranked.length,
        "ids_crc32",
        (where.sequence + ranked["rank"] - where.lo).alias("sequence_id"),
        "offset",
    )
