"""Codes of vectors by an integer Walsh-Hadamard transform.

Vectors become integers and are cut into equal parts, and each part position has a codebook. The
nearest entry of a part is searched among the transforms: parts and entries are padded with zeros to a
power of two and transformed by sums and differences alone, which multiplies every squared distance by
that power. Squared differences are added coefficient after coefficient, fewest sign changes first, since
these tell smooth parts apart soonest; an entry goes as soon as what it has gathered exceeds the whole
distance of the entry that looked best at first. The rest is a division that leaves no remainder.

All of it is integer arithmetic. Numbers too large for 64 bits are computed as Python integers, by the
same code. Each round is one pass over the vectors, which sums them per part and entry where they are read:
what is shuffled, and the codebooks on the driver, do not grow with the table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small, staged
from .vectors import is_finite, matrix, widest

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256

ROWS = 8_192  # parts compared at a time
_MOST = 2**63 - 1


def to_integers(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x), exactly, for a scale that is a power of two."""
    if np.abs(values).max(initial=0) < 2.0**40:
        return np.floor(values * scale).astype(np.int64)
    # From 2 ** 53 on, every number is whole.
    exact = [int(np.floor(x * scale)) if abs(x) < 2.0**53 else int(x) * scale for x in values.ravel().tolist()]
    return np.array(exact, object).reshape(values.shape)


def _largest(values: np.ndarray) -> int:
    return int(np.abs(values).max()) if values.size else 0


def walsh(values: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of each row, zeros behind it up to a power of two, in order of the
    number of sign changes."""
    size = 1 << max(0, values.shape[1] - 1).bit_length()
    out = np.zeros((len(values), size), values.dtype)
    out[:, : values.shape[1]] = values
    signs = np.ones((1, 1), np.int64)
    step = 1
    while step < size:
        pairs = out.reshape(len(values), -1, 2, step)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2)
        out = out.reshape(len(values), size)
        signs = np.block([[signs, signs], [signs, -signs]])
        step *= 2
    return out[:, np.argsort(np.count_nonzero(np.diff(signs, axis=1), axis=1), kind="stable")]


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each part the index of its nearest entry (of several, the first) and the squared distance."""
    size = 1 << max(0, parts.shape[1] - 1).bit_length()
    if (_largest(parts) + _largest(entries)) * size >= 1 << 31:
        parts, entries = parts.astype(object), entries.astype(object)
    known = walsh(entries)
    index, distance = np.zeros(len(parts), np.int64), np.zeros(len(parts), parts.dtype)
    for first in range(0, len(parts), ROWS):
        own = walsh(parts[first : first + ROWS])
        sums = (own[:, :1] - known[:, 0]) ** 2
        bound = ((own - known[sums.argmin(axis=1)]) ** 2).sum(axis=1)
        row, entry = np.nonzero(sums <= bound[:, None])
        gathered = sums[row, entry]
        for k in range(1, size):
            gathered = gathered + (own[row, k] - known[entry, k]) ** 2
            left = np.flatnonzero(gathered <= bound[row])
            row, entry, gathered = row[left], entry[left], gathered[left]
        order = np.lexsort((entry, gathered, row)) if gathered.dtype != object else np.array(
            sorted(range(len(row)), key=lambda i: (row[i], gathered[i], entry[i])), np.int64
        )
        _, best = np.unique(row[order], return_index=True)
        at = order[best]
        index[first : first + ROWS] = entry[at]
        distance[first : first + ROWS] = gathered[at] // size
    return index, distance


@dataclass(frozen=True)
class Codebooks:
    """``books[p]`` holds the entries of part position p, one row each."""

    books: list[np.ndarray]
    width: int  # of a part
    scale: int

    def sha256(self) -> str:
        numbers = (str(x) for book in self.books for x in book.ravel().tolist())
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()

    def parts(self, column: pa.ListArray) -> list[np.ndarray]:
        whole = to_integers(matrix(column, self.width * len(self.books)), self.scale)
        return [whole[:, p * self.width : (p + 1) * self.width] for p in range(len(self.books))]


def _numbers(rows: list[list[int]], width: int) -> np.ndarray:
    large = any(abs(x) >= 1 << 62 for row in rows for x in row)
    return np.array(rows, object if large else np.int64).reshape(len(rows), width)


def _round(vectors: DataFrame, books: Codebooks) -> Codebooks:
    """Every entry becomes the floor of the mean of the parts nearest to it; unused ones stay."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], list] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            for p, part in enumerate(books.parts(batch.column(0))):
                index, _ = nearest(part, books.books[p])
                order = np.argsort(index, kind="stable")
                used, first, n = np.unique(index[order], return_index=True, return_counts=True)
                total = np.add.reduceat(part[order], first, axis=0)
                for j, entry in enumerate(used.tolist()):
                    old = sums.setdefault((p, entry), [0, [0] * books.width])
                    old[0] += int(n[j])
                    old[1] = [a + b for a, b in zip(old[1], total[j].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([p for p, _ in sums], pa.int32()),
                pa.array([entry for _, entry in sums], pa.int32()),
                pa.array([n for n, _ in sums.values()], pa.int64()),
                # As text, since sums of large numbers exceed every number type.
                pa.array([[str(x) for x in total] for _, total in sums.values()], pa.list_(pa.string())),
            ],
            ["part", "entry", "n", "sums"],
        )

    def mean(table: pa.Table) -> pa.Table:
        n = sum(table.column("n").to_pylist())
        columns = zip(*table.column("sums").to_pylist(), strict=True)
        means = [[str(sum(map(int, column)) // n) for column in columns]]
        return table.slice(0, 1).select(["part", "entry"]).append_column("means", pa.array(means, pa.list_(pa.string())))

    sums = vectors.select("embedding").mapInArrow(add, "part int, entry int, n bigint, sums array<string>")
    means = sums.groupBy("part", "entry").applyInArrow(mean, "part int, entry int, means array<string>")
    moved = {(r.part, r.entry): [int(x) for x in r.means] for r in means.collect()}
    kept = [
        [moved.get((p, e), row) for e, row in enumerate(book.tolist())] for p, book in enumerate(books.books)
    ]
    return Codebooks([_numbers(rows, books.width) for rows in kept], books.width, books.scale)


def train_codebooks(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE
) -> Codebooks:
    """Codebooks that start from the vectors of the smallest vec_ids and are moved ``rounds`` times.

    Null ids come last and rows of one id in order of their vectors. With fewer vectors than ``entries``,
    there are as many entries. ``vectors`` holds finite vectors only.
    """
    width = ceil(widest(vectors) / parts)
    books = Codebooks([np.zeros((0, width), np.int64)] * parts, width, scale)
    order = [F.col("vec_id").asc_nulls_last(), "embedding"]
    start = [r.embedding for r in vectors.select("vec_id", "embedding").orderBy(*order).limit(entries).collect()]
    if start:
        books = Codebooks(books.parts(pa.array(start, pa.list_(pa.float64()))), width, scale)
        for _ in range(rounds):
            books = _round(vectors, books)
    return books


def encode_vectors(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """Returns vec_id, label, code and error of every row; an error beyond a long is the largest long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [nearest(part, book) for part, book in zip(books.parts(batch.column(2)), books.books, strict=True)]
            codes = np.stack([index for index, _ in found], axis=1).astype(np.uint8)
            errors = np.sum([distance.astype(object) for _, distance in found], axis=0).tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([row.tobytes().hex() for row in codes], pa.string()),
                    pa.array([min(e, _MOST) for e in errors], pa.int64()),
                ],
                ["vec_id", "label", "code", "error"],
            )

    kinds = dict(vectors.dtypes)
    schema = f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error bigint"
    return vectors.select("vec_id", "label", "embedding").mapInArrow(run, schema)


def compress_vectors(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE
) -> DataFrame:
    """Returns vec_id, code, error, label, label_error and codebooks_sha256 of every row with a finite vector.

    Rows whose vector is null or holds a null or non-finite number are left out; the others stay, repeated
    ones too. Shorter vectors, and lengths that ``parts`` does not divide, count as padded with zeros;
    empty vectors have distance 0 from each other. ``entries`` is at most 256, ``scale`` a power of two.
    Rows without a label are one label. Of ``vectors``, the columns vec_id, embedding and label are read. Sums
    beyond a long are the largest long. Without rows the result is empty.
    """
    held = vectors.select("vec_id", "embedding", "label").filter(is_finite())
    books = train_codebooks(held, parts, entries, rounds, scale)
    coded = staged(encode_vectors(held, books), "vector-codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(_MOST).cast("decimal(38,0)"))
    totals = coded.groupBy("label").agg(total.cast("bigint").alias("label_error"))
    totals = small(staged(totals, "label-errors")).alias("t")
    both = coded.alias("c").join(totals, F.col("c.label").eqNullSafe(F.col("t.label")))
    return both.select("vec_id", "code", "error", "c.label", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))
