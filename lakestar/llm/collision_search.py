"""Nearest neighbours by cosine, by counting collisions in query-centred windows.

Vectors are scaled to length one, so that the nearest by cosine are the nearest by distance. A block of a
few thousand of them is indexed together: for each of ``PROJECTIONS`` random directions, the order of its
vectors along that direction. A query opens a window around its own projection in every sorted array, and a
vector collides as often as it is inside. Windows grow by virtual rehashing: a larger radius only adds the
two ends of each window to the counts. A vector that collides ``COLLISIONS`` times is verified, which means
its cosine is computed; a query is done when its k-th best verified vector is nearer than the radius, since
windows of that radius catch any nearer vector with high probability. No number of candidates is capped.

1. Each task turns the vectors it reads into blocks, and searches each block for the queries in it. That
   gives every query an upper bound on the distance of its k-th nearest.
2. Blocks and queries are dealt to cells, each block meeting each group of queries in one of them, and the
   search goes on there from that bound, so that most blocks end after small windows.
3. The best k of all blocks are the result.

A cell holds one block and a bounded group of queries; nothing is broadcast, and every row is indexed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged
from .vectors import is_finite, matrix

NEAREST = 5
EVERY = 50
PROJECTIONS = 64
# Of 64 projections, a vector as far as the radius collides in 44 on average, with a deviation of 3.7.
COLLISIONS = 39
FIRST_RADIUS, GROWTH = 0.25, 1.5
FARTHEST = 2.0  # distance of two unit vectors
BLOCK = 4_096
MOST = 60_000  # vectors of a block, which are numbered in 16 bits
GROUP = 2_048  # queries that meet a block together
CELLS = 20_000  # tasks; more cells share them


def scaled(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows scaled by powers of two, which rounds nothing, and their lengths after that."""
    out = np.ldexp(values, -np.frexp(np.abs(values).max(axis=1, initial=0))[1][:, None])
    return out, np.sqrt((out * out).sum(axis=1))


@cache
def directions(width: int) -> np.ndarray:
    return np.random.default_rng(width).standard_normal((width, PROJECTIONS))


class Block:
    """Vectors, none of them zero, with their order along every direction."""

    def __init__(self, values: np.ndarray, order: np.ndarray | None = None):
        n, width = values.shape
        self.values, self.lengths = scaled(values)
        self.units = self.values / self.lengths[:, None]
        along = (self.units @ directions(width)).T
        if order is None:
            order = np.argsort(along, axis=1, kind="stable")
        self.order = order.reshape(PROJECTIONS, n).astype(np.int64)
        # The sorted arrays one after the other, too far apart for any window to reach two of them.
        gap = 2 * np.sqrt((directions(width) ** 2).sum(axis=0)).max() + FARTHEST + 1
        self.base = np.arange(PROJECTIONS) * gap
        self.sorted = (np.take_along_axis(along, self.order, axis=1) + self.base[:, None]).ravel()
        self.order = self.order.ravel()

    def search(
        self, query: np.ndarray, k: int = NEAREST, bound: float = np.inf, own: int = -1
    ) -> tuple[np.ndarray, np.ndarray]:
        """Positions and cosines of those among the k nearest, found with high probability, that are at
        most ``bound`` away; all but the vector at ``own`` if these are no more than k. Others may follow."""
        n = len(self.values)
        (query,), (length,) = scaled(query[None])
        ahead = query / length
        centre = ahead @ directions(len(query)) + self.base
        low = high = np.searchsorted(self.sorted, centre)
        counts, checked = np.zeros(n, np.int64), np.zeros(n, bool)
        checked[own : own + 1] = own >= 0
        places, cosines = np.zeros(0, np.int64), np.zeros(0)
        farthest = min(bound, FARTHEST)
        radius = min(FIRST_RADIUS, farthest)
        while True:
            # Rounding may move a projection by less than this.
            left = np.searchsorted(self.sorted, centre - radius - 1e-9, side="left")
            right = np.searchsorted(self.sorted, centre + radius + 1e-9, side="right")
            new = [self.order[a:b] for ends in ((left, low), (high, right)) for a, b in zip(*ends, strict=True)]
            counts += np.bincount(np.concatenate(new), minlength=n)
            low, high = left, right
            wanted = (counts >= COLLISIONS) & ~checked
            if radius >= FARTHEST and np.count_nonzero(checked | wanted) - (own >= 0) < k:
                wanted = ~checked  # too few for any threshold
            new = np.flatnonzero(wanted)
            checked |= wanted
            places = np.append(places, new)
            cosines = np.append(cosines, self.units[new] @ ahead)
            if len(places) >= k:
                farthest = min(farthest, distance(np.partition(cosines, -k)[-k]))
            if radius >= farthest:
                # The product so far depends on the block in its last bits; what is returned does not.
                places = places[cosines >= 1 - (farthest + 1e-6) ** 2 / 2]
                return places, (self.values[places] * query).sum(axis=1) / (self.lengths[places] * length)
            radius = min(radius * GROWTH, farthest)


def distance(cosine: float) -> float:
    return float(np.sqrt(max(0.0, 2 - 2 * cosine)))


def _first(places: np.ndarray, cosines: np.ndarray, ids: list, k: int) -> list[tuple]:
    """The k best (id, cosine), ties by id, null ids last."""
    if len(places) > k:
        keep = cosines >= np.partition(cosines, -k)[-k]
        places, cosines = places[keep], cosines[keep]
    found = [(ids[p], c) for p, c in zip(places.tolist(), cosines.tolist(), strict=True)]
    return sorted(found, key=lambda f: (-f[1], f[0] is None, 0 if f[0] is None else f[0]))[:k]


def _index(vectors: DataFrame, number: str, width: int, k: int) -> DataFrame:
    """One row for each block: its number, ids, vectors and orders, and its queries with what they found."""
    name = dict(vectors.dtypes)["vec_id"]
    query = f"struct<place: int, id: {name}, vector: binary, bound: double, found: array<struct<id: {name}, score: double>>>"
    schema = f"i int, b int, ids array<{name}>, vectors binary, orders binary, queries array<{query}>"

    def block(rows: pa.Table, ordinal: int) -> pa.RecordBatch:
        ids, asks = rows.column("vec_id").to_pylist(), rows.column("asks").to_pylist()
        values = matrix(rows.column("embedding").combine_chunks(), width)
        held, queries = Block(values), []
        for place in (p for p, ask in enumerate(asks) if ask):
            found = _first(*held.search(values[place], k, own=place), ids, k)
            queries.append(
                {
                    "place": place,
                    "id": ids[place],
                    "vector": values[place].astype(number).tobytes(),
                    "bound": distance(found[-1][1]) if len(found) == k else float("inf"),
                    "found": [{"id": i, "score": c} for i, c in found],
                }
            )
        one = {
            "i": TaskContext.get().partitionId(),
            "b": ordinal,
            "ids": ids,
            "vectors": values.astype(number).tobytes(),
            "orders": held.order.astype("<u2").tobytes(),
            "queries": queries,
        }
        ids_kind = rows.schema.field("vec_id").type
        near = pa.list_(pa.struct([("id", ids_kind), ("score", pa.float64())]))
        fields = [("place", pa.int32()), ("id", ids_kind), ("vector", pa.binary()), ("bound", pa.float64()), ("found", near)]
        kinds = [pa.int32(), pa.int32(), pa.list_(ids_kind), pa.binary(), pa.binary(), pa.list_(pa.struct(fields))]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(one.values(), kinds, strict=True)], [*one])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        ordinal = 0
        for batch in batches:
            while batch.num_rows:
                room = MOST - sum(b.num_rows for b in held)
                held.append(batch.slice(0, room))
                batch = batch.slice(room)
                if batch.num_rows:
                    yield block(pa.Table.from_batches(held), ordinal)
                    held, ordinal = [], ordinal + 1
        if held:
            yield block(pa.Table.from_batches(held), ordinal)

    return vectors.mapInArrow(run, schema)


def _elsewhere(index: DataFrame, number: str, width: int, k: int) -> DataFrame:
    """(home, b, place, query_id, vec_id, score): what queries find in blocks other than their own.

    The query at ``place`` of block (home, b) is dealt to a group g and goes to the cells (i, g) of all
    i; a block goes to its cells with all groups."""
    first, last, asks = index.agg(F.min("i"), F.max("i"), F.sum(F.size("queries"))).first()
    if not asks:
        first = last = 0
    groups = max(1, ceil((asks or 0) / GROUP))
    tasks = min(CELLS, (last - first + 1) * groups)
    name = index.schema["ids"].dataType.elementType.simpleString()
    asked = index.select(F.col("i").alias("home"), "b", F.explode("queries").alias("q")).select("home", "b", "q.*")
    asked = asked.drop("found").withColumn("g", F.pmod(F.xxhash64("home", "b", "place"), F.lit(groups)).cast("int"))
    asked = asked.withColumn("i", F.explode(F.sequence(F.lit(first), F.lit(last)))).repartition(tasks, "i", "g")
    held = index.drop("queries").withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    held = held.repartition(tasks, "i", "g")

    def meet(blocks: pa.Table, queries: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        for block in blocks.to_pylist():
            ids = block["ids"]
            values = np.frombuffer(block["vectors"], number).reshape(len(ids), width).astype(np.float64)
            held = Block(values, np.frombuffer(block["orders"], "<u2"))
            for q in queries.to_pylist():
                if (q["home"], q["b"]) == (block["i"], block["b"]):
                    continue
                vector = np.frombuffer(q["vector"], number).astype(np.float64)
                found = _first(*held.search(vector, k, q["bound"]), ids, k)
                rows += [(q["home"], q["b"], q["place"], q["id"], *f) for f in found]
        kind = queries.schema.field("id").type
        kinds = (pa.int32(), pa.int32(), pa.int32(), kind, kind, pa.float64())
        columns = [*zip(*rows, strict=True)] or [()] * 6
        arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
        return pa.Table.from_arrays(arrays, ["home", "b", "place", "query_id", "vec_id", "score"])

    schema = f"home int, b int, place int, query_id {name}, vec_id {name}, score double"
    return held.groupBy("i", "g").cogroup(asked.groupBy("i", "g")).applyInArrow(meet, schema)


def nearest_vectors(vectors: DataFrame, is_query: Column, k: int = NEAREST) -> DataFrame:
    """Returns query_id, rank, vec_id and score: for each row that ``is_query`` names, the ``k`` other rows
    found with the largest cosine, ties by vec_id, null ids last.

    Vectors that are null, zero or hold a null or non-finite number take no part. Shorter vectors count as
    padded with zeros. Repeated rows are candidates, and queries, of their own; with no more than ``k``
    candidates all are found. A null ``is_query`` is no query. Of ``vectors``, the columns vec_id and
    embedding are read. Without queries the result is empty.
    """
    held = vectors.withColumn("#asks", F.coalesce(is_query, F.lit(False)))
    held = held.select("vec_id", "embedding", F.col("#asks").alias("asks"))
    held = held.filter(is_finite() & F.expr("exists(embedding, x -> x <> 0)"))
    rows, width = held.agg(F.count("*"), F.max(F.size("embedding"))).first()
    number = "<f4" if dict(held.dtypes)["embedding"] == "array<float>" else "<f8"
    blocks = held.repartition(max(1, ceil(rows / BLOCK)))  # evenly, whatever the keys are
    index = staged(_index(blocks, number, width or 0, k), "collision-index")
    own = index.select(F.col("i").alias("home"), "b", F.explode("queries").alias("q"))
    own = own.select("home", "b", "q.place", F.col("q.id").alias("query_id"), F.explode("q.found").alias("f"))
    own = own.select("home", "b", "place", "query_id", F.col("f.id").alias("vec_id"), "f.score")
    found = own.unionByName(_elsewhere(index, number, width or 0, k))
    order = Window.partitionBy("home", "b", "place").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")
