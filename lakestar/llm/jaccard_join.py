"""Exact Jaccard join on word shingles, in the metric space of the Jaccard distance.

Documents with equal shingle sets are one class, and one document stands for it. Then:

1. Pivots. Classes that share a minimum of one of ``ORDERS`` hash orders meet in a region, whose pivot is its
   least member. Each class belongs to the pivot it shares most regions with and is compared with that
   one only: those within the threshold form stars around their pivots.
2. Boundaries. For two sets within distance 1 - t, a quarter of each set and one more, taken in one
   global order, always share a member. A class is therefore replicated into the regions of its
   leading quarter, but only into those that hold classes of different components so far: inside a
   component nothing is left to find. Shingles that are frequent in a sample come last in the order,
   so that common passages make no regions; the order changes the cost, never the result.
3. Windows. In such a region two classes are compared only if the triangle inequality lets them be near:
   the empty set as a pivot gives a window on sizes, and 64 pivots, one for the members of each hash
   bucket, give the differences of bucket counts, whose sum bounds the symmetric difference from below.
   Large regions are joined in blocks, so that no task holds one whole. A region is joined twice: first
   each class with a new pivot, the class that has most others in its window; then, when these links have
   joined components, whatever pairs of different components are left. A group of thousands of near
   copies thus costs a few comparisons for each member, and still no link is missed.
4. What passes is compared exactly, and the links of both steps are joined to components.

Texts are read once: the sets of a task's distinct documents are stored with their signatures, and every
later step reads those. Sets are told apart by 128-bit hashes, shingles by 64-bit ones; a class is named by
the number of the row its set is stored in.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from .common import release, slices, small
from .common import staged_sets as staged
from .components import components
from .shingles import forget, mixed, set_digest, shingle_set

SIMILARITY = 75  # per cent
ORDERS = 8
BUCKETS = 64
FEW = 64  # classes of a cell whose pairs are all tried at once
BLOCK = 500  # classes of a region in one block of its join
STAR = 2_000  # classes that are compared with one copy of their pivot
SAMPLE = 4_000  # documents whose frequent shingles come last in the order
FREQUENT = 200_000

_FACTORS = np.random.default_rng(5).integers(1 << 62, size=ORDERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


_SIGNATURES = "doc_id {}, n bigint, digest binary, spot bigint, keys array<bigint>, counts binary, shingles binary"


def _signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n, digest (null for an empty set) and spot, the row's number; with the first row of each set
    in a task, its keys in the hash orders, its bucket counts and the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spot = TaskContext.get().partitionId() << 40
        seen: set[bytes] = set()
        for batch in slices(batches, 1):
            out: list[list] = [[] for _ in range(6)]
            for text in batch.column(1).to_pylist():
                s = shingle_set(text)
                row = [len(s), set_digest(s) if len(s) else None, spot, None, None, None]
                if len(s) and row[1] not in seen:
                    seen.add(row[1])
                    least = np.array([mixed(s * f).min() for f in _FACTORS], np.uint64)
                    row[3:] = _signed(least + np.arange(len(least), dtype=np.uint64)), _fine_counts(s).tobytes(), s.tobytes()
                for column, value in zip(out, row, strict=True):
                    column.append(value)
                spot += 1
            kinds = (pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary())
            columns = [batch.column(0), *(pa.array(c, t) for c, t in zip(out, kinds, strict=True))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "digest", "spot", "keys", "counts", "shingles"])
        forget()

    return docs.select("doc_id", "text").mapInArrow(run, _SIGNATURES.format(dict(docs.dtypes)["doc_id"]))


def _near_in_size(a: str, b: str):
    return (F.col(a) * 100 >= F.col(b) * SIMILARITY) & (F.col(b) * 100 >= F.col(a) * SIMILARITY)


def _pivot_pairs(classes: DataFrame) -> DataFrame:
    """(a, b): each class with the pivot that most of its regions share, its nearest by that estimate."""
    keyed = classes.select("class", "n", F.explode("keys").alias("key"))
    least = F.min(F.struct("class", "n"))
    pivots = keyed.groupBy("key").agg(least.alias("pivot"), F.count("*").alias("members")).filter("members > 1")
    pairs = keyed.join(pivots.select("key", "pivot.class", "pivot.n").toDF("key", "b", "m"), "key")
    pairs = pairs.filter((F.col("class") != F.col("b")) & _near_in_size("n", "m"))
    pairs = pairs.groupBy(F.col("class").alias("a"), "b").agg(F.count("*").alias("shared"))
    return pairs.groupBy("a").agg(F.max_by("b", F.struct("shared", "b")).alias("b"))


def _fine_counts(s: np.ndarray) -> np.ndarray:
    """Bucket counts in as many buckets, a power of two, as make about eight members in each."""
    buckets = 1 << max(6, (len(s) // 8).bit_length())
    counts = np.bincount(((s >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64), minlength=buckets)
    return counts.astype("<u2")


def _may_be_near(a: np.ndarray, b: np.ndarray, n: int) -> bool:
    """The window on bucket counts of two sets of ``n`` members together; the finer one is folded."""
    a, b = a.astype(np.int64), b.astype(np.int64)
    size = min(len(a), len(b))
    apart = int(np.abs(a.reshape(-1, size).sum(axis=0) - b.reshape(-1, size).sum(axis=0)).sum())
    return (100 + SIMILARITY) * apart <= (100 - SIMILARITY) * n


def _compare(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) of a stored table that are near enough. Finer bucket counts, of a few hundredths
    of a set's size, rule out most of the others before whole sets are sent."""
    return _meet(sets, staged(_meet(sets, pairs, False), "window-pairs"), True)


def _meet(sets: DataFrame, pairs: DataFrame, exact: bool) -> DataFrame:
    """The set of each class (or its bucket counts) goes to the pairs' right sides it is wanted at, and is
    compared there."""
    counts = pairs.groupBy("b").agg(F.ceil(F.count("*") / F.lit(STAR)).cast("int").alias("parts"))
    sided = pairs.join(counts, "b")
    members = sided.select(
        F.col("a").alias("class"), "b", F.pmod(F.xxhash64("a"), F.col("parts")).cast("int").alias("part")
    )
    pivots = counts.select(F.col("b").alias("class"), "b", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    wanted = staged(members.union(pivots), "wanted")
    held = sets.select("class", F.col("shingles" if exact else "counts").alias("held"))
    sent = held.join(small(wanted), "class").select("b", "part", (F.col("class") != F.col("b")).alias("member"), "class", "held")
    met = sent.repartition("b", "part").sortWithinPartitions("b", "part", "member")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = np.uint64 if exact else np.dtype("<u2")
        at, pivot = None, np.zeros(0, kind)
        for batch in slices(batches, 4):
            links: tuple[list, list] = ([], [])
            for b, member, name, raw in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4)), strict=True):
                own = np.frombuffer(raw, kind)
                if not member:
                    at, pivot = b, own
                elif at == b and not exact:
                    if _may_be_near(own, pivot, int(own.sum(dtype=np.int64) + pivot.sum(dtype=np.int64))):
                        links[0].append(name)
                        links[1].append(b)
                elif at == b:
                    place = np.minimum(np.searchsorted(pivot, own), len(pivot) - 1)
                    common = int(np.count_nonzero(pivot[place] == own))
                    if 100 * common >= SIMILARITY * (len(own) + len(pivot) - common):
                        links[0].append(name)
                        links[1].append(b)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in links], ["a", "b"])

    return met.mapInArrow(compare, "a bigint, b bigint")


def _frequent(sets: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several classes of a bounded sample share, sorted, and in how many they are."""
    ids = sets.select("class").orderBy(F.xxhash64("class"), "class").limit(SAMPLE)
    sample = sets.select("class", "shingles").join(F.broadcast(ids), "class").select("shingles")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0):
            raw = b"".join(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(raw, np.int64))], ["s"])

    counts = sample.mapInArrow(run, "s bigint").groupBy("s").agg(F.count("*").alias("n")).filter("n > 2")
    rows = counts.orderBy(F.desc("n"), "s").limit(FREQUENT).collect()
    found, n = np.array([r.s for r in rows], np.int64).view(np.uint64), np.array([r.n for r in rows], np.int64)
    order = np.argsort(found)
    return found[order], n[order]


def _leading(s: np.ndarray, frequent: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The leading part of a set: any set near enough shares a member with it, and its own leading
    part has that member too."""
    n = len(s)
    # ceil(n * t) of the members are in both sets; the first of them is at most so far into the order.
    part = n - -(-n * SIMILARITY // 100) + 1
    if len(frequent):
        place = np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)
        weight = np.where(frequent[place] == s, counts[place], 0)
        return s[np.lexsort((mixed(s), weight))[:part]]
    return s[np.argsort(mixed(s))[:part]]


def _leading_parts(sets: DataFrame, frequent) -> DataFrame:
    """class and leading shingles of each set."""
    sent = sets.sparkSession.sparkContext.broadcast(frequent)  # at most ``FREQUENT`` numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, counts = sent.value
        for batch in slices(batches, 1):
            held = (np.frombuffer(raw, np.uint64) for raw in batch.column(1).to_pylist())
            parts = [_signed(_leading(s, common, counts)) for s in held]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(parts, pa.list_(pa.int64()))], ["class", "leading"])

    return sets.select("class", "shingles").mapInArrow(run, "class bigint, leading array<bigint>")


def _coarse_counts(sets: DataFrame) -> DataFrame:
    """class, n and the counts of each set in a few buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            buckets = []
            for raw in batch.column(2).to_pylist():
                coarse = np.frombuffer(raw, "<u2").reshape(-1, BUCKETS).sum(axis=0, dtype=np.int64)
                # Cut off at 255, differences only shrink, so they still are a lower bound.
                buckets.append(np.minimum(coarse, 255).astype(np.uint8).tobytes())
            columns = [*batch.columns[:2], pa.array(buckets, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["class", "n", "buckets"])

    return sets.select("class", "n", "counts").mapInArrow(run, "class bigint, n bigint, buckets binary")


def _placed(df: DataFrame, roots: DataFrame) -> DataFrame:
    """``df`` with the component of its classes so far."""
    roots = small(roots.select(F.col("node").alias("class"), "root"))
    return df.join(roots, "class", "left").withColumn("root", F.coalesce("root", "class"))


def _boundary_regions(sets: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows (s, class, n, buckets, blocks) of the regions that hold several components. Only (s, class) is
    shuffled for all shingles and stored; what the windows need is joined to the rows that are left."""
    parts = _leading_parts(sets, _frequent(sets))
    first = _placed(parts, roots).select("root", F.explode("leading").alias("s"))
    several = first.groupBy("s").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi")
    several = staged(several.select("s"), "several")
    release(sets.sparkSession)
    again = parts.select("class", F.explode("leading").alias("s"))
    inside = staged(again.join(small(several), "s"), "inside")
    release(sets.sparkSession)
    sizes = inside.groupBy("s").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("blocks"))
    return inside.join(small(staged(sizes, "sizes")), "s").join(_coarse_counts(sets), "class")


def _window_join(regions: DataFrame, roots: DataFrame, cover: bool) -> DataFrame:
    """(a, b): classes of different components that share a region and pass the windows. With ``cover``,
    all of those of small cells, and of the others enough to join each class to a hub among its near ones;
    without, the rest of the others."""
    own = _placed(regions, roots).withColumn("own", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    others = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda k: F.struct(F.least(k, F.col("own")).alias("i"), F.greatest(k, F.col("own")).alias("j")),
    )
    dealt = own.select("s", "class", "n", "root", "buckets", "own", F.explode(others).alias("at"))
    dealt = dealt.select("s", "at.i", "at.j", "own", "class", "n", "root", "buckets")
    dealt = dealt.repartition("s", "i", "j").sortWithinPartitions("s", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last cell so far, which may go on in the next batch
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            if rows.num_rows:
                cut = _starts(rows)[-1]
                if cut:
                    yield _cells(rows.slice(0, cut), cover)
                held = rows.slice(cut)
        if held is not None:
            yield _cells(held, cover)

    return dealt.mapInArrow(run, "a bigint, b bigint").distinct()


def _starts(rows: pa.Table) -> list[int]:
    """Where the cells of rows in order begin."""
    if not rows.num_rows:
        return []
    keys = np.stack([rows.column(c).to_numpy() for c in ("s", "i", "j")])
    return [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist()]


def _cells(rows: pa.Table, cover: bool) -> pa.RecordBatch:
    """The pairs of whole cells."""
    starts = np.array([*_starts(rows), rows.num_rows])
    cells = np.diff(starts)
    names, n, root, own, i, j = (rows.column(c).to_numpy() for c in ("class", "n", "root", "own", "i", "j"))
    counts = np.frombuffer(b"".join(rows.column("buckets").to_pylist()), np.uint8).reshape(rows.num_rows, -1)
    found: list[np.ndarray] = [np.zeros((2, 0), np.int64)]

    def near(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Which of the pairs (x, y) of places pass."""
        ok = (root[x] != root[y]) & (n[x] * 100 >= n[y] * SIMILARITY) & (n[y] * 100 >= n[x] * SIMILARITY)
        ok &= (i[x] == j[x]) | (own[x] != own[y])
        at = np.flatnonzero(ok)
        apart = np.abs(counts[x[at]].astype(np.int16) - counts[y[at]]).sum(axis=1, dtype=np.int64)
        # |A ^ B| / |A u B| <= 1 - t, where 2 |A u B| = |A| + |B| + |A ^ B|
        return at[(100 + SIMILARITY) * apart <= (100 - SIMILARITY) * (n[x[at]] + n[y[at]])]

    if cover:  # the members of all small cells, each with the one ``k`` places on
        cell = np.repeat(np.arange(len(cells)), cells)
        few = cells[cell] <= FEW
        for k in range(1, int(cells[cells <= FEW].max(initial=1))):
            x = np.flatnonzero(few[:-k] & (cell[k:] == cell[:-k]))
            x = x[near(x, x + k)]
            found.append(np.sort(np.stack([names[x], names[x + k]]), axis=0))
    for a, b in zip(starts[:-1][cells > FEW].tolist(), starts[1:][cells > FEW].tolist(), strict=True):
        if (root[a:b] == root[a]).all():
            continue
        here = np.arange(a, b)
        partners = [here[near(np.full(b - a, x), here)] for x in here.tolist()]
        if not cover:
            for x, y in zip(here.tolist(), partners, strict=True):
                y = y[y > x]
                found.append(np.sort(np.stack([np.full(len(y), names[x]), names[y]]), axis=0))
            continue
        free = np.ones(b - a, bool)
        for hub in sorted(range(b - a), key=lambda x: -len(partners[x])):
            if free[hub] and len(partners[hub]):
                joined = partners[hub][free[partners[hub] - a]]
                found.append(np.stack([names[joined], np.full(len(joined), names[a + hub])]))
                free[joined - a] = free[hub] = False
    pairs = np.unique(np.concatenate(found, axis=1), axis=1)
    return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])


def jaccard_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored rows (doc_id, n, digest, class) and links (a, b) between classes that connect all near ones."""
    stored = staged(_signatures(docs), "signatures")
    known = stored.filter("digest IS NOT NULL").groupBy("digest")
    names = staged(known.agg(F.min("spot").alias("class")), "classes")
    rows = stored.select("doc_id", "n", "digest").join(names, "digest", "left")
    rows = staged(rows.select("doc_id", "n", "digest", "class"), "rows")
    # The least spot of a set is the first in its task, so the set is stored there.
    first = small(names.select("class"))
    sets = stored.filter("shingles IS NOT NULL").withColumnRenamed("spot", "class").join(first, "class", "left_semi")
    links = staged(_compare(sets, staged(_pivot_pairs(sets.select("class", "n", "keys")), "pivot-pairs")), "links")
    release(docs.sparkSession)
    regions = _boundary_regions(sets, components(links))
    for cover in (True, False):
        pairs = staged(_window_join(regions, components(links), cover), "boundary-pairs")
        release(docs.sparkSession)
        links = links.union(staged(_compare(sets, pairs), "links"))
        release(docs.sparkSession)
    return rows, links


def jaccard_join(docs: DataFrame) -> DataFrame:
    """Returns doc_id, n_shingles and component_id of every row.

    Two documents are linked when their sets of five-word shingles have a Jaccard similarity of at least
    0.75; component_id is the least doc_id that links lead to, its own included. A null or wordless text
    has the empty set and is linked with nothing. Repeated rows stay repeated. A null doc_id is no
    candidate for component_id; a component without ids has none.
    """
    rows, links = jaccard_classes(docs)
    rooted = _rooted(rows, links)
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(named, "root").select("class", "component_id")
    return rows.join(named, "class", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def _rooted(rows: DataFrame, links: DataFrame) -> DataFrame:
    """Stored rows (class, digest, root, least): the root of the class's component, the class's least doc_id."""
    roots = components(links).select(F.col("node").alias("class"), "root")
    least = rows.filter("class IS NOT NULL").groupBy("class", "digest").agg(F.min("doc_id").alias("least"))
    root = F.coalesce("root", "class").alias("root")
    return staged(least.join(roots, "class", "left").select("class", "digest", root, "least"), "rooted")


def _with_digest(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with the digest of each row's set (null for an empty one) as a last column."""
    at, names = docs.columns.index("text"), [*docs.columns, name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, at):
            got = [shingle_set(text) for text in batch.column(at).to_pylist()]
            digests = pa.array([set_digest(s) if len(s) else None for s in got], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, digests], names)
        forget()

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, BinaryType())]))


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each component of ``docs``, with all columns: the one with the least doc_id, and of
    several texts under that id the one whose set has the least hash. Distinct texts under one id are told
    apart: each stays or goes with its own component. Rows without words are components of their own, one for
    each id; rows without an id cannot be told apart and are all kept."""
    rows, links = jaccard_classes(docs)
    known = rows.filter("doc_id IS NOT NULL")
    first = _rooted(rows, links).filter("least IS NOT NULL").groupBy("root")
    first = first.agg(F.min(F.struct("least", "digest")).alias("first")).select("first.*").toDF("doc_id", "digest")
    named = first.unionByName(known.filter("digest IS NULL").select("doc_id", "digest").distinct())
    named = staged(named.join(known.groupBy("doc_id").agg(F.count("*").alias("n")), "doc_id"), "named")
    one = docs.join(small(named.filter("n = 1").select("doc_id")), "doc_id", "left_semi")
    # Only rows of repeated ids are read for their set again.
    several = named.filter("n > 1")
    more = docs.join(small(several.select("doc_id").distinct()), "doc_id", "left_semi")
    name = "digest"
    while name in docs.columns:
        name += "_"
    more, several = _with_digest(more, name).alias("m"), small(several).alias("s")
    same = (F.col("m.doc_id") == F.col("s.doc_id")) & F.col(f"m.{name}").eqNullSafe(F.col("s.digest"))
    more = more.join(several, same, "left_semi").dropDuplicates(["doc_id", name]).drop(name)
    kept = one.unionByName(more).unionByName(docs.filter("doc_id IS NULL"))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
