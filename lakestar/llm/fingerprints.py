"""Document fingerprints as invertible Bloom lookup sketches of paragraph digests.

A text is cut into short paragraphs, and each distinct one is digested to 64 bits. A sketch adds every
digest to one cell of each of three tables; a cell keeps the number, the xor of its digests and the xor
of their checks. Sketches of two versions are subtracted cell by cell, which cancels what they share.
Cells left with a single digest give it away; taking it out of its other cells frees more, and so on
until nothing is left: the paragraphs that differ are then all recovered. When that gets stuck, the
sketches are made again larger. The fingerprint is the sketch of the smallest size.

A large sketch is made of independent ones, each for the digests of one slice of the hash range, as
many as the numbers of paragraphs ask for, so that the work grows with the length of the texts.

Only SQL functions are used. Documents are dealt once, by ranges of their id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

CELLS = 8  # of each of the three tables, at the smallest size
SIZES = (8, 16, 32, 128)  # tried one after the other for a slice
PER_SLICE = 12  # paragraphs of both texts together; edits share most of them and take twice as many
ROUNDS = 6  # of peeling; what needs more counts as stuck
SHIFTS = (0, 14, 28)  # bits of a digest that choose its cell in each table
SLICE_SHIFT = 44

# A sentence or line, at most 100 characters of it, with the marks that end it.
PARAGRAPH = r"[^\\n.!?]{1,100}[\\n.!?]*|[\\n.!?]+"

_ZERO = "named_struct('n', 0, 'k', 0L, 'c', 0L)"


def digests(text: str) -> str:
    """SQL for the distinct paragraph digests of a text column."""
    return f"array_distinct(transform(regexp_extract_all({text}, '{PARAGRAPH}', 0), p -> xxhash64(p)))"


def sketch(found: str, size: int) -> str:
    """SQL for the cells of a digest array: three tables of ``size`` cells."""
    tables = [
        f"""transform(sequence(0, {size - 1}), j -> aggregate(
            filter({found}, v -> (shiftright(v, {shift}) & {size - 1}L) = j), {_ZERO},
            (c, v) -> named_struct('n', c.n + 1, 'k', c.k ^ v, 'c', c.c ^ xxhash64(v))))"""
        for shift in SHIFTS
    ]
    return f"concat({', '.join(tables)})"


def _subtract(a: str, b: str) -> str:
    return f"zip_with({a}, {b}, (x, y) -> named_struct('n', x.n - y.n, 'k', x.k ^ y.k, 'c', x.c ^ y.c))"


_NONE = "cast(array() AS array<struct<n: int, k: bigint>>)"


def _peeling(cells: str, size: int, kept: str, add: str) -> str:
    """SQL that peels a difference of sketches: what ``add`` makes of the digests ``pure`` found in a round is
    gathered, from ``kept`` on; null if it got stuck. Once a round finds nothing, later ones do no work."""
    pure = """array_distinct(filter(s.cells, x -> abs(x.n) = 1 AND x.c = xxhash64(x.k)))"""
    tables = [
        f"""transform(sequence(0, {size - 1}), j -> aggregate(
            filter(pure, q -> (shiftright(q.k, {shift}) & {size - 1}L) = j), s.cells[j + {t * size}],
            (x, q) -> named_struct('n', x.n - q.n, 'k', x.k ^ q.k, 'c', x.c ^ q.c)))"""
        for t, shift in enumerate(SHIFTS)
    ]
    taken = f"concat({', '.join(tables)})"
    step = f"""transform(array({pure}), pure -> IF(size(pure) = 0,
        named_struct('cells', s.cells, 'found', s.found, 'on', false),
        named_struct('cells', {taken}, 'found', {add}, 'on', true)))[0]"""
    return f"""aggregate(sequence(1, {ROUNDS}), named_struct('cells', {cells}, 'found', {kept}, 'on', true),
        (s, i) -> IF(s.on, {step}, s),
        s -> IF(forall(s.cells, x -> x.n = 0 AND x.k = 0 AND x.c = 0), s.found, NULL))"""


def peeled(cells: str, size: int) -> str:
    """SQL for the digests recovered from a difference of sketches, or null if it got stuck: structs of n,
    1 for the first sketch's and -1 for the second's, and the digest k."""
    return _peeling(cells, size, _NONE, "concat(s.found, transform(pure, q -> named_struct('n', q.n, 'k', q.k)))")


def peel(cells: str, size: int) -> str:
    """SQL for the number of digests recovered from a difference of sketches, or null if it got stuck."""
    return _peeling(cells, size, "0", "s.found + size(pure)")


def _by_slice(a: str, b: str, sizes, share: int, peel_one) -> str:
    """SQL for an array of what ``peel_one`` gives for each slice, null where it got stuck at every size."""
    bits = f"greatest(0, cast(ceil(log2((size({a}) + size({b}) + 1) / {share * PER_SLICE}.0D)) AS int))"
    # Cut twice, each time by about the root of the number of slices.
    masks = "'m', shiftleft(1L, cast(k DIV 2 AS int)) - 1L, 'r', shiftleft(1L, cast(k - k DIV 2 AS int)) - 1L"

    def cut(left: str, right: str, shift: int, mask: str, slice_: str) -> str:
        part = f"filter({{}}, v -> (shiftright(v, {shift}) & {mask}) = {slice_})"
        return f"named_struct('a', {part.format(left)}, 'b', {part.format(right)})"

    parts = f"""transform(array({bits}), k -> transform(array(named_struct({masks})), p -> flatten(transform(
        transform(sequence(0L, p.m), h -> {cut(a, b, SLICE_SHIFT, 'p.m', 'h')}),
        w -> transform(sequence(0L, p.r), g -> {cut('w.a', 'w.b', SLICE_SHIFT + 10, 'p.r', 'g')}))))[0])[0]"""
    tried = [peel_one(_subtract(sketch("t.a", size), sketch("t.b", size)), size) for size in sizes]
    return f"transform({parts}, t -> coalesce({', '.join(tried)}))"


def differing(a: str, b: str, sizes=SIZES, share: int = 1) -> str:
    """SQL for the number of digests that differ, or null if a slice got stuck at every size."""
    return f"aggregate({_by_slice(a, b, sizes, share, peel)}, 0, (n, x) -> n + x)"


def recovered(a: str, b: str, sizes=SIZES, share: int = 1) -> str:
    """SQL for the digests that differ, as ``peeled`` gives them, recovered slice by slice; null if a
    slice got stuck at every size."""
    return f"flatten({_by_slice(a, b, sizes, share, peeled)})"


def _text(cells: str):
    """A sketch as text: number, xor of the digests and xor of the checks of each cell, in hexadecimal."""
    return F.expr(f"array_join(transform({cells}, x -> concat(hex(x.n), ':', hex(x.k), ':', hex(x.c))), ' ')")


def cells_of(fingerprint: str) -> str:
    """SQL for the cells of a fingerprint, which can be subtracted from another's and peeled."""
    number = "cast(conv(p[{}], 16, -10) AS bigint)"
    return f"""transform(transform(split({fingerprint}, ' '), x -> split(x, ':')), p -> named_struct(
        'n', cast({number.format(0)} AS int), 'k', {number.format(1)}, 'c', {number.format(2)}))"""


def apart(a: str, b: str) -> str:
    """SQL for the digests that two fingerprints differ by, or null if they are too many for their size."""
    return peeled(_subtract(cells_of(a), cells_of(b)), CELLS)


def with_next(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, text, next_text) with null texts empty: the text of the row before in (doc_id, text)
    order, for the first row that of the last. A null doc_id comes first.

    Rows are dealt to ranges of ids and ordered there. The last row of each range also goes to the
    next range that has rows, the last of all to the first: one row for each range.
    """
    spark = docs.sparkSession
    rows = docs.select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("doc_id", F.lit(-(1 << 63))).alias("key")
    )
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    shares = F.array(*[F.lit(i / n) for i in range(1, n)]) if n > 1 else F.array(F.lit(0.5))
    bounds = sorted(set(rows.agg(F.percentile_approx("key", shares, 10_000)).first()[0] or []))
    ranges = F.lit(0)
    if bounds:
        ranges = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b < F.col("key")))
    rows = rows.withColumn("range", ranges)
    # One row per range, and few ranges: as many as shuffle partitions.
    ends = rows.groupBy("range").agg(F.max(F.struct("key", "text")).alias("end"))
    ends = staged(ends.select("range", "end.key", F.sha2("end.text", 256).alias("sha")), "range-ends")
    order = Window.orderBy("range")
    last = ends.agg(F.max("range")).first()[0]
    first = ends.agg(F.min("range")).first()[0]
    target = F.coalesce(F.lead("range").over(order), F.lit(first if first is not None else 0))
    carried = ends.select("key", "sha", target.alias("target"), (F.col("range") == F.lit(last)).alias("wraps"))
    carriers = (
        rows.drop("range")
        .join(F.broadcast(carried), "key")
        .filter(F.sha2("text", 256) == F.col("sha"))
        .dropDuplicates(["key", "sha", "target"])
        .select("doc_id", "text", "key", F.col("target").alias("range"), F.lit(0).alias("own"))
    )
    dealt = rows.withColumn("own", F.lit(1)).unionByName(carriers).repartitionById(n, F.col("range"))
    dealt = dealt.withColumn("digests", F.expr(digests("text")))
    inside = Window.partitionBy("range").orderBy("own", "key", "text")
    before = [F.lag(c).over(inside).alias(f"next_{c}") for c in ("text", "digests")]
    return dealt.select("doc_id", "text", "digests", "own", *before).filter("own = 1").drop("own")


def fingerprint(docs: DataFrame) -> DataFrame:
    """Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next
    of every row.

    The edited text has its last third (rounded down, in code points) replaced by as many of the next
    document's first code points, or all it has. Null text is empty. Repeated rows stay repeated, and one
    of two equal rows has the other as its next. A single row is its own next.
    """
    pairs = with_next(docs)
    third = "cast(floor(length(text) / 3) AS int)"
    edited = F.expr(f"concat(substring(text, 1, length(text) - {third}), substring(next_text, 1, {third}))")
    rows = pairs.withColumn("edited", edited).withColumn("edited_digests", F.expr(digests("edited")))
    rows = rows.select(
        "doc_id",
        F.length("text").cast("bigint").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        "digests",
        "edited_digests",
        "next_digests",
        F.expr(sketch("digests", CELLS)).alias("cells"),
        F.expr(sketch("edited_digests", CELLS)).alias("edited_cells"),
    )
    small = peel(_subtract("cells", "edited_cells"), CELLS)
    rows = rows.withColumn("edits", F.expr(f"coalesce({small}, {differing('digests', 'edited_digests', share=2)})"))
    rows = rows.withColumn("apart", F.expr(differing("digests", "next_digests")))
    rows = rows.withColumn("fingerprint", _text("cells")).withColumn("edited_fingerprint", _text("edited_cells"))
    # The digests go on only for rows that got stuck at every size.
    stuck = "(edits IS NULL OR apart IS NULL)"
    keep = [F.expr(f"IF({stuck}, {c}, array())").cast("array<bigint>").alias(c) for c in _DIGESTS]
    sizes = [F.size(c).alias(f"{c}_size") for c in _DIGESTS]
    size = SIZES[-1]
    done = staged(rows.select(*_OUT, "edits", "apart", *keep, *sizes), "fingerprints")
    results = []
    while True:
        results.append(done.filter("edits IS NOT NULL AND apart IS NOT NULL"))
        left = done.filter("edits IS NULL OR apart IS NULL")
        if left.isEmpty():
            break
        size *= 4
        again = [
            F.expr(f"coalesce({old}, {differing('digests', other, (size,))})").alias(old)
            for old, other in (("edits", "edited_digests"), ("apart", "next_digests"))
        ]
        done = staged(left.withColumns({c: e for c, e in zip(("edits", "apart"), again, strict=True)}), "stuck")
    whole = results[0]
    for more in results[1:]:
        whole = whole.unionByName(more)

    def like(other: str, differ: str):
        both = f"(digests_size + {other}_size)"
        return F.expr(f"IF({both} = 0, 1.0D, cast({both} - {differ} AS double) / ({both} + {differ}))")

    return whole.select(
        *_OUT, like("edited_digests", "edits").alias("near_edited"), like("next_digests", "apart").alias("near_next")
    )


_OUT = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint")
_DIGESTS = ("digests", "edited_digests", "next_digests")
