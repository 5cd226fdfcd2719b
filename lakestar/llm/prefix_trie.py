"""The trie of conversations' first turns, found by peeling turns off their ends.

A conversation is one row: a hash for each of its prefixes, longest last, and the length of each turn. The
deepest prefixes are nodes; stripping their last turn gives candidates for the depth above, where they
meet the conversations that end there. Equal prefixes are grouped, which makes the nodes of that depth and
adds up their figures at once, and so on up to the root. Each group is one aggregate with partial sums where
the rows are, so a first turn or a conversation that a third of all share is no hot key.

Most deep prefixes belong to one row only. Before a depth is grouped, the peeling therefore tries to strip
many turns at once: if the prefixes that are left still all differ, nothing can have met on the way, and
every row yields its whole chain of nodes without a shuffle. If two are alike, it tries half as many turns,
down to a single one, which is grouped. Rounds thus follow the depths at which conversations part.

Hashes are 128 bits wide. Conversations are stored by their length, and each round reads those that end in it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import scratch_path
from .common import small, staged

GROUP = 100  # conversations that begin like the first of them
SHARED = 6  # by fewer turns than this
IDS = 8_192  # width of the ranges of ids that are put in order together
BROADCAST_ROWS = 200_000  # of a hash or two each

ROOT = hashlib.md5(b"").digest()
_STATE = "conv_id", "path", "n_convs", "n_leaves", "saved_tokens"


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): one row for each conversation, its turns in order as (digest, chars).

    Null turns come first; rows of one turn number are ordered by their digest. Null roles and texts are empty.
    Rows without conv_id belong to no conversation."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    # The length of the role says where the text begins.
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    turn = F.struct("turn", digest.alias("digest"), F.length(text).alias("chars"))
    ordered = F.transform(F.sort_array(F.collect_list(turn)), lambda t: F.struct(t.digest, t.chars))
    return conversations.filter("conv_id IS NOT NULL").groupBy("conv_id").agg(ordered.alias("turns"))


def shared_turns(conv_id: str | Column = "conv_id", shared: int = SHARED) -> Column:
    """How many turns a conversation takes from the first of its hundred."""
    return (F.crc32(F.col(conv_id).cast("string").cast("binary")) % shared).cast("int")


def rebuild(turns: DataFrame, group: int = GROUP, shared: int = SHARED) -> DataFrame:
    """``turns`` with the first few turns of each conversation replaced by those of the first conversation of
    its group; that may leave it without turns. Where the group has no such conversation, they just go."""
    first = turns.filter(F.col("conv_id") % group == 0)
    first = first.select(F.col("conv_id").alias("base"), F.slice("turns", 1, shared).alias("lead"))
    own = turns.withColumn("base", F.col("conv_id") - F.col("conv_id") % group).withColumn("h", shared_turns(shared=shared))
    led = own.join(first, "base", "left")
    lead = F.when(F.col("lead").isNull(), F.slice("turns", 1, 0)).otherwise(F.slice("lead", F.lit(1), F.col("h")))
    rest = F.slice("turns", F.col("h") + 1, F.size("turns"))
    return led.select("conv_id", F.concat(lead, rest).alias("turns"))


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, path): for each prefix, the root's first, its hash and the length of its last turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("key", pa.binary()), ("chars", pa.int64())]))
        for batch in batches:
            paths = []
            for turns in batch.column(1):
                key, path = ROOT, [{"key": ROOT, "chars": 0}]
                for turn in turns.as_py():
                    key = hashlib.md5(key + turn["digest"]).digest()
                    path.append({"key": key, "chars": turn["chars"]})
                paths.append(path)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(paths, kind)], ["conv_id", "path"])

    name = dict(turns.dtypes)["conv_id"]
    return turns.mapInArrow(run, f"conv_id {name}, path array<struct<key: binary, chars: bigint>>")


def ends_digest(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256) of rows (conv_id, key): the hash of each key's ids in numeric order, with commas.

    Ids are joined in narrow ranges first, so that a key that most conversations end at is put in order by
    many tasks; the last one only reads the parts, one after the other."""
    parts = ends.withColumn("range", F.floor(F.col("conv_id") / F.lit(IDS)))
    ids = F.sort_array(F.collect_list("conv_id")).cast("array<string>")
    parts = parts.groupBy("key", "range").agg(F.array_join(ids, ",").alias("ids"))
    parts = parts.repartition("key").sortWithinPartitions("key", "range").select("key", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, hashlib.sha256()
        for batch in batches:
            done = []
            for key, ids in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if key == at:
                    state.update(b",")
                else:
                    if at is not None:
                        done.append((at, state.hexdigest()))
                    at, state = key, hashlib.sha256()
                state.update(ids.as_py().encode())
            yield _digests(done)
        if at is not None:
            yield _digests([(at, state.hexdigest())])

    return parts.mapInArrow(run, "key binary, ends_sha256 string")


def _digests(done: list[tuple[bytes, str]]) -> pa.RecordBatch:
    columns = [pa.array([k for k, _ in done], pa.binary()), pa.array([s for _, s in done], pa.string())]
    return pa.RecordBatch.from_arrays(columns, ["key", "ends_sha256"])


def _key(path: Column, depth: int | Column) -> Column:
    return F.element_at(path, F.lit(depth) + 1).key


class _Peeling:
    """Nodes found so far are stored level by level; ``state`` holds those of depth ``depth``."""

    def __init__(self, paths: DataFrame):
        self.spark = spark = paths.sparkSession
        stored, self.out = scratch_path(spark, "trie-paths"), scratch_path(spark, "trie-nodes")
        paths = paths.withColumn("turns", F.size("path") - 1)
        paths.hint("rebalance", "turns").write.partitionBy("turns").parquet(stored)
        self.paths = spark.read.schema(paths.schema).parquet(stored)
        deepest = self.paths.agg(F.max("turns")).first()[0]
        self.depth = -1 if deepest is None else deepest + 1
        self.state = self._ended(0, -1)

    def _ended(self, low: int, high: int) -> DataFrame:
        """Conversations of ``low`` to ``high`` turns, none of them grouped yet: no convs below them."""
        ended = self.paths.filter(F.col("turns").between(low, high))
        return ended.select("conv_id", "path", F.lit(0).cast("bigint").alias("n_convs"), *[
            F.lit(0).cast("bigint").alias(c) for c in ("n_leaves", "saved_tokens")
        ])

    def _rows(self, low: int) -> DataFrame:
        """What meets at depth ``low``: nodes of the depth below this peeling, and conversations that end
        from there up to ``low``. The former have n_convs > 0."""
        return self.state.unionByName(self._ended(low, self.depth - 1))

    def _alone(self, low: int) -> bool:
        keys = self._rows(low).groupBy(_key(F.col("path"), low).alias("key")).agg(F.count("*").alias("n"))
        return keys.filter("n > 1").isEmpty()

    def _store(self, nodes: DataFrame, depth: int) -> None:
        """Writes ``nodes``; those of ``depth``, which have their paths, are the next state."""
        folder = f"{self.out}/level={depth}"
        nodes.write.parquet(folder)
        self.schema = nodes.schema
        self.state = self.spark.read.schema(self.schema).parquet(folder).filter(F.col("depth") == depth).select(*_STATE)
        self.depth = depth

    def strip(self, low: int) -> None:
        """Peels down to depth ``low`` where no two rows meet: every row is a chain of nodes."""
        rows = self._rows(low).withColumn("top", F.size("path") - 1)
        inner = F.col("n_convs") > 0  # a node of the depth below, that has a subtree
        rows = rows.withColumn("first", F.when(inner, F.col("top") - 1).otherwise(F.col("top")))
        rows = rows.withColumn("depth", F.explode(F.sequence(F.col("first"), F.lit(low), F.lit(-1))))
        convs = F.greatest("n_convs", F.lit(1))
        # Each node above adds its share of its own last turn.
        turns = F.slice("path", F.col("depth") + 1, F.col("first") - F.col("depth") + 1)
        chars = F.aggregate(turns, F.lit(0).cast("bigint"), lambda s, t: s + t.chars)
        self._store(
            rows.select(
                "conv_id",
                F.when(F.col("depth") == low, F.slice("path", 1, low + 1)).alias("path"),
                convs.alias("n_convs"),
                F.greatest("n_leaves", F.lit(1)).alias("n_leaves"),
                (F.col("saved_tokens") + (convs - 1) * chars).alias("saved_tokens"),
                F.when(inner | (F.col("depth") < F.col("first")), 1).otherwise(0).cast("bigint").alias("n_children"),
                "depth",
                _key(F.col("path"), F.col("depth")).alias("key"),
                F.when(F.col("depth") > 0, _key(F.col("path"), F.greatest(F.col("depth") - 1, F.lit(0)))).alias("parent"),
            ),
            low,
        )

    def group(self) -> None:
        """Peels one depth: strips a turn, merges what ends there, and groups."""
        low = self.depth - 1
        rows = self._rows(low).withColumn("key", _key(F.col("path"), low))
        child = F.col("n_convs") > 0
        met = rows.groupBy("key").agg(
            F.min("conv_id").alias("conv_id"),
            F.any_value(F.slice("path", 1, low + 1)).alias("path"),
            F.sum(F.greatest("n_convs", F.lit(1))).alias("n_convs"),
            F.greatest(F.sum("n_leaves"), F.lit(1)).alias("n_leaves"),
            F.sum("saved_tokens").alias("below"),
            F.count_if(child).alias("n_children"),
        )
        own = (F.col("n_convs") - 1) * F.element_at("path", -1).chars
        met = met.withColumn("saved_tokens", F.col("below") + own).withColumn("depth", F.lit(low))
        parent = F.element_at("path", -2).key if low else F.lit(None).cast("binary")
        self._store(met.select(*_STATE, "n_children", "depth", "key", parent.alias("parent")), low)

    def run(self) -> DataFrame:
        step, levels = self.depth, 1
        while self.depth > 0:
            step = min(step, self.depth)
            if step > 1 and self._alone(self.depth - step):
                self.strip(self.depth - step)
                step, levels = step * 2, 1
            elif step > 2:
                step //= 2
            else:  # rows meet here; the more often in a row they did, the more depths until the next try
                for _ in range(min(levels, self.depth)):
                    self.group()
                step, levels = 2, levels * 2
        return self.spark.read.schema(self.schema).parquet(self.out).drop("path")


def trie(turns: DataFrame) -> DataFrame:
    """Stored nodes (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)
    of rows (conv_id, turns) as ``turns_of`` makes them, ids in no two rows. Without rows there is no node."""
    paths = staged(prefixes(turns), "trie-prefixes")
    peeling = _Peeling(paths)
    if peeling.depth < 0:
        nodes = paths.select("conv_id").limit(0)
        for c in ("depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"):
            nodes = nodes.withColumn(c, F.lit(None).cast("bigint"))
        return nodes.withColumn("ends_sha256", F.lit(None).cast("string"))
    nodes = peeling.run()
    ends = staged(ends_digest(paths.select("conv_id", F.element_at("path", -1).key.alias("key"))), "trie-ends")
    parents = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    parents = small(parents, BROADCAST_ROWS)
    whole = nodes.join(small(ends, BROADCAST_ROWS), "key", "left").join(parents, "parent", "left")
    return whole.select(
        "conv_id",
        F.col("depth").cast("bigint").alias("depth"),
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """Returns the nodes of the trie of rebuilt conversations: conv_id, the smallest member; depth;
    parent_conv_id, null for the root; n_convs, n_children, n_leaves, saved_tokens and ends_sha256.

    Turns are ordered by number, null first, and rows of one number by a hash of role and text; repeated rows
    are turns of their own. Null role and text are empty. Rows without conv_id belong to no conversation. A
    conversation left without turns ends at the root. An empty table has no nodes, not even a root. Only
    conv_id, turn, role and text are read. A conversation is held as one row of 24 bytes for each turn.
    """
    return trie(rebuild(turns_of(conversations.select("conv_id", "turn", "role", "text"))))
