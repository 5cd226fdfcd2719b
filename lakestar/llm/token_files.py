"""Token files: documents encoded, written in ascending doc_id order, and read back.

Documents are range-partitioned by doc_id once, as text. A task encodes its range and stores it in
segments (``pfor``) of about ``SEGMENT_IDS`` ids, as binary rows of a Parquet table: Spark's commit
protocol then makes retried tasks safe on any store. Each segment row also says how many ids of its
range come before it; the ranges' totals, one number per task, give the global positions.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .pfor import Segment, encode_segment
from .tokens import encoder, groups

SEGMENT_IDS = 262_144
SEGMENT_SCHEMA = "part int, before bigint, n_ids bigint, image binary"
_NO_ID = -(1 << 63)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, folds: bool = False) -> None:
    """Encodes ``text`` of every row (null: empty), appends the end id, stores the ids in ascending
    (doc_id, text) order. A null doc_id comes first and is stored as the least long. ``folds``: see ``tokens.Encoder``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        encode = encoder(tokenizer, folds).encode
        names: list[int] = []
        held: list[np.ndarray] = []

        def segment() -> pa.RecordBatch:
            nonlocal before
            n = sum(map(len, held))
            row = {"part": [part], "before": [before], "n_ids": [n], "image": [encode_segment(np.array(names), held)]}
            before += n
            names.clear()
            held.clear()
            types = (pa.int32(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(row.values(), types, strict=True)], list(row)
            )

        size = 0
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for some in groups(texts):
                for doc_id, got in zip(ids[some], encode(texts[some]), strict=True):
                    names.append(_NO_ID if doc_id is None else doc_id)
                    held.append(got)
                    size += len(got)
                    if size >= SEGMENT_IDS:
                        yield segment()
                        size = 0
        if held:
            yield segment()

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(run, SEGMENT_SCHEMA).write.parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Returns doc_id, start, n_tokens and ids_crc32 of every stored document, from the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, before, image in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                segment = Segment.open(image)
                ends = np.cumsum(segment.lengths, dtype=np.int64)
                starts = ends - segment.lengths
                raw = memoryview(segment.ids().astype("<u4").tobytes())
                sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(segment.doc_ids, pa.int64(), mask=segment.doc_ids == _NO_ID),
                        pa.array(starts + (base + before)),
                        pa.array(segment.lengths.astype(np.int64)),
                        pa.array(sums, pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    stored = spark.read.schema(SEGMENT_SCHEMA).parquet(path)
    totals = stored.groupBy("part").agg(F.sum("n_ids").alias("n"))
    up_to = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("n").over(up_to), F.lit(0)).alias("base"))
    # One row per task of the writing job.
    placed = stored.join(F.broadcast(bases), "part").select("base", "before", "image")
    return placed.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
