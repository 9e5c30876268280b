"""Token-id files: documents in ascending doc_id order as coded segments of ids.

A store is a folder of Parquet files. Each row is a segment: `part` numbers the parts of
the whole stream of ids in order, `begin` is the segment's place in its part, `doc_ids`
and `n_tokens` are its documents in order, `code` their ids as the id coder writes them. A segment holds whole documents, so every
segment can be read, checked and repeated without any other. Files are written by Spark's
committer; a task that is repeated writes the same segments.

Rows with a null doc_id come first; rows of one doc_id are ordered by a hash of their text,
so they spread over tasks, also where all are alike. A null or empty text is a document of
the end id alone; an empty table is an empty store; other columns are not read.
"""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martwright.llm import id_coder
from martwright.llm.common import binary_array, one_array, release_memory, text_slices
from martwright.llm.word_bpe import forget, token_ids

SEGMENT_IDS = 2_000_000
_SLICE = 3_000_000


def _encode_task(batches, path, end_id):
    part, written = TaskContext.get().partitionId(), 0
    documents, counts, held = [], [], 0
    parts: list[np.ndarray] = []
    kind = None

    def segment():
        nonlocal written, held
        ids = np.concatenate(parts)
        parts.clear()
        release_memory()
        code = id_coder.encode(ids)
        batch = pa.RecordBatch.from_arrays(
            [
                pa.array([part], pa.int32()),
                pa.array([written], pa.int64()),
                pa.array([documents], pa.list_(kind)),
                pa.array([counts], pa.list_(pa.int64())),
                pa.array([code], pa.binary()),
            ],
            ["part", "begin", "doc_ids", "n_tokens", "code"],
        )
        written, held = written + held, 0
        documents.clear()
        counts.clear()
        return batch

    for batch in batches:
        kind = batch.column(0).type
        doc_ids = batch.column(0).to_pylist()
        for row, texts in text_slices(batch.column(1), _SLICE):
            ids, lengths = token_ids(path, texts)
            ends = np.cumsum(lengths)
            ids = np.insert(ids, ends, end_id)
            lengths, ends = lengths + 1, ends + np.arange(1, len(ends) + 1)
            first = 0
            while first < len(ends):
                # Documents until the segment is full, and at least one.
                begin = ends[first] - lengths[first]
                last = int(np.searchsorted(ends, begin + SEGMENT_IDS - held, "right"))
                if last == first and held:
                    yield segment()
                    continue
                last = max(last, first + 1)
                documents.extend(doc_ids[row + first : row + last])
                counts.extend(lengths[first:last].tolist())
                parts.append(ids[begin : ends[last - 1]])
                held += int(ends[last - 1] - begin)
                first = last
                if held >= SEGMENT_IDS:
                    yield segment()
    if held:
        yield segment()


def write(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = 2) -> None:
    """Write the store of `docs` (doc_id, text): each text's ids and the end id."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    place = F.xxhash64(F.coalesce("text", F.lit("")))
    # The number only tells equal rows apart, whose order is all the same.
    spread = docs.select("doc_id", "text").repartitionByRange(
        "doc_id", place, F.monotonically_increasing_id()
    )
    ordered = spread.sortWithinPartitions("doc_id", place, "text")
    schema = f"part int, begin long, doc_ids array<{kind}>, n_tokens array<bigint>, code binary"

    def task(batches):
        return _encode_task(batches, tokenizer_path, end_id)

    ordered.mapInArrow(task, schema).write.parquet(folder)


def _decode_task(batches):
    # The worker may have written the store.
    forget()
    for batch in batches:
        for row in range(len(batch)):
            start, counts = batch.column(0)[row].as_py(), batch.column(2)[row].values.to_numpy()
            ids = id_coder.decode(batch.column(3)[row].as_py())
            release_memory()
            ends = np.cumsum(counts)
            if ends[-1] != len(ids):
                raise ValueError("a segment's documents do not fit its ids")
            # In pieces, so that no batch gets too large to send.
            cuts = np.searchsorted(ends, np.arange(1, ends[-1] // SEGMENT_IDS + 1) * SEGMENT_IDS, "right")
            edges = [0, *sorted({int(c) for c in cuts} - {0, len(ends)}), len(ends)]
            for first, last in zip(edges, edges[1:], strict=False):
                begin = ends[first] - counts[first]
                offsets = np.concatenate([[0], ends[first:last] - begin])
                yield pa.RecordBatch.from_arrays(
                    [
                        one_array(batch.column(1)[row].values).slice(first, last - first),
                        pa.array(start + begin + offsets[:-1]),
                        binary_array(ids[begin : ends[last - 1]], offsets),
                    ],
                    ["doc_id", "start", "ids"],
                )
        release_memory()


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of a store: doc_id, start (ids of all documents before it) and ids as
    little-endian unsigned 32-bit integers. Damaged blocks raise."""
    store = spark.read.parquet(folder)
    kind = store.schema["doc_ids"].dataType.elementType.simpleString()
    size = F.aggregate("n_tokens", F.lit(0).cast("long"), lambda total, n: total + n)
    # One row for each task that has written, so the window and the broadcast stay small.
    parts = store.groupBy("part").agg(F.sum(size).alias("size"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("base"))
    placed = store.join(F.broadcast(parts), "part").select(
        (F.col("base") + F.col("begin")).alias("start"), "doc_ids", "n_tokens", "code"
    )
    return placed.mapInArrow(_decode_task, f"doc_id {kind}, start long, ids binary")
