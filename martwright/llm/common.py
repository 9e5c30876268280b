"""Helpers shared by the operators: stored steps, text buffers, words."""

import ctypes
import uuid
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

# What separates words: space, tab, line feed, vertical tab, form feed, carriage return.
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Texts are taken from an Arrow batch in slices of about so many bytes.
SLICE_BYTES = 2_000_000


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, or else the context's checkpoint folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Rows written to the shared folder and read again: a lineage cut that survives
    the loss of executors and lets every reader start from files."""
    folder = new_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def one_array(column) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


@lru_cache(maxsize=1)
def _trim():
    """glibc's way to give freed memory back, where there is one."""
    try:
        return ctypes.CDLL("libc.so.6").malloc_trim
    except (OSError, AttributeError):
        return lambda _: None


def release_memory() -> None:
    pa.default_memory_pool().release_unused()
    _trim()(0)


def text_slices(column, size=SLICE_BYTES):
    """(first row, texts) pieces of a text column of about `size` bytes; null is empty."""
    column = pc.fill_null(one_array(column).cast(pa.large_string()), "")
    sizes = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False))
    row = 0
    while row < len(column):
        before = sizes[row - 1] if row else 0
        end = max(row + 1, int(np.searchsorted(sizes, before + size, "right")))
        yield row, column.slice(row, end - row)
        row = end
    # A worker waits with what it holds, next to those of other stages.
    release_memory()


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the offset of each text in them."""
    _, offsets, data = texts.cast(pa.large_binary()).buffers()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def text_list(words: pa.Array) -> list[str]:
    """Words, of UTF-8 without a line feed, decoded all at once."""
    if not len(words):
        return []
    data, offsets = buffers(words)
    return np.insert(data, offsets[1:-1], 0x0A).tobytes().decode().split("\n")


class Words:
    """The words `[^\\x20\\x09-\\x0D]+` of several texts, one after the other.

    starts, ends: byte range of each word in data; text: the text it lies in;
    first: index of each text's first word, with the number of words at the end.
    """

    def __init__(self, texts: pa.Array):
        self.data, self.offsets = buffers(texts)
        size = len(self.data)
        self.space = _IS_SPACE[self.data]
        edge = np.zeros(size + 1, dtype=bool)
        edge[self.offsets] = True
        inside = ~self.space
        begins, finishes = inside.copy(), inside.copy()
        begins[1:] &= self.space[:-1] | edge[1:size]
        finishes[:-1] &= self.space[1:] | edge[1:size]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(finishes) + 1
        self.first = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.first)
        self.text = np.repeat(np.arange(len(texts)), self.counts)

    def __len__(self):
        return len(self.starts)

    def encoded(self) -> tuple[np.ndarray, pa.Array]:
        """Index of each word among the distinct words, and the distinct words (binary)."""
        joined = np.ascontiguousarray(self.data[~self.space])
        ends = np.zeros(len(self) + 1, np.int64)
        np.cumsum(self.ends - self.starts, out=ends[1:])
        array = pa.Array.from_buffers(
            pa.large_binary(), len(self), [None, pa.py_buffer(ends), pa.py_buffer(joined)]
        )
        coded = array.dictionary_encode()
        return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def binary_array(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A binary array whose rows are the given ranges of consecutive values."""
    values = np.ascontiguousarray(values)
    ends = np.asarray(offsets, np.int64) * values.itemsize
    if len(values) * values.itemsize < 2**31:
        return pa.Array.from_buffers(
            pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(values)]
        )
    return pa.Array.from_buffers(
        pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(values)]
    ).cast(pa.binary())


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The ranges flat[start : start + length], one after the other."""
    ends = np.cumsum(lengths)
    if not len(ends):
        return flat[:0]
    kind = np.int32 if max(len(flat), ends[-1]) < 2**31 else np.int64
    at = np.repeat((starts - (ends - lengths)).astype(kind), lengths)
    at += np.arange(ends[-1], dtype=kind)
    return flat[at]


class DistinctIds:
    """Ids of distinct words by a given encoder, of which the first `most` words met are
    remembered, so that a worker's memory stays bounded."""

    def __init__(self, encode, most: int):
        self.encode, self.most = encode, most
        self.index: dict[str, int] = {}
        self.flat, self.counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def __call__(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, start, count): the ids of word i begin at start[i] in ids."""
        at = np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(at < 0)
        flat, counts = self.encode([words[i] for i in new])
        at[new] = len(self.counts) + np.arange(len(new))
        all_flat = np.concatenate([self.flat, flat])
        all_counts = np.concatenate([self.counts, counts])
        starts = np.cumsum(all_counts) - all_counts
        kept = min(self.most - len(self.index), len(new))
        if kept > 0:
            base = len(self.counts)
            self.index.update((words[i], base + k) for k, i in enumerate(new[:kept]))
            self.counts = all_counts[: base + kept]
            self.flat = all_flat[: len(self.flat) + counts[:kept].sum()]
        return all_flat, starts[at], all_counts[at]
