"""Hierarchical multi-length packing of documents into token sequences.

A document's ids (its text's ids and an end id) are routed by length. Every full window
of the longest context size is a sequence of its own. What is left of the document goes
to the shortest tier that holds it. Tiers are packed from the longest to the shortest:
the longest piece opens a window of its tier's size, the gap is filled with the longest
pieces of shorter tiers that fit, and a piece is cut only to fill the last gap exactly.
So every window is full; only what a task has left at its end is dealt out in windows of
falling powers of two. Windows of one tier make step groups of equal token budgets.

The work is one pass without a shuffle: a task packs the documents it reads, in pools of
bounded size, and numbers its windows by its partition, which a repeated task does alike.

Defined cases: a null or empty text is a document of the end id alone; rows with the
same id, or a null id, are packed as documents of their own; a very long text fills windows of
the longest size and is cut like any other, its ids being held by one task while it is
packed; an empty table gives no rows; other columns are not read.
"""

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from martwright.llm.common import binary_array, text_slices
from martwright.llm.word_bpe import token_ids

TIERS = (2048, 1024, 512, 256)
STEP_TOKENS = 32_768
_POOL_TOKENS = 1_000_000
_SLICE = 3_000_000
_SCHEMA = (
    "doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long,"
    " offset long, window int, step_group long"
)


class _Pool:
    """Pieces by length; a piece is (document, start, ids)."""

    def __init__(self, tiers):
        self.tiers = sorted(tiers)
        self.by_length = defaultdict(list)
        self.there = 0  # bit n: there is a piece of length n
        self.tokens = 0

    def put(self, piece) -> None:
        size = len(piece[2])
        self.by_length[size].append(piece)
        self.there |= 1 << size
        self.tokens += size

    def take(self, size):
        stack = self.by_length[size]
        piece = stack.pop()
        if not stack:
            self.there &= ~(1 << size)
        self.tokens -= size
        return piece

    def longest(self, limit: int) -> int:
        """The greatest length up to the limit, 0 if there is none."""
        return max((self.there & ((2 << limit) - 1)).bit_length() - 1, 0)

    def shortest(self, above: int) -> int:
        rest = self.there >> (above + 1)
        return above + (rest & -rest).bit_length() if rest else 0

    def tier(self, size: int) -> int:
        return next(tier for tier in self.tiers if tier >= size)


def _window(pool: _Pool, size: int):
    """Pieces that fill a window of the size: the longest first, then the best fits, and
    a cut piece to end on. The pool must hold as many tokens."""
    pieces, gap = [], size
    while gap:
        fit = pool.longest(gap)
        if fit:
            piece = pool.take(fit)
        else:
            document, start, ids = pool.take(pool.shortest(gap))
            piece = document, start, ids[:gap]
            pool.put((document, start + gap, ids[gap:]))
        pieces.append(piece)
        gap -= len(piece[2])
    return pieces


def pack_pool(pool: _Pool, last: bool):
    """Windows of (size, pieces) from the longest tier down; keeps less than the longest
    tier's tokens, unless these are the last."""
    most = pool.tiers[-1]
    while pool.tokens >= most:
        opening = pool.longest(most)
        size = pool.tier(opening)
        yield size, _window(pool, size)
    while last and pool.tokens:
        size = 1 << (pool.tokens.bit_length() - 1)
        yield size, _window(pool, size)


def _pack_task(batches, path, end_id, tiers, step_tokens):
    partition = TaskContext.get().partitionId() << 40
    most, pool = max(tiers), _Pool(tiers)
    windows = 0
    # Step groups by window size: number of the open group and its windows.
    groups, numbered = {}, 0
    rows = []

    def emit(size, pieces):
        nonlocal windows, numbered
        number, filled = groups.get(size, (None, 0))
        if number is None or filled + size > step_tokens:
            number, filled = numbered, 0
            numbered += 1
        groups[size] = number, filled + size
        offset = 0
        for (doc_id, doc_tokens), start, ids in pieces:
            rows.append(
                (doc_id, start, ids, doc_tokens, partition + windows, offset, size, partition + number)
            )
            offset += len(ids)
        windows += 1

    def flush(schema):
        columns = list(zip(*rows, strict=True)) or [()] * 8
        lengths = np.array([len(ids) for ids in columns[2]], dtype=np.int64)
        flat = np.concatenate(columns[2]) if rows else np.zeros(0, "<u4")
        arrays = [
            pa.array(columns[0], schema),
            pa.array(columns[1], pa.int64()),
            pa.array(lengths),
            binary_array(flat.astype("<u4"), np.concatenate([[0], np.cumsum(lengths)])),
            *(pa.array(values, pa.int64()) for values in columns[3:6]),
            pa.array(columns[6], pa.int32()),
            pa.array(columns[7], pa.int64()),
        ]
        rows.clear()
        return pa.RecordBatch.from_arrays(
            arrays,
            ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "window", "step_group"],
        )

    kind = pa.int64()
    for batch in batches:
        kind = batch.column(0).type
        doc_ids = batch.column(0).to_pylist()
        for row, texts in text_slices(batch.column(1), _SLICE):
            ids, counts = token_ids(path, texts)
            ends = np.cumsum(counts)
            for i, (count, end) in enumerate(zip(counts.tolist(), ends.tolist(), strict=True)):
                whole = np.append(ids[end - count : end], np.uint32(end_id))
                document = doc_ids[row + i], count + 1
                full = len(whole) // most * most
                for start in range(0, full, most):
                    emit(most, [(document, start, whole[start : start + most])])
                if full < len(whole):
                    pool.put((document, full, whole[full:]))
                if pool.tokens > _POOL_TOKENS:
                    for window in pack_pool(pool, last=False):
                        emit(*window)
            yield flush(kind)
    for window in pack_pool(pool, last=True):
        emit(*window)
    yield flush(kind)


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int = 1,
    tiers: tuple[int, ...] = TIERS,
    step_tokens: int = STEP_TOKENS,
) -> DataFrame:
    """Pieces of `docs` (doc_id, text): where each lies in its document and sequence.

    ids holds the piece's token ids as little-endian unsigned 32-bit integers; window is
    the sequence's length, which its pieces fill; step_group numbers sets of windows of
    one length with step_tokens tokens (fewer only in a task's last set of a length).
    """
    if any(tier & (tier - 1) for tier in tiers) or step_tokens < max(tiers):
        raise ValueError("tiers are powers of two up to step_tokens")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def task(batches):
        return _pack_task(batches, tokenizer_path, end_id, tiers, step_tokens)

    return docs.select("doc_id", "text").mapInArrow(task, _SCHEMA.format(kind=kind))
