"""Substring deduplication on a sparse de Bruijn graph of words.

A window of WINDOW words is an edge between its first and its last WINDOW - 1 words.
Every window is represented by its anchor: the k-mer of words in it with the least hash,
the leftmost of equals, which depends on the window's words alone. Consecutive windows of
a document with one anchor make a segment, a nonbranching stretch of the graph as far as
that document can tell, and equal windows always lie in segments with equal anchors. So:

1. Segments are counted by anchor, with partial counts before the shuffle. An anchor seen
   once has only windows that are not repeated, and that is where most text ends.
2. A join brings the repeated anchors back to the segments. Where all segments of an
   anchor are equal, the path does not branch and all of its windows are repeated.
3. Where they differ, each different segment is unfolded once, at one of its source
   coordinates, into its windows' 128-bit hashes. Windows are counted with the number of
   places of their segment and those counted twice or more go back to it as a bit mask.
4. Coordinates of repeated windows are joined to their documents and the words that they
   cover are removed.

A passage that many documents share is one row in steps 3 and 4 until its coordinates are
needed; joins on anchors and segments have no hint, so adaptive execution splits those
that a third of all rows share. Tables between steps are written to the shared folder.

Defined cases: null and empty texts have no words; a text shorter than a window is kept;
rows with the same doc_id and text are separate documents, so their windows are repeated;
a null doc_id is a document like any other; an empty table gives no rows.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from martwright.llm.common import Words, binary_array, stored, text_slices

WINDOW = 35
ANCHOR = 8

_U = np.uint64
# Odd multipliers of two rolling hashes and of the final mixing.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_MIXERS = (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(33))) * _U(_MIXERS[0])
    x = (x ^ (x >> _U(33))) * _U(_MIXERS[1])
    return x ^ (x >> _U(33))


class _Rolling:
    """Hashes of word sequences at any place, equal for equal words."""

    def __init__(self, hashes: np.ndarray, which: int):
        n = len(hashes)
        base = _BASES[which]
        powers = np.full(n, base, _U)
        inverse = np.full(n, pow(base, -1, 1 << 64), _U)
        if n:
            powers[0] = inverse[0] = 1
        powers, self.inverse = np.multiply.accumulate(powers), np.multiply.accumulate(inverse)
        self.sums = np.zeros(n + 1, _U)
        own = hashes if which == 0 else _mix(hashes + _U(which))
        np.cumsum(own * powers, out=self.sums[1:])

    def at(self, starts, length) -> np.ndarray:
        return _mix((self.sums[starts + length] - self.sums[starts]) * self.inverse[starts])


class _Text:
    """Words of some texts, their hashes and the starts of whole windows."""

    def __init__(self, texts: pa.Array, window: int):
        self.words = Words(texts)
        self.hashes = np.zeros(0, _U)
        if len(self.words):
            index, distinct = self.words.encoded()
            self.hashes = np.array(
                [xxhash.xxh3_64_intdigest(word) for word in distinct.to_pylist()], _U
            )[index]
        text = self.words.text
        self.whole = np.flatnonzero(text[window - 1 :] == text[: max(len(text) - window + 1, 0)])


def _segments(text: _Text, window: int, anchor: int):
    """First window, number of windows, anchor hash and content hash of each segment."""
    whole = text.whole
    if not len(whole):
        none = np.zeros(0, np.int64)
        return none, none, none, none
    rolling = _Rolling(text.hashes, 0)
    least = rolling.at(np.arange(len(text.hashes) - anchor + 1), anchor)
    place = np.arange(len(least), dtype=np.int64)

    def narrower(least, place, step):
        """Of each k-mer and the one `step` further, the lesser, the left if equal."""
        left = least[:-step] <= least[step:]
        return np.where(left, least[:-step], least[step:]), np.where(left, place[:-step], place[step:])

    span, covered = window - anchor + 1, 1
    while covered * 2 <= span:
        least, place = narrower(least, place, covered)
        covered *= 2
    if covered < span:
        least, place = narrower(least, place, span - covered)
    own = place[whole]
    # A window's anchor lies in its text, so another text has other places.
    begins = np.flatnonzero(np.diff(own, prepend=-1))
    counts = np.diff(begins, append=len(whole))
    first = whole[begins]
    content = rolling.at(first, counts + window - 1)
    return first, counts, least[first], content


def _occurrences(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """A row for each segment: document, place, number of windows, anchor, content."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def task(batches):
        for batch in batches:
            for row, texts in text_slices(batch.column(2)):
                text = _Text(texts, window)
                first, counts, anchors, content = _segments(text, window, anchor)
                owner = text.words.text[first] if len(first) else first
                rows = pa.array(owner + row)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(rows),
                        batch.column(1).take(rows),
                        pa.array((first - text.words.first[owner]).astype(np.int64)),
                        pa.array(counts.astype(np.int32)),
                        pa.array(anchors.view(np.int64)),
                        pa.array(content.view(np.int64)),
                    ],
                    ["doc_id", "text_key", "place", "windows", "anchor", "content"],
                )

    schema = f"doc_id {kind}, text_key long, place long, windows int, anchor long, content long"
    return docs.select("doc_id", "text_key", "text").mapInArrow(task, schema)


def _unfolded(docs: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """Window hashes of the wanted segments (doc_id, text_key, place, windows, ...)."""
    lists = wanted.groupBy("doc_id", "text_key").agg(
        F.collect_list(F.struct("place", "windows", "anchor", "content", "places")).alias("own")
    )
    same = docs.doc_id.eqNullSafe(lists.doc_id) & (docs.text_key == lists.text_key)
    # Of equal rows one is enough.
    texts = docs.join(lists, same).select(docs.text, "own")

    def task(batches):
        for batch in batches:
            own = batch.column(1)
            for row, texts in text_slices(batch.column(0)):
                text = _Text(texts, window)
                part = own.slice(row, len(texts))
                sizes = part.value_lengths().to_numpy()
                flat = part.flatten()
                column = {name: flat.field(name).to_numpy() for name in ("place", "windows", "anchor", "content", "places")}
                first = text.words.first[np.repeat(np.arange(len(texts)), sizes)] + column["place"]
                counts = column["windows"].astype(np.int64)
                at = np.repeat(np.arange(len(counts)), counts)
                offset = np.arange(len(at)) - np.repeat(np.cumsum(counts) - counts, counts)
                starts = first[at] + offset
                hashes = [_Rolling(text.hashes, i).at(starts, window).view(np.int64) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(pa.array(x) for x in hashes),
                        pa.array(column["anchor"][at]),
                        pa.array(column["content"][at]),
                        pa.array(offset.astype(np.int32)),
                        pa.array(column["places"][at]),
                    ],
                    ["w1", "w2", "anchor", "content", "offset", "places"],
                )

    schema = "w1 long, w2 long, anchor long, content long, offset int, places long"
    return texts.mapInArrow(task, schema)


def repeated_windows(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """Coordinates of repeated windows in `docs` (doc_id, text_key, text): the windows at
    place + bit for each bit set in mask, a segment a row."""
    if not 0 < anchor <= window or window - anchor + 1 > 62:
        raise ValueError("an anchor fits into a window, and a segment into a mask")
    found = _occurrences(docs, window, anchor)
    anchors = found.groupBy("anchor").agg(
        F.count("*").alias("n"), F.min("content").alias("low"), F.max("content").alias("high")
    )
    anchors = stored(
        anchors.filter("n > 1").select("anchor", (F.col("low") != F.col("high")).alias("branches")),
        "anchors",
    )
    # The same segments once more, with what is known of their anchors.
    places = stored(found.join(anchors, "anchor"), "segments")
    all_bits = F.expr("shiftleft(1L, windows) - 1").alias("mask")
    keys = ("doc_id", "text_key", "place")
    straight = places.filter("not branches").select(*keys, all_bits)
    branching = places.filter("branches")
    segments = branching.groupBy("anchor", "content").agg(
        F.count("*").alias("places"), F.min(F.struct(*keys, "windows")).alias("source")
    )
    segments = segments.select("anchor", "content", "places", "source.*")
    windows = stored(_unfolded(docs, segments, window), "windows")
    twice = windows.groupBy("w1", "w2").agg(F.sum("places").alias("n")).filter("n > 1")
    twice = stored(twice.select("w1", "w2"), "repeated")
    masks = windows.join(twice, ["w1", "w2"]).groupBy("anchor", "content")
    masks = stored(masks.agg(F.bit_or(F.expr("shiftleft(1L, offset)")).alias("mask")), "masks")
    branched = branching.join(masks, ["anchor", "content"]).select(*keys, "mask")
    return straight.unionByName(branched)


def _removal_task(window: int, bits: int):
    def task(batches):
        for batch in batches:
            for row, texts in text_slices(batch.column(0)):
                words = Words(texts)
                own = batch.column(1).slice(row, len(texts))
                sizes = np.nan_to_num(
                    own.value_lengths().to_numpy(zero_copy_only=False).astype(float)
                ).astype(np.int64)
                flat = own.flatten()
                place, mask = flat.field("place").to_numpy(), flat.field("mask").to_numpy()
                first = words.first[np.repeat(np.arange(len(texts)), sizes)] + place
                edge = np.zeros(len(words) + 1, np.int64)
                for bit in range(bits):
                    starts = first[mask >> bit & 1 == 1] + bit
                    np.add.at(edge, starts, 1)
                    np.add.at(edge, starts + window, -1)
                removed = np.cumsum(edge)[:-1] > 0
                carried = [column.slice(row, len(texts)) for column in batch.columns[2:]]
                yield _kept_batch(carried, words, removed)

    return task


def _kept_batch(carried, words: Words, removed: np.ndarray):
    """Kept words joined by one space, and the removed ranges of words."""
    n = len(words.counts)
    kept = np.flatnonzero(~removed)
    per_text = np.bincount(words.text[kept], minlength=n)
    lengths = (words.ends - words.starts)[kept]
    # A space follows each kept word but the last of its text.
    last = np.cumsum(per_text)[per_text > 0] - 1
    sizes = lengths + 1
    sizes[last] -= 1
    ends = np.cumsum(sizes)
    joined = np.full(int(ends[-1]) if len(ends) else 0, 0x20, np.uint8)
    inside = np.ones(len(joined), dtype=bool)
    spaced = np.ones(len(kept), dtype=bool)
    spaced[last] = False
    inside[ends[spaced] - 1] = False
    stays = np.zeros(len(words.data) + 1, np.int64)
    np.add.at(stays, words.starts[kept], 1)
    np.add.at(stays, words.ends[kept], -1)
    joined[inside] = words.data[np.cumsum(stays)[:-1] > 0]
    edges = np.concatenate([[0], np.cumsum(np.bincount(words.text[kept], sizes, n).astype(np.int64))])
    text = binary_array(joined, edges).cast(pa.string())
    padded = np.concatenate([[False], removed, [False]])
    new_text = np.zeros(len(words) + 1, dtype=bool)
    new_text[words.first] = True
    begin = np.flatnonzero(padded[1:-1] & (~padded[:-2] | new_text[:-1]))
    end = np.flatnonzero(padded[1:-1] & (~padded[2:] | new_text[1:])) + 1
    owner = words.text[begin] if len(begin) else begin
    spans = pa.ListArray.from_arrays(
        pa.array(np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)),
        pa.StructArray.from_arrays(
            [pa.array(begin - words.first[owner]), pa.array(end - begin)], names=["place", "length"]
        ),
    )
    return pa.RecordBatch.from_arrays(
        [pa.array(words.counts), pa.array(words.counts - per_text), text, spans, *carried],
        ["n_words", "n_removed", "kept", "spans", *(f"carried_{i}" for i in range(len(carried)))],
    )


def _with_text_key(docs: DataFrame, *carried: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    more = (F.col(name).alias(f"carried_{i}") for i, name in enumerate(carried))
    return docs.select("doc_id", F.xxhash64(text).alias("text_key"), text.alias("text"), *more)


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, carry: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """n_words, n_removed, kept (remaining words joined by one space) and spans (removed
    ranges of words) of `docs` (doc_id, text), as a struct `result` beside the columns of
    `docs` named in carry."""
    keyed = _with_text_key(docs, *carry)
    found = repeated_windows(_with_text_key(docs), window, anchor).groupBy("doc_id", "text_key")
    # Copies of a row say the same, once.
    lists = found.agg(F.collect_set(F.struct("place", "mask")).alias("own"))
    same = keyed.doc_id.eqNullSafe(lists.doc_id) & (keyed.text_key == lists.text_key)
    names = [f"carried_{i}" for i in range(len(carry))]
    texts = keyed.join(lists, same, "left").select(keyed.text, "own", *names)
    results = ("n_words", "n_removed", "kept", "spans")
    schema = StructType(
        [
            StructField("n_words", LongType()),
            StructField("n_removed", LongType()),
            StructField("kept", StringType()),
            StructField("spans", ArrayType(StructType([StructField(n, LongType()) for n in ("place", "length")]))),
            *(StructField(a, docs.schema[b].dataType) for a, b in zip(names, carry, strict=True)),
        ]
    )
    cleaned = texts.mapInArrow(_removal_task(window, window - anchor + 1), schema)
    back = (F.col(a).alias(b) for a, b in zip(names, carry, strict=True))
    return cleaned.select(*back, F.struct(*results).alias("result"))
