"""Stupid-backoff language-model scores from n-gram counts of all other documents.

Documents are dealt into chunks, blocks of neighbouring rows at a time, so that equal rows
spread too. A chunk sends each different n-gram it holds once, with its own count, to the
bucket of the n-gram's hash; buckets add up the counts of all chunks, which makes the
count tables, and answer every chunk with the counts of the n-grams it has sent; a join by
chunk brings them to the documents, whose n-grams are looked up and summed. An n-gram that
every document holds is one entry for each chunk, so no bucket is hot. Bucket rows are
sorted hashes in one binary value.

A document is scored by what the others say: every count is the whole corpus' count less
the document's own, so a word backs off where its n-gram occurs in no other document.

    S(w | context) = count(context w) / count(context)       if it occurs elsewhere
                   = ALPHA * S(w | context without its first word)   otherwise
    S(w) = count(w) / N             if the word occurs elsewhere (N: words of the others)
         = ALPHA / (N + 1)          otherwise

N-grams lie inside documents; hashes have 60 bits.

Defined cases: null and empty texts have no words, score 0 and no mean; each row is a
document, so a repeated row finds its own n-grams in its copies; a null doc_id is a document
like any other; the only document of a table is scored with N = 0; an empty table gives no
rows; other columns are not read. `docs` is read twice and must give its rows in the same
order, as a scan of files does.
"""

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.llm.common import Words, one_array, release_memory

ORDER = 3
ALPHA = 0.4
CHUNK_BYTES = 12_000_000
BUCKET_BYTES = 8_000_000

# Rows that are dealt together, as a power of two.
_BLOCK_BITS = 7
_HASH_BITS = 60
_U = np.uint64
_REQUEST = "bucket int, chunk long, n int, grams binary, counts binary"
_ANSWER = "chunk long, bucket int, n int, counts binary"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


class _Grams:
    """Hashes of a chunk's n-grams: of[n][i] is the n-gram that ends in word i, where
    place[i], the words before it in its text, is at least n - 1."""

    def __init__(self, texts: pa.Array, order: int):
        words = Words(texts)
        self.n_texts, self.text, self.counts = len(texts), words.text.astype(np.int32), words.counts
        self.place = np.arange(len(words)) - words.first[words.text]
        hashes = np.zeros(0, _U)
        if len(words):
            index, distinct = words.encoded()
            hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in distinct.to_pylist()], _U)[index]
        whole = {1: hashes}
        for n in range(2, order + 1):
            longer = hashes.copy()
            longer[1:] = _mix(whole[n - 1][:-1] * _U(0x9E3779B97F4A7C15) + hashes[1:] + _U(n))
            whole[n] = longer
        self.of = {n: h >> _U(64 - _HASH_BITS) for n, h in whole.items()}

    def __len__(self):
        return len(self.text)

    def whole(self, n: int) -> np.ndarray:
        return self.place >= n - 1


def _planes(values: np.ndarray) -> np.ndarray:
    """Lowest bytes of all values, then their second bytes, and so on."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)


def _values(planes: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(planes.reshape(8, -1).T).view("<u8").ravel()


def _packed(counts: np.ndarray) -> bytes:
    """Counts, most of which are small and alike."""
    return zlib.compress(_planes(counts), 1)


def _unpacked(blob: bytes) -> np.ndarray:
    return _values(np.frombuffer(zlib.decompress(blob), np.uint8)).astype(np.int64)


def _sorted_packed(grams: np.ndarray) -> bytes:
    """Sorted hashes as differences: their low five bytes as they are, the rest, in which
    there is little, compressed."""
    planes = _planes(np.diff(grams, prepend=_U(0)))
    return planes[:5].tobytes() + zlib.compress(planes[5:], 1)


def _sorted_unpacked(blob: bytes, size: int) -> np.ndarray:
    rest = zlib.decompress(memoryview(blob)[5 * size :])
    steps = np.concatenate([np.frombuffer(blob, np.uint8, 5 * size), np.frombuffer(rest, np.uint8)])
    return np.cumsum(_values(steps), dtype=_U)


def _requests(chunk: int, n: int, grams: np.ndarray, counts: np.ndarray, buckets: int):
    """Rows of the sorted n-grams; a bucket is a range of hashes."""
    bucket = ((grams >> _U(_HASH_BITS - 32)) * _U(buckets) >> _U(32)).astype(np.int64)
    edges = np.searchsorted(bucket, np.arange(buckets + 1))
    return [
        (b, chunk, n, _sorted_packed(grams[low:high]), _packed(counts[low:high]))
        for b, (low, high) in enumerate(zip(edges, edges[1:], strict=False))
        if low < high
    ]


def _table(rows, schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    arrays = [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields, strict=True)]
    return pa.Table.from_arrays(arrays, [name for name, _ in fields])


def _requests_of(table: pa.Table, order: int, buckets: int) -> pa.Table:
    chunk = table["chunk"][0].as_py()
    grams = _Grams(_texts(table), order)
    # The empty n-gram's count is the number of words.
    rows = [(0, chunk, 0, _sorted_packed(np.zeros(1, _U)), _packed(np.array([len(grams)])))]
    for n in range(1, order + 1):
        rows += _requests(chunk, n, *np.unique(grams.of.pop(n)[grams.whole(n)], return_counts=True), buckets)
    release_memory()
    return _table(rows, _REQUEST)


def _texts(table: pa.Table) -> pa.Array:
    return one_array(table["text"]).cast(pa.large_string())


def _answers(table: pa.Table) -> pa.Table:
    """Counts over all chunks of the n-grams of a bucket, for each row in its order."""
    rows = []
    bucket = table["bucket"][0].as_py()
    for n in np.unique(table["n"].to_numpy()).tolist():
        part = table.filter(pc.equal(table["n"], n))
        counts = [_unpacked(blob.as_py()) for blob in part["counts"]]
        asked = [
            _sorted_unpacked(blob.as_py(), len(own))
            for blob, own in zip(part["grams"], counts, strict=True)
        ]
        counts = np.concatenate(counts)
        _, back = np.unique(np.concatenate(asked), return_inverse=True)
        total = np.bincount(back, counts).astype(np.int64)[back]
        ends = np.cumsum([len(a) for a in asked])
        for chunk, end, size in zip(part["chunk"].to_pylist(), ends, map(len, asked), strict=True):
            rows.append((chunk, bucket, n, _packed(total[end - size : end])))
    release_memory()
    return _table(rows, _ANSWER)


class _Counts:
    """Counts of a chunk's n-grams in other documents, from the answers it has got."""

    def __init__(self, grams: _Grams, answers: pa.Table):
        self.grams = grams
        self.answers: dict[int, list] = {}
        order = pc.sort_indices(answers, [("n", "ascending"), ("bucket", "ascending")])
        answers = answers.take(order)
        for n, blob in zip(answers["n"].to_pylist(), answers["counts"], strict=True):
            self.answers.setdefault(n, []).append(_unpacked(blob.as_py()))
        self.words = int(self.answers[0][0][0]) - grams.counts[grams.text]

    def of(self, n: int) -> np.ndarray:
        """Count in other documents of the n-gram that ends in each word, 0 where none does."""
        count = np.zeros(len(self.grams), np.int64)
        whole = np.flatnonzero(self.grams.whole(n))
        if len(whole):
            # Each order is asked for once.
            _, back = np.unique(self.grams.of.pop(n)[whole], return_inverse=True)
            own = self.grams.text[whole].astype(np.int64) * (back.max() + 1) + back
            _, place, times = np.unique(own, return_inverse=True, return_counts=True)
            count[whole] = np.concatenate(self.answers.pop(n))[back] - times[place]
        return count


def _scores(texts: pa.Table, answers: pa.Table, order: int, alpha: float) -> pa.Table:
    grams = _Grams(_texts(texts), order)
    score = np.zeros(len(grams))
    full, unseen = np.zeros((2, len(grams)), dtype=bool)
    if len(grams):
        counts = _Counts(grams, answers)
        before = counts.of(1)
        unseen = before == 0
        ratio = np.where(unseen, alpha / (counts.words + 1), before / np.maximum(counts.words, 1))
        for n in range(2, order + 1):
            whole, count, context = grams.whole(n), counts.of(n), np.zeros(len(grams), np.int64)
            context[1:] = before[:-1]
            full = count > 0
            ratio = np.where(full, count / np.maximum(context, 1), np.where(whole, alpha * ratio, ratio))
            before = count
        score = np.log(ratio)
    sums = [np.bincount(grams.text, flags, grams.n_texts).astype(np.int64) for flags in (full, unseen)]
    total = np.bincount(grams.text, score, grams.n_texts)
    release_memory()
    return pa.Table.from_arrays(
        [one_array(texts["doc_id"]), *map(pa.array, (grams.counts, *sums, total))],
        ["doc_id", "n_words", "n_full", "n_unseen", "log_score"],
    )


def score(docs: DataFrame, order: int = ORDER, alpha: float = ALPHA) -> DataFrame:
    """doc_id, n_words, n_full (words scored by an n-gram of the full order), n_unseen (words
    of no other document) and log_score (sum of the natural logarithms of S) of `docs`
    (doc_id, text)."""
    if order < 2:
        raise ValueError("the order is at least 2")
    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.coalesce("text", F.lit(""))
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    chunks, buckets = size // CHUNK_BYTES + 1, size // BUCKET_BYTES + 1
    block = F.shiftright(F.monotonically_increasing_id(), _BLOCK_BITS)
    chunk = F.pmod(F.xxhash64(block), F.lit(chunks)).alias("chunk")
    dealt = docs.select(chunk, "doc_id", text.alias("text"))

    def first(table: pa.Table) -> pa.Table:
        return _requests_of(table, order, buckets)

    requests = dealt.groupBy("chunk").applyInArrow(first, _REQUEST)
    answers = requests.groupBy("n", "bucket").applyInArrow(_answers, _ANSWER)

    def last(texts: pa.Table, got: pa.Table) -> pa.Table:
        return _scores(texts, got, order, alpha)

    schema = f"doc_id {kind}, n_words long, n_full long, n_unseen long, log_score double"
    return dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(last, schema)
