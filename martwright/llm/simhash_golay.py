"""SimHash near-duplicates found by Golay-code fuzzy hashing.

Two fingerprints that differ in at most three bits have a half of 32 bits with at most
one differing bit, and then one of the other half's four bytes is equal. A half is split
into 23 bits and 9. The 23 bits are decoded with the perfect binary Golay code: a stored
fingerprint is filed under the codeword nearest to it, and a probing one looks under every
codeword within four bits of it, one or six of them. With at most one bit between the two,
the stored one's codeword is among the probed ones. So a stored key is (half, byte,
codeword, the 9 bits), and a second kind of key, (half, byte, the 23 bits), serves halves
that differ in the 9 bits. Key matches are joined and their distance is counted.

Equal fingerprints are one row with the smallest doc_id, so copies are never paired. Joins
of what grows with the documents are always sort-merge joins: Spark sizes keys like the
fingerprints they are made of, and stored rows by their compressed files, and would send
both whole through the driver. Adaptive execution splits a key that many fingerprints share,
and the distance is part of the join's condition, so no unverified pair leaves it.

Defined cases: null and empty texts have fingerprint zero; a null doc_id is never a
component's name unless all of its component's are null; repeated rows are returned as
often as given; an empty table gives no rows; other columns are not read.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.llm.common import Words, stored, text_slices
from martwright.llm.components import components

MAX_BITS = 3
SEED = 42

# The [23, 12, 7] Golay code: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1 (fixed value).
_GENERATOR = 0b110001110101
_N, _CHECK = 23, 11
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _syndromes(words: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words by the generator polynomial."""
    rest = words.copy()
    for bit in range(_N - 1, _CHECK - 1, -1):
        rest ^= np.where(rest >> bit & 1, _GENERATOR << (bit - _CHECK), 0)
    return rest


class Golay:
    """Nearest codewords, and all codewords within four bits, of 23-bit words."""

    def __init__(self):
        bits = [1 << i for i in range(_N)]
        errors = [0, *bits]
        errors += [a | b for i, a in enumerate(bits) for b in bits[:i]]
        errors += [
            a | b | c for i, a in enumerate(bits) for j, b in enumerate(bits[:i]) for c in bits[:j]
        ]
        errors = np.array(errors, dtype=np.int64)
        # Perfect code: every syndrome has exactly one error of at most three bits.
        self.error = np.zeros(1 << _CHECK, np.int64)
        self.error[_syndromes(errors)] = errors
        messages = np.arange(1 << (_N - _CHECK), dtype=np.int64) << _CHECK
        codewords = messages ^ _syndromes(messages)
        sevens = codewords[np.bitwise_count(codewords) == 7]
        # A word three bits from its codeword is four from five others: those that differ
        # from it by a codeword of weight seven that covers the three bits.
        self.others = np.zeros((1 << _CHECK, 5), np.int64)
        for syndrome, error in enumerate(self.error):
            if int(error).bit_count() == 3:
                self.others[syndrome] = sevens[(sevens & error) == error]

    def nearest(self, words: np.ndarray) -> np.ndarray:
        return (words ^ self.error[_syndromes(words)]) >> _CHECK

    def within_four(self, words: np.ndarray) -> np.ndarray:
        """Six columns of message numbers, -1 where there are no more."""
        syndrome = _syndromes(words)
        codeword = words ^ self.error[syndrome]
        more = (codeword[:, None] ^ self.others[syndrome]) >> _CHECK
        more[self.others[syndrome] == 0] = -1
        return np.concatenate([(codeword >> _CHECK)[:, None], more], axis=1)


_golay: Golay | None = None


def golay() -> Golay:
    global _golay
    if _golay is None:
        _golay = Golay()
    return _golay


def fingerprints(texts: pa.Array, shingle: int) -> np.ndarray:
    """Unsigned fingerprints of texts whose letters A-Z are taken as lower case."""
    words = Words(texts)
    data = _LOWER[words.data]
    # Words with one space between them; positions of each word in that.
    keep = ~words.space
    keep[words.ends[words.ends < len(data)]] = True
    ends = np.cumsum(words.ends - words.starts + 1) - 1
    starts = ends - (words.ends - words.starts)
    joined = np.full(int(ends[-1]) + 1 if len(ends) else 0, 0x20, np.uint8)
    inside = np.ones(len(joined), dtype=bool)
    inside[ends] = False
    joined[inside] = data[~words.space]
    buffer = memoryview(joined)
    digest = xxhash.xxh64_intdigest
    result = np.zeros(len(texts), np.uint64)
    begins, finishes, n = starts.tolist(), ends.tolist(), shingle
    for row in np.flatnonzero(words.counts):
        first, last = words.first[row], words.first[row + 1]
        size = max(last - first - n + 1, 1)
        hashes = np.array(
            [
                digest(buffer[begins[i] : finishes[min(i + n, last) - 1]], SEED)
                for i in range(first, first + size)
            ],
            dtype=">u8",
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
        over = 2 * bits.sum(axis=0, dtype=np.int64) > size
        result[row] = np.packbits(over).view(">u8")[0]
    return result


def _keys(fingerprints: np.ndarray, probing: bool) -> tuple[np.ndarray, np.ndarray]:
    """(row of the fingerprint, key) pairs."""
    code, rows, keys = golay(), [], []
    for half in range(2):
        own = (fingerprints >> np.uint64(32 * half)).astype(np.int64) & 0xFFFFFFFF
        other = (fingerprints >> np.uint64(32 * (1 - half))).astype(np.int64) & 0xFFFFFFFF
        word, rest = own >> 9, own & 0x1FF
        near = code.within_four(word) if probing else code.nearest(word)[:, None]
        fuzzy = np.where(near >= 0, near << 9 | rest[:, None], -1)
        for byte in range(4):
            tag = (half << 2 | byte) << 8 | (other >> (8 * byte) & 0xFF)
            row, column = np.nonzero(fuzzy >= 0)
            rows.append(row)
            keys.append(tag[row] << 24 | fuzzy[row, column])
            rows.append(np.arange(len(fingerprints)))
            keys.append(tag << 24 | 1 << 23 | word)
    return np.concatenate(rows), np.concatenate(keys)


def _key_task(probing: bool):
    def task(batches):
        for batch in batches:
            # Fingerprints are kept as signed longs.
            prints = batch.column(0).to_numpy().view(np.uint64)
            for first in range(0, len(prints), 20_000):
                part = prints[first : first + 20_000]
                rows, keys = _keys(part, probing)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), pa.array(part[rows].view(np.int64))], ["key", "print"]
                )

    return task


def _text_key() -> Column:
    return F.xxhash64("text").alias("text_key")


def fingerprint_table(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id, print, the fingerprint as a signed long, and text_key, a hash of the text, of
    `docs` (doc_id, text)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def task(batches):
        for batch in batches:
            for row, texts in text_slices(batch.column(1)):
                prints = fingerprints(texts, shingle).view(np.int64)
                ids, keys = (batch.column(i).slice(row, len(texts)) for i in (0, 2))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(prints), keys], ["doc_id", "print", "text_key"]
                )

    rows = docs.select("doc_id", "text", _text_key())
    return rows.mapInArrow(task, f"doc_id {kind}, print long, text_key long")


def _shuffled(side: DataFrame) -> DataFrame:
    """A join's side that is never broadcast, whatever size Spark takes it for."""
    return side.hint("shuffle_merge")


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs (u, v), u < v, of the distinct fingerprints `print` within max_bits bits."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"the keys cover up to {MAX_BITS} bits")
    filed = prints.select("print").mapInArrow(_key_task(False), "key long, print long")
    probes = prints.select("print").mapInArrow(_key_task(True), "key long, print long")
    filed = filed.select("key", F.col("print").alias("u"))
    probes = probes.select("key", F.col("print").alias("v"))
    near = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits
    found = _shuffled(filed).join(probes, (filed.key == probes.key) & (F.col("u") < F.col("v")) & near)
    return found.select("u", "v").distinct()


def _members(docs: DataFrame, shingle: int, max_bits: int) -> DataFrame:
    """Fingerprint table with component (of fingerprints) and component_id (of documents)."""
    table = stored(fingerprint_table(docs, shingle), "fingerprints")
    classes = stored(table.groupBy("print").agg(F.min("doc_id").alias("first")), "classes")
    nodes = components(links(classes, max_bits))
    member = classes.join(_shuffled(nodes.withColumnRenamed("node", "print")), "print", "left")
    member = member.withColumn("component", F.coalesce("component", "print"))
    names = member.groupBy("component").agg(F.min("first").alias("component_id"))
    named = stored(member.join(_shuffled(names), "component").select("print", "component", "component_id"), "members")
    return table.join(_shuffled(named), "print")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, print and component_id (smallest doc_id reachable by links) of `docs`."""
    return _members(docs, shingle, max_bits).select("doc_id", "print", "component_id")


def keep_first(docs: DataFrame, shingle: int = 3, max_bits: int = MAX_BITS) -> DataFrame:
    """One row, with all its columns, of each component of `docs`: of the smallest doc_id, and
    of several such rows the least by fingerprint and text hash, or by all columns if the text
    is the same. Rows of one doc_id in different components are chosen each for itself. Rows
    without a doc_id cannot be named and stay."""
    names = docs.columns
    found = _members(docs, shingle, max_bits).filter("doc_id is not null")
    least = found.groupBy("component").agg(F.min(F.struct("doc_id", "print", "text_key")).alias("least"))
    first = stored(least.select("least.doc_id", "least.text_key"), "kept")
    rows = docs.select("doc_id", _text_key(), F.struct(*names).alias("row"))
    named = rows.join(_shuffled(first), ["doc_id", "text_key"], "left_semi")
    one = named.groupBy("doc_id", "text_key").agg(F.min("row").alias("row"))
    return one.select("row.*").unionByName(docs.filter("doc_id is null"))
