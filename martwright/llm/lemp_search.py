"""Ranked lexical search by buckets of vectors of like length.

A document is a vector of impacts over the items' terms, an item a vector of weights, a
score their inner product. Vectors are ordered by length (range partitions, longest
first) and cut into buckets. A task keeps the best documents of each item it has met, and
the score of the last of them, theta, prunes:

  * a whole bucket, where |item| * (its longest vector) < theta (Cauchy-Schwarz);
  * inside a bucket, coordinates are taken from the heaviest weight on until what the rest
    could add, bounded by the bucket's greatest impacts and by Cauchy-Schwarz, is less
    than theta: documents without one of these coordinates are out, and the others stay
    only if their part so far and the bound of their own rest reach theta.

Survivors are scored again in 64-bit integers over all coordinates. A bound prunes only
what lies strictly below theta, so ties are never lost. Thetas start from a share of about
SEEDS documents chosen by a hash, which are documents like any other.

Terms are the runs of ASCII letters and digits and of all characters beyond ASCII, A-Z
lower-cased. N documents hold a term, L terms in all, n in one document; a term lies in df
documents and tf times in one:

    weight  floor(1000 * ln((2 N + 2) / (2 df + 1)))
    impact  (1000000000 tf) div (1000 tf + 8 m),  m = 10 + ((90 n N) div L)

Items are read in blocks of at most BLOCK_TERMS terms (and one item at least), and a block
goes to every task. Documents are read once a block: a task reduces those it reads to their
entries of the block's terms, which are stored; counts of documents a term are summed
before they are shuffled; each task returns `top` documents an item at most, whatever it
reads. Equal vectors are spread over range partitions by their row's number.

Defined cases: null and empty texts have no terms and are neither counted nor found; an
item without terms, or whose terms no document holds, has no rows; equal scores go by
ascending doc_id, null first; repeated documents and items are taken as given, each for
itself; empty tables give no rows; other columns are not read.
"""

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martwright.llm.common import Words, buffers, gather, one_array, stored, text_slices

TOP = 10
BLOCK_TERMS = 200_000
BUCKET = 8192
SEEDS = 4096

# Separators become spaces, A-Z small letters; bytes beyond ASCII stay.
_TERM = np.arange(256, dtype=np.uint8)
_TERM[0x41:0x5B] += 32
_TERM[[c for c in range(0x80) if not chr(c).isalnum()]] = 0x20


def terms_of(texts: pa.Array) -> Words:
    """The terms of several texts, lower-cased."""
    data, offsets = buffers(texts)
    ends = pa.py_buffer(np.ascontiguousarray(offsets, np.int64))
    mapped = pa.py_buffer(np.ascontiguousarray(_TERM[data]))
    return Words(pa.Array.from_buffers(pa.large_binary(), len(texts), [None, ends, mapped]))


def _item_terms(text: str | None) -> list[bytes]:
    _, distinct = terms_of(pa.array([text or ""], pa.large_string())).encoded()
    return distinct.to_pylist()


def _blocks(items: DataFrame):
    """Lists of (item_id, terms)."""
    block, size = [], 0
    for row in items.select("item_id", "text").toLocalIterator():
        own = _item_terms(row.text)
        if block and size + len(own) > BLOCK_TERMS:
            yield block
            block, size = [], 0
        block.append((row.item_id, own))
        size += len(own)
    if block:
        yield block


def _entries(texts: pa.Array, vocabulary: pa.Array):
    """Terms a text, and (text, term, times) of the vocabulary's terms, by text and term."""
    words = terms_of(texts)
    if not len(words):
        none = np.zeros(0, np.int64)
        return words.counts, none, none, none
    index, distinct = words.encoded()
    known = pc.fill_null(pc.index_in(distinct, vocabulary), -1).to_numpy(zero_copy_only=False)
    term = known[index].astype(np.int64)
    held = term >= 0
    both, times = np.unique(words.text[held] * len(vocabulary) + term[held], return_counts=True)
    return words.counts, both // len(vocabulary), both % len(vocabulary), times


def _vectors(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """doc_id, n, terms and tfs of the documents that hold a term, stored with a number."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    known = pa.array(vocabulary, pa.large_binary())

    def reduced(batches):
        for batch in batches:
            for row, texts in text_slices(batch["text"]):
                ids = one_array(batch["doc_id"]).slice(row, len(texts))
                counts, text, term, times = _entries(texts, known)
                ends = pa.array(np.searchsorted(text, np.arange(len(texts) + 1)), pa.int32())
                lists = [
                    pa.ListArray.from_arrays(ends, pa.array(v.astype(np.int32))) for v in (term, times)
                ]
                rows = [ids, pa.array(counts.astype(np.int64)), *lists]
                names = ["doc_id", "n", "terms", "tfs"]
                yield pa.RecordBatch.from_arrays(rows, names).filter(pa.array(counts > 0))

    schema = f"doc_id {kind}, n long, terms array<int>, tfs array<int>"
    rows = docs.select("doc_id", "text").mapInArrow(reduced, schema)
    return stored(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")


class _Corpus:
    """Counts of the whole corpus that impacts and weights depend on."""

    def __init__(self, n_docs: int, n_terms: int):
        self.n_docs, self.n_terms = n_docs, n_terms

    def weight(self, df: int) -> int:
        return math.floor(1000 * math.log((2 * self.n_docs + 2) / (2 * df + 1)))

    def impacts(self, n: np.ndarray, tfs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        if len(n) and int(n.max()) * 90 * self.n_docs >= 2**63:
            n = n.astype(object)
        m = (10 + (90 * n * self.n_docs) // self.n_terms).astype(np.int64)
        tfs = tfs.astype(np.int64)
        return (1_000_000_000 * tfs) // (1000 * tfs + 8 * np.repeat(m, lengths))

    def norms(self, n: pa.Array, tfs: pa.Array) -> np.ndarray:
        n, tfs, lengths = _flat(n, tfs)
        impacts = self.impacts(n, tfs, lengths).astype(np.float64)
        return np.sqrt(np.bincount(np.repeat(np.arange(len(n)), lengths), impacts**2, len(n)))


def _flat(n: pa.Array, lists: pa.Array):
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    return n.to_numpy(zero_copy_only=False), pc.list_flatten(lists).to_numpy(zero_copy_only=False), lengths


class _Query:
    """An item's weights, heaviest first."""

    def __init__(self, item_id, terms, weights):
        order = np.lexsort((terms, -weights))
        order = order[weights[order] > 0]
        self.item_id, self.terms, self.weights = item_id, terms[order], weights[order]
        self.norm = float(np.sqrt((self.weights.astype(np.float64) ** 2).sum()))


# Bounds are floating point numbers; a little is added so that they stay bounds.
def _above(bound):
    return bound * (1 + 1e-9) + 1


def _from_here(values: np.ndarray) -> np.ndarray:
    """Sums of the values from each place to the end, and 0 at the end."""
    return np.append(np.cumsum(values[::-1])[::-1], 0)


class _Bucket:
    """Vectors of like length, by coordinate."""

    def __init__(self, ids: pa.Array, rows: pa.Array, n: pa.Array, terms: pa.Array, tfs: pa.Array, corpus: _Corpus):
        self.ids, self.rows = ids, rows
        n, tfs, self.lengths = _flat(n, tfs)
        self.terms = pc.list_flatten(terms).to_numpy(zero_copy_only=False)
        self.impacts = corpus.impacts(n, tfs, self.lengths)
        self.begins = np.cumsum(self.lengths) - self.lengths
        doc = np.repeat(np.arange(len(n)), self.lengths)
        order = np.argsort(self.terms, kind="stable")
        self.docs, self.by_term = doc[order], self.impacts[order]
        self.known, self.at = np.unique(self.terms[order], return_index=True)
        self.ends = np.append(self.at[1:], len(order))
        self.most = np.maximum.reduceat(self.by_term, self.at) if len(order) else self.at
        self.square = np.bincount(doc, self.impacts.astype(np.float64) ** 2, len(n))
        self.norm = float(np.sqrt(self.square.max(initial=0)))
        table = pa.table({"id": ids, "row": rows})
        keys = [("id", "ascending"), ("row", "ascending")]
        by_id = pc.sort_indices(table, sort_keys=keys, null_placement="at_start").to_numpy()
        self.place = np.empty(len(n), np.int64)
        self.place[by_id] = np.arange(len(n))

    def survivors(self, query: _Query, theta: int, scratch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents that may reach theta, and their scores."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if _above(query.norm * self.norm) < theta or not len(self.known):
            return none
        at = np.minimum(np.searchsorted(self.known, query.terms), len(self.known) - 1)
        there = self.known[at] == query.terms
        at, weights = at[there], query.weights[there]
        if not len(at):
            return none
        most = _from_here(weights * self.most[at])
        tail = np.sqrt(_from_here(weights.astype(np.float64) ** 2))
        rest = np.minimum(most, _above(tail * self.norm))
        focus = int((rest[:-1] >= max(theta, 1)).sum())
        if not focus:
            return none
        part = np.zeros(len(self.lengths), np.int64)
        square = np.zeros(len(self.lengths))
        for k in range(focus):
            entries = slice(self.at[at[k]], self.ends[at[k]])
            docs, impacts = self.docs[entries], self.by_term[entries]
            part[docs] += weights[k] * impacts
            square[docs] += impacts.astype(np.float64) ** 2
        found = np.flatnonzero(part)
        left = tail[focus] * np.sqrt(np.maximum(self.square[found] - square[found], 0))
        bound = part[found] + np.minimum(_above(left), most[focus])
        found = found[bound >= theta]
        # All coordinates of the survivors, as integers.
        scratch[query.terms] = query.weights
        lengths = self.lengths[found]
        entries = gather(np.arange(len(self.terms)), self.begins[found], lengths)
        scores = scratch[self.terms[entries]] * self.impacts[entries]
        scratch[query.terms] = 0
        ends = np.concatenate([[0], np.cumsum(scores)])
        total = np.cumsum(lengths)
        scores = ends[total] - ends[total - lengths]
        keep = scores >= max(theta, 1)
        return found[keep], scores[keep]


class _Best:
    """The best documents met so far of every item."""

    def __init__(self, queries: list[_Query], thetas: dict[int, int], top: int):
        self.queries, self.top = queries, top
        self.theta = [thetas.get(i, 0) for i in range(len(queries))]
        self.rows: list[list] = [[] for _ in queries]

    def add(self, bucket: _Bucket, scratch: np.ndarray) -> None:
        for i, query in enumerate(self.queries):
            found, scores = bucket.survivors(query, self.theta[i], scratch)
            order = np.lexsort((bucket.place[found], -scores))[: self.top]
            new = []
            for doc, score in zip(found[order].tolist(), scores[order].tolist(), strict=True):
                doc_id = bucket.ids[doc].as_py()
                new.append((-score, doc_id is not None, doc_id, bucket.rows[doc].as_py()))
            if new:
                # Ids are compared where both are given; the row's number differs at last.
                key = lambda r: (r[0], r[1], *((r[2],) if r[1] else ()), r[3])
                self.rows[i] = sorted(self.rows[i] + new, key=key)[: self.top]
                if len(self.rows[i]) == self.top:
                    self.theta[i] = max(self.theta[i], -self.rows[i][-1][0])

    def table(self, id_kind: pa.DataType, item_kind: pa.DataType) -> pa.RecordBatch:
        rows = [
            (i, query.item_id, doc_id, row, -score)
            for i, query in enumerate(self.queries)
            for score, _, doc_id, row in self.rows[i]
        ]
        columns = list(zip(*rows, strict=True)) or [()] * 5
        kinds = (pa.int32(), item_kind, id_kind, pa.int64(), pa.int64())
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, ["item", "item_id", "doc_id", "row", "score"])


def _searched(vectors: DataFrame, queries, size: int, corpus: _Corpus, thetas, top: int, item_type) -> DataFrame:
    """The best documents of each item among a task's vectors, which come longest first."""
    from pyspark.sql.pandas.types import to_arrow_type

    id_type = vectors.schema["doc_id"].dataType
    id_kind, item_kind = to_arrow_type(id_type), to_arrow_type(item_type)

    def best(batches):
        found, scratch = _Best(queries, thetas, top), np.zeros(size, np.int64)
        for batch in batches:
            for begin in range(0, len(batch), BUCKET):
                part = batch.slice(begin, BUCKET)
                columns = [one_array(part[c]) for c in ("doc_id", "row", "n", "terms", "tfs")]
                found.add(_Bucket(*columns, corpus), scratch)
        yield found.table(id_kind, item_kind)

    schema = (
        f"item int, item_id {item_type.simpleString()}, doc_id {id_type.simpleString()},"
        " row long, score long"
    )
    return vectors.select("doc_id", "row", "n", "terms", "tfs").mapInArrow(best, schema)


def _ranked(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def _block_results(docs: DataFrame, block, top: int, item_type) -> DataFrame | None:
    vocabulary = sorted({term for _, own in block for term in own})
    number = {term: i for i, term in enumerate(vocabulary)}
    vectors = _vectors(docs, vocabulary)
    n_docs, n_terms = vectors.agg(F.count("n"), F.sum("n")).first()
    if not n_docs or not vocabulary:
        return None
    corpus = _Corpus(n_docs, n_terms)
    # A row for each of the block's terms.
    counted = vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    weights = np.zeros(len(vocabulary), np.int64)
    for row in counted:
        weights[row.term] = corpus.weight(row["count"])
    queries = []
    for item_id, own in block:
        terms = np.array([number[t] for t in own], np.int64)
        queries.append(_Query(item_id, terms, weights[terms]))

    @F.arrow_udf("double")
    def norm(n: pa.Array, tfs: pa.Array) -> pa.Array:
        return pa.array(corpus.norms(n, tfs))

    size = len(vocabulary)
    held = vectors.filter(F.size("terms") > 0)
    share = -(-n_docs // SEEDS)
    seeds = held.filter(F.pmod(F.xxhash64("row"), F.lit(share)) == 0)
    # At most `top` rows an item.
    first = _ranked(_searched(seeds, queries, size, corpus, {}, top, item_type), top)
    thetas = {r.item: r.score for r in first.filter(F.col("rank") == top).collect()}
    longest = F.desc("norm")
    ordered = (
        held.withColumn("norm", norm("n", "tfs"))
        .repartitionByRange(longest, F.xxhash64("row"))
        .sortWithinPartitions(longest)
    )
    return _ranked(_searched(ordered, queries, size, corpus, thetas, top, item_type), top)


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the `top` best documents with a score
    above 0 of each row of `items` (item_id, text) among `docs` (doc_id, text)."""
    item_type = items.schema["item_id"].dataType
    parts = [_block_results(docs, block, top, item_type) for block in _blocks(items)]
    columns = ("item_id", "rank", "doc_id", "score")
    schema = (
        f"item_id {item_type.simpleString()}, rank int,"
        f" doc_id {docs.schema['doc_id'].dataType.simpleString()}, score long"
    )
    result = docs.sparkSession.createDataFrame([], schema)
    for part in parts:
        if part is not None:
            result = result.unionByName(part.select(*columns))
    return result
