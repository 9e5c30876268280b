"""Quality classifier: naive Bayes support vectors.

Features say which n-grams a text holds: words and word pairs (hashed), trigrams of
character classes (letters of one case, digits, white space; other ASCII characters stand
for themselves), and four-grams of "this word repeats the one before". Each indicator is
scaled by its class log-count ratio, a text's vector is scaled to length one, and a linear
hinge-loss model is fit by dual coordinate descent. Margins become scores by a logistic
curve fit to the training rows.

Only MAX_ROWS labelled rows at most are learned from, those whose doc_id hashes lowest, so
the choice does not depend on how the data lie. Scoring covers every row and is one pass
without a shuffle; nothing but the text goes into a score.

Defined cases: null and empty texts hold no n-gram and get the score of the intercept;
labels that are null, contradict each other for a document, or have no document are not
learned from; with labels of one class or none every score is 0.5; an empty table gives
no rows.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.llm.common import Words, release_memory, stored, text_slices

#: Labelled rows learned from at most.
MAX_ROWS = 12_000
MIN_ROWS_WITH_FEATURE = 5
EPOCHS = 10
# Features take many times their text's memory, so they are taken of smaller slices.
_SLICE = 1_000_000

_CLASSES = 40
_WORDS = 1 << 17
_FLAGS_AT = _CLASSES**3
_WORDS_AT = _FLAGS_AT + 16
_PAIRS_AT = _WORDS_AT + _WORDS
N_FEATURES = _PAIRS_AT + _WORDS

# Character classes: 0 white space, 1 a-z, 2 A-Z, 3 digit, 4 other control characters,
# 5 bytes beyond ASCII, from 6 on the ASCII marks in their order.
_CLASS_OF = np.full(256, 5, np.int32)
_CLASS_OF[:0x20] = 4
_CLASS_OF[0x7F] = 4
_MARKS = [c for c in range(0x21, 0x7F) if not chr(c).isalnum()]
_CLASS_OF[_MARKS] = 6 + np.minimum(np.arange(len(_MARKS)), _CLASSES - 7)
_CLASS_OF[ord("a") : ord("z") + 1] = 1
_CLASS_OF[ord("A") : ord("Z") + 1] = 2
_CLASS_OF[ord("0") : ord("9") + 1] = 3
_CLASS_OF[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0


def features(texts: pa.Array, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) pairs without repetition, by text; only wanted features if given."""
    words = Words(texts)
    rows, found = [], []
    codes = _CLASS_OF[words.data]
    held = np.zeros(_CLASSES**3, dtype=bool)
    for row, (begin, end) in enumerate(zip(words.offsets, words.offsets[1:], strict=False)):
        own = codes[begin:end]
        if len(own) > 2:
            held[:] = False
            held[(own[:-2] * _CLASSES + own[1:-1]) * _CLASSES + own[2:]] = True
            grams = np.flatnonzero(held)
            rows.append(np.full(len(grams), row, np.int32))
            found.append(grams.astype(np.int32))
    if len(words):
        index, distinct = words.encoded()
        hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in distinct.to_pylist()], np.uint64)
        own = hashes[index]
        rows.append(words.text.astype(np.int32))
        found.append(_WORDS_AT + (own % np.uint64(_WORDS)).astype(np.int32))
        same = words.text[1:] == words.text[:-1]
        pairs = (own[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ own[1:]) * np.uint64(0xD6E8FEB86659FD93)
        rows.append(words.text[1:][same].astype(np.int32))
        found.append(_PAIRS_AT + (pairs[same] >> np.uint64(47)).astype(np.int32))
        again = np.zeros(len(words), dtype=np.int64)
        again[1:] = same & (index[1:] == index[:-1])
        if len(words) > 3:
            grams = again[:-3] * 8 + again[1:-2] * 4 + again[2:-1] * 2 + again[3:]
            same = words.text[3:] == words.text[:-3]
            rows.append(words.text[3:][same].astype(np.int32))
            found.append(_FLAGS_AT + grams[same].astype(np.int32))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    rows, found = np.concatenate(rows), np.concatenate(found)
    if wanted is not None:
        keep = wanted[found]
        rows, found = rows[keep], found[keep]
    both = np.unique(rows.astype(np.int64) * N_FEATURES + found)
    return both // N_FEATURES, both % N_FEATURES


class Model:
    def __init__(self, ratio, weight, intercept, slope, shift):
        self.ratio, self.weight = ratio, weight
        self.intercept, self.slope, self.shift = intercept, slope, shift

    def score(self, column) -> np.ndarray:
        scores = []
        wanted = self.ratio != 0
        for _, texts in text_slices(column, _SLICE):
            rows, found = features(texts, wanted)
            ratio = self.ratio[found]
            length = np.sqrt(np.bincount(rows, ratio * ratio, len(texts)))
            dot = np.bincount(rows, ratio * self.weight[found], len(texts))
            scores.append(dot / np.maximum(length, 1e-12) + self.intercept)
        margin = np.concatenate(scores) if scores else np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30)))


def _platt(margin, good) -> tuple[float, float]:
    """Logistic curve through the margins by Newton's method, with smoothed targets."""
    n_good, n_bad = good.sum(), (~good).sum()
    target = np.where(good, (n_good + 1) / (n_good + 2), 1 / (n_bad + 2))
    slope, shift = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margin + shift, -30, 30)))
        error, spread = p - target, p * (1 - p) + 1e-9
        gradient = np.array([(error * margin).sum(), error.sum()])
        mixed = (spread * margin).sum()
        hessian = np.array([[(spread * margin**2).sum() + 1e-3, mixed], [mixed, spread.sum() + 1e-3]])
        step = np.linalg.solve(hessian, gradient)
        slope, shift = slope - step[0], shift - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return max(slope, 0.0), shift


def fit_rows(lists: list[np.ndarray], good: np.ndarray, c: float = 1.0, seed: int = 7) -> Model:
    """The model of rows given by their feature numbers and whether they are good."""
    none = np.zeros(N_FEATURES, np.float32)
    if not len(good) or good.all() or not good.any():
        return Model(none, none, 0.0, 0.0, 0.0)
    # Row by row, and with features only, so that the driver holds little.
    total, positive = np.zeros(N_FEATURES), np.zeros(N_FEATURES)
    for x, is_good in zip(lists, good, strict=True):
        total[x] += 1
        if is_good:
            positive[x] += 1
    p, q = 1.0 + positive, 1.0 + total - positive
    ratio = np.log(p / p.sum()) - np.log(q / q.sum())
    ratio[total < MIN_ROWS_WITH_FEATURE] = 0
    lists = [x[ratio[x] != 0] for x in lists]
    lengths = np.array([max(np.sqrt((ratio[x] ** 2).sum()), 1e-12) for x in lists])
    label = np.where(good, 1.0, -1.0)
    # Classes weigh alike.
    limit = c * len(good) / 2 / np.where(good, good.sum(), (~good).sum())
    weight, intercept = np.zeros(N_FEATURES), 0.0
    alpha = np.zeros(len(lists))
    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(lists)):
            x = lists[i]
            value = ratio[x] / lengths[i]
            gradient = label[i] * (value @ weight[x] + intercept) - 1
            # A vector has length one and the intercept's feature adds one.
            size = 2.0 if len(x) else 1.0
            new = min(max(alpha[i] - gradient / size, 0.0), limit[i])
            step = (new - alpha[i]) * label[i]
            if step:
                weight[x] += step * value
                intercept += step
                alpha[i] = new
    dots = (ratio[x] @ weight[x] for x in lists)
    margin = np.fromiter(dots, np.float64, len(lists)) / lengths + intercept
    slope, shift = _platt(margin, good)
    return Model(ratio.astype(np.float32), weight.astype(np.float32), intercept, slope, shift)


def is_held_out(doc_id: str = "doc_id") -> Column:
    """Documents never learned from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """Learn from `docs` (doc_id, text) that `labels` (doc_id, quality) marks 0 or 1.

    Of a doc_id with several rows the text that hashes lowest is learned from."""
    usable = labels.filter("quality in (0, 1) and doc_id is not null").filter(~is_held_out())
    agreed = usable.groupBy("doc_id").agg(F.min("quality").alias("good"), F.max("quality").alias("most"))
    agreed = agreed.filter("good = most").select("doc_id", "good")
    order = F.xxhash64("doc_id")
    there = stored(agreed.join(docs.select("doc_id"), "doc_id", "left_semi"), "labelled")
    # A few more rows than wanted (eight standard deviations) lie below this hash, so a task
    # sends only its share of them; the limit takes the rest off.
    share = min(1.0, (max_rows + 8 * max_rows**0.5 + 64) / max(there.count(), 1))
    below = min(int(share * 2**64) - 2**63, 2**63 - 1)
    # At most max_rows rows, so they may be broadcast.
    chosen = F.broadcast(there.filter(order <= below).orderBy(order, "doc_id").limit(max_rows))

    @F.arrow_udf("array<int>")
    def held(texts: pa.Array) -> pa.Array:
        values, ends = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)]
        for _, part in text_slices(texts, _SLICE):
            rows, found = features(part)
            values.append(found.astype(np.int32))
            ends.append(ends[-1][-1] + np.searchsorted(rows, np.arange(1, len(part) + 1)))
        offsets = pa.array(np.concatenate(ends), pa.int32())
        return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(values)))

    text = F.min_by("text", F.xxhash64("text")).alias("text")
    rows = docs.select("doc_id", "text").join(chosen, "doc_id").groupBy("doc_id").agg(F.first("good").alias("good"), text)
    table = rows.select(held("text").alias("features"), "good", order.alias("place"), "doc_id")
    # The driver lives on beside later work, so it holds the rows once and gives their memory back.
    # They stay as they came and are visited in order; a row's features are ascending.
    table = table.toArrow()
    places = pc.sort_indices(table, [("place", "ascending"), ("doc_id", "ascending")]).to_numpy()
    good = table["good"].to_numpy()[places] == 1
    lists = []
    for part in table["features"].chunks:
        ends, values = part.offsets.to_numpy(), part.values.to_numpy()
        lists += [values[a:b] for a, b in zip(ends, ends[1:], strict=False)]
    lists = [lists[i] for i in places]
    del table
    try:
        return fit_rows(lists, good)
    finally:
        del lists
        release_memory()


def score_column(model: Model, text: str = "text") -> Column:
    """Probability that a text is good."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(model.score(texts), pa.float64())

    return score.asNondeterministic()(F.col(text))


def keep_good(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """Rows of `docs`, with all their columns, whose text scores `least` at least."""
    names = docs.columns
    added = "score_" + "_".join(names)
    return docs.withColumn(added, score_column(model)).filter(F.col(added) >= least).select(*names)
