"""Quality rules: an isolation forest over rule statistics.

Base rules reject on fixed limits. What passes them is judged by how few random splits set
its statistics apart from those of good documents: each tree splits PER_TREE labelled good
rows at random, also beyond their range by MARGIN of it on both sides, so a document
outside their range soon ends alone, also in a statistic that all good rows share. The score
above which a document goes is calibrated on both labels: of the scores that reject at most
MAX_GOOD_REJECTED of all good rows, one that rejects most bad rows and then fewest good ones,
in the middle of the range where that holds; without bad rows the lowest.

Statistics of every text are taken in one pass and stored. The trees take at most
TREES * PER_TREE labelled good documents in all, those whose ids hash lowest (of several rows
with one id the least); that is the method's own subsampling. The threshold is taken from a histogram of the scores of all labelled rows.

Defined cases: null and empty texts have no words and fail the base rules; labels that are
null or contradict each other are left out; without labelled good rows there are no trees, all
scores are 0 and only the base rules reject; repeated rows are judged alike; an empty table gives no rows.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martwright.llm.common import Words, stored, text_slices

TREES = 100
PER_TREE = 256
MAX_GOOD_REJECTED = 0.002
BINS = 10_000
MARGIN = 1.0
LEAST_MARGIN = 0.1

MIN_WORDS = 50
REPEATED_PERCENT = 50

# Base statistics, in contract order, and one more that only the forest sees.
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
STATS = (*BASE, "n_marks")
_STRUCT = ", ".join(f"{name} long" for name in STATS)

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[[c for c in range(0x21, 0x7F) if not chr(c).isalnum()]] = True
_BLANK = b" \t\n\x0b\x0c\r"


def _repeated_words(words: Words) -> np.ndarray:
    """Flags of the words covered by three-word windows that a text holds twice or more."""
    n = len(words)
    if n < 3:
        return np.zeros(n, dtype=bool)
    index, distinct = words.encoded()
    if len(distinct) < 1 << 21:
        window = index[:-2] << 42 | index[1:-1] << 21 | index[2:]
    else:
        _, pair = np.unique(index[:-1] << 32 | index[1:], return_inverse=True)
        window = pair[:-1] << 32 | index[2:]
    whole = np.flatnonzero(words.text[2:] == words.text[:-2])
    order = whole[np.argsort(window[whole], kind="stable")]
    # A stable order keeps a text's equal windows side by side.
    same = (window[order[1:]] == window[order[:-1]]) & (words.text[order[1:]] == words.text[order[:-1]])
    twice = np.zeros(n, dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = twice.copy()
    covered[1:] |= twice[:-1]
    covered[2:] |= twice[:-2]
    return covered


def _sums(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[edges[1:]] - total[edges[:-1]]


def statistics(column) -> dict[str, np.ndarray]:
    """STATS of every text of a column."""
    parts = {name: [np.zeros(0, np.int64)] for name in STATS}
    for _, texts in text_slices(column):
        words = Words(texts)
        covered = _repeated_words(words)
        chars = ~words.space & ((words.data & 0xC0) != 0x80)
        repeated = np.zeros(len(texts), np.int64)
        for row in np.flatnonzero(words.counts):
            text = words.data[words.offsets[row] : words.offsets[row + 1]].tobytes()
            with_word = [line for line in text.split(b"\n") if line.strip(_BLANK)]
            repeated[row] = len(with_word) - len(set(with_word))
        found = {
            "n_words": words.counts,
            "word_chars": _sums(chars, words.offsets),
            "n_symbols": _sums(_SYMBOL[words.data], words.offsets),
            "n_dup_lines": repeated,
            "n_repeat_words": _sums(covered, words.first),
            "n_marks": _sums(_MARK[words.data], words.offsets),
        }
        for name, values in found.items():
            parts[name].append(values)
    return {name: np.concatenate(values) for name, values in parts.items()}


def statistics_column(text: str = "text") -> Column:
    @F.arrow_udf(f"struct<{_STRUCT.replace(' long', ': bigint')}>")
    def stats(texts: pa.Array) -> pa.Array:
        found = statistics(texts)
        return pa.StructArray.from_arrays(
            [pa.array(found[name], pa.int64()) for name in STATS], names=list(STATS)
        )

    return stats.asNondeterministic()(F.col(text))


def base_failed() -> Column:
    few = F.col("n_words") < MIN_WORDS
    return few | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))


def _vectors(stats) -> np.ndarray:
    """All statistics as shares, the number of words as a logarithm, rounded so that every
    machine splits alike."""
    values = {name: np.asarray(stats[name], np.float64) for name in STATS}
    words, chars = np.maximum(values["n_words"], 1), np.maximum(values["word_chars"], 1)
    shares = [np.log1p(values["n_words"]), values["word_chars"] / words, values["n_marks"] / chars]
    shares += [values[name] / words for name in ("n_symbols", "n_dup_lines", "n_repeat_words")]
    return np.round(np.stack(shares, axis=1), 6)


def _usual_depth(n):
    """Mean depth at which a search for one of n documents ends."""
    n = np.asarray(n, np.float64)
    more = np.maximum(n, 2)
    return np.where(n < 2, 0.0, 2 * (np.log(more - 1) + 0.5772156649) - 2 * (more - 1) / more)


class Forest:
    """Trees as arrays: a node's split, its children, and the depth where it is a leaf."""

    def __init__(self, rows: np.ndarray, seed: int = 11, trees: int = TREES, per_tree: int = PER_TREE):
        rng = np.random.default_rng(seed)
        order = rng.permutation(len(rows))
        self.trees = []
        size = min(per_tree, len(rows))
        for tree in range(trees if len(rows) else 0):
            own = order[np.arange(tree * per_tree, tree * per_tree + size) % len(rows)]
            self.trees.append(self._grow(rows[own], rng))
        self.usual = float(_usual_depth(size)) if size > 1 else 1.0

    @staticmethod
    def _grow(rows, rng):
        limit = int(np.ceil(np.log2(max(len(rows), 2))))
        feature, split, left, right, depth = [], [], [], [], []
        low, high = rows.min(axis=0), rows.max(axis=0)
        margin = np.maximum(MARGIN * (high - low), LEAST_MARGIN)
        open_nodes = [(rows, 0, None, None, low - margin, high + margin)]
        while open_nodes:
            own, level, parent, side, low, high = open_nodes.pop()
            node = len(feature)
            if parent is not None:
                (left if side == 0 else right)[parent] = node
            leaf = level >= limit or len(own) < 2
            depth.append(level + float(_usual_depth(len(own))) if leaf else 0.0)
            chosen = -1 if leaf else int(rng.integers(rows.shape[1]))
            at = 0.0 if leaf else rng.uniform(low[chosen], high[chosen])
            feature.append(chosen)
            split.append(at)
            left.append(node)
            right.append(node)
            if not leaf:
                below = own[:, chosen] <= at
                from_here, to_here = low.copy(), high.copy()
                from_here[chosen] = to_here[chosen] = at
                open_nodes.append((own[~below], level + 1, node, 1, from_here, high))
                open_nodes.append((own[below], level + 1, node, 0, low, to_here))
        arrays = (feature, split, left, right, depth)
        kinds = (np.int64, np.float64, np.int64, np.int64, np.float64)
        return tuple(np.array(x, kind) for x, kind in zip(arrays, kinds, strict=True)), limit

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Near 1: set apart after few splits; 0.5: like most."""
        depth = np.zeros(len(rows))
        if not self.trees or not len(rows):
            return depth
        # Documents with equal statistics are judged once.
        rows, back = np.unique(rows, axis=0, return_inverse=True)
        depth = np.zeros(len(rows))
        everyone = np.arange(len(rows))
        for (feature, split, left, right, ends), limit in self.trees:
            node = np.zeros(len(rows), np.int64)
            for _ in range(limit):
                below = rows[everyone, np.maximum(feature[node], 0)] <= split[node]
                node = np.where(below, left[node], right[node])
            depth += ends[node]
        return np.round(2.0 ** (-depth / len(self.trees) / self.usual), 9)[back.ravel()]


class Rules:
    """A fitted forest and the score above which a document goes (None: none goes)."""

    def __init__(self, forest: Forest, threshold: float | None):
        self.forest, self.threshold = forest, threshold

    def score_column(self) -> Column:
        forest = self.forest

        @F.arrow_udf("double")
        def score(*columns: pa.Array) -> pa.Array:
            stats = {n: c.to_numpy(zero_copy_only=False) for n, c in zip(STATS, columns, strict=True)}
            return pa.array(forest.score(_vectors(stats)), pa.float64())

        return score.asNondeterministic()(*STATS)

    def kept(self, score: Column) -> Column:
        usual = F.lit(True) if self.threshold is None else score <= self.threshold
        return ~base_failed() & usual


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and STATS of `docs` (doc_id, text), stored."""
    rows = docs.select("doc_id", statistics_column().alias("s"))
    return stored(rows.select("doc_id", "s.*"), "statistics")


def fit(stats: DataFrame, labels: DataFrame, max_good_rejected: float = MAX_GOOD_REJECTED) -> Rules:
    """Rules from the statistics of documents and `labels` (doc_id, quality)."""
    usable = labels.filter("quality in (0, 1) and doc_id is not null").groupBy("doc_id")
    agreed = usable.agg(F.min("quality").alias("good"), F.max("quality").alias("most"))
    agreed = agreed.filter("good = most").select("doc_id", "good")
    judged = stored(stats.filter(~base_failed()).join(agreed, "doc_id"), "judged")
    good, wanted, order = judged.filter("good = 1"), TREES * PER_TREE, F.xxhash64("doc_id")
    # A few more rows than wanted (eight standard deviations) lie below this hash, so a task
    # sends only its share of them.
    share = min(1.0, (wanted + 8 * wanted**0.5 + 64) / max(good.select("doc_id").distinct().count(), 1))
    drawn = good.filter(order <= min(int(share * 2**64) - 2**63, 2**63 - 1))
    # One row a document, so an id with many rows is not the whole sample.
    turn = F.row_number().over(Window.partitionBy("doc_id").orderBy(*STATS))
    drawn = drawn.withColumn("turn", turn).filter(F.col("turn") == 1)
    sample = drawn.orderBy(order, "doc_id").limit(wanted).toPandas()
    rules = Rules(Forest(_vectors(sample)), None)
    if len(sample):
        bins = judged.select("good", F.ceil(rules.score_column() * BINS).cast("int").alias("bin"))
        rules.threshold = _threshold(bins.groupBy("good", "bin").count().toPandas(), max_good_rejected)
    return rules


def _threshold(bins, max_good_rejected: float) -> float:
    """Score above which a document goes, from counts by label and bin."""
    above = {}
    for good in (0, 1):
        own = bins[bins["good"] == good]
        counts = np.bincount(own["bin"].astype(int), own["count"], BINS + 1)
        above[good] = counts.sum() - np.cumsum(counts)
    n_good = bins["count"][bins["good"] == 1].sum()
    best = np.flatnonzero(above[1] <= max_good_rejected * n_good)
    if above[0][best[0]] == 0:
        return float(best[0]) / BINS
    best = best[above[0][best] == above[0][best[0]]]
    best = best[above[1][best] == above[1][best].min()]
    return float((best[0] + best[-1]) // 2) / BINS


def judge(stats: DataFrame, rules: Rules) -> DataFrame:
    """Statistics with base_failed, anomaly (the forest's score) and kept."""
    scored = stats.withColumn("anomaly", rules.score_column())
    return scored.withColumn("base_failed", base_failed()).withColumn(
        "kept", rules.kept(F.col("anomaly"))
    )


def keep_usual(docs: DataFrame, rules: Rules) -> DataFrame:
    """Rows of `docs`, with all their columns, that the rules keep. Statistics and score
    come from one pass through a Python worker."""
    forest = rules.forest

    @F.arrow_udf(f"struct<{_STRUCT.replace(' long', ': bigint')}, anomaly: double>")
    def judged(texts: pa.Array) -> pa.Array:
        found = statistics(texts)
        columns = [pa.array(found[name], pa.int64()) for name in STATS]
        columns.append(pa.array(forest.score(_vectors(found)), pa.float64()))
        return pa.StructArray.from_arrays(columns, names=[*STATS, "anomaly"])

    row = F.struct(*docs.columns).alias("row")
    rows = docs.select(row, judged.asNondeterministic()("text").alias("s")).select("row", "s.*")
    return rows.filter(rules.kept(F.col("anomaly"))).select("row.*")
