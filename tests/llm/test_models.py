"""The classifier's fit and the forest's scores against plain versions."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from martwright.llm import isolation_rules, quality_nbsvm


@pytest.fixture
def rows():
    """Feature lists whose classes differ in some features, and a row without any."""
    rng = np.random.default_rng(3)
    good = np.arange(70) % 3 > 0
    lists = []
    for is_good in good:
        chance = np.full(60, 0.15)
        chance[:12] += 0.25 if is_good else 0.0
        chance[12:24] += 0.0 if is_good else 0.25
        lists.append(np.flatnonzero(rng.random(60) < chance).astype(np.int32))
    lists[5] = np.zeros(0, np.int32)
    return lists, good


def dense(lists):
    found = np.zeros((len(lists), 60))
    for row, own in enumerate(lists):
        found[row, own] = 1
    return found


def plain_ratio(held, good):
    """Log of the share of each indicator among the good over that among the bad."""
    p, q = 1 + held[good].sum(axis=0), 1 + held[~good].sum(axis=0)
    total = quality_nbsvm.N_FEATURES - 60  # features that no row holds count one each
    ratio = np.log(p / (p.sum() + total)) - np.log(q / (q.sum() + total))
    ratio[held.sum(axis=0) < quality_nbsvm.MIN_ROWS_WITH_FEATURE] = 0
    return ratio


def test_ratios_and_the_optimum_of_the_dual(rows, monkeypatch):
    """With many rounds, weights are those that projected gradient steps on the whole dual,
    with its kernel matrix, come to."""
    lists, good = rows
    held = dense(lists)
    ratio = plain_ratio(held, good)
    monkeypatch.setattr(quality_nbsvm, "EPOCHS", 3000)
    model = quality_nbsvm.fit_rows(lists, good)
    assert np.allclose(model.ratio[:60], ratio, atol=1e-6) and not model.ratio[60:].any()

    scaled = held * ratio
    scaled /= np.maximum(np.linalg.norm(scaled, axis=1, keepdims=True), 1e-12)
    vectors = np.hstack([scaled, np.ones((len(good), 1))])
    label = np.where(good, 1.0, -1.0)
    kernel = (vectors * label[:, None]) @ (vectors * label[:, None]).T
    limit = len(good) / 2 / np.where(good, good.sum(), (~good).sum())
    alpha = np.zeros(len(good))
    step = 1 / np.linalg.eigvalsh(kernel).max()
    for _ in range(200_000):
        alpha = np.clip(alpha + step * (1 - kernel @ alpha), 0, limit)
    best = (alpha * label) @ vectors
    assert np.allclose(model.weight[:60], best[:60], atol=2e-3)
    assert model.intercept == pytest.approx(best[60], abs=2e-3)

    def primal(w, b):
        slack = np.maximum(0, 1 - label * (scaled @ w + b))
        return (w @ w + b * b) / 2 + (limit * slack).sum()

    dual = alpha.sum() - alpha @ kernel @ alpha / 2
    assert primal(model.weight[:60].astype(float), model.intercept) == pytest.approx(dual, rel=1e-3)


def test_few_rounds_come_close(rows):
    lists, good = rows
    model = quality_nbsvm.fit_rows(lists, good)
    held = dense(lists)
    scaled = held * plain_ratio(held, good)
    scaled /= np.maximum(np.linalg.norm(scaled, axis=1, keepdims=True), 1e-12)
    margin = scaled @ model.weight[:60].astype(float) + model.intercept
    assert ((margin > 0) == good).mean() > 0.85 and model.slope > 0


def usual_depth(n):
    """Mean length of unsuccessful searches among n, by the harmonic number's estimate."""
    return 0.0 if n < 2 else 2 * (np.log(max(n, 2) - 1) + 0.5772156649) - 2 * (n - 1) / n


def plain_path(row, members, tree, limit):
    """Splits until the row's node is a leaf, and what the leaf's rows would still need."""
    (feature, split, left, right, _), node, depth = tree, 0, 0
    while feature[node] >= 0:
        below = row[feature[node]] <= split[node]
        members = [m for m in members if (m[feature[node]] <= split[node]) == below]
        node = (left if below else right)[node]
        depth += 1
    assert depth <= limit and (depth == limit or len(members) < 2)
    return depth + usual_depth(len(members))


def test_forest_scores_equal_plain_paths():
    """Rows walk down each tree one by one; leaves hold the tree's own rows that come there."""
    rng = np.random.default_rng(5)
    rows = np.round(rng.normal(size=(120, 6)), 3)
    rows[40:60] = rows[40]
    trees, per_tree, seed = 12, 32, 11
    forest = isolation_rules.Forest(rows, seed=seed, trees=trees, per_tree=per_tree)
    order = np.random.default_rng(seed).permutation(len(rows))
    judged = np.vstack([rows[:30], rng.normal(size=(20, 6)) * 4])
    scores = forest.score(judged)
    for row, score in zip(judged, scores, strict=True):
        paths = []
        for number, (tree, limit) in enumerate(forest.trees):
            members = rows[order[np.arange(number * per_tree, (number + 1) * per_tree) % len(rows)]]
            paths.append(plain_path(row, list(members), tree, limit))
        assert score == pytest.approx(2 ** (-np.mean(paths) / usual_depth(per_tree)), abs=1e-8)
    assert scores[30:].mean() > scores[:30].mean()


def test_fit_gives_its_memory_back_and_keeps_rows_in_order(spark, monkeypatch):
    """The driver holds the learned rows once, in the order of their hashes, and not after."""
    docs = spark.range(40).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("words of "), F.col("id").cast("string")).alias("text")
    )
    labels = docs.select("doc_id", (F.col("doc_id") % 2).alias("quality"))
    seen = []
    monkeypatch.setattr(quality_nbsvm, "fit_rows", lambda lists, good: seen.append((lists, good)))
    monkeypatch.setattr(quality_nbsvm, "release_memory", lambda: seen.append("released"))
    quality_nbsvm.fit(docs.repartition(5), labels)
    (lists, good), last = seen
    assert last == "released"
    learned = docs.filter(~quality_nbsvm.is_held_out()).orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    assert good.tolist() == [row.doc_id % 2 == 1 for row in learned]
    for own, row in zip(lists, learned, strict=True):
        assert own.tolist() == quality_nbsvm.features(pa.array([row.text]))[1].tolist()
        # Part of what came, not a copy.
        assert own.base is not None
