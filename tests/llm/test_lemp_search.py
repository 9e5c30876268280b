"""Norm-bucket search against scores of every document for every item."""

import collections
import math
import random
import re

import numpy as np
import pytest

from martwright.llm import lemp_search
from martwright.llm.queries import QUERIES
from shared import checkpoint_folder  # noqa: E402, F401

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({c: c.lower() for c in map(chr, range(ord("A"), ord("Z") + 1))})


def brute(docs, items, top=10):
    """(item_id, rank, doc_id, score) of items in their order."""
    bags = [(d, collections.Counter(TERM.findall((t or "").translate(LOWER)))) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    total = sum(sum(b.values()) for _, b in bags)
    df = collections.Counter(t for _, b in bags for t in b)
    weight = {t: math.floor(1000 * math.log((2 * len(bags) + 2) / (2 * n + 1))) for t, n in df.items()}
    for item_id, text in items:
        scored = []
        for doc_id, bag in bags:
            m = 10 + (90 * sum(bag.values()) * len(bags)) // total
            own = {t for t in TERM.findall((text or "").translate(LOWER)) if t in bag}
            score = sum(weight[t] * ((10**9 * bag[t]) // (1000 * bag[t] + 8 * m)) for t in own)
            if score > 0:
                scored.append((-score, doc_id is not None, doc_id or 0, doc_id))
        for rank, row in enumerate(sorted(scored)[:top], 1):
            yield item_id, rank, row[3], -row[0]


def corpus(rng, n):
    words = [f"w{i}" for i in range(60)] + ["Über", "ÉA", "a_b", "x-Y", "中国", "A1b2", "İ"]
    chances = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ".join(rng.choices(words, chances, k=rng.choice([1, 3, 30, 300])))) for i in range(n)]
    copy = docs[3][1]
    docs += [(n + i, copy) for i in range(n // 2)]  # a third alike
    docs += [(7, docs[7][1]), (None, copy), (None, None), (5000, None), (5001, ""), (5002, " -.\x7f")]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([1, 5, 40])))) for i in range(25)]
    items += [(90, None), (91, ""), (92, "unheard of"), (None, copy), (4, "W0 w0 ÉA éa")]
    return docs, items


def found(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.mark.parametrize("bucket, seeds, block", [(8192, 4096, 200_000), (16, 30, 60), (5, 1, 1)])
def test_equals_brute_force(spark, monkeypatch, bucket, seeds, block):
    monkeypatch.setattr(lemp_search, "BLOCK_TERMS", block)
    monkeypatch.setattr(lemp_search, "SEEDS", seeds)
    monkeypatch.setattr(lemp_search, "BUCKET", bucket)
    docs, items = corpus(random.Random(bucket), 150)
    if block == 1:
        items = items[-6:]
    clash = [(d, t, 1, 2.5, "r") for d, t in docs]
    table = spark.createDataFrame(clash, "doc_id long, text string, row int, score double, terms string")
    asked = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, rank int")
    result = found(lemp_search.search(table.repartition(5), asked.coalesce(1)))
    assert result == sorted(brute(docs, items), key=str)


def test_bounds_prune_and_lose_nothing():
    """A bucket far below theta is left out; every survivor set holds all that reach theta."""
    rng = np.random.default_rng(2)
    import pyarrow as pa

    corpus = lemp_search._Corpus(1000, 100_000)
    lists = [np.sort(rng.choice(50, rng.integers(1, 30), replace=False)).astype(np.int32) for _ in range(400)]
    tfs = [rng.integers(1, 9, len(x)).astype(np.int32) for x in lists]
    n = pa.array([int(t.sum()) + 40 for t in tfs], pa.int64())
    ids = pa.array(range(400), pa.int64())
    bucket = lemp_search._Bucket(ids, ids, n, pa.array(lists), pa.array(tfs), corpus)
    scratch = np.zeros(50, np.int64)
    pruned = 0
    for _ in range(200):
        terms = rng.choice(50, 8, replace=False)
        query = lemp_search._Query(0, terms, rng.integers(0, 9000, 8))
        docs, scores = bucket.survivors(query, 0, scratch)
        theta = int(np.sort(scores)[-10])
        kept, again = bucket.survivors(query, theta, scratch)
        assert set(kept) == set(docs[scores >= theta]) and not scratch.any()
        assert dict(zip(kept, again, strict=True)) == {d: s for d, s in zip(docs, scores, strict=True) if s >= theta}
        pruned += len(bucket.survivors(query, int(query.norm * bucket.norm) + 2, scratch)[0]) == 0
    assert pruned == 200


def test_empty_tables_and_other_id_types(spark):
    docs = spark.createDataFrame([("b", "x y"), ("a", "x y"), (None, "x")], "doc_id string, text string")
    items = spark.createDataFrame([("q", "X")], "item_id string, text string")
    assert lemp_search.search(docs.limit(0), items).count() == 0
    assert lemp_search.search(docs, items.limit(0)).count() == 0
    rows = lemp_search.search(docs.union(spark.createDataFrame([("c", "z")] * 4, docs.schema)), items).collect()
    assert [(r.rank, r.doc_id) for r in rows] == [(1, None), (2, "a"), (3, "b")]


def test_query_matches_its_sql(spark):
    import duckdb

    from martwright.llm.oracles import oracle_sql

    folder = "/root/testdata/sf0.001"
    connection = duckdb.connect()
    for name in ("documents", "benchmark"):
        connection.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    theirs = connection.execute(oracle_sql()["op11_lemp_search"]).fetchall()
    assert found(QUERIES["op11_lemp_search"](spark, folder)) == sorted(theirs, key=str)
