"""Operators against brute force, exact libraries and round trips, with odd inputs."""

import collections
import os
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

from martwright.llm import (  # noqa: E402
    backoff_lm,
    embedding_e8,
    id_coder,
    isolation_rules,
    license_rules,
    packing,
    quality_nbsvm,
    sentencepiece_prefix,
    simhash_golay,
    substring_debruijn,
    token_store,
    word_bpe,
)
from martwright.llm.common import new_folder  # noqa: E402
from martwright.llm.components import components  # noqa: E402
from shared import checkpoint_folder  # noqa: E402, F401

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
SPLIT = re.compile("[^\x20\x09-\x0d]+")


def words(text):
    return SPLIT.findall(text or "")


@pytest.fixture(scope="module")
def texts():
    """Null, empty, blank, odd and long texts, copies and near copies."""
    rnd = random.Random(5)
    vocabulary = ["the", "of", "Élan", "straße", "naïve", "x1", "don't", "A,", "中国", "\U0001f600"]
    rows = [(None, "no id"), (None, None), (1, None), (2, ""), (3, " \n\t "), (4, "a\x00b \x7f c\x7fd"),
            (5, "<|endoftext|> <s> <0x41> ▁ ▁▁x  y "), (6, "A" * 3000), (6, "A" * 3000), (7, "B  b\u00a0c")]
    for i in range(10, 60):
        rows.append((i, " ".join(rnd.choices(vocabulary, k=rnd.choice([1, 2, 3, 60, 200])))))
    rows += [(100 + i, rows[20][1]) for i in range(4)]
    return [*rows, (200, " ".join(rnd.choices(vocabulary, k=30_000)))]


@pytest.fixture(scope="module")
def docs(spark, texts):
    """With columns that clash with those of the operators."""
    rows = [(d, t, 1, "s", None, 0.5) for d, t in texts]
    schema = "doc_id long, text string, length int, score string, kept boolean, anomaly double"
    return spark.createDataFrame(rows, schema).repartition(3, "doc_id")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, length int")


def rows_by(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_word_ids_equal_the_library(texts):
    whole = [t or "" for _, t in texts]
    ids, counts = word_bpe.token_ids(WORD_BPE, pa.array(whole, pa.large_string()))
    ends = np.cumsum(counts)
    library = word_bpe.load(WORD_BPE).library
    for text, count, end in zip(whole, counts, ends, strict=True):
        assert ids[end - count : end].tolist() == library.encode(text, add_special_tokens=False).ids


def test_units_of_letters_and_marks_keep_word_ids():
    """Letters and marks in any mix, × and ÷, letters that lower-case to another form."""
    rng = random.Random(5)
    alphabet = [*"aBcÉß×÷.,-'3 \n\tńÃ中|<>#", "J̌", "H̱", word_bpe.MARK, "\x85", "\xa0"]
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(60))) for _ in range(3000)]
    texts += ["H̱x J̌. İ.", "a×b ÷ Ã·", "A.", ".a", "<|startoftext|> hi.<|endoftext|>"]
    ids, counts = word_bpe.token_ids(WORD_BPE, pa.array(texts, pa.large_string()))
    library = word_bpe.load(WORD_BPE).library
    for text, own in zip(texts, np.split(ids, np.cumsum(counts)[:-1]), strict=True):
        assert own.tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_packing_covers_each_id_once_and_fills_windows(docs, none, texts):
    pieces = packing.pack(docs, WORD_BPE, end_id=1).toPandas()
    library = word_bpe.load(WORD_BPE).library
    expected = collections.Counter()
    for doc_id, text in texts:
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        expected[(doc_id, zlib.crc32(np.array(ids, "<u4").tobytes()))] += 1
    found = collections.Counter()
    # Copies of one id are told apart by how pieces follow each other.
    for doc_id, own in pieces.groupby("doc_id", dropna=False):
        size = own.doc_tokens.iloc[0]
        if (own.doc_tokens == size).all() and len(own[own.start == 0]) == 1:
            whole = b"".join(own.sort_values("start").ids)
            assert len(whole) == 4 * size
            found[(None if doc_id != doc_id else int(doc_id), zlib.crc32(whole))] += 1
    assert found and not found - expected
    assert pieces.length.sum() == pieces[pieces.start == 0].doc_tokens.sum()
    for _, own in pieces.sort_values("offset").groupby("sequence_id"):
        assert own.offset.tolist() == [0, *np.cumsum(own.length)[:-1]]
        assert own.length.sum() == own.window.iloc[0] <= 2048
        assert own.window.iloc[0] & (own.window.iloc[0] - 1) == 0
    groups = pieces.groupby("step_group")
    assert (groups.length.sum() <= packing.STEP_TOKENS).all() and (groups.window.nunique() == 1).all()
    assert packing.pack(none, WORD_BPE).count() == 0


@pytest.mark.parametrize("size", [0, 1, 2, 1023, 1025, 5000])
@pytest.mark.parametrize("kinds", [1, 3, 300, 65_536])
def test_id_coder_round_trip(size, kinds):
    ids = np.random.default_rng(size + kinds).integers(0, kinds, size).astype(np.uint32)
    assert id_coder.decode(id_coder.encode(ids)).tolist() == ids.tolist()


def test_id_coder_repeats_cost_little_and_damage_is_found():
    ids = np.tile(np.arange(50, dtype=np.uint32) * 977 % 49_000, 400)
    code = id_coder.encode(ids)
    assert len(code) < len(ids)
    for at in (0, 13, len(code) // 2, len(code) - 1):
        damaged = bytearray(code)
        damaged[at] ^= 0x55
        with pytest.raises(ValueError):
            id_coder.decode(bytes(damaged))
    assert id_coder.decode(id_coder.encode(np.array([70_000, 2**32 - 1], np.uint32))).tolist() == [70_000, 2**32 - 1]
    with pytest.raises(ValueError):
        id_coder.encode(np.arange(id_coder.MAX_KINDS + 1, dtype=np.uint32))


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="test tables not present")
def test_coded_ids_take_less_than_their_order_0_entropy():
    """Header, index and checksums included, over all ids of the documents."""
    import pyarrow.parquet as pq

    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet")["text"].combine_chunks()
    ids, counts = word_bpe.token_ids(WORD_BPE, texts)
    ids = np.insert(ids, np.cumsum(counts), 2)
    share = np.bincount(ids) / len(ids)
    entropy = -(share[share > 0] * np.log2(share[share > 0])).sum()
    assert 8 * len(id_coder.encode(ids)) / len(ids) < entropy


def test_a_store_splits_rows_of_one_id(spark, conf):
    """A third of all rows alike: several tasks write them, and they come back in order."""
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = [(7, "the same text")] * 3000 + [(i, f"text {i}") for i in range(100, 6100)]
    folder = new_folder(spark, "ids")
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    token_store.write(docs, WORD_BPE, folder)
    found = token_store.read(spark, folder).orderBy("start").collect()
    assert [r.doc_id for r in found] == sorted(d for d, _ in rows)
    with_seven = spark.read.parquet(folder).filter(F.array_contains("doc_ids", F.lit(7).cast("long")))
    assert with_seven.select("part").distinct().count() > 1


def test_token_store_round_trip(spark, docs, none, texts, monkeypatch):
    monkeypatch.setattr(token_store, "SEGMENT_IDS", 3000)
    folder = new_folder(spark, "ids")
    token_store.write(docs, WORD_BPE, folder, end_id=2)
    found = token_store.read(spark, folder).toPandas().sort_values("start")
    library = word_bpe.load(WORD_BPE).library
    place = lambda t: np.uint64(xxhash.xxh64_intdigest((t or "").encode(), 42)).astype(np.int64)
    ordered = sorted(texts, key=lambda r: (r[0] is not None, r[0] or 0, place(r[1]), r[1] is not None))
    assert len(found) == len(ordered)
    start = 0
    for (doc_id, text), row in zip(ordered, found.itertuples(), strict=True):
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        assert row.start == start and np.frombuffer(row.ids, "<u4").tolist() == ids
        assert (None if row.doc_id != row.doc_id else row.doc_id) == doc_id
        start += len(ids)
    empty = new_folder(spark, "ids")
    token_store.write(none, WORD_BPE, empty)
    assert token_store.read(spark, empty).count() == 0


def test_sentencepiece_equals_the_library(docs, none, texts):
    model = sentencepiece_prefix.load(PIECE_BPE).library
    expected = sorted(
        (
            (d, np.array(ids, "<u4").tobytes(), model.decode(ids))
            for d, t in texts
            for ids in [model.encode(t or "", add_bos=True, add_eos=True)]
        ),
        key=str,
    )
    found = sentencepiece_prefix.round_trip(docs, PIECE_BPE)
    assert sorted(((r.doc_id, bytes(r.ids), r.decoded) for r in found.collect()), key=str) == expected
    assert sentencepiece_prefix.round_trip(none, PIECE_BPE).count() == 0
    rnd = random.Random(3)
    signs = list("aeinrst  ▁é中\n\x00.-=12") + ["ing", "the", "<s>", "    "]
    odd = ["".join(rnd.choices(signs, k=rnd.randint(0, 40))) for _ in range(3000)]
    ids, counts = sentencepiece_prefix.load(PIECE_BPE).encode(pa.array(odd, pa.large_string()))
    lists = np.split(ids, np.cumsum(counts)[:-1])
    assert [x.tolist() for x in lists] == model.encode(odd, add_bos=True, add_eos=True)


def brute_repeats(rows, n):
    lists = [words(t) for _, t in rows]
    seen = collections.Counter(tuple(w[i : i + n]) for w in lists for i in range(len(w) - n + 1))
    for (doc_id, _), own in zip(rows, lists, strict=True):
        gone = [False] * len(own)
        for i in range(len(own) - n + 1):
            if seen[tuple(own[i : i + n])] > 1:
                gone[i : i + n] = [True] * n
        yield doc_id, len(own), sum(gone), " ".join(w for w, g in zip(own, gone, strict=True) if not g)


@pytest.mark.parametrize("window,anchor", [(35, 8), (9, 3), (5, 5), (6, 1)])
def test_substring_equals_brute_force(spark, docs, none, texts, window, anchor):
    columns = ("doc_id", "result.n_words", "result.n_removed", "result.kept")
    found = substring_debruijn.remove_repeats(docs, window, anchor)
    assert rows_by(found, *columns) == sorted(brute_repeats(texts, window), key=str)
    spans = found.filter(F.aggregate("result.spans", F.lit(0).cast("long"), lambda n, s: n + s.length) != F.col("result.n_removed"))
    assert spans.count() == 0
    assert substring_debruijn.remove_repeats(none, window, anchor).count() == 0


def brute_print(text):
    own = [w.encode() for w in words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))]
    grams = [b" ".join(own[i : i + 3]) for i in range(max(len(own) - 2, 1))] if own else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """Smallest id of each row's component, by links of three bits at most."""
    values = sorted(set(p for _, p in prints))
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    least = {}
    for d, p in prints:
        if d is not None:
            least[find(p)] = min(least.get(find(p), d), d)
    return [(d, p, least.get(find(p))) for d, p in prints]


def test_simhash_equals_brute_force(docs, none, texts):
    found = simhash_golay.near_duplicates(docs)
    got = sorted(((r.doc_id, r.print % (1 << 64), r.component_id) for r in found.collect()), key=str)
    assert got == sorted(brute_components([(d, brute_print(t)) for d, t in texts]), key=str)
    assert simhash_golay.near_duplicates(none).count() == 0
    kept = simhash_golay.keep_first(docs)
    assert kept.columns == docs.columns
    named = {c for d, _, c in got if d is not None and d == c}
    assert sorted(r.doc_id for r in kept.filter("doc_id is not null").collect()) == sorted(named)


def test_golay_keys_find_all_pairs_within_three_bits(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 300, dtype=np.int64)
    flips = [sum(1 << int(b) for b in rng.choice(64, n, replace=False)) for n in rng.integers(1, 5, 300)]
    other = (base.view(np.uint64) ^ np.array(flips, np.uint64)).view(np.int64)
    values = sorted({*base.tolist(), *other.tolist()})
    expected = {(a, b) for a in values for b in values if a < b and ((a ^ b) % (1 << 64)).bit_count() <= 3}
    prints = spark.createDataFrame([(v,) for v in values], "print long")
    assert {tuple(r) for r in simhash_golay.links(prints).collect()} == expected and expected


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i + 1, i) for i in range(40)] + [(1000, 1000 + i) for i in range(1, 30)] + [(7, 7), (3, 2)]
    found = dict(map(tuple, components(spark.createDataFrame(edges, "u long, v long")).collect()))
    assert found == {**{i: 0 for i in range(41)}, **{1000 + i: 1000 for i in range(30)}}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_embeddings_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    rows, base = [], rng.normal(size=(60, 24))
    for i, v in enumerate(base):
        rows.append((i, v.tolist(), i % 3))
        for k in range(4):
            near = v + rng.normal(size=24) * np.linalg.norm(v) * 0.03
            rows.append((100 + i * 4 + k, near.tolist(), i % 3))
    rows += [(900 + k, base[0].tolist(), 0) for k in range(5)]
    odd = [(1, None, 0), (2, [0.0] * 24, 0), (3, [float("nan")] * 24, 0), (4, [None, *[1.0] * 23], 0),
           (5, base[0].tolist(), None), (6, [float("inf"), *[1.0] * 23], 0), (7, [], 0), (8, base[0, :5].tolist(), 0)]
    rows += [(2000 + i, v, label) for i, v, label in odd] + [(None, base[0].tolist(), 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("n_links", F.lit("x"))
    found = {r.vec_id: (r.n_links, r.component_id) for r in embedding_e8.near_duplicates(df).collect()}
    good = [r for r in rows if r[0] is not None and r[0] < 2000]
    matrix = np.array([v for _, v, _ in good])
    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
    labels = np.array([label for _, _, label in good])
    near = (matrix @ matrix.T >= 0.98) & (labels[:, None] == labels)
    links = dict(zip((r[0] for r in good), (near.sum(axis=1) - 1).tolist(), strict=True))
    total = sum(links.values())
    assert sum(found[i][0] for i in links) >= 0.99 * total > 0
    assert all(found[i][0] <= n for i, n in links.items())
    assert {found[900 + k][1] for k in range(5)} == {0}
    assert all(found[2000 + i] == (0, 2000 + i) for i, _, _ in odd) and found[None] == (0, None)
    assert embedding_e8.near_duplicates(df.limit(0)).count() == 0


def brute_statistics(text):
    own = words(text)
    windows = collections.Counter(zip(own, own[1:], own[2:], strict=False))
    covered = {j for i in range(len(own) - 2) if windows[tuple(own[i : i + 3])] > 1 for j in range(i, i + 3)}
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if SPLIT.search(line):
            repeated += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(own), sum(map(len, own)), symbols, repeated, len(covered)


def test_rule_statistics_equal_brute_force(spark, docs, none, texts):
    more = [(1, "x y\nx y\n\nx y\r\nx y\n \n \nz"), (2, "a b c a b c # | <é>"), (3, "a a a a"), (4, "\n\n")]
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    expected = sorted(((d, *brute_statistics(t)) for d, t in texts + more), key=str)
    assert rows_by(isolation_rules.measured(df), "doc_id", *isolation_rules.BASE) == expected
    labels = spark.createDataFrame([], "doc_id long, quality int")
    stats = isolation_rules.measured(docs)
    rules = isolation_rules.fit(stats, labels)
    judged = isolation_rules.judge(stats, rules)
    assert rules.threshold is None and judged.filter("kept = base_failed").count() == 0
    kept = isolation_rules.keep_usual(docs, rules)
    assert kept.columns == docs.columns and kept.count() == judged.filter("kept").count()
    empty = isolation_rules.measured(none)
    assert isolation_rules.judge(empty, isolation_rules.fit(empty, labels)).count() == 0


def test_forest_sets_few_apart_and_threshold_keeps_good(spark):
    rng = random.Random(1)
    vocabulary = [f"w{i}" + rng.choice(["", "", "", ".", ","]) for i in range(300)]
    plain = [(i, " ".join(rng.choices(vocabulary, k=80))) for i in range(600)]
    junk = [(1000 + i, " ".join(f"z{i}{k}$%&" for k in range(80))) for i in range(12)]
    df = spark.createDataFrame(plain + junk, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(300)] + [(1000, 0), (5, 0), (6, None)], "doc_id long, quality int")
    stats = isolation_rules.measured(df)
    judged = isolation_rules.judge(stats, isolation_rules.fit(stats, labels, max_good_rejected=0.0))
    scores = {r.doc_id: (r.anomaly, r.kept, r.base_failed) for r in judged.collect()}
    assert all(scores[i][1] for i in range(7, 300) if not scores[i][2])
    assert min(scores[1000 + i][0] for i in range(12)) > np.median([scores[i][0] for i in range(600)])


def test_classifier_on_held_out_rows(spark, docs, none, monkeypatch):
    rng = random.Random(2)
    plain = ["the", "cat", "sat", "on", "a", "mat", "quite", "well"]
    rows, labels = [], []
    for i in range(600):
        good = i % 3 > 0
        text = " ".join(rng.choices(plain, k=60)) if good else " ".join(w + "$%" for w in rng.choices(plain, k=60))
        rows.append((i, text))
        labels.append((i, int(good)))
    labels += [(0, 1), (700, 1), (None, 1), (3, None)]
    df = spark.createDataFrame(rows + [(700, None)], "doc_id long, text string")
    marked = spark.createDataFrame(labels, "doc_id long, quality int")
    model = quality_nbsvm.fit(df, marked)
    scored = df.select("doc_id", quality_nbsvm.is_held_out().alias("h"), quality_nbsvm.score_column(model).alias("s"))
    for doc_id, held_out, value in map(tuple, scored.collect()):
        assert held_out == (zlib.crc32(str(doc_id).encode()) % 3 == 1) and 0 <= value <= 1
        if doc_id < 600:
            assert (value >= 0.5) == (doc_id % 3 > 0)
    kept = quality_nbsvm.keep_good(docs, model, least=0.0)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    # At most max_rows rows are learned from, however often a labelled id is repeated.
    learned = []
    monkeypatch.setattr(quality_nbsvm, "fit_rows", lambda lists, good: learned.append(len(lists)))
    twice = df.unionByName(df.filter("doc_id < 90"))
    quality_nbsvm.fit(twice, marked, max_rows=50)
    quality_nbsvm.fit(twice, marked, max_rows=100_000)
    monkeypatch.undo()
    # Document 0 has both labels.
    usable = [i for i in range(1, 600) if zlib.crc32(str(i).encode()) % 3 != 1] + [700]
    assert learned == [50, len([i for i in usable if i != 700 or zlib.crc32(b"700") % 3 != 1])]
    unfit = quality_nbsvm.fit(docs, marked.limit(0))
    assert {r.s for r in docs.select(quality_nbsvm.score_column(unfit).alias("s")).collect()} == {0.5}
    assert none.select(quality_nbsvm.score_column(model)).count() == 0


def brute_scores(rows, order, alpha):
    """doc_id, words, words by the full order, words of no other row, score."""
    lists = [words(t) for _, t in rows]
    grams = [
        collections.Counter(tuple(w[i - n : i]) for n in range(order + 1) for i in range(max(n, 1), len(w) + 1))
        for w in lists
    ]
    everywhere = collections.Counter()
    for own in grams:
        everywhere.update(own)
    for (doc_id, _), own, mine in zip(rows, lists, grams, strict=True):
        total, full, unseen = 0.0, 0, 0
        for i in range(len(own)):
            factor = 1.0
            for n in range(min(order, i + 1), 0, -1):
                gram = tuple(own[i + 1 - n : i + 1])
                others = everywhere[gram] - mine[gram]
                if others:
                    total += np.log(factor * others / (everywhere[gram[:-1]] - mine[gram[:-1]]))
                    full += n == order
                    break
                factor *= alpha
            else:
                total += np.log(factor / (everywhere[()] - mine[()] + 1))
                unseen += 1
        yield doc_id, len(own), full, unseen, round(total, 5)


@pytest.mark.parametrize("order", [2, 3, 4])
def test_backoff_equals_brute_force(spark, docs, none, texts, monkeypatch, order):
    monkeypatch.setattr(backoff_lm, "CHUNK_BYTES", 40_000)
    monkeypatch.setattr(backoff_lm, "BUCKET_BYTES", 60_000)
    monkeypatch.setattr(backoff_lm, "_BLOCK_BITS", 2)
    found = backoff_lm.score(docs, order=order).withColumn("s", F.round("log_score", 5))
    got = rows_by(found, "doc_id", "n_words", "n_full", "n_unseen", "s")
    expected = sorted(brute_scores(texts, order, 0.4), key=str)
    assert [g[:4] for g in got] == [e[:4] for e in expected]
    assert np.allclose([g[4] for g in got], [e[4] for e in expected], atol=2e-5)
    assert sum(e[2] for e in expected) > 0 and sum(e[3] for e in expected) > 0
    assert backoff_lm.score(none).count() == 0
    alone = backoff_lm.score(spark.createDataFrame([(1, "a a b")], "doc_id long, text string")).first()
    assert (alone.n_full, alone.n_unseen) == (0, 3)


def test_equal_rows_of_a_language_model_spread_over_chunks(spark, monkeypatch):
    """A third of all rows alike: no group of a chunk holds them all."""
    monkeypatch.setattr(backoff_lm, "CHUNK_BYTES", 20_000)
    rows = [(1, "the same words again and again")] * 3000 + [(i + 2, f"w{i} other") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    size = sum(len(t) for _, t in rows)
    block = F.shiftright(F.monotonically_increasing_id(), backoff_lm._BLOCK_BITS)
    chunk = F.pmod(F.xxhash64(block), F.lit(size // 20_000 + 1))
    largest = docs.filter("doc_id = 1").groupBy(chunk).count().agg(F.max("count")).first()[0]
    assert largest < 2000
    scores = backoff_lm.score(docs).filter("doc_id = 1").select("n_full", "n_unseen").distinct().collect()
    assert [tuple(r) for r in scores] == [(4, 0)]


def test_licences(spark, none):
    wrapped = "\n".join(re.sub(r"(.{50}\S*) ", "\\1\n", license_rules.SENTENCES[k]) for k in license_rules.RULES[0][1])
    text = {k: " ".join(license_rules.SENTENCES[s] for s in keys) for k, keys in license_rules.RULES}
    rows = [
        (1, f"Copyright 2020 x\n\n{wrapped}", ["MIT"]),
        (2, "x\nLicensed under CC BY-NC 4.0.\nReleased  UNDER the MIT License. y", ["CC-BY-NC-4.0", "MIT"]),
        (3, license_rules.SENTENCES["bsd-grant"] + " 1. " + license_rules.SENTENCES["bsd-source"], []),
        (4, text["BSD-2-Clause"], ["BSD-2-Clause"]),
        (5, text["BSD-3-Clause"], ["BSD-3-Clause"]),
        (6, None, []),
        (7, "", []),
        (8, "licensed under the mit licence", []),
    ]
    found = license_rules.scan(spark.createDataFrame(rows, "doc_id long, text string, licences array<string>"))
    assert {r.doc_id: list(r.licences) for r in found.collect()} == {d: want for d, _, want in rows}
    assert license_rules.scan(none).count() == 0


SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")
def test_queries_with_sql_match_it(spark):
    import duckdb

    from martwright.llm.oracles import oracle_sql
    from martwright.llm.queries import QUERIES

    connection = duckdb.connect()
    connection.execute(f"create view documents as select * from '{SF_DIR}/documents.parquet'")
    for name in ("op1_license_rules", "op6_backoff_lm"):
        sql = oracle_sql()[name]
        mine = QUERIES[name](spark, SF_DIR).toPandas()
        theirs = connection.execute(sql).df()[list(mine.columns)]
        for frame in (mine, theirs):
            frame.sort_values("doc_id", inplace=True, ignore_index=True)
        for column in mine:
            if mine[column].dtype == float:
                assert np.allclose(mine[column], theirs[column], atol=2e-6, equal_nan=True)
            else:
                assert mine[column].tolist() == theirs[column].tolist()


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")
def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, before = docs.columns, docs.count()
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, SF_DIR), name)
        kept[name] = docs.count()
        if name != "packing":
            assert docs.columns == columns and kept[name] <= before
            before = kept[name]
    assert kept["quality_classifier"] > kept["near_duplicates"] > 0
    assert docs.select("doc_id").distinct().count() == kept["substring_dedup"]
