"""The trie against one built in memory, with shards and queues of every size."""

import collections
import hashlib
import random
import re
import zlib

import pytest

from martwright.llm import conversation_trie
from martwright.llm.queries import QUERIES
from shared import checkpoint_folder  # noqa: E402, F401

SCHEMA = "conv_id long, turn int, role string, text string, depth string, words int"


def brute(rows):
    convs = collections.defaultdict(list)
    for conv_id, turn, role, text, *_ in rows:
        if conv_id is not None:
            convs[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    said = {c: [t[2:] for t in sorted(own)] for c, own in convs.items()}
    rebuilt = {}
    for c, own in said.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = (*said.get(c - c % 20, [])[:h], *own[h:])
    members = collections.defaultdict(list)
    for c, path in rebuilt.items():
        for depth in range(len(path) + 1):
            members[path[:depth]].append(c)
    children = collections.defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    totals = {}
    for path in sorted(members, key=len, reverse=True):
        words = len(re.findall("[^\x20\x09-\x0d]+", path[-1][1])) if path else 0
        saved = (len(members[path]) - 1) * words + sum(totals[p][1] for p in children[path])
        totals[path] = (sum(totals[p][0] for p in children[path]) or 1, saved)
    for path, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if len(rebuilt[c]) == len(path))
        yield (
            min(own), len(path), min(members[path[:-1]]) if path else None, len(own), len(children[path]),
            *totals[path], hashlib.sha256(ends.encode()).hexdigest(),
        )


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


def conversations(rng, n):
    """Shared openings, copies (a third of all alike), one long conversation, odd rows."""
    rows = []
    for c in range(n):
        rng_c = random.Random(0 if c % 3 == 0 else c % 17)
        for turn in range(rng_c.choice([1, 2, 5, 8])):
            rows.append((c, turn, "user" if turn % 2 == 0 else "bot", f"t {rng_c.randrange(4)}\t{turn} x"))
    rows += [(10_005, i, "user", f"long {i} {i % 7}") for i in range(300)]
    rows += [(10_006, i, "user", f"long {i} {i % 7}") for i in range(250)]
    rows += [(7, 1, "user", "again"), (7, 1, "user", "again"), (7, 1, "bot", None), (7, None, None, "first")]
    rows += [(None, 1, "user", "nobody's"), (30_001, 0, "user", ""), (30_002, None, None, None), (-5, 0, "u", "é  ü")]
    rng.shuffle(rows)
    return [(*r, "kept", 3) for r in rows]


def rebuilt(df):
    return conversation_trie.with_openings(conversation_trie.numbered(df))


@pytest.mark.parametrize("shard, queue", [(1_000_000, 200_000), (40, 3), (0, 1), (None, 200_000)])
def test_equals_a_trie_in_memory(spark, conf, shard, queue):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = conversations(random.Random(shard or 9), 120)
    table = spark.createDataFrame(rows, SCHEMA).repartition(4)
    nodes = conversation_trie.trie(*rebuilt(table), shard=shard, limit=queue)
    assert found(nodes) == sorted(brute(rows), key=str)


def test_a_conversation_of_most_rows_is_split_over_tasks(spark, conf):
    """Its prefixes lie in several sort tasks and still meet those of its copy."""
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = [(c, i, "u", f"w {i}") for c in (11, 31) for i in range(4000)] + [(c, 0, "u", "w 0") for c in range(50)]
    table = spark.createDataFrame([(*r, "", 0) for r in rows], SCHEMA)
    turns, convs = rebuilt(table)
    paths = conversation_trie.prefixes(turns)
    assert paths.count() == sum(r.length for r in convs.collect())
    ordered = turns.orderBy("conv_id", "depth").rdd.glom().map(lambda part: {r.conv_id for r in part}).collect()
    assert sum(11 in part for part in ordered) > 1
    assert found(conversation_trie.trie(turns, convs)) == sorted(brute(rows), key=str)


def test_queue_returns_what_was_pushed_in_order():
    rng = random.Random(1)
    queue, shadow = conversation_trie.SpillingQueue(limit=7, width=2), []
    for _ in range(2000):
        if shadow and rng.random() < 0.45:
            least = min(shadow)
            assert queue.least() == least and queue.pop() == least
            shadow.remove(least)
        else:
            item = (rng.randrange(-50, 50), rng.randrange(3))
            queue.push(item)
            shadow.append(item)
    assert queue.spilled > 10
    assert [queue.pop() for _ in range(len(shadow))] == sorted(shadow)
    assert queue.least() is None


def test_empty_table(spark):
    assert conversation_trie.trie(*rebuilt(spark.createDataFrame([], SCHEMA))).count() == 0


def test_query_matches_its_sql(spark):
    import duckdb

    from martwright.llm.oracles import oracle_sql

    folder = "/root/testdata/sf0.001"
    connection = duckdb.connect()
    connection.execute(f"create view conversations as select * from '{folder}/conversations.parquet'")
    theirs = connection.execute(oracle_sql()["op13_conversation_trie"]).fetchall()
    assert found(QUERIES["op13_conversation_trie"](spark, folder)) == sorted(theirs, key=str)
