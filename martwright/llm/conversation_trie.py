"""Prefix trie of conversations, its subtree totals by time-forward processing.

Prefixes. Rows are sorted by conversation and turn over range partitions, so that a
conversation with any share of all rows is split over tasks. A turn's fingerprint (two
numbers of 62 bits, of its place, role and text) is added up along the conversation; sums
restart with each conversation, and a conversation that goes on in the next task gets the
sum of the tasks before (a row a task). Equal sums at equal depth are one node: prefixes
whose 124 bits agree are taken as equal.

Totals. A node's weight is the number of its members' turns below it, which bounds the
nodes below it. The topmost nodes with at most the square root of all turns as their weight
(LEAST_SHARD at least) are shard roots; their subtrees are shards. Shards are sorted externally by reverse level order, and a task passes
each node's totals forward to its parent through a priority queue that spills sorted runs,
so it holds neither a shard nor a level. Totals of shard roots are summed by parent, and
the same pass goes over the nodes above the shard roots, of which a level has fewer than the
square root of all turns.

The conversations that end in a node are joined in blocks of neighbouring ids, and one
task hashes a node's blocks one after the other without keeping them.

Defined cases: rows with a null conv_id belong to no conversation and are left out; null
roles and texts are empty; turns with a null number come first; turns of equal number go by
role and text, and repeated rows are turns of their own; texts are used whole; an empty
table gives no nodes, not even a root; other columns are not read.
"""

import hashlib
import heapq
import tempfile
from array import array
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martwright.llm.common import one_array, stored

LEAST_SHARD = 256
QUEUE = 200_000
GROUP = 20
_ID_BLOCK_BITS = 10
_MASK = (1 << 62) - 1
_RUN_BITS = 33
_NODE = ("depth", "f1", "f2")


# --- turns and their places ---------------------------------------------------------


def numbered(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1), words, a and b (hashes of role and text) of every turn, and
    size, the number of the conversation's turns."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text")
    )
    ordered = rows.orderBy("conv_id", F.asc_nulls_first("turn"), "role", "text").select(
        "conv_id",
        F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
        F.xxhash64("role", "text").alias("a"),
        F.xxhash64(F.lit("b"), "text", "role").alias("b"),
        F.monotonically_increasing_id().alias("at"),
    )
    turns = stored(ordered, "turns").withColumn("task", F.shiftright("at", _RUN_BITS))
    # A row a task.
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum("n").over(before), F.lit(0))
    offsets = turns.groupBy("task").agg(F.count("*").alias("n")).select("task", earlier.alias("offset"))
    rank = F.col("offset") + F.col("at").bitwiseAND(F.lit((1 << _RUN_BITS) - 1))
    ranked = turns.join(F.broadcast(offsets), "task").withColumn("rank", rank)
    first = ranked.groupBy("conv_id").agg(F.min("rank").alias("first"), F.count("*").alias("size"))
    placed = ranked.join(first, "conv_id")
    place = (F.col("rank") - F.col("first") + 1).alias("place")
    return placed.select("conv_id", place, "size", "words", "a", "b")


def with_openings(turns: DataFrame, group: int = GROUP) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt with the opening turns of their group's first conversation.

    Of conversation c the first h = crc32(c) % 4 turns are those of c - c % group (all it
    has, if fewer), and c's own turns after its first h follow. Returns the rebuilt turns
    (conv_id, depth, length, words, a, b) and all conversations (conv_id, length)."""
    convs = turns.filter("place = 1").select("conv_id", "size")
    base = F.col("conv_id") - F.pmod("conv_id", F.lit(group))
    heads = convs.select(F.col("conv_id").alias("base"), F.col("size").alias("there"))
    h = F.crc32(F.col("conv_id").cast("string")) % 4
    plan = convs.withColumns({"h": h, "base": base}).join(heads, "base", "left")
    plan = plan.withColumn("taken", F.least("h", F.coalesce("there", F.lit(0))))
    plan = plan.withColumn("length", F.col("taken") + F.greatest(F.col("size") - F.col("h"), F.lit(0)))
    own = turns.filter(F.col("place") > h).drop("size")
    own = own.join(plan.select("conv_id", "h", "taken", "length"), "conv_id")
    own = own.withColumn("depth", F.col("place") - F.col("h") + F.col("taken"))
    # Three turns and `group` conversations a base at most.
    opening = turns.filter("place <= 3").filter(F.pmod("conv_id", F.lit(group)) == 0)
    opening = opening.select(F.col("conv_id").alias("base"), F.col("place").alias("depth"), "words", "a", "b")
    taken = opening.join(plan.select("conv_id", "base", "taken", "length"), "base")
    taken = taken.filter(F.col("depth") <= F.col("taken"))
    columns = ("conv_id", "depth", "length", "words", "a", "b")
    return own.select(*columns).unionByName(taken.select(*columns)), plan.select("conv_id", "length")


# --- prefixes -----------------------------------------------------------------------


def _summed(batches):
    """Sums of h1 and h2 from the first turn of a conversation that the task has met."""
    task, last, carried = TaskContext.get().partitionId(), None, [np.uint64(0)] * 2
    for batch in batches:
        convs = one_array(batch["conv_id"]).to_numpy(zero_copy_only=False)
        if not len(convs):
            continue
        starts = np.flatnonzero(np.append(True, convs[1:] != convs[:-1]))
        lengths = np.diff(np.append(starts, len(convs)))
        columns = {name: one_array(batch[name]) for name in batch.schema.names}
        for k, name in enumerate(("h1", "h2")):
            values = columns[name].to_numpy(zero_copy_only=False).astype(np.uint64)
            sums = np.cumsum(values, dtype=np.uint64)
            before = np.append(np.uint64(0), sums)[starts]
            if convs[0] == last:
                before[0] -= carried[k]
            sums = (sums - np.repeat(before, lengths)) & np.uint64(_MASK)
            carried[k] = sums[-1]
            columns[f"s{k + 1}"] = pa.array(sums.astype(np.int64))
        last = convs[-1]
        columns["task"] = pa.array(np.full(len(convs), task, np.int32))
        yield pa.RecordBatch.from_pydict(columns)


def prefixes(rebuilt: DataFrame) -> DataFrame:
    """conv_id, depth, length, words and the sums f1, f2 (p1, p2 without the last turn) of
    every prefix of every conversation, stored."""
    mask = F.lit(_MASK)
    hashed = rebuilt.select(
        "conv_id", "depth", "length", "words",
        F.xxhash64("depth", "a", "b").bitwiseAND(mask).alias("h1"),
        F.xxhash64(F.lit("h2"), "depth", "b", "a").bitwiseAND(mask).alias("h2"),
    )
    schema = ", ".join(f"{c} long" for c in (*hashed.columns, "s1", "s2")) + ", task int"
    rows = stored(hashed.orderBy("conv_id", "depth").mapInArrow(_summed, schema), "sums")
    # A row a task, as are those sent to all tasks.
    ends = rows.groupBy("task").agg(
        F.min(F.struct("conv_id", "depth")).alias("head"),
        F.max(F.struct("conv_id", "depth", "s1", "s2")).alias("tail"),
    )
    so_far = Window.partitionBy("tail.conv_id").orderBy("task")
    added = lambda c: (F.sum(F.col(c).cast("decimal(38,0)")).over(so_far) % (_MASK + 1)).cast("long")
    ends = ends.withColumns({"sum1": added("tail.s1"), "sum2": added("tail.s2")})
    in_order = Window.orderBy("task")
    offsets = ends.select(
        "task", F.col("head.conv_id").alias("conv_id"), F.col("head.depth").alias("from"),
        F.lag("sum1").over(in_order).alias("o1"), F.lag("sum2").over(in_order).alias("o2"),
    )
    offsets = offsets.filter(F.col("from") > 1).drop("from")
    whole = rows.join(F.broadcast(offsets), ["task", "conv_id"], "left")
    for k in "12":
        total = F.col(f"s{k}") + F.coalesce(f"o{k}", F.lit(0))
        whole = whole.withColumn(f"f{k}", total.bitwiseAND(mask))
        parent = F.col(f"f{k}") - F.col(f"h{k}") + F.lit(_MASK + 1)
        whole = whole.withColumn(f"p{k}", parent.bitwiseAND(mask))
    return stored(whole.select("conv_id", "depth", "length", "words", "f1", "f2", "p1", "p2"), "prefixes")


def _nodes(paths: DataFrame, convs: DataFrame) -> DataFrame:
    """The distinct prefixes, the empty one included, stored."""
    inner = paths.groupBy(*_NODE).agg(
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
        F.min("words").alias("words"),
        F.min("p1").alias("p1"),
        F.min("p2").alias("p2"),
        F.sum(F.col("length") - F.col("depth")).alias("weight"),
    )
    zero = F.lit(0).cast("long")
    root = convs.agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.sum("length").alias("weight")
    ).filter("n_convs > 0")
    root = root.withColumns(dict.fromkeys((*_NODE, "words", "p1", "p2"), zero))
    return stored(inner.unionByName(root), "nodes")


# --- conversations that end in a node ------------------------------------------------


def _digests(batches):
    """Hash of the joined blocks of each node, which come one after the other."""
    node, digest = None, None

    def done():
        columns = [pa.array([v], pa.int64()) for v in node]
        return pa.RecordBatch.from_arrays([*columns, pa.array([digest.hexdigest()])], [*_NODE, "ends_sha256"])

    for batch in batches:
        finished = []
        for *key, ids in zip(*(batch[c].to_pylist() for c in (*_NODE, "ids")), strict=True):
            if key != node:
                if node is not None:
                    finished.append(done())
                node, digest = key, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
        if finished:
            yield pa.Table.from_batches(finished).combine_chunks().to_batches()[0]
    if node is not None:
        yield done()


def _endings(paths: DataFrame, convs: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("long")
    ended = paths.filter("depth = length").select(*_NODE, "conv_id")
    turnless = convs.filter("length = 0").select(*(zero.alias(c) for c in _NODE), "conv_id")
    block = F.shiftright("conv_id", _ID_BLOCK_BITS).alias("block")
    # At most 1,024 ids a block.
    ids = F.transform(F.sort_array(F.collect_list("conv_id")), lambda i: i.cast("string"))
    blocks = ended.unionByName(turnless).groupBy(*_NODE, block).agg(F.array_join(ids, ",").alias("ids"))
    dealt = blocks.repartition(*_NODE).sortWithinPartitions(*_NODE, "block").drop("block")
    return dealt.mapInArrow(_digests, "depth long, f1 long, f2 long, ends_sha256 string")


# --- totals -------------------------------------------------------------------------


class SpillingQueue:
    """Tuples of `width` 64-bit numbers, least first. Beyond `limit` tuples in memory, all of
    them are written as a sorted run into a file without a name, which ends with the task."""

    def __init__(self, limit: int = QUEUE, width: int = 5):
        self.limit, self.width = limit, width
        self.heap: list[tuple] = []
        self.runs: list[tuple] = []
        self.spilled = 0

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.limit:
            self._spill()

    def least(self) -> tuple | None:
        """The least tuple, which stays."""
        heads = [*self.heap[:1], *(run[0] for run in self.runs[:1])]
        return min(heads) if heads else None

    def pop(self) -> tuple:
        if not self.runs or (self.heap and self.heap[0] <= self.runs[0][0]):
            return heapq.heappop(self.heap)
        item, number, rest = self.runs[0]
        following = next(rest, None)
        if following is None:
            heapq.heappop(self.runs)
        else:
            heapq.heapreplace(self.runs, (following, number, rest))
        return item

    def _spill(self) -> None:
        file = tempfile.TemporaryFile()
        self.heap.sort()
        for begin in range(0, len(self.heap), 4096):
            array("q", [v for item in self.heap[begin : begin + 4096] for v in item]).tofile(file)
        self.heap = []
        file.seek(0)
        rest = self._read(file)
        self.spilled += 1
        heapq.heappush(self.runs, (next(rest), self.spilled, rest))

    def _read(self, file):
        with file:
            while block := file.read(4096 * self.width * 8):
                values = iter(array("q", block))
                yield from zip(*[values] * self.width, strict=True)


_FORWARD = (
    "shard", "top", *_NODE, "p1", "p2", "conv_id", "n_convs", "words", "n_children", "n_leaves", "saved_tokens",
)


def _forward(limit: int):
    """Totals of nodes that come shard by shard, each in reverse level order. Counts that a
    row brings along are those of children in other shards."""

    def passed(batches):
        queue = SpillingQueue(limit)
        for batch in batches:
            columns = {name: one_array(batch[name]).to_pylist() for name in _FORWARD}
            rows = zip(*columns.values(), strict=True)
            out: tuple[list, list, list] = ([], [], [])
            for _, top, depth, f1, f2, p1, p2, _, n_convs, words, children, leaves, saved in rows:
                node = (-depth, f1, f2)
                saved += (n_convs - 1) * words
                while (head := queue.least()) and head[:3] == node:
                    *_, more_leaves, more_saved = queue.pop()
                    children, leaves, saved = children + 1, leaves + more_leaves, saved + more_saved
                leaves = leaves or 1
                if depth > top:
                    queue.push((1 - depth, p1, p2, leaves, saved))
                elif queue.least():
                    raise AssertionError(f"totals for a node that does not come: {queue.least()}")
                for values, value in zip(out, (children, leaves, saved), strict=True):
                    values.append(value)
            done = [one_array(batch[name]) for name in _FORWARD[:-3]]
            yield pa.RecordBatch.from_arrays([*done, *(pa.array(v, pa.int64()) for v in out)], list(_FORWARD))

    return passed


_FORWARD_SCHEMA = ", ".join(f"{name} long" for name in _FORWARD)


def _zero() -> Column:
    return F.lit(0).cast("long")


def _totals(nodes: DataFrame, paths: DataFrame, shard: int | None, limit: int) -> DataFrame:
    """Nodes with n_children, n_leaves and saved_tokens."""
    if shard is None:
        root = nodes.filter("depth = 0").select("weight").first()
        shard = max(LEAST_SHARD, isqrt(root.weight if root else 0))
    light = (F.col("weight") <= shard) & (F.col("depth") > 0)
    above = nodes.filter(~light)
    # Where a conversation's path enters its shard.
    inside = above.filter("depth > 0").select(*_NODE)
    entered = paths.join(inside, list(_NODE)).groupBy("conv_id").agg((F.max("depth") + 1).alias("top"))
    top = F.coalesce("top", F.lit(1)).cast("long")
    roots = paths.join(entered, "conv_id", "left").withColumn("top", top).filter("depth = top")
    roots = roots.select("conv_id", "top", F.col("f1").alias("shard"))
    none = {name: _zero() for name in _FORWARD[-3:]}
    below = nodes.filter(light).join(roots, "conv_id").withColumns(none).select(*_FORWARD)
    reverse_levels = ("shard", F.desc("depth"), "f1", "f2")
    below = below.repartition("shard").sortWithinPartitions(*reverse_levels)
    below = stored(below.mapInArrow(_forward(limit), _FORWARD_SCHEMA), "shards")
    brought = (
        below.filter("depth = top")
        .groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("f1"), F.col("p2").alias("f2"))
        .agg(*(F.sum(c).alias(c) for c in _FORWARD[-2:]), F.count("*").alias("n_children"))
    )
    above = above.join(brought, list(_NODE), "left").fillna(0, list(_FORWARD[-3:]))
    above = above.withColumns({"shard": _zero(), "top": _zero()}).select(*_FORWARD)
    above = above.repartition(1).sortWithinPartitions(*reverse_levels)
    return below.unionByName(above.mapInArrow(_forward(limit), _FORWARD_SCHEMA))


def trie(rebuilt: DataFrame, convs: DataFrame, shard: int | None = None, limit: int = QUEUE) -> DataFrame:
    """Nodes of the conversations `convs` (conv_id, length) with turns `rebuilt` (conv_id,
    depth from 1 to length, length, words, a, b): conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    paths = prefixes(rebuilt)
    nodes = _nodes(paths, convs)
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("f1").alias("p1"), F.col("f2").alias("p2"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    totals = _totals(nodes, paths, shard, limit)
    joined = totals.join(_endings(paths, convs), list(_NODE), "left")
    joined = joined.join(parents, ["depth", "p1", "p2"], "left")
    nobody = F.lit(hashlib.sha256(b"").hexdigest())
    return joined.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", nobody).alias("ends_sha256"),
    )
