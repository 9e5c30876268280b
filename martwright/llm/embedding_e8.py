"""Near-duplicate embeddings found by E8 lattice hashing.

In each of TABLES tables a random rotation takes a unit vector to sixteen numbers, two
blocks of eight, and each block is decoded to its nearest point of the lattice E8. A
vector is filed under its pair of points. It is looked up under all pairs made of its own
points and the PROBES lattice points next nearest in each block. Pairs that meet in any
table, of one label and one length, are compared by cosine in double precision. The scale
of the lattice follows from the vectors' length so that a pair at a cosine of 0.98 meets
in one table with a probability of 0.87 and in one of four with 0.999.

Equal vectors of a label are one class with a count, so copies are never paired. Candidate
pairs hold two ids until they are distinct, then each side's vector is joined once.

Defined cases: vectors that are null, zero, or hold a null or non-finite component, and
those with a null label, link with nothing; a row with a null vec_id links with nothing
and has no component; rows of one vec_id with different vectors are compared each for
itself and may lie in different components; an empty table gives no rows; other columns are
not read.
"""

from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from martwright.llm.common import stored
from martwright.llm.components import components

TABLES = 4
PROBES = 4
LEAST_COSINE = 0.98
#: Times the root of the vectors' length: the lattice's scale.
SCALE = 0.5625
_SEED = 20
_BLOCKS = 2
_ROWS = 2048


def _shortest() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    found = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1.0, -1.0), repeat=2):
            vector = np.zeros(8)
            vector[i], vector[j] = a, b
            found.append(vector)
    halves = (np.array(signs) for signs in product((0.5, -0.5), repeat=8))
    return np.array(found + [h for h in halves if (h < 0).sum() % 2 == 0])


_NEIGHBOURS = _shortest()


def _nearest_d8(points: np.ndarray) -> np.ndarray:
    """Nearest whole points whose coordinates have an even sum."""
    whole = np.rint(points)
    error = points - whole
    odd = np.flatnonzero(whole.sum(axis=1) % 2)
    worst = np.abs(error[odd]).argmax(axis=1)
    whole[odd, worst] += np.where(error[odd, worst] >= 0, 1.0, -1.0)
    return whole


def nearest_e8(points: np.ndarray) -> np.ndarray:
    """Nearest points of E8, which is D8 and D8 moved by a half in every coordinate."""
    whole, half = _nearest_d8(points), _nearest_d8(points - 0.5) + 0.5
    nearer = ((points - whole) ** 2).sum(axis=1) <= ((points - half) ** 2).sum(axis=1)
    return np.where(nearer[:, None], whole, half)


def _projection(length: int, table: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([_SEED, length, table])
    size = 8 * _BLOCKS
    rotation = np.linalg.qr(rng.normal(size=(max(length, size), size)))[0][:length]
    return rotation * SCALE * np.sqrt(max(length, size)), rng.random(size)


def _mixed(*columns: np.ndarray) -> np.ndarray:
    key = np.zeros(np.broadcast_shapes(*(c.shape for c in columns)), np.uint64)
    for column in columns:
        key = (key ^ column.astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key


def _cells(points: np.ndarray, probing: bool) -> np.ndarray:
    """Numbers of each point's cell, and of the PROBES next cells; a column each."""
    own = nearest_e8(points)
    cells = own[:, None]
    if probing:
        nearness = (points - own) @ _NEIGHBOURS.T
        next_ = np.argsort(-nearness, axis=1, kind="stable")[:, :PROBES]
        cells = np.concatenate([cells, own[:, None] + _NEIGHBOURS[next_]], axis=1)
    doubled = np.rint(2 * cells).astype(np.int64)
    return _mixed(*(doubled[:, :, i] for i in range(8)))


def cell_keys(vectors: np.ndarray, labels: np.ndarray, table: int, probing: bool) -> np.ndarray:
    """Keys of unit vectors in a table; a column for each cell looked at."""
    length = vectors.shape[1]
    rotation, offset = _projection(length, table)
    points = vectors @ rotation + offset
    first, second = (_cells(points[:, 8 * b : 8 * b + 8], probing) for b in range(_BLOCKS))
    pairs = _mixed(first[:, :, None].view(np.int64), second[:, None, :].view(np.int64))
    place = np.full(len(vectors), table * 1_000_003 + length, np.int64)
    scope = _mixed(labels.astype(np.int64), place)
    return _mixed(scope[:, None].view(np.int64), pairs.reshape(len(vectors), -1).view(np.int64))


def _key_task(probing: bool):
    def task(batches):
        for batch in batches:
            sizes = batch.column(2).value_lengths().to_numpy()
            for length in np.unique(sizes):
                rows = np.flatnonzero(sizes == length)
                for first in range(0, len(rows), _ROWS):
                    part = batch.take(pa.array(rows[first : first + _ROWS]))
                    vectors = part.column(2).flatten().to_numpy().astype(np.float64)
                    vectors = vectors.reshape(len(part), length)
                    # By the greatest component first, as squares may overflow.
                    vectors /= np.abs(vectors).max(axis=1, keepdims=True)
                    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
                    ids, labels = part.column(0).to_numpy(), part.column(1).to_numpy()
                    for table in range(TABLES):
                        keys = cell_keys(vectors, labels, table, probing)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(keys.ravel().view(np.int64)),
                                pa.array(np.repeat(ids, keys.shape[1])),
                            ],
                            ["key", "id"],
                        )

    return task


@F.arrow_udf(DoubleType())
def _cosine(left: pa.Array, right: pa.Array) -> pa.Array:
    sizes = left.value_lengths().to_numpy()
    flat = [a.flatten().to_numpy().astype(np.float64) for a in (left, right)]
    starts = np.cumsum(sizes) - sizes
    if not len(sizes):
        return pa.array([], pa.float64())
    # Scaled by the greatest component, so that no square overflows.
    flat = [a / np.repeat(np.maximum.reduceat(np.abs(a), starts), sizes) for a in flat]
    dot, own, other = (
        np.add.reduceat(x, starts) for x in (flat[0] * flat[1], flat[0] ** 2, flat[1] ** 2)
    )
    return pa.array(dot / (np.sqrt(own) * np.sqrt(other)))


def links(classes: DataFrame, least_cosine: float = LEAST_COSINE) -> DataFrame:
    """Pairs (u, v), u < v, of classes (id, label, embedding) with a cosine that high."""
    keyed = classes.select("id", F.col("label").cast("long").alias("label"), "embedding")
    filed = keyed.mapInArrow(_key_task(False), "key long, id long").withColumnRenamed("id", "u")
    probes = keyed.mapInArrow(_key_task(True), "key long, id long").withColumnRenamed("id", "v")
    met = filed.join(probes, "key").filter("u <> v")
    pairs = met.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    one = classes.select(F.col("id").alias("u"), "label", F.col("embedding").alias("left"))
    two = classes.select(
        F.col("id").alias("v"), F.col("label").alias("other"), F.col("embedding").alias("right")
    )
    both = pairs.join(one, "u").join(two, "v").filter("label = other and size(left) = size(right)")
    return both.filter(_cosine("left", "right") >= least_cosine).select("u", "v")


def near_duplicates(embeddings: DataFrame, least_cosine: float = LEAST_COSINE) -> DataFrame:
    """vec_id, n_links (other vectors linked directly) and component_id (smallest vec_id
    reachable) of `embeddings` (vec_id, embedding, label)."""
    rows = embeddings.select("vec_id", "embedding", "label")
    usable = (
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & F.coalesce(F.exists("embedding", lambda x: x != 0), F.lit(False))
        & F.forall(
            "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
        )
    )
    compared = rows.filter(usable)
    grouped = compared.groupBy("label", "embedding").agg(
        F.min("vec_id").alias("first"), F.count("*").alias("n")
    )
    # Written once, so a class keeps its number.
    classes = stored(grouped.withColumn("id", F.monotonically_increasing_id()), "classes")
    pairs = stored(links(classes, least_cosine), "links")
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    counts = both.join(classes.select(F.col("id").alias("v"), "n"), "v").groupBy("u")
    counts = counts.agg(F.sum("n").alias("others")).withColumnRenamed("u", "id")
    nodes = components(pairs).withColumnRenamed("node", "id")
    found = classes.join(counts, "id", "left").join(nodes, "id", "left")
    found = found.withColumn("component", F.coalesce("component", "id"))
    names = found.groupBy("component").agg(F.min("first").alias("component_id"))
    named = stored(
        found.join(names, "component").select(
            "label", "embedding", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id"
        ),
        "named",
    )
    linked = compared.join(named, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter(~F.coalesce(usable, F.lit(False))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.unionByName(alone)
