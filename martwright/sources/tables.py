"""Parquet tables written as numbered snapshots that become visible when published.

What a table is made of is said by its publish records, one line of text each: the number,
the batch it holds, its rows, an order-free digest of its content, its parts' schemas and
the greatest values of its keys. Counts, digests and greatest values are taken while the
rows are written, so no reader opens footers or scans rows for them.
"""

import json
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Whether an execution's shuffle files go when it ends, and not when the driver happens to
# collect its garbage.
_REMOVAL = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Writes inside the block leave no shuffle files; their rows are in the files written."""
    before = spark.conf.get(_REMOVAL, None)
    spark.conf.set(_REMOVAL, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_REMOVAL)
        else:
            spark.conf.set(_REMOVAL, before)


def content_digest(columns: Iterable[str]) -> Column:
    """Sum of row hashes, alike for the same rows in any order. NULLs count by their place."""
    columns = list(columns)
    there = F.concat(*[F.when(F.col(c).isNull(), "0").otherwise("1") for c in columns])
    return F.sum(F.xxhash64(*columns, there).cast("decimal(38,0)"))


def read_log(spark: SparkSession, path: str) -> list[dict]:
    """All records of a log, a line each; none for a log never written."""
    try:
        lines = spark.read.text(path).collect()
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    return [json.loads(line.value) for line in lines]


def append_log(spark: SparkSession, path: str, record: dict) -> None:
    line = spark.range(1, numPartitions=1).select(F.lit(json.dumps(record)).alias("value"))
    line.write.mode("append").text(path)


@dataclass(frozen=True)
class Written:
    """A part of a coming snapshot, and what its write has observed."""

    number: int
    part: str
    rows: DataFrame
    count: int
    digest: str | None = None
    greatest: dict[str, int] = field(default_factory=dict)


def write_observed(
    df: DataFrame,
    folder: str,
    digest_of: Iterable[str] | None = None,
    greatest: Iterable[str] = (),
    partition_by: Iterable[str] = (),
    widest: Iterable[str] = (),
) -> dict:
    """Write rows, replacing what the folder holds; their count, digest, greatest keys and the
    greatest number of bytes in each of some columns."""
    seen = Observation()
    marks = [F.count(F.lit(1)).alias("count"), *(F.max(c).alias(c) for c in greatest)]
    marks += [F.max(F.octet_length(F.col(c).cast("string"))).alias(f"_{c}") for c in widest]
    if digest_of is not None:
        marks.append(content_digest(digest_of).cast("string").alias("digest"))
    writer = df.observe(seen, *marks).write.mode("overwrite")
    with shuffles_removed(df.sparkSession):
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(folder)
    found = seen.get
    keys = {c: found[c] for c in greatest if found[c] is not None}
    # The digest of no rows is 0.
    return {
        "count": found["count"], "greatest": keys, "widest": {c: found[f"_{c}"] or 0 for c in widest},
        "digest": None if digest_of is None else found["digest"] or "0",
    }


@dataclass(frozen=True)
class SnapshotTable:
    """`<path>/<part>/snapshot=N` folders plus the log of publish records.

    A plan may read snapshot N while N+1 is written, and readers ignore a folder until
    its number is published. A failed run leaves an unpublished folder that the next
    run overwrites.
    """

    spark: SparkSession
    path: str

    def records(self) -> list[dict]:
        """Publish records, oldest first."""
        found = read_log(self.spark, f"{self.path}/log")
        return sorted(found, key=lambda r: (r["snapshot"], r["entry"]))

    def published(self) -> int:
        """Newest visible snapshot, 0 for a table never published."""
        return max((r["snapshot"] for r in self.records()), default=0)

    def batch(self, batch_id: str) -> dict | None:
        """The record of a batch that the table has taken."""
        return next((r for r in self.records() if r["batch_id"] == batch_id), None)

    def greatest(self, key: str) -> int:
        """The greatest published value of a key; 0 for none."""
        return max((r["greatest"].get(key, 0) for r in self.records()), default=0)

    def write(self, df: DataFrame, part: str = "rows") -> DataFrame:
        """Write the coming snapshot of a part and return the scan of it."""
        return self.write_observed(df, part).rows

    def write_observed(self, df: DataFrame, part: str = "rows", **options) -> Written:
        """The same, with what the write has observed; options as for the function."""
        number = self.published() + 1
        folder = self.folder(number, part)
        seen = write_observed(df, folder, **options)
        rows = self.spark.read.schema(df.schema).parquet(folder).select(*df.columns)
        return Written(number, part, rows, seen["count"], seen["digest"], seen["greatest"])

    def publish(
        self,
        *written: Written,
        index: Iterable[Written] = (),
        batch_id: str | None = None,
        digest: str | None = None,
    ) -> int:
        """Make the parts of the coming snapshot visible; without any, those in its folder.
        Parts in `index` repeat rows of others, so they do not count."""
        number = self.published() + 1
        if written:
            schemas = {w.part: w.rows.schema for w in (*written, *index)}
        else:
            schemas = {"rows": self.spark.read.parquet(self.folder(number)).schema}
        greatest: dict[str, int] = {}
        for part in written:
            for key, value in part.greatest.items():
                greatest[key] = max(value, greatest.get(key, value))
        rows = sum(w.count for w in written) if written else None
        digest = digest or next((w.digest for w in written if w.digest), None)
        self._log(number, batch_id, digest, rows, schemas, greatest)
        return number

    def note(self, batch_id: str, digest: str | None = None) -> None:
        """Record a batch that the table has taken without a change."""
        self._log(self.published(), batch_id, digest, 0, {}, {})

    def _log(self, number, batch_id, digest, rows, schemas, greatest) -> None:
        record = {
            "snapshot": number, "entry": len(self.records()), "batch_id": batch_id,
            "rows": rows, "digest": digest, "greatest": greatest,
            "schemas": {part: schema.jsonValue() for part, schema in schemas.items()},
        }
        append_log(self.spark, f"{self.path}/log", record)

    def latest(self, part: str = "rows") -> DataFrame:
        """The newest published snapshot: the whole content of a replaced table."""
        return self._read([self._visible(part)[-1]], part)

    def history(self, part: str = "rows", after: int = 0, until: int | None = None) -> DataFrame:
        """All published snapshots together, or those after one number and until another: the
        content of an appended table.

        Columns of every one of them apply, the newest one's first; files show NULL for a
        column they lack. With none between the numbers, no rows of the table's columns.
        """
        visible = self._visible(part)
        last = visible[-1]["snapshot"] if until is None else until
        wanted = [r for r in visible if after < r["snapshot"] <= last]
        return self._read(wanted, part) if wanted else self._read(visible[-1:], part).limit(0)

    def of_batch(self, batch_id: str) -> DataFrame:
        """The rows of a published batch, with no other snapshot's columns."""
        found = [r for r in self._visible("rows") if r["batch_id"] == batch_id]
        if not found:
            raise FileNotFoundError(f"nothing published at {self.path} is batch {batch_id}")
        return self._read(found, "rows")

    def folder(self, number: int, part: str = "rows") -> str:
        return f"{self.path}/{part}/snapshot={number}"

    def _visible(self, part: str) -> list[dict]:
        """Records of the snapshots that hold the part, oldest first."""
        found = [r for r in self.records() if part in r["schemas"]]
        if not found:
            raise FileNotFoundError(f"nothing published at {self.path}")
        return found

    def _read(self, records: list[dict], part: str) -> DataFrame:
        schema = joined_schema([r["schemas"][part] for r in reversed(records)])
        folders = [self.folder(r["snapshot"], part) for r in records]
        found = self.spark.read.schema(schema).option("basePath", f"{self.path}/{part}").parquet(*folders)
        return found.select(*schema.names)


def joined_schema(schemas: list[dict]) -> T.StructType:
    """All columns of several schemas, those of the first one first."""
    columns: dict[str, T.StructField] = {}
    for schema in schemas:
        for column in T.StructType.fromJson(schema):
            known = columns.setdefault(column.name, column)
            if known.dataType != column.dataType:
                raise ValueError(f"column {column.name} is {known.dataType} and {column.dataType}")
    return T.StructType([T.StructField(c.name, c.dataType) for c in columns.values()])
