"""Intermediate results written once and read many times."""

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.sources.tables import shuffles_removed, write_observed

#: May be set at run time; otherwise spark.checkpoint.dir names the folder.
SETTING = "spark.martwright.staging.dir"

# Rows that a bucket may hold, and beyond them how many times the mean.
BUCKET_ROWS, BUCKET_SHARE = 1_000_000, 4


# Folders staged since the innermost `released` began.
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Empty the folders staged inside the block when it ends, also when it fails. What the
    block leaves must not read them any more, as rows written to a table do not."""
    made: list[str] = []
    token = _made.set(made)
    try:
        yield
    finally:
        _made.reset(token)
        for folder in made:
            spark.range(0).write.mode("overwrite").parquet(folder)


def _staged_folder(spark: SparkSession) -> str:
    folder, made = new_folder(spark), _made.get()
    if made is not None:
        made.append(folder)
    return folder


def staging_root(spark: SparkSession) -> str:
    """Folder for intermediate tables that driver and executors share."""
    folder = spark.conf.get(SETTING, None) or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise ValueError(f"set {SETTING} or spark.checkpoint.dir to a folder all executors share")
    return f"{folder.rstrip('/')}/martwright"


def new_folder(spark: SparkSession) -> str:
    return f"{staging_root(spark)}/{uuid.uuid4().hex}"


def stage(df: DataFrame) -> DataFrame:
    """Write a frame as Parquet and return the scan of it.

    Cuts the lineage at durable storage, so a lost executor costs a re-read, and later
    consumers read only the columns they need.
    """
    path = _staged_folder(df.sparkSession)
    with shuffles_removed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_counted(df: DataFrame) -> tuple[DataFrame, int]:
    """The same with the number of rows, counted by the write."""
    path = _staged_folder(df.sparkSession)
    count = write_observed(df, path)["count"]
    return df.sparkSession.read.schema(df.schema).parquet(path), count


def stage_by(df: DataFrame, key: str) -> DataFrame:
    """Write a frame in buckets of a key's hash, as many as a shuffle has partitions, and return
    the scan of it.

    What then ranks, groups or joins by the key reads buckets and shuffles nothing; columns in
    files take a fraction of what rows take in a shuffle. A bucket is read by one task, so
    where a hot key fills one, the scan returned is a plain one, whose rows later steps shuffle.
    """
    return stage_by_counted(df, key)[0]


def stage_by_counted(df: DataFrame, key: str) -> tuple[DataFrame, int]:
    """The same with the number of rows."""
    spark, path = df.sparkSession, _staged_folder(df.sparkSession)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"martwright_{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd").option("path", path).bucketBy(buckets, key)
    with shuffles_removed(spark):
        writer.saveAsTable(table)
    bucketed = spark.table(table)
    # Only the entry goes: the files of an external table stay, and the scan has been resolved.
    spark.sql(f"DROP TABLE `{table}`")
    plain = spark.read.schema(df.schema).parquet(path)
    # The bucket's number ends the file's name.
    files = plain.groupBy(F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("n"))
    held = files.groupBy(F.regexp_extract("file", r"_([0-9]+)[.][^/]*$", 1)).agg(F.sum("n").alias("n"))
    rows, most = held.agg(F.sum("n"), F.max("n")).first()
    even = (most or 0) <= max(BUCKET_ROWS, BUCKET_SHARE * (rows or 0) / buckets)
    return bucketed if even else plain, rows or 0
