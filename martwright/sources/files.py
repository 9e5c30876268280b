"""CSV feeds: file selection, by-name reading, audit control files."""

import re
from collections.abc import Iterable
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.contracts import contract_columns


def list_feed_files(spark: SparkSession, root: str, entity: str) -> DataFrame:
    """Every `*.csv` or `*.csv.gz` below root whose relative path names the entity and no audit.

    The binary-file source lists paths and sizes; file contents stay unread because
    the content column is never selected.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.[cC][sS][vV]{,.[gG][zZ]}")
        .load(root)
        .select("path", "length")
    )
    # Listed paths may name scheme and host where the root does not.
    inner = _below_scheme(root).rstrip("/") + "/"
    begin = F.instr("path", inner) + len(inner)
    below_root = F.lower(F.col("path").substr(begin, F.length("path")))
    return files.filter(
        below_root.contains(entity.lower()) & ~below_root.contains("audit")
    )


def feed_folders(spark: SparkSession, root: str, entity: str) -> dict[str, list[str]]:
    """Selected files grouped by the folder that delivered them.

    Only paths reach the driver, which lists a scan's files in any case.
    """
    folders: dict[str, list[str]] = {}
    for row in list_feed_files(spark, root, entity).select("path").collect():
        folders.setdefault(row.path.rsplit("/", 1)[0], []).append(row.path)
    if not folders:
        raise FileNotFoundError(f"no {entity} CSV below {root}")
    return {folder: sorted(paths) for folder, paths in sorted(folders.items())}


def read_text_csv(spark: SparkSession, paths: str | list[str], mode: str = "PERMISSIVE") -> DataFrame:
    """All columns as text, named by the header.

    `enforceSchema=false` makes every file's own header part of the check: a file whose
    header differs from the first one fails the scan instead of shifting its columns.
    """
    return (
        spark.read.option("header", True)
        .option("mode", mode)
        .option("enforceSchema", False)
        .csv(paths)
    )


def read_contract_csv(spark: SparkSession, entity: str, paths: str | list[str]) -> DataFrame:
    feed = read_text_csv(spark, paths)
    return feed.select(*contract_columns(entity, feed.columns))


def _below_scheme(path: str) -> str:
    return re.sub("^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", path)


def header_groups(spark: SparkSession, paths: list[str]) -> list[list[str]]:
    """The files in groups of one first line, by which a group can be read in one scan.

    First lines are found by one scan of text, a line a file being kept; only they and
    the paths reach the driver.
    """
    lines = spark.read.text(paths).select(
        "value",
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("begin"),
        F.monotonically_increasing_id().alias("at"),
    )
    first = lines.filter("begin = 0").groupBy("path").agg(F.min_by("value", "at").alias("header"))
    given = {_below_scheme(path): path for path in paths}
    groups: dict[str, list[str]] = {}
    for row in first.collect():
        path = given.pop(unquote(_below_scheme(row.path)))
        groups.setdefault(row.header.lstrip("\ufeff").rstrip("\r"), []).append(path)
    # Files without a line have no header; a scan of them says so.
    return [sorted(group) for _, group in sorted(groups.items())] + [[path] for path in sorted(given.values())]


def strict_union(frames: Iterable[DataFrame]) -> DataFrame:
    """By-name union that refuses frames with differing columns."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=False), frames)


def padded_union(frames: Iterable[DataFrame]) -> DataFrame:
    """By-name union that pads absent columns with NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_entity_feed(
    spark: SparkSession, root: str, entity: str, per_file: bool = False
) -> DataFrame:
    """One logical feed out of all matching files.

    Files with one header are read in one scan, however many they are, and the scans meet
    in a by-name union. A folder is one delivery, whose first file speaks for the others;
    another header in it fails the scan. `per_file` looks at the header of every file, for
    folders that mix them.
    """
    folders = feed_folders(spark, root, entity)
    if per_file:
        groups = header_groups(spark, [path for paths in folders.values() for path in paths])
    elif len(folders) == 1:
        groups = list(folders.values())
    else:
        speaks_for = {paths[0]: paths for paths in folders.values()}
        groups = [
            [path for first in group for path in speaks_for[first]]
            for group in header_groups(spark, list(speaks_for))
        ]
    return strict_union(read_contract_csv(spark, entity, group) for group in groups)


def write_text_csv(df: DataFrame, path: str) -> None:
    """Compressed CSV with a header; blanks around values are kept. A file is one task's, so
    its readers are as many as its writers."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("compression", "gzip")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """Control file with the row count each dataset must have."""
    audit = read_text_csv(spark, path, mode="FAILFAST")
    missing = sorted({"table_name", "row_count"} - set(audit.columns))
    if missing:
        raise ValueError(f"audit file {path} lacks columns {missing}")
    return audit.select("table_name", "row_count")
