"""Catalog entries for the star schema."""

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType


def register_tables(
    spark: SparkSession, schema: str, folders: dict[str, str], location: str | None = None
) -> None:
    """Make each folder a Parquet table of the schema and point it at the folder."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema}`{where}")
    for table, folder in folders.items():
        name = f"`{schema}`.`{table}`"
        # Only the entry goes: the files of an external table stay.
        if spark.catalog.tableExists(name) and (
            spark.table(name).schema != spark.read.parquet(folder).schema
        ):
            spark.sql(f"DROP TABLE {name}")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS `{schema}`.`{table}` USING parquet LOCATION '{folder}'"
        )
        spark.sql(f"ALTER TABLE `{schema}`.`{table}` SET LOCATION '{folder}'")
        spark.catalog.refreshTable(f"`{schema}`.`{table}`")


def register_monthly(
    spark: SparkSession, schema: str, table: str, columns: StructType, by: str, folders: dict[int, str]
) -> None:
    """Make a table of the schema out of one folder for each value of the column `by`.

    The entry is made anew, so a reader sees the folders of one publication; files stay.
    """
    name = f"`{schema}`.`{table}`"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    listed = ", ".join(f"`{c.name}` {c.dataType.simpleString()}" for c in columns)
    # Its own folder stays empty: every partition has its place.
    home = f"{min(folders.values()).rsplit('/', 2)[0]}/registered" if folders else None
    where = f" LOCATION '{home}'" if home else ""
    spark.sql(f"CREATE TABLE {name} ({listed}) USING parquet PARTITIONED BY (`{by}`){where}")
    if folders:
        parts = " ".join(f"PARTITION (`{by}`={value}) LOCATION '{folder}'" for value, folder in folders.items())
        spark.sql(f"ALTER TABLE {name} ADD {parts}")
    spark.catalog.refreshTable(name)
