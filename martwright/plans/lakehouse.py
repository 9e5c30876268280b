"""The layered tables below one root folder, and the record that publishes the star."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from martwright.sources.tables import SnapshotTable, append_log, joined_schema, read_log

DIMENSIONS = ("dim_customer", "dim_product", "dim_promotion", "dim_date")
STAR_TABLES = (*DIMENSIONS, "fact_sales")

#: Tables that are stored by month, each month in the snapshot that changed it last.
MONTHLY = ("fact_sales", "kpi_states")

MONTH = "sale_month"


@dataclass(frozen=True)
class Lakehouse:
    """The layered tables below one root folder."""

    spark: SparkSession
    root: str

    def raw(self, entity: str, load_type: str) -> str:
        return f"{self.root}/raw/{entity}/{load_type}"

    def landing(self, entity: str, load_type: str) -> SnapshotTable:
        return SnapshotTable(self.spark, f"{self.root}/landing/{entity}/{load_type}")

    def bronze(self, entity: str, load_type: str) -> SnapshotTable:
        return SnapshotTable(self.spark, f"{self.root}/bronze/{entity}/{load_type}")

    def silver(self, entity: str) -> SnapshotTable:
        return SnapshotTable(self.spark, f"{self.root}/silver/{entity}")

    def gold(self, table: str) -> SnapshotTable:
        return SnapshotTable(self.spark, f"{self.root}/gold/{table}")

    def customers(self) -> DataFrame:
        """Customer history: open versions of the last merge, closed ones of all."""
        table = self.silver("customer")
        return table.latest("current").unionByName(
            table.history("closed"), allowMissingColumns=True
        )

    def products(self) -> DataFrame:
        return self.silver("product").latest()

    def sales(self) -> DataFrame:
        return self.ledger().drop(MONTH)

    def ledger(self, after: int = 0, until: int | None = None) -> DataFrame:
        """Sales with the month they are stored by, of all batches or some."""
        return self.silver("sales").history(after=after, until=until)

    def sales_keys(self, until: int | None = None) -> DataFrame:
        """Ids of the ledger with the part they are stored in."""
        return self.silver("sales").history("keys", until=until)

    # --- the published star ---------------------------------------------------------

    def publication(self) -> dict | None:
        """The newest record that names the snapshots of the star which belong together."""
        found = read_log(self.spark, f"{self.root}/gold/publications")
        return max(found, key=lambda r: r["number"], default=None)

    def publish_star(self, record: dict) -> None:
        """One line makes all tables of a star visible at once."""
        append_log(self.spark, f"{self.root}/gold/publications", record)

    def star(self, publication: dict | None = None) -> dict[str, DataFrame]:
        """The tables of the star as they were published together."""
        record = publication or self.publication()
        if record is None:
            raise FileNotFoundError(f"no star published at {self.root}")
        return {name: self.star_table(record, name) for name in STAR_TABLES}

    def star_table(self, record: dict, name: str) -> DataFrame:
        if name in MONTHLY:
            return self.monthly(record, name).drop(MONTH)
        schema = joined_schema([record["schemas"][name]])
        return self.spark.read.schema(schema).parquet(self.gold(name).folder(record["number"]))

    def monthly(self, record: dict, name: str) -> DataFrame:
        """A table stored by month, with its month."""
        schema = joined_schema([record["schemas"][name]])
        schema = T.StructType([*(f for f in schema if f.name != MONTH), T.StructField(MONTH, T.IntegerType())])
        folders = list(self.month_folders(record, name).values())
        if not folders:
            return self.spark.createDataFrame([], schema)
        base = f"{self.gold(name).path}/rows"
        found = self.spark.read.schema(schema).option("basePath", base).parquet(*folders)
        return found.select(*schema.names)

    def month_folders(self, record: dict, name: str) -> dict[int, str]:
        table = self.gold(name)
        return {
            int(month): f"{table.folder(number)}/{MONTH}={month}"
            for month, number in record["months"].items()
        }
