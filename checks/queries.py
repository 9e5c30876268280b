"""The operators run on the derived feeds, one entry per check."""

import functools
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks.feeds import feed, read_tables, shared_lines, store_lines
from martwright.contracts import (
    CUSTOMER_RULES,
    ENTITIES,
    OPTIONAL_COLUMNS,
    PRODUCT_RULES,
    SALES_RULES,
    SOURCE_COLUMNS,
)
from martwright.functions.calendar import calendar_attributes
from martwright.functions.parsing import to_day, to_double, to_whole
from martwright.operators import audit, cleanse, dedup, kpis, lookups, merge, star
from martwright.operators.keys import dense_key, id_order
from martwright.plans import medallion
from martwright.sources import catalog, files, provenance
from martwright.sources.staging import new_folder, released, stage, stage_by
from martwright.sources.tables import SnapshotTable

AS_OF = "2001-12-31"
LOADS = {"historical": "hist", "incremental": "inc"}

# Columns that name a KPI's groups.
KPI_GROUPS = {
    "net_margin_by_store": ["store_location"],
    "order_value_by_promotion": ["promotion_type"],
    "churn_heatmap": ["customer_state", "loyalty_program"],
    "product_quality": ["product_category"],
    "store_traffic": ["store_location", "day_of_week", "transaction_hour"],
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(run):
    @functools.wraps(run)
    def prepared(spark, sf_dir):
        with shared_lines():
            return run(spark, sf_dir)

    QUERIES[run.__name__] = prepared
    return prepared


# --- shared inputs ------------------------------------------------------------------


# Cleaned feeds that the query at work has stored for all its steps.
_cleaned: ContextVar[dict[tuple[str, str], DataFrame] | None] = ContextVar("cleaned", default=None)


@contextmanager
def shared_cleaned() -> Iterator[None]:
    """Each feed is derived and cleaned once, however many steps of a query begin with it."""
    token = _cleaned.set({})
    try:
        yield
    finally:
        _cleaned.reset(token)


def cleaned(spark, sf_dir, name) -> DataFrame:
    """A cleaned feed, stored as a merge expects it."""
    known, key = _cleaned.get(), (sf_dir, name)
    if known is None:
        return stage(cleaned_plan(spark, sf_dir, name))
    if key not in known:
        known[key] = stage(_cleaned_feed(spark, sf_dir, name))
    return known[key]


def cleaned_plan(spark, sf_dir, name) -> DataFrame:
    """A cleaned feed for a single reader; where feeds are shared, the stored one."""
    return (_cleaned_feed if _cleaned.get() is None else cleaned)(spark, sf_dir, name)


def _cleaned_feed(spark, sf_dir, name) -> DataFrame:
    return cleanse.CLEANERS[name.split("_")[1]](feed(spark, sf_dir, name, often=True))


def first_customers(spark, sf_dir):
    """The first history; its keys come from stored rows, so it is not stored again."""
    return merge.initialize_history(cleaned_plan(spark, sf_dir, "src_customer_hist"))


def customer_merge(spark, sf_dir, increment="src_customer_inc"):
    target = first_customers(spark, sf_dir)
    return merge.merge_history(target, cleaned(spark, sf_dir, increment), AS_OF)


def first_products(spark, sf_dir):
    rows = cleaned_plan(spark, sf_dir, "src_product_hist").drop(*OPTIONAL_COLUMNS["product"])
    return merge.initialize_products(rows)


def product_increment(spark, sf_dir):
    return cleaned(spark, sf_dir, "src_product_inc").drop(*OPTIONAL_COLUMNS["product"])


def merged_products(spark, sf_dir):
    return merge.upsert_products(
        first_products(spark, sf_dir), product_increment(spark, sf_dir)
    )


def ledger_rows(spark, sf_dir, name) -> DataFrame:
    """A cleaned sales feed for a single reader. The feed is stored in buckets of the ledger's
    key, so that no whole row is shuffled to be ranked, numbered or searched for."""
    rows = cleanse.require_key(feed(spark, sf_dir, name, to_store=True), merge.SALES_KEY)
    return cleanse.clean_sales(stage_by(rows, merge.SALES_KEY))


def first_ledger(spark, sf_dir):
    return merge.initialize_ledger(ledger_rows(spark, sf_dir, "src_sales_hist"))


def sales_increment(spark, sf_dir):
    """The cleaned increment, stored by the key that the ledger is searched for."""
    return stage_by(ledger_rows(spark, sf_dir, "src_sales_inc"), merge.SALES_KEY)


def merged_ledger(spark, sf_dir):
    return merge.append_ledger(
        first_ledger(spark, sf_dir), sales_increment(spark, sf_dir)
    )


def star_dimensions(spark, sf_dir) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The ledger and the dimensions, whose keys come from stored rows."""
    sales = merged_ledger(spark, sf_dir)
    return sales, {
        "dim_customer": star.dim_customer(customer_merge(spark, sf_dir).table()),
        "dim_product": star.dim_product(merged_products(spark, sf_dir)),
        "dim_promotion": star.dim_promotion(sales),
        "dim_date": star.dim_date(sales),
    }


def star_tables(spark, sf_dir) -> dict[str, DataFrame]:
    """The dimensions and the fact over them."""
    sales, tables = star_dimensions(spark, sf_dir)
    tables["fact_sales"] = star.fact_sales(
        sales, tables["dim_customer"], tables["dim_product"], tables["dim_promotion"]
    )
    return tables


def stamped(spark, sf_dir, entity, load_type, feed_name=None, label="") -> DataFrame:
    """A cleaned feed as a batch that Silver takes, sales in buckets of their id."""
    name = feed_name or f"src_{entity}_{LOADS[load_type]}"
    names = {
        "batch_id": provenance.batch_identity(entity, load_type, label),
        "load_type": F.lit(load_type),
    }
    if entity == "sales":
        return stage_by(ledger_rows(spark, sf_dir, name).withColumns(names), merge.SALES_KEY)
    return stage(cleaned_plan(spark, sf_dir, name).withColumns(names))


# Published stars of each session: after the historical load and after both.
_lakes: WeakKeyDictionary = WeakKeyDictionary()


def published_lake(spark, sf_dir) -> medallion.Lakehouse:
    """A lake whose star was published after the historical load and brought up to date
    after the increment, which KPIs and star queries share. What a step has staged goes when
    the lake's tables hold it."""
    lakes = _lakes.setdefault(spark, {})
    if sf_dir not in lakes:
        read_tables(spark, sf_dir)
        lake = medallion.Lakehouse(spark, new_folder(spark))
        steps = {
            "customer": lambda rows, load: medallion.refine_customers(lake, rows, load, AS_OF),
            "product": lambda rows, load: medallion.refine_products(lake, rows, load),
            "sales": lambda rows, _: medallion.refine_sales(lake, rows, in_buckets=True),
        }
        with shared_lines(), released(spark):
            store_lines(spark, sf_dir)
            for load_type in LOADS:
                for entity, refine in steps.items():
                    with released(spark):
                        refine(stamped(spark, sf_dir, entity, load_type), load_type)
                medallion.build_star(lake)
        lakes[sf_dir] = lake
    return lakes[sf_dir]


def contract_feed(spark, sf_dir, entity, load_type, to_store=False) -> DataFrame:
    rows = feed(spark, sf_dir, f"src_{entity}_{LOADS[load_type]}", to_store=to_store)
    return rows.drop("ingested_at")


# --- sources and sinks --------------------------------------------------------------


@query
def contract_csv_scan(spark, sf_dir):
    folder = new_folder(spark)
    files.write_text_csv(feed(spark, sf_dir, "src_product").drop("ingested_at"), folder)
    return files.read_contract_csv(spark, "product", folder)


@query
def source_file_selection(spark, sf_dir):
    """Rows found of each load, below a folder whose name holds an expression's marks."""
    root = f"{new_folder(spark)}/audit.lake(eu)+1"
    found = {}
    for load_type in LOADS:
        for entity in ENTITIES:
            rows = stage(contract_feed(spark, sf_dir, entity, load_type))
            files.write_text_csv(rows, f"{root}/{load_type}/delivery/{entity}")
            files.write_text_csv(rows, f"{root}/{load_type}/audit/{entity}")
    for load_type in LOADS:
        for entity in ENTITIES:
            found[f"{entity}_{load_type}"] = files.read_entity_feed(
                spark, f"{root}/{load_type}/", entity
            )
    return audit.row_counts(found)


@query
def strict_union(spark, sf_dir):
    historical = feed(spark, sf_dir, "src_sales_hist")
    incremental = feed(spark, sf_dir, "src_sales_inc")
    return files.strict_union([historical, incremental.select(*reversed(incremental.columns))])


@query
def padded_union(spark, sf_dir):
    return files.padded_union(
        [feed(spark, sf_dir, "src_customer_hist"), feed(spark, sf_dir, "src_customer_inc")]
    )


def write_audit(counts: DataFrame, path: str) -> None:
    files.write_text_csv(
        counts.select(F.col("dataset").alias("table_name"), F.col("actual").alias("row_count")),
        path,
    )


@query
def audit_contract(spark, sf_dir):
    read_tables(spark, sf_dir)
    per_nation = spark.table("customer").join(
        spark.table("nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    counts = per_nation.groupBy("n_name", "n_regionkey").agg(F.count("*").alias("n"))
    control = counts.select(
        F.col("n_name").alias("dataset"),
        F.when(F.col("n_regionkey") == 2, F.concat("n", F.lit(" rows")))
        .otherwise(F.col("n").cast("string"))
        .alias("actual"),
        "n_regionkey",
    )
    twice = control.unionByName(control.filter("n_regionkey = 1"))
    folder = new_folder(spark)
    write_audit(twice, folder)
    datasets = spark.table("nation").select(F.col("n_name").alias("dataset"))
    expected_too = spark.table("region").select(F.col("r_name").alias("dataset"))
    return audit.audit_problems(
        files.read_audit(spark, folder), datasets.unionByName(expected_too)
    )


@query
def provenance_stamp(spark, sf_dir):
    stamped = [
        provenance.stamp_provenance(
            feed(spark, sf_dir, f"src_sales_{short}"), "sales", load_type
        ).select("transaction_id", "batch_id", "load_type", "source_file")
        for load_type, short in LOADS.items()
    ]
    return files.strict_union(stamped)


@query
def idempotent_append(spark, sf_dir):
    historical = provenance.stamp_provenance(
        feed(spark, sf_dir, "src_sales_hist"), "sales", "historical"
    )
    incremental = provenance.stamp_provenance(
        feed(spark, sf_dir, "src_sales_inc"), "sales", "incremental"
    )
    once = stage(
        provenance.append_batch(
            historical, incremental, provenance.batch_identity("sales", "incremental")
        )
    )
    again = provenance.append_batch(
        once, incremental, provenance.batch_identity("sales", "incremental")
    )
    return again.groupBy("batch_id", "load_type").agg(F.count("*").alias("n_rows"))


@query
def snapshot_roundtrip(spark, sf_dir):
    """Columns come and go between snapshots; an unpublished one is not seen."""
    read_tables(spark, sf_dir)
    orders = spark.table("orders")
    table = SnapshotTable(spark, new_folder(spark))
    table.write(orders.select("o_orderkey", "o_custkey"))
    table.publish()
    table.write(orders.select("o_orderkey", "o_totalprice"))
    table.publish()
    table.write(orders.select("o_orderdate"))
    return table.history()


def _counts_with_slip(spark, sf_dir) -> tuple[dict[str, DataFrame], DataFrame]:
    """Six loads and control counts, one of which is one too high."""
    loads = {
        f"{entity}_{load_type}": contract_feed(spark, sf_dir, entity, load_type)
        for entity in ENTITIES
        for load_type in LOADS
    }
    counts = audit.row_counts(loads)
    slip = F.when(F.col("dataset") == "product_incremental", 1).otherwise(0)
    return loads, counts.withColumn("actual", F.col("actual") + slip)


@query
def row_count_reconciliation(spark, sf_dir):
    loads, control = _counts_with_slip(spark, sf_dir)
    folder = new_folder(spark)
    write_audit(control, folder)
    report = audit.reconcile(audit.row_counts(loads), files.read_audit(spark, folder))
    return report.orderBy("dataset")


@query
def staged_reconciliation(spark, sf_dir):
    """Historical loads are counted after cleaning, increments before."""
    counted, control = {}, {}
    for entity in ENTITIES:
        historical = feed(spark, sf_dir, f"src_{entity}_hist", often=True)
        incremental = feed(spark, sf_dir, f"src_{entity}_inc", often=True)
        counted[f"{entity}_historical"] = cleanse.CLEANERS[entity](historical)
        counted[f"{entity}_new"] = incremental
        control[f"{entity}_historical"] = historical
        control[f"{entity}_new"] = incremental
    folder = new_folder(spark)
    write_audit(audit.row_counts(control), folder)
    return audit.reconcile(audit.row_counts(counted), files.read_audit(spark, folder))


def _deliver(spark, sf_dir) -> dict[str, str]:
    """Source folders and audit folders as a source system would leave them."""
    root = new_folder(spark)
    paths = {
        "historical": f"{root}/delivery/historical",
        "incremental": f"{root}/delivery/incremental",
        "landing": f"{root}/controls/landing",
        "silver": f"{root}/controls/silver",
    }
    with shared_lines(), released(spark):
        store_lines(spark, sf_dir)
        for load_type in LOADS:
            for entity in ENTITIES:
                with released(spark):
                    _deliver_feed(spark, sf_dir, entity, load_type, paths)
    return paths


def _deliver_feed(spark, sf_dir, entity, load_type, paths) -> None:
    rows = stage(contract_feed(spark, sf_dir, entity, load_type, to_store=True))
    key = SOURCE_COLUMNS[entity][0]
    files.write_text_csv(rows, f"{paths[load_type]}/{entity}")
    landing = medallion.LANDING_AUDIT_FILES[load_type].format(entity=entity)
    silver = medallion.SILVER_AUDIT_FILES[load_type].format(entity=entity)
    dataset = medallion.SILVER_AUDIT_DATASETS[load_type].format(entity=entity)
    write_audit(
        audit.row_counts({f"{entity}_{load_type}": rows}), f"{paths['landing']}/{landing}"
    )
    kept = rows.select(key).filter(F.col(key).isNotNull()).distinct()
    write_audit(
        audit.row_counts({dataset: kept if load_type == "historical" else rows}),
        f"{paths['silver']}/{silver}",
    )


@query
def landing_gate(spark, sf_dir):
    """Landing reports of the six loads, and of a load refused for a wrong count."""
    paths = _deliver(spark, sf_dir)
    lake = medallion.Lakehouse(spark, new_folder(spark))
    reports = []
    for load_type in LOADS:
        for entity in ENTITIES:
            medallion.ingest_raw(lake, paths[load_type], entity, load_type)
            reports.append(medallion.land(lake, paths["landing"], entity, load_type))
    counts = audit.row_counts(
        {"sales_incremental": contract_feed(spark, sf_dir, "sales", "incremental")}
    )
    controls = new_folder(spark)
    name = medallion.LANDING_AUDIT_FILES["incremental"].format(entity="sales")
    write_audit(counts.withColumn("actual", F.col("actual") + 1), f"{controls}/{name}")
    try:
        medallion.land(lake, controls, "sales", "incremental")
    except RuntimeError:
        control = files.read_audit(spark, f"{controls}/{name}")
        reports.append(audit.reconcile(counts, control).select(*reports[0].columns))
    return files.strict_union(reports)


@query
def medallion_e2e(spark, sf_dir):
    """Feed files to the five KPIs through every stored layer, a row for each measure."""
    paths = _deliver(spark, sf_dir)
    lake = medallion.Lakehouse(spark, new_folder(spark))
    roots = {load_type: paths[load_type] for load_type in LOADS}
    medallion.run(lake, roots, paths["landing"], paths["silver"], AS_OF)
    return files.strict_union(
        _measures(name, report) for name, report in medallion.published_kpis(lake).items()
    )


def _measures(name: str, report: DataFrame) -> DataFrame:
    """(kpi, member, measure, value) rows; a member is named by all of its group's columns."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in KPI_GROUPS[name]]
    measures = [c for c in report.columns if c not in KPI_GROUPS[name]]
    rows = report.select(
        F.lit(name).alias("kpi"),
        F.concat_ws(" / ", *parts).alias("member"),
        *[F.col(c).cast("double").alias(c) for c in measures],
    )
    return rows.unpivot(["kpi", "member"], measures, "measure", "value")


@query
def register_star(spark, sf_dir):
    """Row counts of the published star, read through the catalog, and the columns of a
    table registered again after it has got one more."""
    lake = published_lake(spark, sf_dir)
    folder = new_folder(spark)
    schema = "martwright_" + folder.rsplit("/", 1)[-1]
    medallion.register_star(lake, schema, location=f"{folder}/catalog")
    counts = audit.row_counts(
        {name: spark.table(f"{schema}.{name}") for name in medallion.STAR_TABLES}
    )
    counts = counts.select(F.col("dataset").alias("table_name"), F.col("actual").alias("n_rows"))
    stored = stage(counts)
    dates = lake.star()["dim_date"]
    dates.withColumn("half_year", F.ceil(F.col("quarter") / 2)).write.parquet(f"{folder}/dates")
    catalog.register_tables(spark, schema, {"dim_date": f"{folder}/dates"})
    width = len(spark.table(f"{schema}.dim_date").columns)
    # The files stay, the entries of this run go.
    spark.sql(f"DROP SCHEMA `{schema}` CASCADE")
    return stored.unionByName(
        spark.range(1).select(
            F.lit("dim_date columns").alias("table_name"), F.lit(width).cast("long").alias("n_rows")
        )
    )


# --- cleansing ----------------------------------------------------------------------


@query
def drop_null_keys(spark, sf_dir):
    return cleanse.require_key(feed(spark, sf_dir, "src_sales"), "transaction_id")


@query
def blank_to_null(spark, sf_dir):
    return cleanse.blank_to_null(feed(spark, sf_dir, "src_product"), keep=["product_id"])


@query
def fill_unknown(spark, sf_dir):
    return cleanse.fill_unknown(
        feed(spark, sf_dir, "src_customer"), CUSTOMER_RULES.labels
    )


@query
def fill_zero(spark, sf_dir):
    typed = cleanse.cast_tolerant(
        feed(spark, sf_dir, "src_sales"), SALES_RULES.integers, SALES_RULES.doubles
    )
    return cleanse.fill_zero(typed, SALES_RULES.zero_filled).select(
        "transaction_id", *SALES_RULES.integers, *SALES_RULES.doubles
    )


@query
def normalize_boolean(spark, sf_dir):
    return cleanse.normalize_booleans(
        feed(spark, sf_dir, "src_customer"), ["churned", "loyalty_program"]
    ).select("customer_id", "churned", "loyalty_program")


@query
def tolerant_cast(spark, sf_dir):
    """Quantities written in many ways, well-formed and not."""
    read_tables(spark, sf_dir)
    number = F.col("l_quantity").cast("int").cast("string")
    spellings = ["{}", " {} ", "+{}", "-{}", "{}.9", "-{}.5", ".{}", "{}.", "{}e2", "{}x", "", " ", "{}99999999999"]
    which = F.pmod(F.col("l_partkey"), F.lit(len(spellings)))
    text = F.coalesce(
        *[F.when(which == i, F.concat(F.lit(s.split("{}")[0]), number, F.lit(s.split("{}")[1])) if "{}" in s else F.lit(s)) for i, s in enumerate(spellings)]
    )
    return spark.table("lineitem").select(
        "l_orderkey", "l_linenumber", text.alias("number_text")
    ).withColumns(
        {
            "as_int": to_whole(F.col("number_text")),
            "as_bigint": to_whole(F.col("number_text"), "bigint"),
            "as_double": to_double(F.col("number_text")),
        }
    )


@query
def tolerant_timestamp(spark, sf_dir):
    return cleanse.parse_timestamps(
        feed(spark, sf_dir, "src_product"), PRODUCT_RULES.timestamps
    ).select("product_id", *PRODUCT_RULES.timestamps)


@query
def dedup_by_version(spark, sf_dir):
    return dedup.latest_by_version(feed(spark, sf_dir, "src_customer_months"), "customer_id")


@query
def dedup_by_payload_hash(spark, sf_dir):
    rows = cleanse.require_key(feed(spark, sf_dir, "src_customer"), "customer_id")
    return dedup.one_by_payload(rows, "customer_id")


@query
def dedup_by_last_updated(spark, sf_dir):
    rows = cleanse.require_key(feed(spark, sf_dir, "src_product"), "product_id")
    return dedup.latest_by_update(rows, "product_id")


@query
def dedup_latest_ingest(spark, sf_dir):
    rows = cleanse.require_key(feed(spark, sf_dir, "src_sales", often=True), "transaction_id")
    return dedup.latest_by_ingest(rows, "transaction_id")


@query
def clean_customer(spark, sf_dir):
    return cleanse.clean_customer(feed(spark, sf_dir, "src_customer"))


@query
def clean_product(spark, sf_dir):
    return cleanse.clean_product(feed(spark, sf_dir, "src_product"))


@query
def clean_sales(spark, sf_dir):
    return cleaned_plan(spark, sf_dir, "src_sales")


# --- joins --------------------------------------------------------------------------


@query
def anti_join_new_keys(spark, sf_dir):
    return lookups.new_keys(
        cleaned(spark, sf_dir, "src_sales_inc"),
        cleaned(spark, sf_dir, "src_sales_hist"),
        "transaction_id",
    ).select("transaction_id", "ingested_at")


@query
def carry_forward_key(spark, sf_dir):
    return lookups.carry_key(
        product_increment(spark, sf_dir),
        first_products(spark, sf_dir),
        "product_id",
        "product_sk",
    ).select("product_id", "product_sk", "product_stock")


@query
def classify_changes(spark, sf_dir):
    return merge.classify_changes(
        cleaned(spark, sf_dir, "src_customer_inc"), stage(first_customers(spark, sf_dir))
    ).select("customer_id", "change")


@query
def point_in_time_join(spark, sf_dir):
    return lookups.lookup_as_of(
        cleaned_plan(spark, sf_dir, "src_sales"),
        stage(customer_merge(spark, sf_dir, "src_customer_versions").table()),
        "customer_id",
        to_day(F.col("transaction_date")),
        "customer_sk",
    ).select("transaction_id", "customer_sk")


@query
def lookup_product_sk(spark, sf_dir):
    return lookups.lookup(
        cleaned_plan(spark, sf_dir, "src_sales"),
        first_products(spark, sf_dir),
        ["product_id"],
        "product_sk",
    ).select("transaction_id", "product_sk")


@query
def lookup_promotion_sk(spark, sf_dir):
    sales = cleaned(spark, sf_dir, "src_sales")
    return lookups.lookup(
        sales.withColumn("promotion_id", star.promotion_number()),
        stage(star.dim_promotion(sales)),
        ["promotion_id", "promotion_type"],
        "promotion_sk",
    ).select("transaction_id", "promotion_sk")


# --- merges and keys ----------------------------------------------------------------


@query
def row_change_hash(spark, sf_dir):
    rows = feed(spark, sf_dir, "src_customer")
    return rows.select("customer_id", "ingested_at", merge.change_hash(rows).alias("row_hash"))


@query
def dense_surrogate_key(spark, sf_dir):
    read_tables(spark, sf_dir)
    orders = spark.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return dense_key(
        orders, [F.col("o_custkey"), F.col("o_orderdate"), F.col("o_orderkey")], "order_sk"
    )


@query
def continue_surrogate_key(spark, sf_dir):
    return dense_key(
        cleaned(spark, sf_dir, "src_sales_inc").select("transaction_id"),
        id_order("transaction_id"),
        "sales_sk",
        after=first_ledger(spark, sf_dir),
    )


@query
def scd2_initialize(spark, sf_dir):
    return first_customers(spark, sf_dir)


@query
def scd2_merge(spark, sf_dir):
    return customer_merge(spark, sf_dir).table()


@query
def scd2_merge_versions(spark, sf_dir):
    """An increment with several versions per customer."""
    return customer_merge(spark, sf_dir, "src_customer_versions").table()


@query
def scd2_closed_rows(spark, sf_dir):
    return customer_merge(spark, sf_dir).closed().select(
        "customer_id", "customer_sk", "effective_start_date", "effective_end_date"
    )


@query
def scd2_inserted_rows(spark, sf_dir):
    return customer_merge(spark, sf_dir).inserted


@query
def scd2_current_invariant(spark, sf_dir):
    """Violations per table: none after the merge, many if the ranges are ignored."""
    merged = stage(customer_merge(spark, sf_dir, "src_customer_versions").table())
    all_open = merged.withColumn("is_current", F.lit(True))
    return audit.row_counts(
        {
            "merged": merge.current_violations(merged),
            "all_open": merge.current_violations(all_open),
        }
    )


@query
def scd1_upsert(spark, sf_dir):
    return merged_products(spark, sf_dir)


@query
def ledger_append(spark, sf_dir):
    return merged_ledger(spark, sf_dir)


@query
def merge_idempotency(spark, sf_dir):
    """Each merge applied twice, and older batches after newer ones: rows before and after
    the repetition, and rows that differ."""
    with shared_cleaned():
        outcome = _repetitions(spark, sf_dir)
    return files.strict_union(_difference(*case) for case in outcome)


def _repetitions(spark, sf_dir) -> list[tuple[str, DataFrame, DataFrame]]:
    """(case, table, table after the repetition); the first of them is stored."""
    customers_inc = cleaned(spark, sf_dir, "src_customer_versions")
    products_inc = product_increment(spark, sf_dir)
    sales_inc = sales_increment(spark, sf_dir)
    steps = {
        "customer": (
            stage(first_customers(spark, sf_dir)),
            lambda t: merge.merge_history(t, customers_inc, AS_OF).table(),
        ),
        "product": (
            first_products(spark, sf_dir),
            lambda t: merge.upsert_products(t, products_inc),
        ),
        "sales": (first_ledger(spark, sf_dir), lambda t: merge.append_ledger(t, sales_inc)),
    }
    outcome = []
    for name, (start, apply) in steps.items():
        once = stage(apply(start))
        outcome.append((name, once, apply(once)))
    # A batch, a later one, and the first again.
    for name in ("src_customer_inc", "src_customer_versions"):
        batch = cleaned(spark, sf_dir, name)
        later = batch.withColumns(
            {"effective_start_date": F.lit("2010-01-01"), "income_bracket": F.lit("NEXT")}
        )
        rows = stage(first_customers(spark, sf_dir))
        for increment in (batch, later):
            rows = stage(merge.merge_history(rows, increment, AS_OF).table())
        outcome.append((name, rows, merge.merge_history(rows, batch, AS_OF).table()))
    return [*outcome, *_replays(spark, sf_dir)]


def _replays(spark, sf_dir):
    """Batches that Silver has taken, delivered again after later ones: products B, C, B, and
    customers without dates whose repetition comes on a later day."""
    lake = medallion.Lakehouse(spark, new_folder(spark))
    medallion.refine_products(lake, stamped(spark, sf_dir, "product", "historical"), "historical")
    medallion.refine_customers(lake, stamped(spark, sf_dir, "customer", "historical"), "historical")
    products = stamped(spark, sf_dir, "product", "incremental", label="B")
    customers = stamped(spark, sf_dir, "customer", "incremental", label="U").drop("effective_start_date")
    next_batch = {"batch_id": provenance.batch_identity("product", "incremental", "C"), "product_stock": F.lit(-1.0)}
    medallion.refine_products(lake, products, "incremental")
    medallion.refine_products(lake, products.withColumns(next_batch), "incremental")
    once = stage(lake.products())
    medallion.refine_products(lake, products, "incremental")
    yield "product_b_c_b", once, lake.products()
    next_batch = {
        "batch_id": provenance.batch_identity("customer", "incremental", "V"),
        "income_bracket": F.lit("NEXT"),
    }
    medallion.refine_customers(lake, customers, "incremental", AS_OF)
    medallion.refine_customers(lake, customers.withColumns(next_batch), "incremental", "2010-01-01")
    once = stage(lake.customers())
    medallion.refine_customers(lake, customers, "incremental", "2015-01-01")
    yield "customer_undated", once, lake.customers()


def _difference(name, once, twice):
    """Rows of both tables, and distinct rows that do not occur as often in both. Each table is
    read once, so the second one need not be stored."""
    both = once.withColumn("_n", F.lit(1)).unionByName(twice.withColumn("_n", F.lit(-1)))
    rows = both.groupBy(*once.columns).agg(
        F.count_if(F.col("_n") == 1).alias("_once"), F.count_if(F.col("_n") == -1).alias("_twice")
    )
    none = F.lit(0).cast("bigint")
    return rows.agg(
        F.coalesce(F.sum("_once"), none).alias("rows_once"),
        F.coalesce(F.sum("_twice"), none).alias("rows_twice"),
        F.count_if(F.col("_once") != F.col("_twice")).alias("differing"),
    ).select(F.lit(name).alias("table_name"), "rows_once", "rows_twice", "differing")


# --- aggregates ---------------------------------------------------------------------


@query
def uniqueness_violations(spark, sf_dir):
    return audit.uniqueness_violations(feed(spark, sf_dir, "src_sales"), "transaction_id")


@query
def top_regions(spark, sf_dir):
    """All stores by their net margin, with their rank."""
    fact = cleaned_plan(spark, sf_dir, "src_sales")
    # A row for each store.
    order = Window.orderBy(F.desc("net_margin"), "store_location")
    return kpis.net_margin_by_store(fact).withColumn("place", F.row_number().over(order))


@query
def scalar_date_attributes(spark, sf_dir):
    read_tables(spark, sf_dir)
    day = F.col("o_orderdate").cast("date")
    return spark.table("orders").select(
        "o_orderkey", *[c.alias(n) for n, c in calendar_attributes(day).items()]
    )


# --- star schema --------------------------------------------------------------------


@query
def dim_customer(spark, sf_dir):
    return star.dim_customer(customer_merge(spark, sf_dir).table())


@query
def dim_product(spark, sf_dir):
    return star.dim_product(merged_products(spark, sf_dir))


@query
def dim_promotion(spark, sf_dir):
    return star.dim_promotion(cleaned_plan(spark, sf_dir, "src_sales"))


@query
def dim_date(spark, sf_dir):
    return star.dim_date(cleaned_plan(spark, sf_dir, "src_sales"))


@query
def fact_sales(spark, sf_dir):
    return star_tables(spark, sf_dir)["fact_sales"]


@query
def fact_incremental(spark, sf_dir):
    """The published fact, of which the increment has rebuilt only the months it changes."""
    return published_lake(spark, sf_dir).star()["fact_sales"]


@query
def unknown_member(spark, sf_dir):
    """Fact rows per key that fell back to the Unknown member."""
    fact = star_tables(spark, sf_dir)["fact_sales"]
    return fact.agg(
        *[F.count_if(F.col(k) == 0).alias(k) for k in star.FACT_KEYS]
    ).unpivot([], list(star.FACT_KEYS), "key", "unknown_rows")


# --- KPIs ---------------------------------------------------------------------------


@query
def kpi_net_margin(spark, sf_dir):
    return kpis.net_margin_by_store(published_lake(spark, sf_dir).star()["fact_sales"])


@query
def kpi_aov_by_promotion(spark, sf_dir):
    return kpis.order_value_by_promotion(published_lake(spark, sf_dir).star()["fact_sales"])


@query
def kpi_churn_heatmap(spark, sf_dir):
    return kpis.churn_heatmap(published_lake(spark, sf_dir).star()["dim_customer"])


@query
def kpi_product_quality(spark, sf_dir):
    return kpis.product_quality(published_lake(spark, sf_dir).star()["dim_product"])


@query
def kpi_store_traffic(spark, sf_dir):
    return kpis.store_traffic(published_lake(spark, sf_dir).star()["fact_sales"])


@query
def kpi_states_by_month(spark, sf_dir):
    """All KPIs from the states of months that an increment has replaced in part, a row for
    each measure."""
    reports = medallion.published_kpis(published_lake(spark, sf_dir))
    return files.strict_union(_measures(name, report) for name, report in reports.items())


# --- table checks -------------------------------------------------------------------


@query
def silver_invariants(spark, sf_dir):
    """Merged tables hold every rule; the sales feed before cleaning does not."""
    customers = stage(customer_merge(spark, sf_dir).table())
    products = stage(merged_products(spark, sf_dir))
    good = audit.silver_invariants(customers, products, merged_ledger(spark, sf_dir))
    raw = audit.silver_invariants(
        customers, products, feed(spark, sf_dir, "src_sales", to_store=True)
    )
    return good.withColumn("stage", F.lit("silver")).unionByName(
        raw.withColumn("stage", F.lit("feed"))
    )


@query
def gold_fk_nulls(spark, sf_dir):
    """NULL keys of the fact, which has none, and of its lookups among known members only."""
    sales, tables = star_dimensions(spark, sf_dir)
    dimensions = {k: tables[k] for k in ("dim_customer", "dim_product", "dim_promotion")}
    known = [df.filter(F.col(k.replace("dim_", "") + "_sk") != 0) for k, df in dimensions.items()]
    facts = {
        "fact": star.fact_sales(sales, *dimensions.values()),
        "lookup": star.fact_sales(sales, *known, unknown=False),
    }
    return files.strict_union(
        audit.fact_key_nulls(fact).withColumn("stage", F.lit(name)) for name, fact in facts.items()
    )


@query
def gold_fk_orphans(spark, sf_dir):
    """Orphans against product and promotion dimensions that lack the Unknown member."""
    tables = star_tables(spark, sf_dir)
    return audit.fact_key_orphans(
        tables["fact_sales"],
        {
            "customer_sk": tables["dim_customer"],
            "product_sk": tables["dim_product"].filter("product_sk != 0"),
            "promotion_sk": tables["dim_promotion"].filter("promotion_sk != 0"),
            "date_sk": tables["dim_date"],
        },
    )
