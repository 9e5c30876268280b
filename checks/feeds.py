"""Retail feeds derived from the whole test tables, in SQL that Spark and DuckDB share.

The feeds are dirty on purpose: NULL and repeated keys, blanks, malformed numbers and
dates, unknown customers and products, a promotion id with two types. Each carries its
whole contract as text plus `ingested_at`. `{ntz}` names the zone-less timestamp type.

`src_customer`, `src_customer_months`, `src_product` and `src_sales` hold everything.
Historical and incremental feeds are date windows of orders and shipments. The sales
windows overlap by two months, as an extract that resends late transactions would.

Within `shared_lines` lines and orders are stored once, in buckets of the order. The sales
feeds that are read often come from one stored join of them, and those that their reader
stores join the buckets; each selects its own as its SQL says.
"""

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

from martwright.sources.staging import SETTING, stage, stage_by, stage_by_counted

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

# Unevaluated scans of each session, so that a schema is read once per file.
_scans: WeakKeyDictionary = WeakKeyDictionary()

# A table joined whole. Its files are far smaller than its rows in the driver's memory, so
# its rows say whether it may be broadcast.
WHOLE, MOST_BROADCAST = "part", 100_000

# Removed when Python exits.
_folders: list[tempfile.TemporaryDirectory] = []

CUT = "{ntz} '2000-01-01 00:00:00'"
RESENT_FROM = "{ntz} '1999-11-01 00:00:00'"

_SALES = """
select case when l_orderkey % 997 = 0 then null else cast(l_orderkey * 8 + l_linenumber as string) end as transaction_id,
       case when l_orderkey % 101 = 0 then null when l_orderkey % 103 = 0 then '31/12/1999' else cast(cast(o_orderdate as date) as string) end as transaction_date,
       case when l_orderkey % 59 = 0 then '999999999' else cast(o_custkey as string) end as customer_id,
       case when l_partkey % 61 = 0 then null else cast(l_partkey as string) end as product_id,
       case when l_partkey % 71 = 0 then cast(cast(l_quantity as int) as string) || '.7' else cast(cast(l_quantity as int) as string) end as quantity,
       cast(cast(900 + l_partkey % 1000 as decimal(18,2)) as string) as unit_price,
       cast(cast(l_extendedprice as decimal(18,2)) * cast(l_discount as decimal(4,2)) as string) as discount_applied,
       case l_returnflag when 'A' then 'card' when 'N' then '  ' else 'cash' end as payment_method,
       case when l_suppkey % 9 = 0 then '' else n_name end as store_location,
       cast(l_partkey % 24 as string) as transaction_hour,
       case when l_orderkey % 7 = 0 then 'Monday' when l_orderkey % 7 = 1 then 'Sunday' else null end as day_of_week,
       cast(l_suppkey % 53 as string) as week_of_year,
       cast(month(o_orderdate) as string) as month_of_year,
       case when l_partkey % 67 = 0 then 'oops' else cast(cast(l_extendedprice as decimal(18,2)) as string) end as total_sales,
       case when l_linenumber = 7 then null else cast(l_linenumber % 5 as string) end as promotion_id,
       case when l_linenumber = 7 then null when l_linenumber = 6 then 'promo-1b' else 'promo-' || cast(l_linenumber % 5 as string) end as promotion_type,
       case l_linestatus when 'O' then 'Y' else 'maybe' end as holiday_season,
       case when l_suppkey % 5 = 0 then '' else 'spring' end as season,
       case when l_orderkey % 7 in (0, 1) then 'Yes' else 'No' end as weekend,
       l_shipdate as ingested_at
from lineitem join orders on l_orderkey = o_orderkey
     join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey
"""

# What a sales feed selects from, and the columns of it that feeds use.
_SALES_LINES = _SALES[_SALES.index("from lineitem") :]
_LINE_COLUMNS = (
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    "l_discount", "l_returnflag", "l_linestatus", "l_shipdate",
)
_ORDER_COLUMNS = ("o_orderkey", "o_orderdate", "o_custkey")
_FEED_COLUMNS = (*_LINE_COLUMNS, *_ORDER_COLUMNS[1:], "n_name")

# Lines that a task joins at most, and that are worth a task: one that writes buckets sorts
# its rows, and writes a file for each.
MOST_LINES, LEAST_LINES = 1_500_000, 50_000

# Joined lines of the tables that the query at work reads, and whether they are stored.
_lines: ContextVar[dict[tuple[str, bool], DataFrame] | None] = ContextVar("lines", default=None)

_CUSTOMER = """
select %(id)s as customer_id,
       case when c_custkey %% 50 = 0 then 'n/a' when c_custkey %% 51 = 0 then '' else cast(18 + c_custkey %% 60 as string) end as age,
       case c_custkey %% 4 when 0 then 'M' when 1 then 'F' when 2 then ' ' end as gender,
       %(income)s as income_bracket,
       case c_custkey %% 3 when 0 then 'Yes' when 1 then 'No' else '  ' end as loyalty_program,
       cast(c_custkey %% 12 as string) as membership_years,
       case c_custkey %% 7 when 0 then 'Yes' when 1 then 'no' when 2 then ' TRUE ' when 3 then '0' when 4 then 'maybe' when 5 then 'N' end as churned,
       case when c_acctbal < 0 then 'single' else 'married' end as marital_status,
       case when c_custkey %% 6 = 5 then 'two' else cast(c_custkey %% 6 as string) end as number_of_children,
       %(education)s as education_level,
       %(occupation)s as occupation,
       cast(10000 + c_custkey %% 89 as string) as customer_zip_code,
       n_name as customer_city, r_name as customer_state,
       %(extra)s o_orderdate as ingested_at
from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
     %(orders)s
"""

_PRODUCT = """
select %(id)s as product_id,
       case when p_partkey %% 13 = 0 then ' ' else p_name end as product_name,
       p_brand as product_brand,
       case when p_partkey %% 17 = 0 then null else p_type end as product_category,
       case when p_partkey %% 19 = 0 then 'bad' else cast(cast(p_size / 10.0 as decimal(6,2)) as string) end as product_rating,
       cast(l_linenumber as string) as product_review_count,
       cast(cast(l_quantity as int) as string) as product_stock,
       cast(cast((p_partkey %% 40) / %(rate)s as decimal(6,2)) as string) as product_return_rate,
       cast(p_size as string) as product_size,
       cast(cast(l_tax as decimal(4,2)) as string) as product_weight,
       case when p_partkey %% 3 = 0 then '' else 'red' end as product_color,
       'steel' as product_material,
       case when p_partkey %% 23 = 0 then '31/12/2024' else '2024-01-0' || cast(1 + p_partkey %% 9 as string) end as product_manufacture_date,
       case when p_partkey %% 29 = 0 then null else '2026-01-0' || cast(1 + p_partkey %% 9 as string) end as product_expiry_date,
       case when p_partkey %% 31 = 0 then '12.9' else cast(p_partkey %% 90 as string) end as product_shelf_life,
       cast(cast(p_retailprice as decimal(18,2)) as string) as unit_price,
       case when l_linenumber = 7 then null else cast(cast(l_shipdate as date) as string) end as last_updated,
       l_shipdate as ingested_at
from part %(lines)s
"""

_EARLIER_ORDERS = f"left join orders on o_custkey = c_custkey and o_orderdate < {CUT}"
_LATER_ORDERS = f"join orders on o_custkey = c_custkey and o_orderdate >= {CUT}"
_SHIFTED_CUSTOMER = "cast(case when c_custkey % 100 = 7 then c_custkey + 1000000 else c_custkey end as string)"
_START = "case when c_custkey % 130 = 3 then null else cast(cast(o_orderdate as date) as string) end as effective_start_date,"

_DIRTY_CUSTOMER = "case when c_custkey % 211 = 0 then null else cast(c_custkey as string) end"
_DIRTY_PART = "case when p_partkey % 307 = 0 then null else cast(p_partkey as string) end"

_INCREMENT = {
    "id": _SHIFTED_CUSTOMER,
    "income": "case when c_custkey % 10 = 3 then 'CHANGED' else c_mktsegment end",
    "education": "'Graduate'",
    "occupation": "'clerk'",
    "extra": _START,
    "orders": _LATER_ORDERS,
}

FEEDS = {
    "src_sales": _SALES,
    "src_sales_hist": f"{_SALES} where o_orderdate < {CUT}",
    "src_sales_inc": f"{_SALES} where o_orderdate >= {RESENT_FROM}",
    "src_customer_hist": _CUSTOMER
    % {
        "id": _DIRTY_CUSTOMER,
        "income": "c_mktsegment",
        "education": "case when o_orderstatus = 'O' then 'Graduate' else 'School' end",
        "occupation": "'clerk'",
        "extra": "",
        "orders": _EARLIER_ORDERS,
    },
    "src_customer_inc": _CUSTOMER % _INCREMENT,
    "src_customer_versions": _CUSTOMER
    % {
        **_INCREMENT,
        "occupation": "case when o_orderstatus = 'F' then 'clerk' else o_orderpriority end",
        "extra": "cast(year(o_orderdate) * 100 + month(o_orderdate) as string) as version, "
        + _START,
    },
    "src_product_hist": _PRODUCT
    % {
        "id": _DIRTY_PART,
        "rate": "100.0",
        "lines": f"left join lineitem on l_partkey = p_partkey and l_shipdate < {CUT}",
    },
    "src_customer": _CUSTOMER
    % {
        "id": _DIRTY_CUSTOMER,
        "income": "c_mktsegment",
        "education": "case when o_orderstatus = 'O' then 'Graduate' else 'School' end",
        "occupation": "'clerk'",
        "extra": "",
        "orders": "left join orders on o_custkey = c_custkey",
    },
    "src_customer_months": _CUSTOMER
    % {
        **_INCREMENT,
        "occupation": "case when o_orderstatus = 'F' then 'clerk' else o_orderpriority end",
        "extra": "cast(year(o_orderdate) * 100 + month(o_orderdate) as string) as version, "
        + _START,
        "orders": "left join orders on o_custkey = c_custkey",
    },
    "src_product": _PRODUCT
    % {
        "id": _DIRTY_PART,
        "rate": "100.0",
        "lines": "left join lineitem on l_partkey = p_partkey",
    },
    "src_product_inc": _PRODUCT
    % {
        "id": "cast(case when p_partkey % 10 = 9 then p_partkey + 1000000 else p_partkey end as string)",
        "rate": "50.0",
        "lines": f"join lineitem on l_partkey = p_partkey and l_shipdate >= {CUT}",
    },
}


def feed_sql(name: str, ntz: str) -> str:
    return FEEDS[name].format(ntz=ntz)


def stage_locally(spark: SparkSession) -> None:
    """A temporary staging folder for a local session that names none."""
    named = spark.conf.get(SETTING, None) or spark.conf.get("spark.checkpoint.dir", None)
    if not named and spark.sparkContext.master.startswith("local"):
        folder = tempfile.TemporaryDirectory(prefix="martwright-")
        _folders.append(folder)
        spark.conf.set(SETTING, folder.name)


def read_tables(spark: SparkSession, sf_dir: str) -> None:
    """Make the test tables visible to the feeds under their names."""
    stage_locally(spark)
    scans = _scans.setdefault(spark, {})
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if path not in scans:
            scans[path] = spark.read.parquet(path)
            if name == WHOLE and scans[path].count() > MOST_BROADCAST:
                scans[path] = scans[path].hint("shuffle_merge")
        scans[path].createOrReplaceTempView(name)


@contextmanager
def shared_lines() -> Iterator[None]:
    """Feeds read often share the lines and orders that the first of them has stored."""
    token = _lines.set({})
    try:
        yield
    finally:
        _lines.reset(token)


def _joined_lines(spark: SparkSession) -> DataFrame:
    """Lines with their orders, whose buckets meet without a shuffle."""
    lines, n = stage_by_counted(spark.table("lineitem").select(*_LINE_COLUMNS), "l_orderkey")
    orders = stage_by(spark.table("orders").select(*_ORDER_COLUMNS), "o_orderkey")
    lines.createOrReplaceTempView("stored_lines")
    orders.createOrReplaceTempView("stored_orders")
    stored = _SALES_LINES.replace("lineitem", "stored_lines").replace("orders", "stored_orders")
    joined = spark.sql(f"select {', '.join(_FEED_COLUMNS)} {stored}")
    at_once = min(spark.sparkContext.defaultParallelism, n // LEAST_LINES + 1)
    return joined.coalesce(max(at_once, n // MOST_LINES + 1))


def store_lines(spark: SparkSession, sf_dir: str) -> None:
    """Store lines and orders now, for feeds to come; else the first of them does."""
    read_tables(spark, sf_dir)
    lines = _lines.get()
    if lines is not None and (sf_dir, False) not in lines:
        lines[sf_dir, False] = _joined_lines(spark)


def feed(
    spark: SparkSession, sf_dir: str, name: str, often: bool = False, to_store: bool = False
) -> DataFrame:
    """A feed; one that is read `often` should not join lines and orders each time, and one that
    is read once, `to_store` or to check it, should not shuffle them."""
    read_tables(spark, sf_dir)
    sql, lines = feed_sql(name, "timestamp_ntz"), _lines.get()
    if (often or to_store) and lines is not None and _SALES_LINES in sql:
        joined, stored = (sf_dir, False), (sf_dir, True)
        store_lines(spark, sf_dir)
        if often and stored not in lines:
            lines[stored] = stage(lines[joined].select(*_FEED_COLUMNS))
        lines[stored if often else joined].createOrReplaceTempView("sales_lines")
        sql = sql.replace(_SALES_LINES, "from sales_lines\n")
    return spark.sql(sql)
