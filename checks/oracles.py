"""DuckDB SQL that computes each query of `checks.queries` on its own."""

from checks.feeds import FEEDS, feed_sql

KEYS = {"customer": "customer_id", "product": "product_id", "sales": "transaction_id"}

# Column names of the feeds and how each is typed.
COLUMNS = {
    "customer": [
        "customer_id",
        "age",
        "gender",
        "income_bracket",
        "loyalty_program",
        "membership_years",
        "churned",
        "marital_status",
        "number_of_children",
        "education_level",
        "occupation",
        "customer_zip_code",
        "customer_city",
        "customer_state",
    ],
    "product": [
        "product_id",
        "product_name",
        "product_brand",
        "product_category",
        "product_rating",
        "product_review_count",
        "product_stock",
        "product_return_rate",
        "product_size",
        "product_weight",
        "product_color",
        "product_material",
        "product_manufacture_date",
        "product_expiry_date",
        "product_shelf_life",
        "unit_price",
    ],
    "sales": [
        "transaction_id",
        "transaction_date",
        "customer_id",
        "product_id",
        "quantity",
        "unit_price",
        "discount_applied",
        "payment_method",
        "store_location",
        "transaction_hour",
        "day_of_week",
        "week_of_year",
        "month_of_year",
        "total_sales",
        "promotion_id",
        "promotion_type",
        "holiday_season",
        "season",
        "weekend",
    ],
}
INTS = {
    "age",
    "membership_years",
    "number_of_children",
    "product_shelf_life",
    "quantity",
    "transaction_hour",
    "week_of_year",
    "month_of_year",
}
DOUBLES = {
    "product_rating",
    "product_review_count",
    "product_stock",
    "product_return_rate",
    "product_weight",
    "discount_applied",
    "total_sales",
    "promotion_id",
    "unit_price",
}
STAMPS = {"product_manufacture_date", "product_expiry_date", "transaction_date"}
FLAGS = {"churned", "holiday_season", "weekend"}
LABELS = {
    "gender",
    "income_bracket",
    "loyalty_program",
    "marital_status",
    "education_level",
    "occupation",
    "customer_zip_code",
    "customer_city",
    "customer_state",
    "product_name",
    "product_brand",
    "product_category",
    "product_size",
    "product_color",
    "product_material",
    "payment_method",
    "store_location",
    "day_of_week",
    "season",
    "promotion_type",
}
EXTRA = {
    "src_customer_inc": ["effective_start_date"],
    "src_customer_versions": ["version", "effective_start_date"],
    "src_customer_months": ["version", "effective_start_date"],
    "src_product": ["last_updated"],
    "src_product_hist": ["last_updated"],
    "src_product_inc": ["last_updated"],
}
AS_OF = "date '2001-12-31'"
NUMBER = "'^ *[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+) *$'"


def entity_of(feed):
    return feed.split("_")[1]


def feed_columns(feed):
    return COLUMNS[entity_of(feed)] + EXTRA.get(feed, [])


def blank(c):
    return f"case when trim({c}) <> '' then {c} end"


def flag(c):
    return (
        f"case when lower(trim({c})) in ('true','yes','y','1') then true "
        f"when lower(trim({c})) in ('false','no','n','0') then false end"
    )


def whole(c, kind="int"):
    return f"case when regexp_full_match({c}, {NUMBER}) then try_cast(trunc(try_cast({c} as double)) as {kind}) end"


def typed(c):
    if c in INTS:
        return f"coalesce({whole(c)}, 0)"
    if c in DOUBLES:
        return f"coalesce(try_cast({c} as double), 0.0)"
    if c in STAMPS:
        return f"try_cast({c} as timestamp)"
    if c in FLAGS:
        return flag(c)
    if c in LABELS:
        return f"coalesce({c}, 'Unknown')"
    return c


def marked_hash(columns):
    parts = ", ".join(f"coalesce(cast({c} as varchar), '<NULL>')" for c in columns)
    return f"sha256(concat_ws('||', {parts}))"


def plain_hash(columns):
    return f"sha256(concat_ws('|', {', '.join(columns)}))"


def dedup_order(feed, ingested=True):
    payload = [c for c in feed_columns(feed) if c != KEYS[entity_of(feed)]]
    newest = ["ingested_at desc nulls last"] if ingested else []
    tie = [f"{c} desc nulls last" for c in payload]
    if entity_of(feed) == "product":
        return ["try_cast(last_updated as date) desc nulls last", *newest, *tie]
    if entity_of(feed) == "customer" and "version" not in payload:
        return [f"{plain_hash(payload)} desc", *newest, *tie]
    return [*newest, *tie]


def dedup_sql(feed, source, ingested=True):
    keys = [KEYS[entity_of(feed)]] + (["version"] if "version" in feed_columns(feed) else [])
    return (
        f"select * from {source} qualify row_number() over "
        f"(partition by {', '.join(keys)} order by {', '.join(dedup_order(feed, ingested))}) = 1"
    )


def clean_ctes(feed, ingested=True):
    """CTEs ending in `clean_<feed without src_>`."""
    key, name = KEYS[entity_of(feed)], feed.removeprefix("src_")
    kept = [key] + [f"{blank(c)} as {c}" for c in feed_columns(feed) if c != key]
    stamp = ", ingested_at" if ingested else ""
    return {
        feed: feed_sql(feed, "timestamp"),
        f"blanked_{name}": f"select {', '.join(kept)}{stamp} from {feed} where {key} is not null",
        f"one_{name}": dedup_sql(feed, f"blanked_{name}", ingested),
        f"clean_{name}": "select "
        + ", ".join(f"{typed(c)} as {c}" for c in feed_columns(feed))
        + f"{stamp} from one_{name}",
    }


def with_sql(ctes, final):
    return "with " + ", ".join(f"{n} as ({q})" for n, q in ctes.items()) + " " + final


def id_order(key):
    return f"try_cast({key} as bigint) nulls first, {key} nulls first"


TRACKED = COLUMNS["customer"][1:]


def first_customer_ctes(ingested=True):
    stamp = ", ingested_at" if ingested else ""
    return {
        **clean_ctes("src_customer_hist", ingested),
        "customers0": f"""select {', '.join(COLUMNS['customer'])}{stamp},
            row_number() over (order by {id_order('customer_id')}, {marked_hash(TRACKED)}) as customer_sk,
            date '1900-01-01' as effective_start_date, cast(null as date) as effective_end_date,
            true as is_current from clean_customer_hist""",
    }


def customer_ctes(feed="src_customer_inc", ingested=True):
    """CTEs ending in `changes` (unkeyed), `inserted`, `resolved`, `customers`."""
    name = feed.removeprefix("src_")
    stamp = ", ingested_at" if ingested else ""
    attributes = ", ".join(COLUMNS["customer"]) + stamp
    start = f"coalesce(try_cast(effective_start_date as date), {AS_OF})"
    ctes = {
        **first_customer_ctes(ingested),
        **clean_ctes(feed, ingested),
        "known": f"select customer_id, {marked_hash(TRACKED)} as known_hash from customers0",
        "dated": f"select {attributes}, {'version' if 'version' in feed_columns(feed) else 'null as version'}, {start} as start_date, {marked_hash(TRACKED)} as new_hash from clean_{name}",
        "daily": "select * from dated qualify row_number() over (partition by customer_id, start_date order by try_cast(version as bigint) desc nulls last, version desc nulls last, new_hash desc) = 1",
        "compared": """select d.*, k.known_hash,
            coalesce(lag(new_hash) over (partition by d.customer_id order by start_date), known_hash) as before_hash
            from daily d left join known k on d.customer_id = k.customer_id""",
        "changed": "select * from compared where before_hash is null or before_hash <> new_hash",
        "changes": "select *, lead(start_date) over (partition by customer_id order by start_date) - 1 as end_date from changed",
        "inserted": f"""select {attributes},
            (select max(customer_sk) from customers0) + row_number() over (order by {id_order('customer_id')}, start_date, new_hash) as customer_sk,
            start_date as effective_start_date, cast(end_date as date) as effective_end_date, end_date is null as is_current from changes""",
        "successors": "select customer_id, min(effective_start_date) as successor from inserted group by 1",
        "resolved": f"""select {', '.join('c.' + a.strip() for a in attributes.split(','))}, customer_sk, effective_start_date,
            cast(coalesce(successor - 1, effective_end_date) as date) as effective_end_date, successor is null as is_current
            from customers0 c left join successors s on c.customer_id = s.customer_id""",
        "customers": "select * from resolved union all by name select * from inserted",
    }
    return ctes


def first_product_ctes(ingested=True):
    stamp = ", ingested_at" if ingested else ""
    return {
        **clean_ctes("src_product_hist", ingested),
        "products0": f"select {', '.join(COLUMNS['product'])}{stamp}, row_number() over (order by {id_order('product_id')}) as product_sk from clean_product_hist",
    }


def product_ctes(ingested=True):
    stamp = ", ingested_at" if ingested else ""
    columns = ", ".join(COLUMNS["product"]) + stamp
    return {
        **first_product_ctes(ingested),
        **clean_ctes("src_product_inc", ingested),
        "products": f"""select * from products0 where product_id not in (select product_id from clean_product_inc)
            union all by name
            select {', '.join('i.' + c.strip() for c in columns.split(','))}, o.product_sk from clean_product_inc i join products0 o on i.product_id = o.product_id
            union all by name
            select {columns}, (select max(product_sk) from products0) + row_number() over (order by {id_order('product_id')}) as product_sk
            from clean_product_inc where product_id not in (select product_id from products0)""",
    }


def first_ledger_ctes(ingested=True):
    return {
        **clean_ctes("src_sales_hist", ingested),
        "ledger0": f"select *, row_number() over (order by {id_order('transaction_id')}) as sales_sk from clean_sales_hist",
    }


def ledger_ctes(ingested=True):
    return {
        **first_ledger_ctes(ingested),
        **clean_ctes("src_sales_inc", ingested),
        "ledger": f"""select * from ledger0 union all by name
            select *, (select max(sales_sk) from ledger0) + row_number() over (order by {id_order('transaction_id')}) as sales_sk
            from clean_sales_inc where transaction_id not in (select transaction_id from ledger0)""",
    }


def promotion_sql(sales):
    return f"""select *, row_number() over (order by promotion_id, promotion_type) as promotion_sk
        from (select distinct cast(promotion_id as bigint) as promotion_id, promotion_type from {sales} where promotion_id <> 0)
        union all select 0, 'Unknown', 0"""


def calendar(day):
    return {
        "date_sk": f"cast(strftime({day}, '%Y%m%d') as int)",
        "day": f"day({day})",
        "day_name": f"dayname({day})",
        "day_of_week": f"dayofweek({day}) + 1",
        "week_of_year": f"weekofyear({day})",
        "month": f"month({day})",
        "month_name": f"monthname({day})",
        "quarter": f"quarter({day})",
        "year": f"year({day})",
        "weekend": f"dayofweek({day}) in (0, 6)",
    }


def date_sql(sales):
    columns = ", ".join(f"{e} as {n}" for n, e in calendar("date").items())
    return f"""select date, {columns} from (select distinct cast(transaction_date as date) as date from {sales} where transaction_date is not null)
        union all select null, 0, 0, 'Unknown', 0, 0, 0, 'Unknown', 0, 0, false"""


AS_OF_MATCH = """s.customer_id = c.customer_id and cast(s.transaction_date as date) >= c.effective_start_date
    and (c.effective_end_date is null or cast(s.transaction_date as date) <= c.effective_end_date)"""


def star_ctes(ingested=True):
    return {
        **ledger_ctes(ingested),
        **customer_ctes(ingested=ingested),
        **product_ctes(ingested),
        "promotions": promotion_sql("ledger"),
        "dates": date_sql("ledger"),
        "fact": f"""select s.sales_sk, s.transaction_id, coalesce(c.customer_sk, 0) as customer_sk, coalesce(p.product_sk, 0) as product_sk,
            coalesce(m.promotion_sk, 0) as promotion_sk,
            case when s.transaction_date is null then 0 else cast(strftime(s.transaction_date, '%Y%m%d') as int) end as date_sk,
            s.quantity, s.unit_price, s.discount_applied, s.total_sales, s.store_location, s.transaction_hour, s.day_of_week, s.promotion_type
            from ledger s left join customers c on {AS_OF_MATCH}
            left join products p on s.product_id = p.product_id
            left join promotions m on s.promotion_id = m.promotion_id and s.promotion_type = m.promotion_type""",
    }


def margin_sql(fact):
    gross, discount = (f"sum(cast({c} as decimal(28,8)))" for c in ("total_sales", "discount_applied"))
    return f"""select store_location, cast({gross} as double) as gross_revenue, cast({discount} as double) as discount_amount,
        count(transaction_id) as transaction_count, cast({gross} - {discount} as double) as net_margin
        from {fact} group by store_location order by net_margin desc, store_location"""


def mean(c):
    return f"cast(sum(cast({c} as decimal(28,8))) as double) / count({c})"


def rounded(x, places):
    """Half up on the shortest decimal text of a double."""
    return f"cast(cast(cast({x} as varchar) as decimal(28,{places})) as double)"


KPI_SQL = {
    "net_margin_by_store": margin_sql("fact"),
    "order_value_by_promotion": f"select promotion_type, {mean('total_sales')} as aov from fact group by 1 order by 1",
    "churn_heatmap": "select customer_state, loyalty_program, count(*) as total_customers, count(*) filter (churned) as churned_customers, "
    f"{rounded('count(*) filter (churned) / count(*) * 100', 2)} as churn_rate from customers where is_current group by 1, 2 order by 1, 2",
    "product_quality": f"select product_category, count(*) as number_of_products, {rounded(mean('product_return_rate'), 4)} as average_return_rate, "
    "max(product_return_rate) as highest_return_rate from products group by 1 order by 3 desc, 1",
    "store_traffic": f"select store_location, day_of_week, transaction_hour, count(*) as transaction_count, {rounded(mean('total_sales'), 2)} as average_transaction_value "
    "from fact group by 1, 2, 3 order by 4 desc, 1, 2, 3",
}

# Each KPI's group columns and measures.
KPI_MEASURES = [
    ("net_margin_by_store", ["store_location"], ["gross_revenue", "discount_amount", "transaction_count", "net_margin"]),
    ("order_value_by_promotion", ["promotion_type"], ["aov"]),
    ("churn_heatmap", ["customer_state", "loyalty_program"], ["total_customers", "churned_customers", "churn_rate"]),
    ("product_quality", ["product_category"], ["number_of_products", "average_return_rate", "highest_return_rate"]),
    ("store_traffic", ["store_location", "day_of_week", "transaction_hour"], ["transaction_count", "average_transaction_value"]),
]


def measures_sql(kpi, groups, measures):
    """A row for each measure; members are named by all of their group's columns."""
    member = " || ' / ' || ".join(f"coalesce(cast({c} as varchar), '-')" for c in groups)
    names = ", ".join(f"'{c}'" for c in measures)
    values = ", ".join(f"cast({c} as double)" for c in measures)
    return f"select '{kpi}' as kpi, {member} as member, unnest([{names}]) as measure, unnest([{values}]) as value from ({KPI_SQL[kpi]}) {kpi}"


def counts(feeds):
    return " union all ".join(f"select '{n}' as dataset, count(*) as n from ({q}) t" for n, q in feeds.items())


def oracle_sql() -> dict[str, str]:
    src = {name: feed_sql(name, "timestamp") for name in FEEDS}
    sales, customers = clean_ctes("src_sales"), customer_ctes()
    six = {
        f"{e}_{load}": src[f"src_{e}_{short}"]
        for e in KEYS
        for load, short in (("historical", "hist"), ("incremental", "inc"))
    }
    distinct = {e: f"select distinct {k} from ({src[f'src_{e}_hist']}) t where {k} is not null" for e, k in KEYS.items()}
    report = "case when actual - expected = 0 then 'PASS' else 'FAIL' end as status"
    spelled = "cast(cast(l_quantity as int) as varchar)"
    spellings = [f"{spelled}", f"' ' || {spelled} || ' '", f"'+' || {spelled}", f"'-' || {spelled}", f"{spelled} || '.9'", f"'-' || {spelled} || '.5'", f"'.' || {spelled}", f"{spelled} || '.'", f"{spelled} || 'e2'", f"{spelled} || 'x'", "''", "' '", f"{spelled} || '99999999999'"]
    number_text = f"case l_partkey % {len(spellings)} " + " ".join(f"when {i} then {s}" for i, s in enumerate(spellings)) + " end"
    customer_columns = ", ".join(COLUMNS["customer"])
    product_columns = ", ".join(COLUMNS["product"])

    def batch(load):
        return f"sha256('martwright|sales|{load}')"

    sql = {
        "contract_csv_scan": "select "
        + ", ".join(f"nullif({c}, '') as {c}" for c in feed_columns("src_product"))
        + f" from ({src['src_product']}) t",
        "source_file_selection": f"select dataset, n as actual from ({counts(six)}) t",
        "strict_union": f"{src['src_sales_hist']} union all {src['src_sales_inc']}",
        "padded_union": f"select * from ({src['src_customer_hist']}) h union all by name select * from ({src['src_customer_inc']}) i",
        "audit_contract": """
            with control as (select n_name, n_regionkey, count(*) as n from customer join nation on c_nationkey = n_nationkey group by all)
            select n_name as dataset, 2 as entries, 'expected exactly one audit row' as problem from control where n_regionkey = 1
            union all select n_name, 1, 'row count is no whole number' from control where n_regionkey = 2
            union all select n_name, 0, 'expected exactly one audit row' from nation where n_name not in (select n_name from control)
            union all select r_name, 0, 'expected exactly one audit row' from region""",
        "provenance_stamp": " union all ".join(
            f"select transaction_id, {batch(load)} as batch_id, '{load}' as load_type, 'sales_{load}.csv' as source_file from ({src[f'src_sales_{short}']}) t"
            for load, short in (("historical", "hist"), ("incremental", "inc"))
        ),
        "idempotent_append": f"""select {batch('historical')} as batch_id, 'historical' as load_type, count(*) as n_rows from ({src['src_sales_hist']}) h
            union all select {batch('incremental')}, 'incremental', count(*) from ({src['src_sales_inc']}) i""",
        "snapshot_roundtrip": "select o_orderkey, o_custkey, null::double as o_totalprice from orders "
        "union all select o_orderkey, null, o_totalprice from orders",
        "row_count_reconciliation": f"""select dataset, expected, n as actual, n - expected as difference, case when n = expected then 'PASS' else 'FAIL' end as status
            from (select *, n + case when dataset = 'product_incremental' then 1 else 0 end as expected from ({counts(six)}) c) t order by dataset""",
        "staged_reconciliation": "select dataset, expected, actual, actual - expected as difference, " + report + " from ("
        + " union all ".join(
            f"select '{e}_historical' as dataset, (select count(*) from ({src[f'src_{e}_hist']}) a) as expected, (select count(*) from ({distinct[e]}) b) as actual"
            f" union all select '{e}_new', count(*), count(*) from ({src[f'src_{e}_inc']}) c"
            for e in KEYS
        )
        + ") t",
        "landing_gate": f"select dataset, n as expected, n as actual, 0 as difference, 'PASS' as status from ({counts(six)}) t "
        f"union all select 'sales_incremental', count(*) + 1, count(*), -1, 'FAIL' from ({src['src_sales_inc']}) s",
        "medallion_e2e": with_sql(
            star_ctes(False), " union all ".join(measures_sql(*report) for report in KPI_MEASURES)
        ),
        "register_star": with_sql(
            star_ctes(),
            "select 'dim_customer' as table_name, count(*) + 1 as n_rows from customers union all select 'dim_product', count(*) + 1 from products "
            "union all select 'dim_promotion', count(*) from promotions union all select 'dim_date', count(*) from dates "
            "union all select 'fact_sales', count(*) from ledger "
            f"union all select 'dim_date columns', {len(calendar('date')) + 2}",
        ),
        "drop_null_keys": f"select * from ({src['src_sales']}) t where transaction_id is not null",
        "blank_to_null": "select product_id, "
        + ", ".join(f"{blank(c)} as {c}" for c in feed_columns("src_product") if c != "product_id")
        + f", ingested_at from ({src['src_product']}) t",
        "fill_unknown": "select "
        + ", ".join(f"coalesce({c}, 'Unknown') as {c}" if c in LABELS else c for c in COLUMNS["customer"])
        + f", ingested_at from ({src['src_customer']}) t",
        "fill_zero": "select transaction_id, "
        + ", ".join(f"{typed(c)} as {c}" for c in COLUMNS["sales"] if c in INTS | DOUBLES)
        + f" from ({src['src_sales']}) t",
        "normalize_boolean": f"select customer_id, {flag('churned')} as churned, {flag('loyalty_program')} as loyalty_program from ({src['src_customer']}) t",
        "tolerant_cast": f"""select l_orderkey, l_linenumber, number_text, {whole('number_text')} as as_int, {whole('number_text', 'bigint')} as as_bigint,
            try_cast(number_text as double) as as_double from (select l_orderkey, l_linenumber, {number_text} as number_text from lineitem) t""",
        "tolerant_timestamp": f"select product_id, try_cast(product_manufacture_date as timestamp) as product_manufacture_date, try_cast(product_expiry_date as timestamp) as product_expiry_date from ({src['src_product']}) t",
        "dedup_by_version": dedup_sql("src_customer_months", f"({src['src_customer_months']}) t"),
        "dedup_by_payload_hash": dedup_sql("src_customer", f"(select * from ({src['src_customer']}) t where customer_id is not null) t"),
        "dedup_by_last_updated": dedup_sql("src_product", f"(select * from ({src['src_product']}) t where product_id is not null) t"),
        "dedup_latest_ingest": dedup_sql("src_sales", f"(select * from ({src['src_sales']}) t where transaction_id is not null) t"),
        "clean_customer": with_sql(clean_ctes("src_customer"), "select * from clean_customer"),
        "clean_product": with_sql(clean_ctes("src_product"), "select * from clean_product"),
        "clean_sales": with_sql(sales, "select * from clean_sales"),
        "anti_join_new_keys": with_sql(
            ledger_ctes(), "select transaction_id, ingested_at from clean_sales_inc where transaction_id not in (select transaction_id from clean_sales_hist)"
        ),
        "carry_forward_key": with_sql(
            product_ctes(), "select i.product_id, o.product_sk, i.product_stock from clean_product_inc i join products0 o on i.product_id = o.product_id"
        ),
        "classify_changes": with_sql(
            customers,
            "select customer_id, case when known_hash is null then 'new' when known_hash = new_hash then 'unchanged' else 'changed' end as change from compared",
        ),
        "point_in_time_join": with_sql(
            {**sales, **customer_ctes("src_customer_versions")},
            f"select s.transaction_id, coalesce(c.customer_sk, 0) as customer_sk from clean_sales s left join customers c on {AS_OF_MATCH}",
        ),
        "lookup_product_sk": with_sql(
            {**sales, **first_product_ctes()},
            "select s.transaction_id, coalesce(p.product_sk, 0) as product_sk from clean_sales s left join products0 p on s.product_id = p.product_id",
        ),
        "lookup_promotion_sk": with_sql(
            {**sales, "promotions": promotion_sql("clean_sales")},
            "select s.transaction_id, coalesce(m.promotion_sk, 0) as promotion_sk from clean_sales s left join promotions m on s.promotion_id = m.promotion_id and s.promotion_type = m.promotion_type",
        ),
        "row_change_hash": f"select customer_id, ingested_at, {marked_hash(TRACKED)} as row_hash from ({src['src_customer']}) t",
        "dense_surrogate_key": "select o_orderkey, o_custkey, o_orderdate, row_number() over (order by o_custkey, o_orderdate, o_orderkey) as order_sk from orders",
        "continue_surrogate_key": with_sql(
            ledger_ctes(),
            f"select transaction_id, (select max(sales_sk) from ledger0) + row_number() over (order by {id_order('transaction_id')}) as sales_sk from clean_sales_inc",
        ),
        "scd2_initialize": with_sql(first_customer_ctes(), "select * from customers0"),
        "scd2_merge": with_sql(customers, "select * from customers"),
        "scd2_merge_versions": with_sql(customer_ctes("src_customer_versions"), "select * from customers"),
        "scd2_closed_rows": with_sql(customers, "select customer_id, customer_sk, effective_start_date, effective_end_date from customers where not is_current"),
        "scd2_inserted_rows": with_sql(customers, "select * from inserted"),
        "scd2_current_invariant": with_sql(
            customer_ctes("src_customer_versions"),
            "select 'merged' as dataset, (select count(*) from (select customer_id from customers group by 1 having count(*) filter (is_current) <> 1) t) as actual "
            "union all select 'all_open', (select count(*) from (select customer_id from customers group by 1 having count(*) <> 1) t)",
        ),
        "scd1_upsert": with_sql(product_ctes(), "select * from products"),
        "ledger_append": with_sql(ledger_ctes(), "select * from ledger"),
        "merge_idempotency": with_sql(
            {**customer_ctes("src_customer_versions"), **product_ctes(), **ledger_ctes()},
            "select 'customer' as table_name, count(*) as rows_once, count(*) as rows_twice, 0 as differing from customers "
            "union all select 'product', count(*), count(*), 0 from products union all select 'sales', count(*), count(*), 0 from ledger "
            f"union all select 'src_customer_versions', n, n, 0 from (select (select count(*) from customers) + count(distinct customer_id) as n from clean_customer_versions) v "
            f"union all select name, n, n, 0 from ({with_sql(customers, 'select (select count(*) from customers) + count(distinct customer_id) as n from clean_customer_inc')}) i, "
            "(select unnest(['src_customer_inc', 'customer_undated']) as name) c "
            "union all select 'product_b_c_b', count(*), count(*), 0 from products",
        ),
        "uniqueness_violations": f"select transaction_id, count(*) as n_rows from ({src['src_sales']}) t group by 1 having count(*) <> 1",
        "top_regions": with_sql(
            {**sales, "margins": margin_sql("clean_sales")},
            "select *, row_number() over (order by net_margin desc, store_location) as place from margins",
        ),
        "scalar_date_attributes": "select o_orderkey, " + ", ".join(f"{e} as {n}" for n, e in calendar("o_orderdate").items()) + " from orders",
        "dim_customer": with_sql(
            customers,
            f"select {customer_columns}, ingested_at, customer_sk, effective_start_date, effective_end_date, is_current from customers union all by name select "
            + ", ".join(("0" if c in INTS else "cast(null as boolean)" if c in FLAGS else "'Unknown'") + f" as {c}" for c in COLUMNS["customer"])
            + ", null as ingested_at, 0 as customer_sk, null as effective_start_date, null as effective_end_date, true as is_current",
        ),
        "dim_product": with_sql(
            product_ctes(),
            f"select {product_columns}, ingested_at, product_sk from products union all by name select "
            + ", ".join(("0" if c in INTS | DOUBLES else "null" if c in STAMPS else "'Unknown'") + f" as {c}" for c in COLUMNS["product"])
            + ", null as ingested_at, 0 as product_sk",
        ),
        "dim_promotion": with_sql(sales, promotion_sql("clean_sales")),
        "dim_date": with_sql(sales, date_sql("clean_sales")),
        "fact_sales": with_sql(star_ctes(), "select * from fact"),
        "fact_incremental": with_sql(star_ctes(), "select * from fact"),
        "unknown_member": with_sql(
            star_ctes(),
            " union all ".join(f"select '{k}' as key, count(*) filter ({k} = 0) as unknown_rows from fact" for k in ("customer_sk", "product_sk", "promotion_sk", "date_sk")),
        ),
        "kpi_net_margin": with_sql(star_ctes(), KPI_SQL["net_margin_by_store"]),
        "kpi_aov_by_promotion": with_sql(star_ctes(), KPI_SQL["order_value_by_promotion"]),
        "kpi_churn_heatmap": with_sql(customers, KPI_SQL["churn_heatmap"]),
        "kpi_product_quality": with_sql(product_ctes(), KPI_SQL["product_quality"]),
        "kpi_store_traffic": with_sql(star_ctes(), KPI_SQL["store_traffic"]),
        "kpi_states_by_month": with_sql(
            star_ctes(), " union all ".join(measures_sql(*report) for report in KPI_MEASURES)
        ),
        "silver_invariants": f"""
            with broken as (select count(*) as n from (select transaction_id from ({src['src_sales']}) t group by 1 having count(*) <> 1) u),
            rules as (select unnest(['customer_has_one_current_row', 'customer_sk_not_null', 'product_id_unique', 'transaction_id_unique']) as rule)
            select rule, 0 as violations, 'silver' as stage from rules
            union all select rule, case when rule = 'transaction_id_unique' then n else 0 end, 'feed' from rules, broken""",
        "gold_fk_nulls": with_sql(
            star_ctes(),
            " union all ".join(
                f"select '{k}' as key, 0 as nulls, 'fact' as stage "
                f"union all select '{k}', count(*) filter ({k} = 0), 'lookup' from fact"
                for k in ("customer_sk", "product_sk", "promotion_sk", "date_sk")
            ),
        ),
        "gold_fk_orphans": with_sql(
            star_ctes(),
            "select 'customer_sk' as key, 0 as orphans union all select 'date_sk', 0 "
            "union all select 'product_sk', count(*) filter (product_sk = 0) from fact "
            "union all select 'promotion_sk', count(*) filter (promotion_sk = 0) from fact",
        ),
    }
    return sql
