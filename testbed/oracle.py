"""The same queries as SQL over the same tables, written the plain relational way."""

from advisorbook import fixed_values as fv
from testbed import tables as tb


def _keyword_case(column: str) -> str:
    whens = []
    for label, keywords in tb.RULES:
        hits = " or ".join(f"contains(lower({column}), '{k}')" for k in keywords)
        whens.append(f"when {hits} then '{label}'")
    return f"case {' '.join(whens)} else 'Unknown' end"


def _label_case(column: str) -> str:
    whens = " ".join(f"when '{k}' then '{v}'" for k, v in fv.ASSET_CLASS_LABELS.items())
    return f"case {column} {whens} else 'Unknown' end"


def _bucket_case(column: str) -> str:
    classes = ", ".join(f"'{c}'" for c in fv.FIXED_INCOME_CLASSES)
    return f"case when {column} in ({classes}) then 'fixed_income' else 'equity_campuran' end"


TIES = (
    "ingested_at desc nulls last, updated_at desc nulls last, date desc nulls last, "
    "ending_balance desc nulls last, is_deleted desc nulls last, agent_id desc nulls last, "
    "unit_holder_id desc nulls last, product_id desc nulls last"
)


def history(name: str = "ph", entry_date: str = "l_shipdate") -> str:
    return f"""
{name} as (
  select l_orderkey * 10 + l_linenumber as id, cast(c_nationkey as bigint) as agent_id,
    l_suppkey as selling_agent_id, fund.id as product_id, o_custkey as unit_holder_id,
    {entry_date} as date, o_orderdate as created_at, o_orderdate as updated_at,
    p_retailprice as current_nav, p_retailprice as run_nav_value,
    l_quantity as beginning_unit, l_quantity as subscription_unit,
    l_discount as redeem_unit, l_tax as dividend_unit, l_quantity as ending_unit,
    o_totalprice as capital, l_extendedprice as beginning_balance,
    l_extendedprice as ending_balance, c_acctbal as profit_or_loss,
    l_discount as profit_or_loss_in_percent, l_returnflag = 'R' as is_deleted,
    cast(l_shipdate as date) as snapshot_date, l_shipdate as ingested_at
  from lineitem join orders on l_orderkey = o_orderkey
  join customer on o_custkey = c_custkey
  join part on l_partkey = p_partkey
  join (select p_name as fund_name, min(p_partkey) as id from part group by p_name) as fund
    on fund_name = p_name)"""


def staged(name: str = "stg", source: str = "ph", condition: str = "true") -> str:
    return f"""
{name} as (
  select id as portfolio_id, agent_id, selling_agent_id, product_id,
    unit_holder_id as customer_id,
    cast(cast(date as timestamp) + interval 15 hours as date) as portfolio_date,
    cast(date_trunc('month', cast(date as timestamp) + interval 15 hours) as date)
      as portfolio_month,
    cast(cast(snapshot_date as timestamp) + interval 15 hours as date) as snapshot_date,
    cast(created_at as timestamp) + interval 15 hours as created_at,
    cast(updated_at as timestamp) + interval 15 hours as updated_at,
    current_nav, run_nav_value, beginning_unit, subscription_unit, redeem_unit, dividend_unit,
    ending_unit, capital, beginning_balance, ending_balance, profit_or_loss,
    profit_or_loss_in_percent as profit_or_loss_pct, is_deleted,
    is_deleted = false as is_active_entry
  from (select *, row_number() over (partition by id order by {TIES}) as version
        from {source} where {condition}) as versions
  where version = 1)"""


PRODUCTS = f"""
listed as (
  select id as product_id, {_bucket_case(_keyword_case('p_name'))} as bucket
  from (select p_name, min(p_partkey) as id from part group by p_name) as funds
  where p_name not like 'new %')"""


def month_ends(
    name: str = "me",
    source: str = "stg",
    condition: str = "true",
    balance: str = "cast(ending_balance as decimal(18, 2))",
) -> str:
    return f"""
{name} as (
  select agent_id, customer_id, product_id, month_start_date, portfolio_date, portfolio_id, balance
  from (select agent_id, customer_id, product_id, portfolio_month as month_start_date,
          portfolio_date, portfolio_id, {balance} as balance,
          row_number() over (
            partition by agent_id, customer_id, product_id, portfolio_month
            order by portfolio_date desc nulls last, portfolio_id desc nulls last) as place
        from {source}
        where is_active_entry and ending_balance is not null and {condition}) as placed
  where place = 1)"""


def kpis(
    name: str = "kpi", source: str = "me", threshold: int = tb.THRESHOLD, prefix: str = ""
) -> str:
    return f"""
{prefix}am as (
  select agent_id, month_start_date, sum(balance) as total,
    sum(case when bucket = 'equity_campuran' then balance else 0 end) as equity,
    sum(case when bucket = 'fixed_income' then balance else 0 end) as fixed,
    sum(case when bucket is null then balance else 0 end) as unclassified,
    count(distinct e.product_id) as products, count(*) as positions
  from {source} as e left join listed on listed.product_id = e.product_id
  group by agent_id, month_start_date),
{prefix}cm as (
  select agent_id, month_start_date, customer_id, sum(balance) as customer_aum
  from {source} group by agent_id, month_start_date, customer_id),
{prefix}cc as (
  select agent_id, month_start_date,
    count(distinct case when customer_aum > {threshold} then customer_id end) as core,
    count(distinct customer_id) as customers
  from {prefix}cm group by agent_id, month_start_date),
{name} as (
  select a.agent_id, a.month_start_date, cast(total as double) as total_aum,
    cast(equity as double) as aum_equity_campuran, cast(fixed as double) as aum_fixed_income,
    cast(unclassified as double) as aum_unknown_class,
    case when total > 0 then cast(equity as double) / cast(total as double) end
      as pct_equity_campuran,
    case when total > 0 then cast(fixed as double) / cast(total as double) end
      as pct_fixed_income,
    coalesce(core, 0) as core_customer_count, coalesce(customers, 0) as total_customer_count,
    products as distinct_products_held, positions as month_end_positions,
    cast({threshold} as bigint) as core_customer_threshold_idr
  from {prefix}am as a left join {prefix}cc as c
    on c.agent_id = a.agent_id and c.month_start_date = a.month_start_date)"""


CUSTOMERS = """
cust as (
  select c_custkey as customer_id, c_name as customer_name, c_custkey as unit_holder_id,
    c_mktsegment as sid, cast(c_nationkey as bigint) as agent_id,
    case when r_name <> 'EUROPE' then n_name end as branch_name,
    cast(first_order as timestamp) + interval 15 hours as approved_kyc_at,
    c_mktsegment as customer_type
  from customer join nation on c_nationkey = n_nationkey
  join region on n_regionkey = r_regionkey
  left join (select o_custkey, min(o_orderdate) as first_order from orders group by o_custkey)
    as firsts on o_custkey = c_custkey)"""

ACTIVITY = """
activity as (
  select agent_id, min(portfolio_date) as first_seen_date, max(portfolio_date) as last_seen_date,
    count(distinct customer_id) as distinct_customers_seen,
    count(distinct product_id) as distinct_products_seen
  from stg group by agent_id)"""

AGENTS = """
agents as (
  select activity.agent_id,
    coalesce(branch, 'Agent ' || cast(activity.agent_id as varchar)) as agent_name,
    first_seen_date, last_seen_date, distinct_customers_seen, distinct_products_seen,
    last_seen_date = (select max(portfolio_date) from stg) as is_currently_active
  from activity left join (select agent_id, min(branch_name) as branch from cust group by agent_id)
    as names on names.agent_id = activity.agent_id)"""

LAGGED = """
lagged as (
  select *,
    lag(total_aum) over (partition by agent_id order by month_start_date) as prev_month_aum,
    lag(core_customer_count) over (partition by agent_id order by month_start_date)
      as prev_month_core_customers
  from kpi)"""

PH, STG, ME, KPI = history(), staged(), month_ends(), kpis()
FACT = (PH, STG, PRODUCTS, ME, KPI)

EXPECTED_CORE = f"""
expected as (
  select agent_id, month_start_date, count(distinct customer_id) as expected_core_count
  from (select agent_id, month_start_date, customer_id, sum(balance) as customer_aum
        from me group by agent_id, month_start_date, customer_id) as totals
  where customer_aum > {tb.THRESHOLD} group by agent_id, month_start_date)"""


def core_mismatch(missing: int) -> str:
    return f"""
select agent_id, month_start_date, expected_core_count, core_customer_count
from expected full outer join kpi using (agent_id, month_start_date)
where coalesce(expected_core_count, {missing}) <> coalesce(core_customer_count, {missing})"""


def allocation(source: str = "kpi") -> str:
    return f"""
select agent_id, month_start_date, total_aum, aum_equity_campuran, aum_fixed_income,
  aum_unknown_class, aum_equity_campuran + aum_fixed_income + aum_unknown_class as bucket_sum
from {source}
where aum_unknown_class > 0
  or abs(aum_equity_campuran + aum_fixed_income + aum_unknown_class - total_aum) > 1"""


def _with(ctes: tuple[str, ...], select: str) -> str:
    return f"with {','.join(ctes)}\n{select}"


def merged_fact(entry_date: str, lookback_days: int = 90) -> str:
    """Old fact from rows ingested before the cut, overlaid with months after the watermark."""
    mark = (
        "(select cast(coalesce(max(month_start_date), date '1900-01-01')"
        f" - interval {lookback_days} day as date) from old_kpi)"
    )
    return _with(
        (
            history("ph", entry_date),
            staged("old_stg", "ph", f"ingested_at < timestamp '{tb.CUT} 00:00:00'"),
            staged("stg", "ph"),
            PRODUCTS,
            month_ends("old_me", "old_stg"),
            kpis("old_kpi", "old_me", prefix="old_"),
            month_ends("me", "stg", f"portfolio_month > {mark}"),
            kpis("kpi", "me"),
        ),
        """
select * from old_kpi as o where not exists (
  select 1 from kpi as n where n.agent_id = o.agent_id and n.month_start_date = o.month_start_date)
union all select * from kpi""",
    )


LINE_COLUMNS = (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, "
    "l_tax, l_returnflag, l_linestatus, l_shipdate"
)
LINES = f"lines as (select {LINE_COLUMNS}, l_orderkey * 10 + l_linenumber as id from lineitem)"
SNAPSHOTS = (
    f"snaps as (select {LINE_COLUMNS}, l_orderkey * 10 + l_linenumber as id,"
    " cast(l_shipdate as date) as snapshot_date from lineitem)"
)
NET = "* replace (l_extendedprice * (1 - l_discount) as l_extendedprice)"

PARTS = f"""
parts as (
  select p_partkey as product_id, p_brand as product_code, p_name as product_name,
    p_type as isin, 'IDR' as currency, {_keyword_case('p_name')} as asset_class
  from part)"""

_SPACES = r"' ' || chr(9) || chr(10) || chr(12288)"


def _profile(table: str, column: str, name: str, dtype: str) -> str:
    return (
        f"select '{name}' as column, count(distinct {column}) as distinct_values,"
        f" count(distinct {column}) / count(*) as cardinality_ratio,"
        f" count(*) filter (where {column} is null) / count(*) as null_fraction,"
        f" '{dtype}' as dtype from {table}"
    )


LINEITEM_PROFILE = " union all ".join(
    _profile("lineitem", c, c, t)
    for c, t in (
        ("l_orderkey", "bigint"),
        ("l_partkey", "bigint"),
        ("l_suppkey", "bigint"),
        ("l_linenumber", "int"),
    )
)
ORDERS_PROFILE = " union all ".join(
    _profile("orders", c, c, "bigint") for c in ("o_orderkey", "o_custkey")
)
EVENTS_PROFILE = _profile("events", "user_id", "user_key", "bigint")

CHECKED_SQL = {
    "customer.c_custkey.not_null": ("error", "select 1 from customer where c_custkey is null"),
    "customer.c_acctbal.non_negative": ("warn", "select 1 from customer where c_acctbal < 0"),
    "events.ts.no_future_dates": (
        "error",
        "select 1 from events where ts > timestamp '2024-01-20 06:00:00' + interval 12 hours",
    ),
    "part.p_type.accepted_values": (
        "warn",
        "select 1 from part where p_type not in"
        " ('ECONOMY', 'LARGE', 'MEDIUM', 'SMALL', 'STANDARD')",
    ),
    "customer.c_custkey.unique": (
        "error",
        "select c_custkey from customer group by c_custkey having count(*) > 1",
    ),
    "lineitem.grain.unique": (
        "error",
        "select 1 from lineitem group by l_orderkey, l_linenumber having count(*) > 1",
    ),
    "orders.o_custkey.relationships": (
        "error",
        "select 1 from orders where o_custkey not in"
        " (select c_custkey from customer where c_mktsegment <> 'FURNITURE')",
    ),
    "kpis.allocation_reconciles": ("error", allocation()),
    "kpis.core_counts_reconcile": ("error", core_mismatch(0)),
}
REPORT = "\nunion all ".join(
    f"select '{name}' as check_name, '{severity}' as severity, count(*) as violations"
    f" from ({sql}) as v"
    for name, (severity, sql) in CHECKED_SQL.items()
)

ORACLE: dict[str, str] = {
    "agent_monthly_kpis": _with(FACT, "select * from kpi"),
    "agent_monthly_performance": _with(
        (*FACT, CUSTOMERS, ACTIVITY, AGENTS, LAGGED),
        """
select l.agent_id, agent_name, month_start_date, total_aum, aum_equity_campuran, aum_fixed_income,
  round(pct_equity_campuran, 4) as pct_equity_campuran,
  round(pct_fixed_income, 4) as pct_fixed_income,
  core_customer_count, total_customer_count, distinct_products_held, month_end_positions,
  rank() over (partition by month_start_date order by total_aum desc nulls last)
    as rank_aum_in_month,
  total_aum - prev_month_aum as aum_mom_change_idr,
  case when prev_month_aum <> 0 then (total_aum - prev_month_aum) / prev_month_aum end
    as aum_mom_change_pct,
  core_customer_count - prev_month_core_customers as core_customers_mom_change,
  case when total_aum is null or total_aum = 0 then 'No AUM'
    when pct_fixed_income >= 0.6 then 'Fixed Income Heavy'
    when pct_equity_campuran >= 0.6 then 'Equity Heavy' else 'Balanced' end as portfolio_profile
from lagged as l left join agents on agents.agent_id = l.agent_id""",
    ),
    "top_agents_latest_month": _with(
        (*FACT, CUSTOMERS, ACTIVITY, AGENTS),
        """
select ranked.rank, ranked.agent_id, agent_name, month_start_date, total_aum, pct_equity_campuran,
  pct_fixed_income, core_customer_count, total_customer_count
from (select *, rank() over (partition by month_start_date order by total_aum desc) as rank
      from kpi where month_start_date = (select max(month_start_date) from kpi)) as ranked
left join agents on agents.agent_id = ranked.agent_id
where ranked.rank <= 5 order by month_start_date desc, ranked.rank""",
    ),
    "total_aum": _with(
        (PH, STG, ME),
        "select agent_id, month_start_date, cast(sum(balance) as double) as total_aum"
        " from me group by agent_id, month_start_date",
    ),
    "total_aum_four_decimals": _with(
        (
            PH,
            STG,
            month_ends(balance="cast(ending_balance as decimal(18, 2)) * (1 - cast(redeem_unit as decimal(4, 2)))"),
        ),
        "select agent_id, month_start_date, cast(sum(balance) as double) as total_aum"
        " from me group by agent_id, month_start_date",
    ),
    "aum_split": _with(
        FACT,
        "select agent_id, month_start_date, aum_equity_campuran, aum_fixed_income,"
        " aum_unknown_class, pct_equity_campuran, pct_fixed_income from kpi",
    ),
    "core_customers": _with((PH, STG, ME, EXPECTED_CORE), "select * from expected"),
    "aum_mom_change": _with(
        (*FACT, LAGGED),
        "select agent_id, month_start_date, total_aum, prev_month_aum,"
        " total_aum - prev_month_aum as aum_mom_change_idr,"
        " case when prev_month_aum <> 0 then (total_aum - prev_month_aum) / prev_month_aum end"
        " as aum_mom_change_pct from lagged",
    ),
    "core_mom_change": _with(
        (*FACT, LAGGED),
        "select agent_id, month_start_date, core_customer_count, prev_month_core_customers,"
        " core_customer_count - prev_month_core_customers as core_customers_mom_change from lagged",
    ),
    "rank_in_month": _with(
        (PH, STG, ME),
        """
select agent_id, month_start_date, total_aum,
  rank() over (partition by month_start_date order by total_aum desc nulls last)
    as rank_aum_in_month
from (select agent_id, month_start_date, cast(sum(balance) as double) as total_aum
      from me group by agent_id, month_start_date) as totals""",
    ),
    "month_end_positions": """
select user_id, event_type, week, ts, event_id, value
from (select user_id, event_type, cast(date_trunc('week', ts) as date) as week, ts, event_id,
        value, row_number() over (partition by user_id, event_type, date_trunc('week', ts)
                                  order by ts desc, event_id desc) as place
      from events where value is not null) as placed
where place = 1""",
    "month_end_entries": _with(
        (PH, STG, ME),
        "select agent_id, customer_id, product_id, month_start_date, portfolio_date,"
        " portfolio_id, cast(balance as double) as ending_balance from me",
    ),
    "kpis_since_month": _with(
        FACT, "select * from kpi where month_start_date >= date '2000-03-01'"
    ),
    "join_unknown_product": _with(
        FACT,
        "select agent_id, month_start_date, total_aum, aum_unknown_class from kpi"
        " where aum_unknown_class > 0",
    ),
    "aum_recompute_union": _with(
        FACT,
        """
select agent_id, month_start_date, cast(sum(balance) as double) as reference_total_aum
from me group by agent_id, month_start_date
union all
select agent_id, month_start_date, total_aum as reference_total_aum from kpi
order by agent_id, month_start_date""",
    ),
    "aum_split_differences": _with(
        FACT,
        """
select *, total_aum - bucket_sum as diff from (
  select agent_id, month_start_date, total_aum, aum_equity_campuran, aum_fixed_income,
    aum_unknown_class, aum_equity_campuran + aum_fixed_income + aum_unknown_class as bucket_sum
  from kpi) as summed
where abs(total_aum - bucket_sum) > 1 or aum_unknown_class > 0 order by diff desc""",
    ),
    "latest_per_key": _with(
        (LINES,),
        f"""
select {LINE_COLUMNS}, id
from (select *, row_number() over (
        partition by id order by l_shipdate desc, l_partkey desc, l_suppkey desc) as version
      from lines) as versions
where version = 1""",
    ),
    "stg_portfolio": _with((PH, STG), "select * from stg"),
    "active_entry_filter": """
select l_orderkey * 10 + l_linenumber as id, l_partkey, l_suppkey, l_shipdate, l_returnflag,
  is_deleted = false as is_active_entry
from (select *, case l_returnflag when 'R' then true when 'A' then false end as is_deleted
      from lineitem) as flagged
where is_deleted = false""",
    "business_date_shift": """
select event_id, ts + interval 15 hours as business_ts,
  cast(ts + interval 15 hours as date) as business_date,
  cast(date_trunc('month', ts + interval 15 hours) as date) as business_month
from events""",
    "classify_products": _with((PARTS,), "select * from parts"),
    "dim_product": _with(
        (PARTS,),
        f"select *, {_label_case('asset_class')} as asset_class_label,"
        f" {_bucket_case('asset_class')} as asset_class_bucket from parts",
    ),
    "dim_agent": _with((PH, STG, CUSTOMERS, ACTIVITY, AGENTS), "select * from agents"),
    "agent_activity": _with((PH, STG, ACTIVITY), "select * from activity"),
    "kyc_tenure": _with(
        (CUSTOMERS,),
        f"select *, date '{tb.AS_OF}' - cast(approved_kyc_at as date) as kyc_tenure_days from cust",
    ),
    "incremental_window": _with(
        (PH, STG),
        f"""
select portfolio_id, agent_id, product_id, customer_id, portfolio_date, portfolio_month,
  ending_balance, is_deleted, is_active_entry
from stg where portfolio_month > (
  select coalesce(max(portfolio_month), date '1900-01-01') - interval 90 day
  from stg where portfolio_date < date '{tb.CUT}')""",
    ),
    "incremental_merge_kpis": merged_fact("l_shipdate"),
    "late_arrival_merge": merged_fact("o_orderdate"),
    "merge_history": _with(
        (SNAPSHOTS,),
        f"""
select {LINE_COLUMNS}, id, snapshot_date
from (select *, row_number() over (
        partition by id, snapshot_date
        order by incoming desc, l_partkey desc, l_suppkey desc) as place
      from (select *, 0 as incoming from snaps where snapshot_date < date '2000-01-01'
            union all
            select {NET}, 1 as incoming from snaps where snapshot_date >= date '1998-01-01')
        as both_sides) as placed
where place = 1""",
    ),
    "merge_latest_guarded": _with(
        (SNAPSHOTS,),
        f"""
select {LINE_COLUMNS}, id, snapshot_date
from (select *, row_number() over (
        partition by id
        order by snapshot_date desc, incoming desc, l_partkey desc, l_suppkey desc) as place
      from (select *, 0 as incoming from snaps where snapshot_date >= date '1998-01-01'
            union all
            select {NET}, 1 as incoming from snaps where snapshot_date < date '1999-01-01')
        as both_sides) as placed
where place = 1""",
    ),
    "maintained_monthly_kpis": _with(FACT, "select * from kpi"),
    "rerun_drift": _with(
        FACT,
        "select count(*) as rows_after,"
        " count(*) filter (where core_customer_count > 0) as rows_with_changed_ts,"
        " count(*) filter (where aum_unknown_class > 0) as aum_drift_rows from kpi",
    ),
    "schema_drift_union": f"""
select o_orderkey, o_custkey, o_totalprice, o_orderdate,
  case when o_orderdate < timestamp '{tb.CUT} 00:00:00' then o_orderstatus end as o_orderstatus,
  case when o_orderdate >= timestamp '{tb.CUT} 00:00:00' then o_orderpriority end
    as o_orderpriority
from orders""",
    "schema_drift_widening": """
select l_orderkey * 10 + l_linenumber as id, l_partkey,
  case when year(l_shipdate) < 1996 then null when year(l_shipdate) < 1999 then floor(l_quantity) else floor(l_quantity) + 0.5 end as qty,
  case when year(l_shipdate) < 1999 then l_returnflag else cast(l_linenumber as varchar) end as note,
  cast(date_trunc('year', l_shipdate) as date) as snapshot_date, cast(date_trunc('year', l_shipdate) as timestamp) as ingested_at
from lineitem""",
    "append_snapshots": f"""
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
  case when o_orderdate >= timestamp '{tb.CUT} 00:00:00' then o_orderpriority end
    as o_orderpriority,
  cast(date_trunc('year', o_orderdate) as date) as snapshot_date
from orders""",
    "ingest_snapshots": f"""
select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_returnflag,
  l_linestatus, cast(l_shipdate as varchar) as l_shipdate,
  case when l_shipdate >= timestamp '{tb.CUT} 00:00:00' then l_tax end as l_tax,
  cast(date_trunc('year', l_shipdate) as date) as snapshot_date,
  cast(date_trunc('year', l_shipdate) as timestamp) as ingested_at
from lineitem""",
    "reload_master": """
select c_custkey, c_name, c_nationkey, c_acctbal + 1 as c_acctbal, c_mktsegment, count(*) over () as rows_loaded
from customer""",
    "ingest_metrics": """
select cast(l_shipdate as date) as snapshot_date, count(*) as rows_input
from lineitem group by cast(l_shipdate as date)""",
    "clean_strings": f"""
select p_partkey,
  trim(' ' || chr(9) || p_name || chr(12288) || chr(10), {_SPACES}) as p_name,
  case p_type when 'PROMO' then null when 'LARGE' then '' else p_type end as p_type
from part""",
    "snapshot_date_from_name": """
select l_orderkey * 10 + l_linenumber as id,
  case when l_returnflag = 'R' then 'history_' || strftime(l_shipdate, '%Y-%m-%d') || '_v2.csv'
    else 'batch123456789_' || strftime(l_shipdate, '%Y%m%d') || '.csv' end as file_name,
  cast(l_shipdate as date) as snapshot_date
from lineitem""",
    "profile_columns": LINEITEM_PROFILE,
    "detect_business_key": f"""
with profiles as (
  select 'orders' as table_name, * from ({ORDERS_PROFILE}) as o
  union all select 'lineitem' as table_name, * from ({LINEITEM_PROFILE}) as l
  union all select 'events' as table_name, * from ({EVENTS_PROFILE}) as e),
judged as (
  select table_name, "column" as key_column,
    cardinality_ratio >= 0.95 and null_fraction = 0 as single,
    cardinality_ratio >= 0.1 and null_fraction = 0 as part_of_key
  from profiles),
placed as (
  select *, bool_or(single) over (partition by table_name) as has_single,
    bool_or(part_of_key) over (partition by table_name) as has_parts,
    row_number() over (partition by table_name, single
                       order by lower(key_column) <> 'id', key_column) as place
  from judged)
select table_name, key_column from placed
where case when has_single then single and place = 1
           when has_parts then part_of_key else true end""",
    "business_key_hash": """
select l_orderkey, l_linenumber, kept as l_partkey,
  sha256(cast(l_orderkey as varchar) || chr(31) || coalesce(cast(kept as varchar), '__NULL__')
    || chr(31) || cast(l_linenumber as varchar)) as bk_hash
from (select *, case when l_returnflag <> 'N' then l_partkey end as kept from lineitem) as keyed""",
    "check_not_null": """
select o_orderkey, o_custkey, c_name
from orders left join (select * from customer where c_mktsegment <> 'FURNITURE') as served
  on o_custkey = c_custkey
where c_name is null""",
    "check_unique": (
        "select l_orderkey, count(*) as n_records from lineitem where l_orderkey is not null"
        " group by l_orderkey having count(*) > 1"
    ),
    "check_unique_grain": (
        "select l_orderkey, l_linenumber, count(*) as n_records from lineitem"
        " group by l_orderkey, l_linenumber having count(*) > 1"
    ),
    "check_accepted_values": (
        "select p_type, count(*) as n_records from part"
        " where p_type not in ('ECONOMY', 'LARGE', 'MEDIUM', 'SMALL', 'STANDARD') group by p_type"
    ),
    "check_relationships": (
        "select o_orderkey, o_custkey from orders where o_custkey is not null and o_custkey not in"
        " (select c_custkey from customer where c_mktsegment <> 'FURNITURE')"
    ),
    "check_no_future_dates": (
        "select event_id, ts from events"
        " where ts > timestamp '2024-01-20 06:00:00' + interval 12 hours"
    ),
    "check_non_negative": "select * from customer where c_acctbal < 0",
    "check_allocation": _with(FACT, allocation()),
    "check_core_reconciles": _with(
        (PH, STG, PRODUCTS, ME, kpis(threshold=90_000), EXPECTED_CORE), core_mismatch(0)
    ),
    "check_core_reconciles_literal": _with((*FACT, EXPECTED_CORE), core_mismatch(-1)),
    "check_positions_bound": _with(
        FACT,
        "select agent_id, month_start_date, month_end_positions, total_customer_count from kpi"
        " where month_end_positions > total_customer_count * 1",
    ),
    "check_no_future_month": _with(
        FACT,
        "select agent_id, month_start_date from kpi where month_start_date > date '2001-01-01'",
    ),
    "dq_report": _with(
        (*FACT, EXPECTED_CORE),
        "select check_name, severity, violations, case when violations = 0 then 'pass'"
        f" when severity = 'warn' then 'warn' else 'fail' end as status from ({REPORT}) as r",
    ),
}

# Kept up by changes, the report equals one built at once.
ORACLE["maintained_monthly_performance"] = ORACLE["agent_monthly_performance"]

ORACLE["rerun_drift_by_month"] = _with(
    FACT,
    "select count(*) as rows_after,"
    " count(*) filter (where core_customer_count > 0 and month_start_date >= date '1998-01-01') as rows_with_changed_ts,"
    " count(*) filter (where aum_unknown_class > 0 and month_start_date >= date '1998-01-01') as aum_drift_rows from kpi",
)
