"""Independent SQL (DuckDB dialect) for every catalog query.

Each layer is one common table expression; an oracle is a final select plus the layers it needs.
"""

from __future__ import annotations

import re

# Whole cents per transaction, and one more where the rest is half a cent or more.
_HALF_UP_AVERAGE = """cast((cents // txn_count + case when 2 * (cents % txn_count) >= txn_count then 1 else 0 end)
    * 0.01::decimal(3,2) as decimal(18,2)) as avg_spend"""

LAYERS = {
    # ---- raw text, as in sources.fixture ----
    "line_rows": """
select l.*, n.n_name, s.s_name || ' ' || p.p_brand as vendor, p.p_name,
  cast(round(l.l_extendedprice * 100) as bigint) // 40 * case when l.l_orderkey % 499 = 0 then 30 else 1 end as cents
from lineitem l
join orders o on o.o_orderkey = l.l_orderkey
join customer c on c.c_custkey = o.o_custkey
join nation n on n.n_nationkey = c.c_nationkey
join supplier s on s.s_suppkey = l.l_suppkey
join part p on p.p_partkey = l.l_partkey""",
    "raw": """
select
  cast(l_orderkey * 10 + l_linenumber as varchar) as transaction_id,
  case when l_linenumber % 2 = 0 then n_name || '  ' else n_name end as agency_name,
  case l_linenumber % 3 when 0 then lower(vendor) when 1 then '  ' || vendor || ' ' else vendor end as vendor_name,
  case l_partkey % 9
    when 0 then 'AIRLINES' when 1 then 'Computer Software' when 2 then 'OFFICE SUPPLIES' when 3 then 'Restaurants'
    when 4 then 'FURNITURE' when 5 then 'Greeting Cards' when 6 then 'Charity' when 7 then 'Books'
  end as mcc_description,
  case when l_orderkey % 227 = 0 then 'n/a' else
    case l_linenumber % 5
      when 0 then strftime(l_shipdate, '%Y/%m/%d %H:%M:%S') || '+00'
      when 1 then strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ')
      when 2 then strftime(l_shipdate, '%m/%d/%Y')
      when 3 then strftime(l_shipdate, '%Y-%m-%d')
      when 4 then strftime(l_shipdate, '%Y/%m/%d')
    end
  end as transaction_date_raw,
  case
    when l_orderkey % 211 = 0 then '($' || dollars || ')'
    when l_orderkey % 223 = 0 then '-' || dollars
    else '$' || dollars
  end as amount_raw,
  p_name as description
from (
  select *, format('{:,}', cents // 100) || '.' || lpad(cast(cents % 100 as varchar), 2, '0') as dollars
  from line_rows
)""",
    # ---- silver ----
    "typed": """
select *,
  coalesce(
    try_strptime(date_text, '%Y/%m/%d %H:%M:%S'),
    try_strptime(date_text, '%Y-%m-%d %H:%M:%S'),
    try_strptime(date_text, '%m/%d/%Y %H:%M:%S'),
    try_strptime(date_text, '%Y/%m/%d'),
    try_strptime(date_text, '%Y-%m-%d'),
    try_strptime(date_text, '%m/%d/%Y')
  ) as transaction_ts
from (
  select *,
    try_cast(replace(replace(amount_raw, '$', ''), ',', '') as decimal(18,2)) as amount,
    trim(regexp_replace(replace(
      regexp_replace(trim(transaction_date_raw), '\\s*(Z|\\+00:00|\\+00)\\s*$', ''),
      'T', ' '), '\\s+', ' ', 'g')) as date_text
  from raw
)""",
    "valid": """
select * from typed
where transaction_id is not null and transaction_ts is not null and amount is not null and amount > 0""",
    "survivors": """
select * exclude (rn, date_text) from (
  select *, row_number() over (partition by transaction_id order by
    transaction_ts desc nulls last, amount desc nulls last, agency_name desc nulls last, vendor_name desc nulls last,
    mcc_description desc nulls last, transaction_date_raw desc nulls last, amount_raw desc nulls last,
    description desc nulls last) as rn
  from valid
) where rn = 1""",
    "silver": """
select
  transaction_id, agency_name, vendor_name, mcc_description, transaction_date_raw, amount_raw, description,
  amount, transaction_ts, cast(transaction_ts as date) as transaction_date,
  upper(trim(vendor_name)) as vendor_name_clean, trim(agency_name) as agency_name_clean,
  cast(year(transaction_ts) as integer) as year, cast(month(transaction_ts) as integer) as month,
  cast(year(transaction_ts) * 100 + month(transaction_ts) as integer) as yyyymm,
  cast(dayofweek(transaction_ts) + 1 as integer) as day_of_week,
  dayofweek(transaction_ts) in (0, 6) as is_weekend,
  case when amount < 100 then '<100' when amount < 500 then '100-499' when amount < 2000 then '500-1999'
    else '>=2000' end as amount_bucket,
  case
    when regexp_matches(lower(coalesce(mcc_description, '')), 'travel|air|hotel|car') then 'Travel'
    when regexp_matches(lower(coalesce(mcc_description, '')), 'software|computer|it|electronics') then 'IT'
    when regexp_matches(lower(coalesce(mcc_description, '')), 'office|stationery|supplies') then 'Office'
    when regexp_matches(lower(coalesce(mcc_description, '')), 'food|restaurant|catering') then 'Meals'
    else 'Other'
  end as category_group
from survivors""",
    # ---- gold ----
    "vendor_monthly": """
select year, month, vendor_name_clean as vendor_name, count(*) as txn_count,
  cast(sum(amount) as double) as total_spend, cast(sum(amount) as double) / count(*) as avg_spend
from silver group by all""",
    "agency_category": """
select year, month, agency_name_clean as agency_name, category_group, count(*) as txn_count,
  cast(sum(amount) as double) as total_spend, cast(sum(amount) as double) / count(*) as avg_spend
from silver group by all""",
    "category_stats": """
select mcc_description as merchant_category,
  cast(sum(amount) as double) / count(*) as mean_amount, stddev_pop(cast(amount as double)) as std_amount
from silver group by all""",
    "first_seen": """
select vendor_name_clean as vendor_name, min(make_date(year, month, 1)) as first_seen_month
from silver group by all""",
    "anomaly": """
select s.transaction_id, s.transaction_date, s.agency_name_clean as agency_name, s.vendor_name_clean as vendor_name,
  s.mcc_description as merchant_category, s.category_group, s.amount, c.mean_amount, c.std_amount,
  case when cast(s.amount as double) > c.mean_amount + 3 * c.std_amount then 1 else 0 end as is_outlier,
  case when make_date(s.year, s.month, 1) = f.first_seen_month then 1 else 0 end as is_new_vendor_month,
  s.year, s.month
from silver s
left join category_stats c on c.merchant_category = s.mcc_description
left join first_seen f on f.vendor_name = s.vendor_name_clean""",
    # ---- all-time risk ----
    "vendor_totals": """
select vendor_name, count(*) as total_txn, sum(amount) as total_amount,
  cast(sum(amount) as double) / count(*) as avg_amount,
  cast(sum(is_outlier) as bigint) as outlier_txn, cast(sum(is_new_vendor_month) as bigint) as new_vendor_txn,
  max(is_outlier) as has_outlier, max(is_new_vendor_month) as is_new_vendor_month_flag,
  cast(sum(is_outlier) as double) / cast(count(*) as double) as outlier_rate
from anomaly group by vendor_name""",
    "scored": """
select *, least(100.0::double, risk_score_raw) as risk_score from (
  select *,
    70 * has_outlier + 30 * is_new_vendor_month_flag + 20 * spend_rank + 10 * outlier_rate as risk_score_raw
  from (select *, percent_rank() over (order by total_amount nulls first) as spend_rank from vendor_totals)
)""",
    # ---- stage ----
    "stage_silver": """
select transaction_id, agency_name, vendor_name, mcc_description, description, transaction_date, year, month, yyyymm,
  amount, category_group, amount_bucket, day_of_week, is_weekend
from silver""",
    "stage_vendor_monthly": f"""
select year, month, vendor_name, txn_count, cast(total_spend as decimal(18,2)) as total_spend, {_HALF_UP_AVERAGE}
from (select *, cast(round(total_spend * 100) as bigint) as cents from vendor_monthly)""",
    "stage_agency_category": f"""
select year, month, agency_name, category_group, txn_count, cast(total_spend as decimal(18,2)) as total_spend,
  {_HALF_UP_AVERAGE}
from (select *, cast(round(total_spend * 100) as bigint) as cents from agency_category)""",
    "stage_anomaly": """
select * replace (cast(mean_amount as decimal(18,2)) as mean_amount, cast(std_amount as decimal(18,2)) as std_amount)
from anomaly""",
    # ---- star: ids are dense ranks of the names' md5, so no dimension is needed to find them ----
    "identified": """
select *, case when agency_md5 is not null then dense_rank() over (order by agency_md5 nulls last) end as agency_id,
  case when vendor_md5 is not null then dense_rank() over (order by vendor_md5 nulls last) end as vendor_id
from (
  select *, md5(nullif(agency_name_clean, '')) as agency_md5, md5(nullif(vendor_name_clean, '')) as vendor_md5
  from silver
)""",
    "dim_agency": """
select distinct on (agency_id) agency_id, agency_name_clean as agency_name
from identified where agency_id is not null""",
    "dim_vendor": """
select distinct on (vendor_id) vendor_id, vendor_md5 as vendor_key, vendor_name_clean
from identified where vendor_id is not null""",
    "fact": """
select transaction_id, agency_id, vendor_id, transaction_date, year, month, yyyymm, amount, mcc_description,
  description, category_group, amount_bucket, is_weekend, day_of_week
from identified where agency_id + vendor_id is not null""",
    "mart_vendor_monthly": f"""
select *, {_HALF_UP_AVERAGE} from (
  select yyyymm, year, month, vendor_id, vendor_name_clean, count(*) as txn_count,
    cast(sum(amount) as decimal(18,2)) as total_spend, cast(sum(amount) * 100 as bigint) as cents
  from identified where vendor_id is not null group by all
)""",
    "mart_agency_category": f"""
select *, {_HALF_UP_AVERAGE} from (
  select yyyymm, year, month, agency_id, agency_name_clean as agency_name, category_group, count(*) as txn_count,
    cast(sum(amount) as decimal(18,2)) as total_spend, cast(sum(amount) * 100 as bigint) as cents
  from identified where agency_id is not null group by all
)""",
    "mart_anomaly": """
select transaction_id, yyyymm, transaction_date, amount, agency_id, vendor_id, category_group,
  is_outlier, is_new_vendor, is_high_amount,
  coalesce(if(is_outlier, concat_ws('+', 'OUTLIER', if(is_new_vendor, 'NEW_VENDOR', null)), null),
           if(is_high_amount, 'HIGH_AMOUNT', null), if(is_new_vendor, 'NEW_VENDOR', null)) as anomaly_reason
from (
  select fact.*, flagged.is_outlier > 0 as is_outlier, flagged.is_new_vendor_month > 0 as is_new_vendor,
    fact.amount >= 2000 as is_high_amount
  from fact join anomaly as flagged using (transaction_id)
)""",
    "mart_vendor_risk": """
select yyyymm, vendor_id, vendor_name_clean, 
  cast(count_if(is_outlier) as bigint) as outlier_txn, cast(count_if(is_new_vendor) as bigint) as new_vendor_txn,
  cast(if(bool_or(is_outlier), 70, 0) + if(bool_or(is_new_vendor), 30, 0) as integer) as risk_score
from mart_anomaly natural join (select vendor_id, vendor_name_clean from dim_vendor) group by all""",
    # ---- views ----
    "v_vendor_monthly_spend": """
select yyyymm, year, month, vendor_name_clean, txn_count, total_spend, avg_spend from mart_vendor_monthly""",
    "v_agency_category_spend": """
select yyyymm, year, month, agency_name, category_group, txn_count, total_spend, avg_spend
from mart_agency_category""",
    "v_transaction_anomaly": """
select mart_anomaly.* exclude (agency_id, vendor_id), agency_name, vendor_name_clean
from mart_anomaly natural join dim_agency natural join (select vendor_id, vendor_name_clean from dim_vendor)""",
    "v_vendor_risk_scores": """
select yyyymm, vendor_name_clean, outlier_txn, new_vendor_txn, risk_score from mart_vendor_risk""",
    "v_dim_date": """
select date, cast(year(date) as integer) as year, cast(month(date) as integer) as month,
  cast(year(date) * 100 + month(date) as integer) as yyyymm, cast(day(date) as integer) as day,
  cast(dayofweek(date) as integer) as dow_0_sun, dayofweek(date) in (0, 6) as is_weekend,
  strftime(date, '%b') as month_short, rpad(strftime(date, '%B'), 9, ' ') as month_name,
  strftime(date, '%Y-%m') as year_month, cast(date_trunc('month', date) as date) as month_start
from (
  select cast(unnest(generate_series(cast(min(transaction_date) as timestamp), cast(max(transaction_date) as timestamp),
    interval 1 day)) as date) as date
  from fact
)""",
    "v_dim_month": """
select distinct yyyymm, year, month, year_month, month_name, month_short, month_start from v_dim_date""",
    "v_exec_kpi": """
select yyyymm, cast(yyyymm // 100 as integer) as year, cast(yyyymm % 100 as integer) as month,
  cast(sum(spend) as decimal(28,2)) as total_spend, cast(sum(txn) as bigint) as txn_count,
  count(distinct vendor) as active_vendors, cast(sum(outlier) as bigint) as outlier_txn,
  cast(sum(fresh) as bigint) as new_vendor_txn
from (
  select yyyymm, total_spend as spend, txn_count as txn, vendor_name_clean as vendor, 0 as outlier, 0 as fresh
  from mart_vendor_monthly
  union all
  select yyyymm, null, null, null, is_outlier::integer, is_new_vendor::integer from mart_anomaly
) group by yyyymm having count(vendor) > 0""",
}


def oracle(select: str) -> str:
    """The select, preceded by the layers it reads, directly or through other layers."""
    needed: set[str] = set()
    pending = [select]
    while pending:
        words = set(re.findall(r"\w+", pending.pop()))
        found = [name for name in LAYERS if name in words and name not in needed]
        needed.update(found)
        pending.extend(LAYERS[name] for name in found)
    ctes = ",\n".join(f"{name} as ({LAYERS[name]}\n)" for name in LAYERS if name in needed)
    own = re.match(r"with\s+(recursive\s+)?", select)  # a select may add layers of its own
    rest = f",\n{select[own.end():]}" if own else f"\n{select}"
    recursive = "recursive " if own and own.group(1) else ""
    return f"with {recursive}{ctes}{rest}" if ctes else select


_STATS_4DP = "round(mean_amount, 4) as mean_amount, round(std_amount, 4) as std_amount"
_RISK_COLUMNS = """vendor_name, total_txn, cast(total_amount as double) as total_spend, avg_amount, outlier_txn,
  outlier_rate, new_vendor_txn, has_outlier, is_new_vendor_month_flag"""
_LANDED = """select *, case when cast(transaction_id as bigint) % 2 = 0 then '20240201_000000'
  else '20240301_000000' end as snapshot from raw"""
_SUNDAY_FIRST = "cast(dayofweek(transaction_ts) + 1 as integer)"
_MONTH = "m.year_month, m.month_start"

# Names with planted misspellings, and the pairs (both ways) that are so near that one may be the other misspelt.
_SPELT = """counted as (
  select vendor_name_clean as name, count(*) as weight from silver where vendor_name_clean <> '' group by all
), numbered as (select *, ('0x' || substr(md5(name), 1, 6))::bigint % 10 as k from counted
), spelt as (
  select name, weight from counted
  union all select replace(name, 'SUPPLIER', 'SUPLIER'), 1 from numbered where k = 1
  union all select replace(name, 'SUPPLIER', 'SUPPLLIER'), 1 from numbered where k = 2
  union all select replace(name, 'BRAND', 'BARND'), 1 from numbered where k = 3
  union all select replace(name, 'SUPPLIER', 'SUPPIER'), 1 from numbered where k = 3
  union all select replace(name, 'BRAND', 'BAND'), 1 from numbered where k = 4
  union all select replace(name, 'SUPPLIER#', 'VENDOR #'), 1 from numbered where k = 5
), linked as (
  select x.name as a, y.name as b, levenshtein(x.name, y.name) as edits
  from spelt x join spelt y on x.name <> y.name
    and regexp_replace(x.name, '[^0-9]', '', 'g') = regexp_replace(y.name, '[^0-9]', '', 'g')
  where levenshtein(x.name, y.name) <= case when least(length(x.name), length(y.name)) >= 12 then 2
                                            when least(length(x.name), length(y.name)) >= 5 then 1 else 0 end
)"""
# Table of the star -> layer, required columns, columns with ranges, flags.
_MEASURED = {
    "dim_agency": ("dim_agency", "agency_id agency_name", "", ""),
    "dim_vendor": ("dim_vendor", "vendor_id vendor_key vendor_name_clean", "", ""),
    "fact_transactions_clean": (
        "fact", "transaction_id agency_id vendor_id transaction_date year month yyyymm amount", "transaction_date yyyymm amount", "",
    ),
    "vendor_monthly_spend": (
        "mart_vendor_monthly", "yyyymm year month vendor_id vendor_name_clean txn_count total_spend avg_spend",
        "yyyymm txn_count total_spend", "",
    ),
    "agency_category_spend": (
        "mart_agency_category", "yyyymm year month agency_id agency_name category_group txn_count total_spend avg_spend",
        "yyyymm txn_count total_spend", "",
    ),
    "transaction_anomaly": (
        "mart_anomaly",
        "transaction_id yyyymm transaction_date amount agency_id vendor_id is_outlier is_high_amount is_new_vendor",
        "transaction_date amount", "is_outlier is_new_vendor is_high_amount",
    ),
    "vendor_risk_scores": (
        "mart_vendor_risk", "yyyymm vendor_id vendor_name_clean outlier_txn new_vendor_txn risk_score", "risk_score", "",
    ),
}


def _all_metrics() -> str:
    """A row per metric: rows, NULLs, ranges (dates as days since 1970) and shares."""
    rows = []
    for table, (layer, required, ranges, flags) in _MEASURED.items():
        metrics = [("rows", None, "count(*)")]
        metrics += [("nulls", c, f"count(*) filter ({c} is null)") for c in required.split()]
        for c in ranges.split():
            number = f"date_diff('day', date '1970-01-01', {c})" if c.endswith("_date") else c
            metrics += [("least", c, f"min({number})"), ("most", c, f"max({number})")]
        metrics += [("share", c, f"round(avg({c}::integer), 6)") for c in flags.split()]
        for metric, column, value in metrics:
            named = "null::varchar" if column is None else f"'{column}'"
            rows.append(f"select '{table}' as table_name, '{metric}' as metric, {named} as column_name, ({value})::double as value from {layer}")
    return "\nunion all ".join(rows)


SELECTS = {
    # sources
    "read_bronze_csv": "select * from raw",
    "land_bronze": _LANDED,
    "land_arrivals": _LANDED,
    "read_table_columns": "select transaction_id, transaction_date, amount from silver",
    "write_table_by_month": "select yyyymm, count(*) as row_count, cast(sum(amount) as decimal(28,2)) as amount from silver group by yyyymm",
    "export_csv_round_trip": "select * from silver",
    "stage_rejects": """select transaction_id, 'amount' as column_name, amount::varchar || 'e17' as text
from silver where transaction_id::bigint % 7 = 0
union all select transaction_id, 'transaction_date', '2024-13-01' from silver where transaction_id::bigint % 11 = 0
union all select transaction_id, 'is_weekend', 'perhaps' from silver where transaction_id::bigint % 13 = 0""",
    "missing_fields": """select unnest(['vendor_name', 'amount_raw']) as field, count(*) as row_count from raw""",
    "stage_silver": "select * from stage_silver",
    "stage_vendor_monthly": "select * from stage_vendor_monthly",
    "stage_agency_category": "select * from stage_agency_category",
    "stage_anomaly": "select * from stage_anomaly",
    # column resolution
    "optional_fields": """select transaction_id, cast(null as varchar) as mcc_description,
  cast(null as varchar) as description from raw""",
    "gold_fallback_columns": """select transaction_id, transaction_date, amount, year, month, vendor_name, agency_name,
  'Other' as merchant_category, 'Other' as category_group from silver""",
    # silver
    "project_raw": "select * from raw",
    "clean_amount": "select transaction_id, amount_raw, amount from typed",
    "normalize_date_text": "select transaction_id, date_text from typed",
    "parse_timestamp": "select transaction_id, transaction_date_raw, transaction_ts from typed",
    "midnight_fallback": """select transaction_id, case when l_linenumber % 3 = 2 then l_shipdate::date + interval '7 hours 8 minutes 9 seconds'
  else cast(l_shipdate::date as timestamp) end as transaction_ts
from (select *, cast(l_orderkey * 10 + l_linenumber as varchar) as transaction_id from line_rows)""",
    "transaction_date": "select transaction_id, cast(transaction_ts as date) as transaction_date from typed",
    "filter_valid": "select * exclude (date_text) from valid",
    "normalize_vendor": "select transaction_id, upper(trim(vendor_name)) as vendor_name_clean from raw",
    "normalize_agency": "select transaction_id, trim(agency_name) as agency_name_clean from raw",
    "calendar_features": """select transaction_id, cast(year(transaction_ts) as integer) as year,
  cast(month(transaction_ts) as integer) as month,
  cast(year(transaction_ts) * 100 + month(transaction_ts) as integer) as yyyymm from valid""",
    "weekday_features": f"""select transaction_id, {_SUNDAY_FIRST} as day_of_week,
  {_SUNDAY_FIRST} in (1, 7) as is_weekend from valid""",
    "amount_bucket": """select transaction_id, amount, case when amount < 100 then '<100' when amount < 500 then '100-499'
  when amount < 2000 then '500-1999' else '>=2000' end as amount_bucket from valid""",
    "category_group": "select transaction_id, mcc_description, category_group from silver",
    "dedup_transactions": "select * from survivors",
    "dedup_repeats": "select * from survivors",
    "build_silver": "select * from silver",
    "silver_of_two_snapshots": """with ids as (
  select transaction_id, amount, cast(transaction_ts as date) as transaction_date from survivors
  where transaction_id::bigint % 3 <> 0
  union all
  select distinct transaction_id, 1.25::decimal(18,2), date '1990-01-02' from raw where transaction_id::bigint % 3 = 0
)
select *, case when amount < 100 then '<100' when amount < 500 then '100-499' when amount < 2000 then '500-1999'
  else '>=2000' end as amount_bucket from ids""",
    "stream_silver": """with ids as (
  select transaction_id, amount, cast(transaction_ts as date) as transaction_date from survivors
  where transaction_id::bigint % 3 <> 0
  union all
  select distinct transaction_id, 1.25::decimal(18,2), date '1996-03-02' from raw where transaction_id::bigint % 3 = 0
  union all  -- an older state counts where no newer one is valid
  select distinct transaction_id, 9999.99::decimal(18,2), date '1990-01-02' from raw
  where transaction_id::bigint % 5 = 0 and transaction_id::bigint % 3 <> 0
    and transaction_id not in (select transaction_id from survivors)
)
select *, case when amount < 100 then '<100' when amount < 500 then '100-499' when amount < 2000 then '500-1999'
  else '>=2000' end as amount_bucket from ids""",
    # gold
    "amount_num": "select transaction_id, cast(amount as double) as amount_num from silver",
    "vendor_monthly_spend": "select * from vendor_monthly",
    "agency_category_spend": "select * from agency_category",
    "sort_by_spend": "select * from agency_category order by total_spend desc, year, month, agency_name, category_group",
    "category_stats": f"select merchant_category, {_STATS_4DP} from category_stats",
    "vendor_first_seen": "select * from first_seen",
    "join_category_stats": f"select transaction_id, merchant_category, {_STATS_4DP} from anomaly",
    "join_first_seen": """select s.transaction_id, f.vendor_name, f.first_seen_month
from silver s left join first_seen f on f.vendor_name = s.vendor_name_clean""",
    "txn_month": "select transaction_id, make_date(year, month, 1) as txn_month from silver",
    "is_outlier": "select transaction_id, amount, is_outlier from anomaly",
    "is_new_vendor_month": "select transaction_id, vendor_name, is_new_vendor_month from anomaly",
    "transaction_anomaly": "select * replace (round(mean_amount, 4) as mean_amount, round(std_amount, 4) as std_amount) from anomaly",
    # all-time risk
    "risk_input": "select vendor_name, amount, is_outlier, is_new_vendor_month from anomaly",
    "vendor_rollup": """select vendor_name, total_txn, cast(total_amount as decimal(28,2)) as total_spend, avg_amount,
  outlier_txn, new_vendor_txn, has_outlier, is_new_vendor_month_flag from vendor_totals""",
    "outlier_rate": "select vendor_name, outlier_rate from vendor_totals",
    "spend_percent_rank": "select vendor_name, cast(total_amount as decimal(28,2)) as total_spend, spend_rank from scored",
    "risk_score_raw": "select vendor_name, round(risk_score_raw, 6) as risk_score_raw from scored",
    "risk_score": "select vendor_name, round(risk_score, 6) as risk_score from scored",
    "vendor_risk_all_time": f"select {_RISK_COLUMNS}, round(risk_score, 6) as risk_score from scored",
    # serving
    "agency_candidates": "select agency_name from dim_agency",
    "upsert_dim_agency": "select * from dim_agency",
    "vendor_candidates": "select vendor_key, vendor_name_clean from dim_vendor",
    "upsert_dim_vendor": "select * from dim_vendor",
    "upsert_dim_vendor_second_load": """select
  row_number() over (order by case when first_year <= 1995 then 0 else 1 end, vendor_key) as vendor_id,
  vendor_key, vendor_name_clean
from (
  select v.vendor_key, v.vendor_name_clean, min(s.year) as first_year
  from dim_vendor v join identified s on s.vendor_id = v.vendor_id group by all
)""",
    "upsert_dim_agency_second_load": """select
  row_number() over (order by case when first_year <= 1995 and agency_name < 'G' then 0 else 1 end, md5(agency_name)) as agency_id,
  agency_name
from (select agency_name_clean as agency_name, min(year) as first_year from identified where agency_id is not null group by all)""",
    "audit_columns": "select yyyymm, count(*) as row_count, count(*) as stamped from fact group by yyyymm",
    "load_fact": "select * from fact",
    "derive_period": "select transaction_id, year, month, yyyymm from silver",
    "load_vendor_monthly": "select * exclude (cents) from mart_vendor_monthly",
    "load_agency_category": "select * exclude (cents) from mart_agency_category",
    "vendor_risk_monthly": "select * from mart_vendor_risk",
    "load_anomaly": "select * from mart_anomaly",
    "is_high_amount": "select transaction_id, amount >= 2000 as is_high_amount from silver",
    "anomaly_reason": "select transaction_id, anomaly_reason from mart_anomaly",
    "full_reload": """select 'fact_transactions_clean' as tbl, count(*) as row_count from fact
union all select 'vendor_monthly_spend', count(*) from mart_vendor_monthly
union all select 'agency_category_spend', count(*) from mart_agency_category
union all select 'transaction_anomaly', count(*) from mart_anomaly
union all select 'vendor_risk_scores', count(*) from mart_vendor_risk
union all select 'dim_agency', count(*) from dim_agency
union all select 'dim_vendor', count(*) from dim_vendor""",
    "full_reload_content": "select * from mart_anomaly",
    "load_months": """select transaction_id, yyyymm, amount, vendor_name_clean, is_outlier, is_new_vendor, anomaly_reason
from mart_anomaly natural join (select vendor_id, vendor_name_clean from dim_vendor)""",
    "load_months_counts": """select 'fact_transactions_clean' as tbl, count(*) as row_count from fact
union all select 'transaction_anomaly', count(*) from mart_anomaly
union all select 'vendor_monthly_spend', count(*) from mart_vendor_monthly
union all select 'vendor_risk_scores', count(*) from mart_vendor_risk
union all select 'dim_vendor', count(*) from dim_vendor""",
    "sql_over_published_views": """select * exclude (month_year, month_no) from v_exec_kpi
join (select * rename (year as month_year, month as month_no) from v_dim_month) using (yyyymm)""",
    "check_integrity": """with spoilt as (
  select * replace (if(transaction_id::bigint % 89 = 0, null, amount) as amount,
                    if(transaction_id::bigint % 83 = 0, -vendor_id, vendor_id) as vendor_id) from fact
  union all select * from fact where transaction_id::bigint % 97 = 0
), found as (
  select 'unique transaction_id' as rule, count(*) as offenders from (
    select transaction_id from spoilt group by transaction_id having count(*) > 1)
  union all select 'required amount', count(*) from spoilt where amount is null
  union all select 'vendor_id references dim_vendor', count(distinct vendor_id) from spoilt where vendor_id < 0
  union all select 'agency_id references dim_agency', count(distinct agency_id) from spoilt where agency_id <= 2
)
select 'fact_transactions_clean' as table_name, rule, offenders from found where offenders > 0""",
    "quality_metrics": _all_metrics(),
    "quality_breaches": """with spoilt as (
  select * replace (case when transaction_id::bigint % 89 = 0 then null when transaction_id::bigint % 97 = 0 then -amount
                         else amount end as amount,
                    case when transaction_id::bigint % 83 = 0 then date '1850-01-01' else transaction_date end as transaction_date)
  from fact
)
select 'fact_transactions_clean' as table_name, * from (
  select 'nulls' as metric, 'amount' as column_name, count(*) filter (amount is null)::double as value,
         null::double as at_least, 0::double as at_most from spoilt
  union all select 'least', 'transaction_date', date_diff('day', date '1970-01-01', min(transaction_date))::double, -25567, 47481 from spoilt
  union all select 'least', 'amount', min(amount)::double, 0.01, null from spoilt
)""",
    # percentile outliers
    "percentile_outliers": """with bounds as (
  select mcc_description as merchant_category, quantile_disc(amount, 0.95) as p95, quantile_disc(amount, 0.99) as p99
  from silver where mcc_description is not null group by all
)
select transaction_id, mcc_description as merchant_category, amount, p95, p99,
  coalesce((amount > p95)::integer, 0) as above_p95, coalesce((amount > p99)::integer, 0) as above_p99
from silver left join bounds on merchant_category = mcc_description""",
    "percentile_bounds_of_vendors": """select vendor_name_clean as vendor_name,
  quantile_disc((amount * 100)::bigint, 0.5) as p50, quantile_disc((amount * 100)::bigint, 0.9) as p90
from silver where vendor_name_clean is not null group by all""",
    "percentile_sketches": """select mcc_description as merchant_category, count(*) as txn_count,
  true as p95_is_near, true as p99_is_near from silver where mcc_description is not null group by all""",
    # vendor matching: all pairs of names with the same digits
    "misspellings": f"with {_SPELT} select a, b, edits::integer as edits from linked where a < b",
    "vendor_groups": f"""with recursive {_SPELT}, reached as (
  select name as start, name from spelt
  union
  select r.start, case when r.name = l.a then l.b else l.a end from reached r join linked l on r.name = l.a
), rooted as (
  select start as name, min(name) as root, count(*) as members from reached group by start
)
select r.name, first(s.name order by s.weight desc, s.name) as group_name, r.members
from rooted r join rooted o on o.root = r.root join spelt s on s.name = o.name group by r.name, r.members""",
    # spans of the calendar
    "active_vendors_by_quarter": """select cast(yyyymm // 100 as integer) as year, cast((yyyymm % 100 + 2) // 3 as integer) as quarter,
  count(distinct vendor_id) as active_vendors from mart_vendor_monthly group by all""",
    "active_vendors_by_year": """select cast(yyyymm // 100 as integer) as year, count(distinct vendor_id) as active_vendors
from mart_vendor_monthly group by all""",
    "quarter_slice": """select yyyymm, strftime(min(transaction_date), '%Y-%m') as year_month, count(*) as txn_count,
  cast(sum(amount) as decimal(28,2)) as amount from fact where month between 4 and 6 group by yyyymm""",
    "weekday_slice": """select *, 0::integer as dow_0_sun from mart_anomaly
where dayofweek(transaction_date) = 0 and year(transaction_date) = 1996""",
    # views
    "v_vendor_monthly_spend": "select * from v_vendor_monthly_spend",
    "v_agency_category_spend": "select * from v_agency_category_spend",
    "v_transaction_anomaly": "select * from v_transaction_anomaly",
    "v_vendor_risk_scores": "select * from v_vendor_risk_scores",
    "v_dim_date": "select * from v_dim_date",
    "v_dim_month": "select * from v_dim_month",
    "v_exec_kpi": "select * from v_exec_kpi order by yyyymm",
    # analyst queries and KPIs
    "row_counts": """select 'fact' as tbl, count(*) as row_count from fact
union all select 'vendor_monthly', count(*) from mart_vendor_monthly
union all select 'agency_category', count(*) from mart_agency_category
union all select 'anomaly', count(*) from mart_anomaly
union all select 'risk', count(*) from mart_vendor_risk
union all select 'stage_silver', count(*) from stage_silver
union all select 'stage_vendor_monthly', count(*) from stage_vendor_monthly
union all select 'stage_agency_category', count(*) from stage_agency_category
union all select 'stage_anomaly', count(*) from stage_anomaly""",
    "preview_view": "select * from v_vendor_monthly_spend order by yyyymm, vendor_name_clean limit 10",
    "preview_agency_category": """select * from v_agency_category_spend
order by yyyymm, agency_name, category_group limit 10""",
    "preview_transaction_anomaly": "select * from v_transaction_anomaly order by transaction_id limit 10",
    "top_vendors": """select vendor_name_clean, cast(sum(total_spend) as decimal(28,2)) as spend
from v_vendor_monthly_spend group by vendor_name_clean order by spend desc, vendor_name_clean limit 10""",
    "top_risk_scores": """select * from v_vendor_risk_scores
order by risk_score desc, yyyymm, vendor_name_clean limit 10""",
    "top_risky_vendors": """select * from v_vendor_risk_scores
order by risk_score desc, outlier_txn desc, yyyymm, vendor_name_clean limit 20""",
    "latest_anomalies": """select * from v_transaction_anomaly where is_outlier or is_new_vendor or is_high_amount
order by transaction_date desc, transaction_id limit 50""",
    "duplicate_months": "select yyyymm, 2::bigint as c from v_dim_month where month between 4 and 6",
    "concentration": """with spent as (
  select vendor_name_clean, cast(sum(total_spend) as decimal(28,2)) as spend from v_vendor_monthly_spend group by all
)
select vendor_name_clean, spend, round(spend::double / all_spend::double, 9) as share,
  round(down_to::double / all_spend::double, 9) as cumulative_share
from (
  select *, sum(spend) over () as all_spend, sum(spend) over (order by spend desc, vendor_name_clean) as down_to,
    row_number() over (order by spend desc, vendor_name_clean) as place from spent
) where place <= 10""",
    "kpi_totals": """select *, outlier_txn + new_vendor_txn as flagged_txn,
  cast(total_spend as double) / nullif(total_txn, 0) as avg_spend_per_txn
from (
  select cast(sum(total_spend) as decimal(38,2)) as total_spend, cast(sum(txn_count) as bigint) as total_txn,
    cast(sum(active_vendors) as bigint) as active_vendors, cast(sum(outlier_txn) as bigint) as outlier_txn,
    cast(sum(new_vendor_txn) as bigint) as new_vendor_txn
  from v_exec_kpi
)""",
    "month_slice_exec_kpi": f"select k.*, {_MONTH} from v_exec_kpi k join v_dim_month m on m.yyyymm = k.yyyymm",
    "month_slice_vendor_monthly": f"""select k.*, {_MONTH}
from v_vendor_monthly_spend k join v_dim_month m on m.yyyymm = k.yyyymm""",
    "month_slice_agency_category": f"""select k.*, {_MONTH}
from v_agency_category_spend k join v_dim_month m on m.yyyymm = k.yyyymm""",
    "month_slice_vendor_risk": f"""select k.*, {_MONTH}
from v_vendor_risk_scores k join v_dim_month m on m.yyyymm = k.yyyymm""",
    "month_slice_one_month": f"""select k.*, {_MONTH}
from v_vendor_risk_scores k join v_dim_month m on m.yyyymm = k.yyyymm where k.yyyymm = 199603""",
    "date_slice": """select k.*, d.year_month, d.dow_0_sun, d.is_weekend, d.month_start
from v_transaction_anomaly k join v_dim_date d on d.date = k.transaction_date""",
}


def oracle_sql() -> dict[str, str]:
    return {name: oracle(select) for name, select in SELECTS.items()}
