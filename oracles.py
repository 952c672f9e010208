"""The same answers in plain SQL, for the comparison with another engine.

Written from the rules, not from the Spark code: amounts are whole numbers of 1/1000000,
and averages come from integer division.
"""

from __future__ import annotations

from siftledger.plans.profiling import ONE_SCAN
from siftledger.schemas import RANGE_CODES, RAW_COLUMNS, REASON_CODES
from siftledger.sources.derived import (
    BATCH,
    COLUMNS,
    HELPERS,
    INGESTED_AT,
    INVOCATION_ID,
    QUARANTINED_AT,
    RUN_STARTED_AT,
    SOURCE_FILE,
)

_helpers = ", ".join(f"{e} as {n}" for n, e in HELPERS.items())
_columns = ",\n  ".join(f"{e} as {n}" for n, e in COLUMNS.items())
FEED = f"""
joined as (select *, {_helpers} from lineitem
  left join orders on l_orderkey = o_orderkey left join part on l_partkey = p_partkey),
feed as (select {_columns}, timestamp '{INGESTED_AT}' as _ingested_at,
  '{SOURCE_FILE}' as _source_file from joined)"""


def _digits(text: str) -> str:
    return f"case when regexp_full_match({text}, '[0-9]+') then try_cast({text} as bigint) end"


def _number(text: str, dtype: str = "decimal(24, 6)") -> str:
    return f"case when regexp_full_match({text}, '[0-9]+([.][0-9]+)?') then try_cast({text} as {dtype}) end"


def _bare(text: str, prefix: str) -> str:
    return f"(case when starts_with({text}, '{prefix}') then {text}[2:] else {text} end)"


_ISO, _DMY = "[0-9]{4}-[0-9]{2}-[0-9]{2}", "[0-9]{2}-[0-9]{2}-[0-9]{4}"


def _day(text: str) -> str:
    return f"""cast(case when regexp_full_match({text}, '{_ISO}') then try_strptime({text}, '%Y-%m-%d')
    when regexp_full_match({text}, '{_DMY}') then try_strptime({text}, '%d-%m-%Y') end as date)"""


_raws = ", ".join(f"{c} as {c}_raw" for c in RAW_COLUMNS)
# The rules as the texts say them: a number by its form, too large by its digits.
_form = "coalesce(regexp_full_match({0}, '[0-9]+([.][0-9]+)?'), false)"
_large = "length(ltrim(split_part({0}, '.', 1), '0')) > 18"
_not_zero = "regexp_matches({0}, '[1-9]')"
_tests = (
    f"not {_form.format('price_raw')}",
    f"not {_form.format('tax_raw')}",
    "quantity is null",
    "transaction_date is null",
    "transaction_id is null",
    f"{_form.format('price_raw')} and not {_not_zero.format('price_raw')}",
    "tax_amount < 0",
    "quantity <= 0",
    "is_duplicate_id",
    f"{_form.format('price_raw')} and ({_large.format('price_raw')}"
    f" or {_not_zero.format('price_raw')} and unit_price = 0)",
    f"{_form.format('tax_raw')} and {_large.format('tax_raw')}",
)
_reasons = ", ".join(
    f"case when {test} then '{code}' end" for test, code in zip(_tests, REASON_CODES + RANGE_CODES, strict=True)
)
STAGED = f"""{FEED},
typed as (select {_raws},
  {_digits(_bare("transaction_id", "T"))} as transaction_id,
  {_digits("regexp_replace(customer_id, '[.]0+$', '')")} as customer_id,
  {_day("transaction_date")} as transaction_date,
  {_digits(_bare("product_id", "P"))} as product_id,
  nullif(trim(product_name), '') as product_name,
  try_cast({_number("quantity", "decimal(20, 6)")} as integer) as quantity,
  {_number("price")} as unit_price,
  {_number("tax")} as tax_amount,
  _ingested_at, _source_file from feed),
shared as (select transaction_id as id from typed where transaction_id is not null
  group by 1 having count(*) > 1),
judged as (select typed.*, shared.id is not null as is_duplicate_id
  from typed left join shared on typed.transaction_id = shared.id),
staged as (select *, list_filter([{_reasons}], lambda code: code is not null) as dq_reasons,
  customer_id is null as missing_customer,
  cast(quantity * unit_price as decimal(35, 6)) as subtotal,
  cast(quantity * unit_price + tax_amount as decimal(36, 6)) as total_amount,
  len(dq_reasons) = 0 as is_valid from judged)"""

MARTS = f"""{STAGED},
valid as (select transaction_id, coalesce(customer_id, -1) as customer_id, product_id, product_name,
  cast(strftime(transaction_date, '%Y%m%d') as integer) as date_key, transaction_date, quantity,
  unit_price, subtotal, tax_amount, total_amount, missing_customer, _ingested_at
  from staged where is_valid),
fact as (select * exclude (product_name) from valid),
product as (select distinct product_id, product_name from valid),
customer as (select distinct customer_id, false as is_unknown from valid where customer_id <> -1
  union all select cast(-1 as bigint), true),
calendar as (select cast(strftime(d, '%Y%m%d') as integer) as date_key, cast(d as date) as date_day,
  cast(year(d) as integer) as year, cast(month(d) as integer) as month, cast(day(d) as integer) as day,
  strftime(d, '%b') as month_name, cast(isodow(d) as integer) as day_of_week
  from (select unnest(range(lo, hi, interval 1 day)) as d from
    (select date_trunc('year', min(transaction_date)) as lo,
      date_trunc('year', max(transaction_date)) + interval 1 year as hi from fact))),
quarantine as (select {", ".join(f"{c}_raw" for c in RAW_COLUMNS)}, dq_reasons, _ingested_at,
  timestamp '{QUARANTINED_AT}' as _quarantined_at from staged where not is_valid),
reasons as (select transaction_id_raw, unnest(dq_reasons) as dq_reason, _quarantined_at from quarantine)"""


def _half_up(top: str, bottom: str, digits: int) -> str:
    """Whole numbers in, decimal(28, digits) out."""
    units = f"cast((2 * {10**digits} * ({top}) + ({bottom})) // (2 * ({bottom})) as decimal(28, 0))"
    step = f"cast({10**-digits:.{digits}f} as decimal({digits + 1}, {digits}))"
    return f"cast({units} * {step} as decimal(28, {digits}))"


def _units(column: str) -> str:
    return f"sum(cast({column} * 1000000 as hugeint))"


QUALITY = f"""{MARTS},
counts as (select (select count(*) from feed) as rows_received, (select count(*) from fact) as rows_modelled,
  (select count(*) from quarantine) as rows_quarantined),
metrics as (select *, rows_modelled + rows_quarantined = rows_received as reconciles,
  {_half_up("100 * rows_quarantined", "rows_received", 1)} as quarantine_pct from counts)"""

_totals = """count(*) as num_transactions, cast(sum(quantity) as bigint) as total_quantity,
  cast(sum(subtotal) as decimal(38, 6)) as total_subtotal, cast(sum(tax_amount) as decimal(34, 6)) as total_tax,
  cast(sum(total_amount) as decimal(38, 6)) as total_amount"""


def _with(ctes: str, query: str) -> str:
    return f"with {ctes}\n{query}"


def _check(name: str, failures: str, severity: str = "error", status: str | None = None) -> str:
    status = status or "case when failures >= 1 then 'fail' else 'pass' end"
    return f"""select '{name}' as "check", '{severity}' as severity, failures, {status} as status
  from (select cast(({failures}) as bigint) as failures)"""


def _checks(*parts: str) -> str:
    return _with(QUALITY, "\nunion all ".join(parts))


def _nulls(relation: str, name: str, columns: str, label: str = "not_null") -> list[str]:
    return [
        _check(f"{label}_{name}_{c}" + ("_required" if label == "contract" else ""),
               f"select count(*) from {relation} where {c} is null")
        for c in columns.split()
    ]


def _repeats(relation: str, column: str) -> str:
    return f"""select count(*) from (select {column} from {relation} where {column} is not null
    group by 1 having count(*) > 1)"""


def _orphans(column: str, dimension: str) -> str:
    return f"select count(*) from fact where {column} not in (select {column} from {dimension})"


_FACT_NN = "transaction_id customer_id product_id date_key quantity unit_price tax_amount total_amount"
_FACT_ALL = (
    "transaction_id customer_id product_id date_key transaction_date quantity unit_price subtotal"
    " tax_amount total_amount missing_customer"
)

_amount = "regexp_full_match({0}, '[0-9]+([.][0-9]+)?')"
_ok = {c: _amount.format(c) for c in ("price", "tax", "quantity")}
_blank = "({0} is null or trim({0}) = '')"


def _bad_values(column: str) -> str:
    return _with(FEED, f"""select {column} as bad_{column}_value, count(*) as n from feed
  where not {_ok[column]} group by 1""")


_issue_flags = f"""flags as (select not {_ok["price"]} as bad_price, not {_ok["tax"]} as bad_tax,
  {_blank.format("quantity")} or not {_ok["quantity"]} as bad_qty,
  {_blank.format("customer_id")} as missing_customer from feed)"""


def _tax_buckets(base: str, where: str, scale: int, name: str) -> str:
    """Tax over base in steps of five percent; both as whole numbers of 10^-scale."""
    tax = f"cast(try_cast(tax as decimal(28, 10)) * {10 ** scale} as hugeint)"
    return _with(FEED, f"""select cast(5 * ((2 * 20 * t + b) // nullif(2 * b, 0)) as bigint) as {name}, count(*) as n
  from (select {tax} as t, cast(cast({base} as decimal(38, 10)) * {10 ** scale} as hugeint) as b from feed
    where {_ok["tax"]} and {where}) group by 1""")


_price, _quantity = "try_cast(price as decimal(24, 6))", "try_cast(quantity as decimal(12, 4))"
_tax = "try_cast(tax as decimal(24, 6))"


def oracle_sql() -> dict[str, str]:
    names_p = {
        "tx_id_missing": "transaction_id", "customer_id_missing": "customer_id",
        "date_missing": "transaction_date", "product_id_missing": "product_id",
        "product_name_missing": "product_name", "quantity_missing": "quantity",
        "price_missing": "price", "tax_missing": "tax",
    }
    missing = ", ".join(f"count(*) filter (where {_blank.format(c)}) as {n}" for n, c in names_p.items())
    iso, dmy = (f"regexp_full_match(transaction_date, '{p}')" for p in (_ISO, _DMY))
    known = ", ".join(f"'{c}'" for c in REASON_CODES + RANGE_CODES)
    quarantined = "select count(*) from quarantine"
    answers = {
        "raw_feed": _with(FEED, "select * from feed"),
        "raw_row_count": _with(FEED, "select count(*) as total_rows from feed"),
        "csv_roundtrip": _with(FEED, "select * exclude (_source_file) from feed"),
        "csv_reconcile": _with(FEED, """select count(*) as rows_in_files, count(*) as rows_landed,
          true as reconciles from feed"""),
        "stg_classified": _with(STAGED, """select * exclude (dq_reasons),
          array_to_string(dq_reasons, '|') as dq_reasons from staged"""),
        "int_transactions_valid": _with(MARTS, "select * from valid"),
        "fct_transactions": _with(MARTS, "select * from fact"),
        "dim_product": _with(MARTS, "select * from product"),
        "dim_customer": _with(MARTS, "select * from customer"),
        "dim_date": _with(MARTS, "select * from calendar"),
        "quarantine": _with(MARTS, """select * exclude (dq_reasons),
          array_to_string(dq_reasons, '|') as dq_reasons from quarantine"""),
        "dq_quarantine_reasons": _with(MARTS, "select * from reasons"),
        "dq_reason_counts": _with(MARTS, "select dq_reason, count(*) as n from reasons group by 1"),
        "dq_completeness": _with(QUALITY, "select * from metrics"),
        "dq_run_audit": _with(QUALITY, f"""select '{INVOCATION_ID}' as invocation_id,
          timestamp '{RUN_STARTED_AT}' as run_started_at, rows_received, rows_modelled, rows_quarantined,
          quarantine_pct,
          (select count(*) from reasons where dq_reason = 'price_not_numeric') as n_price_not_numeric,
          (select count(*) from reasons where dq_reason = 'tax_not_numeric') as n_tax_not_numeric,
          (select count(*) from reasons where dq_reason = 'quantity_missing_or_invalid') as n_quantity_invalid,
          (select count(*) from reasons where dq_reason = 'date_unparseable') as n_date_unparseable,
          (select count(*) from reasons where dq_reason = 'transaction_id_invalid') as n_transaction_id_invalid
          from metrics"""),
        "agg_monthly_sales": _with(MARTS, f"""select cast(date_trunc('month', transaction_date) as date) as month,
          {_totals},
          count(distinct customer_id) filter (where customer_id <> -1) as num_customers,
          count(distinct product_id) as distinct_products,
          {_half_up(_units("total_amount"), "1000000 * count(*)", 2)} as avg_transaction_value,
          {_half_up("sum(quantity)", "count(*)", 2)} as avg_units_per_transaction
          from fact group by 1"""),
        "agg_sales_by_customer": _with(MARTS, f"""select customer_id, customer_id = -1 as is_unknown, {_totals},
          count(distinct product_id) as distinct_products,
          {_half_up(_units("total_amount"), "1000000 * count(*)", 2)} as avg_transaction_value,
          min(transaction_date) as first_transaction_date, max(transaction_date) as last_transaction_date
          from fact group by 1"""),
        "agg_sales_by_product": _with(MARTS, f""", sums as (select f.product_id, p.product_name, {_totals},
            {_units("total_amount")} as units,
            {_half_up(_units("unit_price"), "1000000 * count(*)", 2)} as avg_unit_price
            from fact f join product p on f.product_id = p.product_id group by 1, 2)
          select * exclude (units),
            {_half_up("100 * units", "(select sum(units) from sums)", 1)} as revenue_share_pct
          from sums"""),
        "run_summary": _with(QUALITY, """select 'rows' as section, item, n from
            (select unnest(['rows_received', 'rows_modelled', 'rows_quarantined']) as item,
              unnest([rows_received, rows_modelled, rows_quarantined]) as n from metrics)
          union all select 'reason', dq_reason, count(*) from reasons group by 2"""),
        "dq_alerts": _with(QUALITY, """select code as event, 'transactions' as job, 'dq_report' as task,
            'run-0001' as run_id, 'quarantine_pct=' || quarantine_pct || ' threshold=40.0' as message
          from metrics, (select unnest(['dq_reconcile_failed', 'dq_quarantine_high']) as code)
          where case when code = 'dq_reconcile_failed' then not reconciles else quarantine_pct > 40 end"""),
        "dq_alerts_low_threshold": _with(QUALITY, """select code as event, 'transactions' as job,
            'dq_report' as task, 'run-0001' as run_id,
            'quarantine_pct=' || quarantine_pct || ' threshold=5.0' as message
          from metrics, (select unnest(['dq_reconcile_failed', 'dq_quarantine_high']) as code)
          where case when code = 'dq_reconcile_failed' then not reconciles else quarantine_pct > 5 end"""),
        "stg_classified_large_path": _with(STAGED, """select * exclude (dq_reasons),
          array_to_string(dq_reasons, '|') as dq_reasons from staged"""),
        "check_relationships_fixed_calendar": _with(MARTS, """select date_key as from_field,
          count(*) as n_records from fact
          where transaction_date < '1994-01-01' or transaction_date >= '1997-01-01' group by 1"""),
        "check_not_null": _checks(
            *_nulls("product", "dim_product", "product_id product_name"),
            *_nulls("customer", "dim_customer", "customer_id"),
            *_nulls("calendar", "dim_date", "date_key"),
            *_nulls("fact", "fct_transactions", _FACT_NN),
            _check("not_null_dq_run_audit_invocation_id", "select 0 from metrics"),
        ),
        "check_unique": _checks(
            _check("unique_dim_product_product_id", _repeats("product", "product_id")),
            _check("unique_dim_customer_customer_id", _repeats("customer", "customer_id")),
            _check("unique_dim_date_date_key", _repeats("calendar", "date_key")),
            _check("unique_fct_transactions_transaction_id", _repeats("fact", "transaction_id")),
        ),
        "check_relationships": _checks(
            _check("relationships_fct_transactions_customer_id", _orphans("customer_id", "customer")),
            _check("relationships_fct_transactions_product_id", _orphans("product_id", "product")),
            _check("relationships_fct_transactions_date_key", _orphans("date_key", "calendar")),
        ),
        "check_accepted_values": _checks(_check(
            "accepted_values_dq_completeness_reconciles",
            "select count(distinct reconciles) from metrics where reconciles not in (true)")),
        "check_range": _checks(_check(
            "range_fct_transactions_quantity", "select count(*) from fact where quantity < 1")),
        "check_not_null_proportion": _checks(_check(
            "not_null_proportion_stg_dq_reasons",
            "select count(*) from (select count(dq_reasons) * 1.0 / count(*) as p from staged) where p < 0")),
        "check_contract": _checks(
            *_nulls("product", "dim_product", "product_id product_name", "contract"),
            _check("contract_dim_product_primary_key", _repeats("product", "product_id")),
            *_nulls("customer", "dim_customer", "customer_id is_unknown", "contract"),
            _check("contract_dim_customer_primary_key", _repeats("customer", "customer_id")),
            *_nulls("calendar", "dim_date", "date_key date_day", "contract"),
            _check("contract_dim_date_primary_key", _repeats("calendar", "date_key")),
            *_nulls("fact", "fct_transactions", _FACT_ALL, "contract"),
            _check("contract_fct_transactions_primary_key", _repeats("fact", "transaction_id")),
        ),
        "check_total_formula": _checks(_check(
            "total_amount_formula",
            "select count(*) from fact where total_amount <> quantity * unit_price + tax_amount")),
        "check_reconcile": _checks(_check(
            "partitions_reconcile", "select count(*) from metrics where not reconciles")),
        "check_vocabulary": _checks(_check(
            "dq_reasons_known", f"select count(*) from reasons where dq_reason not in ({known})")),
        "check_quarantine_threshold": _checks(_check(
            "quarantine_within_threshold", quarantined, "warn",
            "case when failures >= 50 then 'fail' when failures > 0 then 'warn' else 'pass' end")),
        "check_freshness": _with(FEED, f"""select 'freshness_raw' as "check", 'error' as severity,
            cast(status <> 'pass' as bigint) as failures, status from
          (select case when age > 72 * 3600 then 'fail' when age > 24 * 3600 then 'warn' else 'pass' end as status
            from (select epoch(timestamp '2024-01-04 00:00:00') - epoch(max(_ingested_at)) as age from feed))"""),
        "check_digits_lost": _checks(*_lost_digits()),
        "failing_unique": _with(STAGED, """select transaction_id as unique_field, count(*) as n_records
          from staged where transaction_id is not null group by 1 having count(*) > 1"""),
        "failing_relationships": _with(MARTS, """select transaction_id as from_field, count(*) as n_records
          from staged where transaction_id is not null
            and transaction_id not in (select transaction_id from fact) group by 1"""),
        "failing_accepted_values": _with(STAGED, """select is_valid as value_field, count(*) as n_records
          from staged where is_valid not in (true) group by 1"""),
        "failing_range": _with(STAGED, """select transaction_id_raw, quantity_raw, quantity from staged
          where quantity < 1"""),
        "profile_total_rows": _with(FEED, "select count(*) as total_rows from feed"),
        "profile_missing": _with(FEED, f"select {missing} from feed"),
        "profile_transaction_ids": _with(FEED, f"""select
          count(*) filter (where transaction_id like 'T%') as t_prefixed,
          count(*) filter (where regexp_full_match({_bare("transaction_id", "T")}, '[0-9]+')) as numeric_after_strip,
          count(distinct {_bare("transaction_id", "T")}) as distinct_after_strip, count(*) as total from feed"""),
        "profile_duplicate_ids": _with(FEED, f"""select {_bare("transaction_id", "T")} as tx_id, count(*) as n
          from feed group by 1 having count(*) > 1"""),
        "profile_customer_ids": _with(FEED, f"""select
          count(*) filter (where regexp_full_match(customer_id, '[0-9]+[.]0+')) as float_form,
          count(*) filter (where regexp_full_match(customer_id, '[0-9]+')) as int_form,
          count(*) filter (where {_blank.format("customer_id")}) as missing,
          count(distinct customer_id) as distinct_vals from feed"""),
        "profile_date_formats": _with(FEED, f"""select count(*) filter (where {iso}) as iso_ymd,
          count(*) filter (where {dmy}) as dmy, count(*) filter (where not {iso} and not {dmy}) as other from feed"""),
        "profile_date_range": _with(FEED, f"""select min({_day("transaction_date")}) as min_date,
          max({_day("transaction_date")}) as max_date from feed"""),
        "profile_product_ids": _with(FEED, f"""select count(*) filter (where product_id like 'P%') as p_prefixed,
          count(distinct {_bare("product_id", "P")}) as distinct_after_strip from feed"""),
        "profile_product_names": _with(FEED, f"""select {_bare("product_id", "P")} as pid, product_name,
          count(*) as n from feed group by 1, 2"""),
        "profile_quantity": _with(FEED, f"""select count(*) filter (where {_blank.format("quantity")}) as missing,
          count(*) filter (where {_ok["quantity"]}) as numeric_vals,
          count(*) filter (where regexp_full_match(quantity, '[0-9]+')) as integer_vals,
          count(*) filter (where {_number("quantity", "decimal(20, 6)")} <= 0) as zero_or_negative from feed"""),
        "profile_price": _with(FEED, f"""select count(*) filter (where {_ok["price"]}) as numeric_vals,
          count(*) filter (where not {_ok["price"]}) as non_numeric_vals from feed"""),
        "profile_bad_prices": _bad_values("price"),
        "profile_tax": _with(FEED, f"""select count(*) filter (where {_ok["tax"]}) as numeric_vals,
          count(*) filter (where not {_ok["tax"]}) as non_numeric_vals from feed"""),
        "profile_bad_taxes": _bad_values("tax"),
        "profile_tax_vs_price": _with(FEED, f"""select cast(round(min(t), 2) as decimal(21, 2)) as min_tax,
            cast(round(max(t), 2) as decimal(21, 2)) as max_tax,
            {_half_up(_units("t"), "1000000 * count(*)", 2)} as avg_tax,
            cast(round(min(p), 2) as decimal(21, 2)) as min_price,
            cast(round(max(p), 2) as decimal(21, 2)) as max_price,
            cast(round(avg(cast(t as double) / nullif(cast(p as double), 0)) * 100, 1) as decimal(28, 1))
              as avg_tax_pct_of_price
          from (select {_tax} as t, {_price} as p from feed where {_ok["tax"]} and {_ok["price"]})"""),
        "profile_disposition": _with(FEED, f""", {_issue_flags}
          select count(*) filter (where bad_price or bad_tax or bad_qty) as would_quarantine,
            count(*) filter (where not (bad_price or bad_tax or bad_qty) and missing_customer) as clean_but_flagged,
            count(*) filter (where not (bad_price or bad_tax or bad_qty) and not missing_customer) as fully_clean,
            count(*) as total from flags"""),
        "profile_issues_per_row": _with(FEED, f""", {_issue_flags}
          select cast(bad_price as integer) + cast(bad_tax as integer) + cast(bad_qty as integer)
            + cast(missing_customer as integer) as issues_on_row, count(*) as n_rows from flags group by 1"""),
        "profile_tax_summary": _with(FEED, f"""select count(*) as n, cast(round(min(t), 2) as decimal(21, 2)) as min,
            cast(round(max(t), 2) as decimal(21, 2)) as max,
            {_half_up(_units("t"), "1000000 * count(*)", 2)} as avg,
            cast(round(stddev_samp(cast(t as double)), 2) as decimal(28, 2)) as stddev,
            count(*) filter (where t = round(t)) as whole_numbers
          from (select {_tax} as t from feed where {_ok["tax"]})"""),
        "profile_tax_correlation": _with(FEED, f"""select
            (select cast(round(corr(cast(tax as double), cast({_price} as double)), 3) as decimal(28, 3)) from feed
              where {_ok["tax"]} and {_ok["price"]}) as corr_tax_price,
            (select cast(round(corr(cast(tax as double), cast(quantity as double) * cast({_price} as double)), 3)
              as decimal(28, 3)) from feed
              where {_ok["tax"]} and {_ok["price"]} and {_ok["quantity"]}) as corr_tax_subtotal"""),
        "profile_tax_percent_of_price": _tax_buckets(_price, _ok["price"], 10, "pct_of_price_bucket"),
        "profile_tax_percent_of_subtotal": _tax_buckets(
            f"({_quantity} * {_price})", f"{_ok['price']} and {_ok['quantity']}", 10, "pct_of_subtotal_bucket"),
    }
    same = {
        "fact": "fct_transactions", "quarantine": "quarantine", "dim_product": "dim_product",
        "dim_customer": "dim_customer", "monthly_sales": "agg_monthly_sales",
        "sales_by_customer": "agg_sales_by_customer", "sales_by_product": "agg_sales_by_product",
        "completeness": "dq_completeness",
    }
    answers |= {f"batches_{name}": answers[whole] for name, whole in same.items()}
    # Whole runs and batches start when they land.
    answers["run_history"] = answers["dq_run_audit"].replace(RUN_STARTED_AT, INGESTED_AT)
    answers["run_stored_failures"] = _with(MARTS, """select transaction_id_raw,
      array_to_string(dq_reasons, '|') as dq_reasons from quarantine""")
    answers["run_alias_views"] = _with(MARTS, """select 'analytics.dim_table' as view, count(*) as n from product
      union all select 'analytics.fact_table', count(*) from fact
      union all select 'analytics.dq_quarantine_reasons', count(*) from reasons""")
    found = _with(QUALITY, "\nunion all ".join([
        *_nulls("fact", "fct_transactions", _FACT_NN),
        *[_check(f"unique_{name}_{key}", _repeats(relation, key)) for name, relation, key in (
            ("dim_product", "product", "product_id"), ("dim_customer", "customer", "customer_id"),
            ("dim_date", "calendar", "date_key"), ("fct_transactions", "fact", "transaction_id"))],
        _check("quarantine_within_threshold", quarantined, "warn",
               "case when failures >= 50 then 'fail' when failures > 0 then 'warn' else 'pass' end"),
        *_lost_digits()]))
    answers["run_check_results"] = f"""select * from ({found}) where "check" like 'not_null_fct%'
      or "check" like 'unique%' or failures > 0"""
    # A batch judges its rows at the time it lands them.
    answers["batches_quarantine"] = answers["quarantine"].replace(QUARANTINED_AT, INGESTED_AT)
    return answers | _stored() | {"profile_overview": _side_by_side(answers)}


def _lost_digits() -> list[str]:
    return [
        _check(f"{name}_{typed}", f"select count(*) from staged where {typed} is {state} "
               f"and regexp_matches({text}, '{form}')", "warn",
               "case when failures > 0 then 'warn' else 'pass' end")
        for typed, text in (("unit_price", "price_raw"), ("tax_amount", "tax_raw"))
        for name, state, form in (("digits_lost", "not null", "^[0-9]+[.][0-9]{6}[0-9]*[1-9]"),
                                  ("overflow", "null", "^[0-9]+([.][0-9]+)?$"))
    ]


def _stored() -> dict[str, str]:
    """What batches, snapshots and upserts leave behind."""
    id_of = _digits(_bare("transaction_id", "T"))
    # The feed with the batch of each row, under the feed's name.
    batched = STAGED.replace(f"'{SOURCE_FILE}' as _source_file from joined", f"'{SOURCE_FILE}' as _source_file, {BATCH} as batch from joined")
    batched = batched.replace("_ingested_at, _source_file from feed", "_ingested_at, _source_file, batch from feed")
    lone = "count(*) over (partition by as_of, transaction_id) > 1 and transaction_id is not null"
    others = " or ".join(f"coalesce({test}, false)" for test in _tests if test != "is_duplicate_id")
    parts = " union all ".join(
        f"select 'analytics.{name}' as item, count(*) as n from {relation}"
        for name, relation in (("quarantine_customer_transactions", "quarantine"),
                               ("dim_product", "product"), ("dim_customer", "customer"))
    )
    contract = [
        *_nulls("product", "dim_product", "product_id product_name", "contract"),
        _check("contract_dim_product_primary_key", _repeats("product", "product_id")),
        *_nulls("customer", "dim_customer", "customer_id is_unknown", "contract"),
        _check("contract_dim_customer_primary_key", _repeats("customer", "customer_id")),
        *_nulls("calendar", "dim_date", "date_key date_day", "contract"),
        _check("contract_dim_date_primary_key", _repeats("calendar", "date_key")),
        *_nulls("fact", "fct_transactions", _FACT_ALL, "contract"),
        _check("contract_fct_transactions_primary_key", _repeats("fact", "transaction_id")),
    ]
    share = _half_up("100 * u", "(select sum(u) from units)", 1)
    known = ", ".join(f"'{c}'" for c in REASON_CODES + RANGE_CODES)
    moved = "transaction_id % 3 = 1"
    return {
        "batches_id_counts": _with(FEED, f"""select transaction_id, count(*) as n_rows,
            count(*) filter (where batch = 3) as n_added, 'batch-' || min(batch) as first_batch
          from (select {id_of} as transaction_id, {BATCH} as batch from
            (select {COLUMNS["transaction_id"]} as transaction_id, l_shipdate from joined))
          where transaction_id is not null group by 1"""),
        "batches_as_of": _with(batched, f""", as_ofs as (select cast(unnest([1, 2, 3]) as integer) as as_of),
          seen as (select as_of, {lone} as shared, {others} as faulty, quantity, unit_price, tax_amount
            from staged, as_ofs where batch <= as_of)
          select as_of as snapshot, count(*) filter (where not shared and not faulty) as n_fact,
            count(*) filter (where shared or faulty) as n_quarantined,
            cast(sum(quantity * unit_price + tax_amount) filter (where not shared and not faulty)
              as decimal(38, 6)) as total_amount
          from seen group by 1"""),
        "distinct_by_month": _with(MARTS, """select cast(date_trunc('month', transaction_date) as date) as month,
            count(distinct customer_id) filter (where customer_id <> -1) as num_customers,
            count(distinct product_id) as distinct_products from fact group by 1"""),
        "distinct_by_period": _with(MARTS, """select period,
            count(distinct customer_id) filter (where customer_id <> -1) as num_customers,
            count(distinct product_id) as distinct_products
          from (select *, unnest(['all', strftime(transaction_date, '%Y'),
            strftime(transaction_date, '%Y') || '-Q' || quarter(transaction_date)]) as period from fact)
          group by 1"""),
        "snapshot_parts": _with(MARTS, f""", parts as (
            select 'analytics.fct_transactions/month=' || strftime(date_trunc('month', transaction_date), '%Y-%m-%d')
              as item, count(*) as n from fact group by 1 union all {parts})
          select item, n as expected, n as found, true as ok from parts"""),
        "snapshot_acceptance": _checks(
            *contract,
            _check("relationships_fct_transactions_customer_id", _orphans("customer_id", "customer")),
            _check("relationships_fct_transactions_product_id", _orphans("product_id", "product")),
            _check("relationships_fct_transactions_date_key", _orphans("date_key", "calendar")),
            _check("partitions_reconcile", "select count(*) from metrics where not reconciles"),
            _check("total_amount_formula",
                   "select count(*) from fact where total_amount <> quantity * unit_price + tax_amount"),
            _check("dq_reasons_known", f"select count(*) from reasons where dq_reason not in ({known})"),
            _check("one_unknown_customer",
                   "select cast(count(*) <> 1 as integer) from customer where is_unknown"),
            _check("shares_add_up", f"""with units as (select product_id, {_units("total_amount")} as u from fact group by 1)
              select cast(abs(sum({share}) - 100) >= 0.5 + 0.05 * count(*) as integer) from units"""),
            _check("rows_are_divided", """select cast(count(*) <> (select count(*) from fact)
              + (select count(*) from quarantine) as integer) from feed"""),
        ),
        "catalog_calendar": _with(MARTS, """select cast(year(transaction_date) as integer) as year, count(*) as n,
            cast(sum(total_amount) as decimal(38, 6)) as total_amount
          from fact where month(transaction_date) = 5 group by 1"""),
        "upsert_fact": _with(MARTS, f""", odd as (select *, month(transaction_date) % 2 = 1 as changed from fact)
          select transaction_id, customer_id, product_id, quantity, unit_price, subtotal, tax_amount, total_amount,
            _ingested_at, changed and transaction_id % 5 = 1 or missing_customer as missing_customer,
            cast(strftime(day, '%Y%m%d') as integer) as date_key, day as transaction_date
          from (select *, case when changed and {moved} and transaction_id % 5 <> 1
              then cast(transaction_date + interval 40 day as date) else transaction_date end as day from odd)
          where not (changed and transaction_id % 5 = 0)"""),
        "ledger_batches": _with(FEED, f"""select 'batch-' || {BATCH} as batch, count(*) as n_rows,
            count(*) as n_landed, 0 as n_different from joined group by 1"""),
    }


def _side_by_side(answers: dict[str, str]) -> str:
    """The one-row profile answers as one row, each column named after its question."""
    parts = [answers[f"profile_{question}"] for question in ONE_SCAN]
    columns = ", ".join(
        f"columns({question}.*) as \"{question}_\\0\"" for question in ONE_SCAN
    )
    rows = ", ".join(f"({sql}) as {question}" for question, sql in zip(ONE_SCAN, parts, strict=True))
    return f"select {columns} from {rows}"
