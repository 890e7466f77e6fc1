"""DuckDB twin of the warehouse layers, as SQL text.

Each oracle query is ``WITH <layers>, <query CTEs> SELECT ...`` over the
driver's pre-registered views (customer, supplier, events, nation, region).
Results are reached another way than in the Spark build: trailing counts by a
self-join over time, scores and bands by joins to tables of rules.  Thresholds
are written out here, apart from ``paymart.config``.  Rounded ratios use the
same integer formulas as ``paymart.functions.rounding`` so that both engines
produce identical doubles.
"""

from __future__ import annotations


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def in_list(values) -> str:
    return ", ".join(q(v) for v in values)


def sk(col: str) -> str:
    return f"md5(coalesce(cast({col} as varchar), '_dbt_utils_surrogate_key_null_'))"


# ---------------------------------------------------------------- rounding
def round_quotient(num: str, den: str, digits: int) -> str:
    """round(num/den, digits) half away from zero, NULL when den = 0."""
    scale = 10 ** digits
    n = f"cast({num} as hugeint)"
    d = f"nullif(cast({den} as hugeint), 0)"
    return (f"(cast(case when {n} < 0 then -((-{n} * {2 * scale} + {d}) // (2 * {d})) "
            f"else ({n} * {2 * scale} + {d}) // (2 * {d}) end as double) / {scale})")


def pct(num: str, den: str, digits: int = 2) -> str:
    return round_quotient(f"({num}) * 100", den, digits)


def ratio(num: str, den: str, digits: int = 2) -> str:
    return round_quotient(num, den, digits)


def round_avg_money(total: str, n: str, digits: int = 2) -> str:
    return round_quotient(f"({total}) * 100", f"({n}) * 100", digits)


def round_avg_int(total: str, n: str, digits: int = 2) -> str:
    return round_quotient(total, n, digits)


def round_double(x: str, digits: int = 2) -> str:
    scale = float(10 ** digits)
    return f"(cast(floor(({x}) * {scale} + 0.5) as double) / {scale})"


def safe_ratio(num: str, den: str) -> str:
    return f"(case when ({den}) is null or ({den}) = 0 then 0.0 else cast({num} as double) / cast({den} as double) end)"


def count_if(cond: str) -> str:
    return f"cast(sum(case when {cond} then 1 else 0 end) as bigint)"


# ---------------------------------------------------------------- adapter
CATEGORY_CASE = """case {k} % 8 when 0 then 'Retail' when 1 then 'Food & Beverage' when 2 then 'Travel'
            when 3 then 'Electronics' when 4 then 'Healthcare' when 5 then 'Entertainment'
            when 6 then 'Groceries' else 'Fashion' end"""

ADAPTER = f"""
users as (
  select concat('USR_', lpad(cast(c_custkey as varchar), 8, '0')) as user_id,
         case c_custkey % 4 when 0 then '18-25' when 1 then '26-35' when 2 then '36-50' else '50+' end as age_group,
         case c_custkey % 3 when 0 then 'savings' when 1 then 'current' else 'premium' end as account_type,
         cast(date '2024-01-01' + cast(c_custkey % 455 as integer) as date) as registration_date,
         n_name as city, r_name as state
  from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
),
merchants as (
  select concat('MER_', lpad(cast(s_suppkey as varchar), 6, '0')) as merchant_id, s_name as merchant_name,
         {CATEGORY_CASE.format(k='s_suppkey')} as merchant_category,
         n_name as city, r_name as state,
         cast(date '2023-01-01' + cast((s_suppkey * 37) % 640 as integer) as date) as onboarding_date
  from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey
),
tx_n as (select (select count(*) from supplier) as ns, (select count(*) from customer) as nc),
tx_e as (
  select event_id, user_id, event_type, value, epoch_us(ts) - 1704067200000000 as off,
         cast(json_extract_string(props, '$.k') as bigint) as k, ns
         , case when user_id % 5 = 1 and event_id % 3 <> 0 or user_id % 5 = 2 and event_id % 12 <> 0
                then nc - 1 - (event_id * 7919) % (nc // 2) else user_id end as owner
  from events cross join tx_n
),
tx_m as (
  select *, case when user_id % 25 = 1 then 3 % ns
                 when event_id % 97 = 0 then ns - 1 - (event_id % (ns // 4))
                 else (k * (k + 1) // 2) % ns end as suppkey
  from tx_e
),
tx_f as (
  select *, (event_id * 7919) % 1000 < (case when suppkey % 11 = 4 then 110 when suppkey % 11 = 5 then 12 else 35 end)
            as is_fraud
  from tx_m
),
transactions as (
  select concat('TXN_', lpad(cast(event_id as varchar), 10, '0')) as transaction_id,
         concat('USR_', lpad(cast(owner as varchar), 8, '0')) as user_id,
         concat('MER_', lpad(cast(suppkey as varchar), 6, '0')) as merchant_id,
         {CATEGORY_CASE.format(k='suppkey')} as merchant_category,
         case event_type when 'view' then 'UPI' when 'click' then 'Credit Card' when 'purchase' then 'Debit Card'
              when 'signup' then 'NetBanking' else 'Wallet' end as payment_method,
         cast(cast(value as decimal(12,2)) * (case when user_id % 10 = 2 then 25 else 250 end) as decimal(12,2)) as amount,
         'INR' as currency,
         case when is_fraud then case when event_id % 20 < 11 then 'failed' when event_id % 20 < 17 then 'declined'
                                      else 'disputed' end
              when (event_id * 13) % 100 < 92 then 'success' when (event_id * 13) % 100 < 96 then 'failed'
              when (event_id * 13) % 100 < 99 then 'declined' else 'disputed' end as status,
         is_fraud,
         case event_id % 4 when 2 then 'desktop' when 3 then 'POS' else 'mobile' end as device_type,
         n_name as city, r_name as state,
         make_timestamp(1704067200000000 + (user_id % 12) * 30 * 86400000000
           + case when user_id % 25 = 0 then off // 72 when user_id % 25 = 1 then off // 36 else off * 6 end)
           as transaction_ts,
         timestamp '2025-07-01 00:00:00' as created_at
  from tx_f join nation on event_id % 25 = n_nationkey join region on n_regionkey = r_regionkey
)"""


def layers(as_of: str = "2025-07-01") -> str:
    """Adapter + staging + enriched + dimensions + fact, as CTEs."""
    as_of_sql = f"date '{as_of}'"
    return ADAPTER + f""",
stg as (
  select transaction_id, user_id, merchant_id, merchant_category, payment_method, amount, currency, status,
         is_fraud, device_type, city, state, transaction_ts, created_at as raw_loaded_at,
         cast(transaction_ts as date) as transaction_date,
         cast(hour(transaction_ts) as integer) as tx_hour,
         cast(extract(dow from transaction_ts) as integer) as tx_day_of_week,
         coalesce(hour(transaction_ts) between 1 and 5, false) as is_odd_hour,
         coalesce(amount >= 25000, false) as is_high_amount,
         coalesce(merchant_category in ('Travel', 'Electronics'), false)
           as is_risky_merchant_category
  from transactions
),
neighbours as (
  select me.transaction_id,
         count(*) filter (where epoch_us(me.transaction_ts) - epoch_us(other.transaction_ts) <= 3600000000) as tx_count_1h,
         count(*) as tx_count_24h,
         count(*) filter (where me.merchant_category is not distinct from other.merchant_category) as tx_same_category_24h
  from stg me join stg other
    on me.user_id = other.user_id
   and other.transaction_ts between me.transaction_ts - interval 24 hours and me.transaction_ts
  group by me.transaction_id
),
vel as (select * from stg join neighbours using (transaction_id)),
rules(rule, points, label) as (
  values (1, 20, 'Odd Hour'), (2, 30, 'High Amount'), (3, 25, 'Risky Category'),
         (4, 15, 'Velocity Spike (1h)'), (5, 10, 'Velocity Spike (24h)')
),
bands(low, high, fraud_risk_level) as (
  values (0, 30, 'low'), (30, 50, 'medium'), (50, 70, 'high'), (70, 1000, 'critical')
),
hits as (
  select transaction_id, unnest(range(1, 6)) as rule,
         unnest([is_odd_hour, is_high_amount, is_risky_merchant_category, tx_count_1h >= 5, tx_count_24h >= 15]) as hit
  from vel
),
judged as (
  select transaction_id, cast(coalesce(sum(points) filter (where hit), 0) as integer) as fraud_risk_score,
         string_agg(label, ' | ' order by rule) filter (where hit) as fraud_reason
  from hits join rules using (rule) group by transaction_id
),
enriched as (
  select {sk('transaction_id')} as transaction_sk, vel.*, tx_count_1h >= 5 as is_velocity_spike_1h,
         tx_count_24h >= 15 as is_velocity_spike_24h, fraud_risk_score, fraud_risk_level, fraud_reason
  from vel join judged using (transaction_id) join bands on fraud_risk_score >= low and fraud_risk_score < high
),
dim_users as (
  select {sk('user_id')} as user_sk, *,
         cast({as_of_sql} - registration_date as integer) as days_since_registration
  from users
),
dim_merchants as (
  select {sk('merchant_id')} as merchant_sk, *,
         coalesce(merchant_category in ('Travel', 'Electronics'), false) as is_high_risk_category,
         cast({as_of_sql} - onboarding_date as integer) as days_since_onboarding
  from merchants
),
fct as (
  select e.transaction_sk, e.transaction_id, du.user_sk, dm.merchant_sk, e.merchant_category, e.payment_method,
         e.amount, e.currency, e.status, e.is_fraud, e.fraud_risk_score, e.fraud_risk_level, e.fraud_reason,
         e.device_type, e.city, e.state, e.transaction_ts, e.raw_loaded_at
  from enriched e
  left join dim_users du on e.user_id = du.user_id
  left join dim_merchants dm on e.merchant_id = dm.merchant_id
)"""


def with_layers(body_ctes: str, final: str) -> str:
    """``WITH <layers>[, body_ctes] <final select>``."""
    extra = f",\n{body_ctes.strip().rstrip(',')}" if body_ctes.strip() else ""
    return f"WITH {layers()}{extra}\n{final}"
