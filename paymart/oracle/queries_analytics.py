"""DuckDB twins of the reporting, KPI, dashboard, EDA, quality and ingestion queries."""

from __future__ import annotations

from paymart.config import (CURRENCIES, DEFAULT as C, DEVICE_TYPES, MERCHANT_CATEGORIES, MERCHANT_ID_PATTERN,
                            PAYMENT_METHODS, RISK_LEVELS, STATUSES, USER_ID_PATTERN)
from paymart.oracle.base import (count_if, in_list, pct, q, round_avg_int, round_avg_money, round_double, safe_ratio,
                                 sk, with_layers)
from paymart.oracle.queries_core import (COHORT_CTE, FRAUD_MART_CTE, MERCHANT_METRICS_CTE, PER_MERCHANT,
                                         SEGMENTS_CTE, VELOCITY_CTE)

SQL: dict[str, str] = {}

HOURLY_CTE = f"""
hft as (
  select tx_hour, merchant_category, payment_method, count(*) as total_transactions,
         {count_if('is_fraud')} as fraud_transactions,
         {pct(count_if('is_fraud'), 'count(*)')} as fraud_rate_pct,
         {round_avg_money('sum(amount)', 'count(amount)')}
           as avg_transaction_amount,
         {round_avg_int('sum(fraud_risk_score)', 'count(fraud_risk_score)')}
           as avg_fraud_risk_score,
         count(distinct user_id) as unique_users,
         {count_if('is_odd_hour')} as odd_hour_transactions
  from enriched group by tx_hour, merchant_category, payment_method
)"""

DAILY_CTE = f"""
dok as (
  select cast(transaction_ts as date) as day, count(*) as total_transactions,
         sum(amount) as total_revenue,
         sum(case when is_fraud then amount else 0 end) as fraud_loss_amount
  from fct group by cast(transaction_ts as date)
)"""


def _reg(name: str, final: str, *ctes: str) -> None:
    SQL[name] = with_layers(",\n".join(c.strip().rstrip(",") for c in ctes if c.strip()), final)


def ratio_of_pct(col: str, pct_digits: int = 2) -> str:
    scale = 10 ** pct_digits
    return f"(case when {col} is not null then cast(round({col} * {scale}) as bigint) / {float(scale * 100)} end)"


def pct_double(num: str, den: str) -> str:
    return f"(cast({num} as double) * 100.0 / nullif(cast({den} as double), 0.0))"


def rate_double(num: str, den: str) -> str:
    return f"(cast({num} as double) / nullif(cast({den} as double), 0.0))"


def money(x: str) -> str:
    return f"cast({x} as double)"


# --------------------------------------------------------------- reporting
_reg("rpt_hourly_fraud_trends", "select * from hft", HOURLY_CTE)
_reg("rpt_merchant_risk_profiling", f"""
select *, {ratio_of_pct('fraud_rate_pct')} as fraud_rate_ratio, {ratio_of_pct('failure_rate_pct')} as failure_rate_ratio
from mrp""", MERCHANT_METRICS_CTE)
_reg("rpt_fraud_customer_segments", "select * from fcs", SEGMENTS_CTE)
_reg("rpt_cohort_analysis", f"""
select *, {ratio_of_pct('retention_1m_pct', 1)} as retention_1m_rate,
          {ratio_of_pct('retention_3m_pct', 1)} as retention_3m_rate,
          {ratio_of_pct('retention_6m_pct', 1)} as retention_6m_rate,
          {ratio_of_pct('fraud_rate_pct')} as fraud_rate_ratio
from coh""", COHORT_CTE)
_reg("rpt_velocity_anomaly_detection", "select * from vad", VELOCITY_CTE)

# --------------------------------------------------------------- KPIs
_reg("kpi_transactions", f"""
select count(*) as total_transactions,
       cast(coalesce(sum(case when status = 'success' then amount end), 0) as double) as gmv,
       cast(coalesce(sum(case when status = 'success' then amount end), 0) as double) as success_gmv,
       {safe_ratio("coalesce(sum(case when status = 'success' then amount end), 0)", 'count(*)')} as avg_ticket,
       {safe_ratio(count_if("status = 'success'"), 'count(*)')} as success_rate,
       {safe_ratio(count_if("status = 'failed'"), 'count(*)')} as failure_rate,
       {safe_ratio("coalesce(sum(case when status = 'success' then amount end), 0)",
                   "coalesce(sum(case when status = 'success' then amount end), 0)")} as capture_rate
from fct""")

MONTHLY_GMV_CTE = """
mg as (
  select date_trunc('month', transaction_ts) as month,
         coalesce(sum(case when status = 'success' then amount end), 0) as gmv, count(*) as transactions
  from fct group by date_trunc('month', transaction_ts)
)"""
_reg("kpi_monthly_mom", f"""
select c.month, cast(c.gmv as double) as gmv, c.transactions, cast(p.gmv as double) as prev_gmv,
       p.transactions as prev_transactions,
       {safe_ratio('c.gmv - p.gmv', 'p.gmv')} as gmv_mom,
       {safe_ratio('c.transactions - p.transactions', 'p.transactions')} as transactions_mom
from mg c left join mg p on p.month + interval 1 month = c.month""", MONTHLY_GMV_CTE)
_reg("kpi_daily_mart", "select cast(sum(total_revenue) as double) as daily_kpi_gmv, "
     "cast(sum(fraud_loss_amount) as double) as daily_kpi_fraud_loss from dok", DAILY_CTE)
_reg("kpi_fraud", f"""
select {count_if('is_fraud')} as fraud_transactions,
       {safe_ratio(count_if('is_fraud'), 'count(*)')} as fraud_rate,
       cast(coalesce(sum(case when is_fraud then amount end), 0) as double) as fraud_loss,
       {safe_ratio('coalesce(sum(case when is_fraud then amount end), 0)',
                   "coalesce(sum(case when status = 'success' then amount end), 0)")} as fraud_loss_rate,
       {count_if("fraud_risk_level in ('high', 'critical')")} as high_risk_transactions,
       {safe_ratio('sum(fraud_risk_score)', 'count(fraud_risk_score)')} as avg_fraud_risk_score
from fct""")
OFF = f"hour(transaction_ts) between {C.odd_hour_start} and {C.odd_hour_end}"
_reg("kpi_off_hours", f"""
select {count_if(OFF)} as off_hours_transactions,
       {count_if(f'({OFF}) and is_fraud')} as off_hours_fraud_transactions,
       {safe_ratio(count_if(f'({OFF}) and is_fraud'), count_if(OFF))} as off_hours_fraud_rate,
       {count_if(f'not ({OFF}) and is_fraud')} as normal_hours_fraud_transactions,
       {safe_ratio(count_if(f'not ({OFF}) and is_fraud'), count_if(f'not ({OFF})'))} as normal_hours_fraud_rate
from fct""")
_reg("kpi_hourly_rate", f"select tx_hour, merchant_category, payment_method, "
     f"{ratio_of_pct('fraud_rate_pct')} as hourly_fraud_rate from hft", HOURLY_CTE)
_reg("kpi_activity", f"""
select count(distinct user_sk) as active_users, count(distinct merchant_sk) as active_merchants,
       {safe_ratio('count(*)', 'count(distinct user_sk)')} as transactions_per_user
from fct""")
_reg("kpi_customers", f"""
select {count_if("fraud_segment in ('Single Fraud', 'Repeat Fraudster')")} as fraud_prone_customers,
       {count_if("monetary_segment = 'High Value'")} as high_monetary_customers,
       {count_if("fraud_segment = 'Repeat Fraudster'")} as repeat_fraudster_count,
       (select {safe_ratio('sum(days_since_registration)', 'count(days_since_registration)')} from dim_users)
         as avg_days_since_registration
from fcs""", SEGMENTS_CTE)
_reg("kpi_weighted_retention", f"""
select {safe_ratio('sum(coalesce(cast(round(retention_1m_pct * 10) as bigint), 0) * mature_1m_cohort_size)',
                   'sum(mature_1m_cohort_size) * 1000')} as weighted_retention_1m
from coh""", COHORT_CTE)
_reg("kpi_gmv_variance", """
select cast(g.gmv as double) as gmv, cast(d.dg as double) as daily_kpi_gmv, cast(g.gmv - d.dg as double) as gmv_variance
from (select coalesce(sum(case when status = 'success' then amount end), 0) as gmv from fct) g,
     (select coalesce(sum(total_revenue), 0) as dg from dok) d""", DAILY_CTE)

# --------------------------------------------------------------- dashboard / top-k
FRAUD_MEASURES = f"""count(*) as transactions, {count_if('is_fraud')} as fraud_transactions,
       cast(coalesce(sum(case when is_fraud then amount end), 0) as double) as fraud_loss"""
_reg("by_risk_level", f"select fraud_risk_level, {FRAUD_MEASURES} from fct group by fraud_risk_level")
_reg("by_fraud_reason", f"select fraud_reason, {FRAUD_MEASURES} from fct group by fraud_reason")
_reg("status_split", f"""
select status, count(*) as transactions, {safe_ratio('count(*)', '(select count(*) from fct)')} as share,
       {safe_ratio('sum(amount)', 'count(amount)')} as avg_ticket
from fct group by status""")
_reg("method_share", f"""
select payment_method, count(*) as transactions, cast(sum(amount) as double) as volume,
       {safe_ratio('sum(amount)', '(select sum(amount) from fct)')} as share_of_volume
from fct group by payment_method""")
for col, name in (("city", "slice_by_city"), ("payment_method", "slice_by_method"),
                  ("merchant_category", "slice_by_category")):
    _reg(name, f"""
select {col}, count(*) as transactions, cast(coalesce(sum(amount), 0) as double) as volume,
       {count_if('is_fraud')} as fraud_transactions,
       cast(coalesce(sum(case when is_fraud then amount end), 0) as double) as fraud_loss,
       {count_if("status = 'success'")} as success_transactions
from fct group by {col}""")
_reg("hour_category_heatmap", f"""
select tx_hour, merchant_category, cast(sum(total_transactions) as bigint) as transactions,
       cast(sum(fraud_transactions) as bigint) as fraud_transactions,
       {safe_ratio('sum(fraud_transactions)', 'sum(total_transactions)')} as fraud_rate
from hft group by tx_hour, merchant_category""", HOURLY_CTE)
_reg("fraud_loss_category_method", f"select merchant_category, payment_method, {FRAUD_MEASURES} from fct "
     "group by merchant_category, payment_method")
_reg("merchant_review_list", f"""
select * from mrp where is_rate_reliable and (merchant_risk_category = 'High Risk'
                                             or fraud_rate_pct > {C.merchant_risk_high_fraud_rate_pct})""",
     MERCHANT_METRICS_CTE)
_reg("alert_action_share", f"""
select count(*) as queue_rows, {count_if('action_required')} as action_rows,
       {safe_ratio(count_if('action_required'), 'count(*)')} as action_share
from vad""", VELOCITY_CTE)
_reg("segment_matrix", """
select fraud_segment, monetary_segment, count(*) as customers, cast(sum(monetary_value) as double) as monetary_value,
       cast(sum(fraud_count) as bigint) as fraud_transactions
from fcs group by fraud_segment, monetary_segment""", SEGMENTS_CTE)
_reg("step_up_candidates", f"""
select transaction_id, user_sk, merchant_sk, merchant_category, payment_method, cast(amount as double) as amount,
       transaction_ts, is_fraud, fraud_risk_score, fraud_risk_level
from fct
where merchant_category in ('Travel', 'Electronics') and amount > 10000
  and hour(transaction_ts) between {C.odd_hour_start} and {C.odd_hour_end}""")
_reg("win_back_list", "select * from fcs where monetary_segment = 'High Value' and recency_segment = 'Lapsed' "
     "and fraud_count = 0", SEGMENTS_CTE)
_reg("monthly_risk_report", f"""
select b.month, b.transactions, b.fraud_transactions, {safe_ratio('b.fraud_transactions', 'b.transactions')} as fraud_rate,
       cast(b.loss as double) as fraud_loss,
       cast(coalesce(k.queue_backlog, 0) as bigint) as queue_backlog,
       cast(coalesce(h.merchants_above_threshold, 0) as bigint) as merchants_above_threshold
from (select date_trunc('month', transaction_ts) as month, count(*) as transactions,
             {count_if('is_fraud')} as fraud_transactions,
             coalesce(sum(case when is_fraud then amount end), 0) as loss
      from fct group by 1) b
left join (select date_trunc('month', transaction_ts) as month, {count_if('action_required')} as queue_backlog
           from vad group by 1) k on k.month = b.month
left join (select month, count(*) as merchants_above_threshold
           from (select date_trunc('month', transaction_ts) as month, merchant_sk, count(*) as n,
                        sum(case when is_fraud then 1 else 0 end) as f
                 from fct where merchant_sk is not null group by 1, 2) pm
           where n >= {C.merchant_risk_min_transactions} and f * 100 > n * {C.merchant_risk_high_fraud_rate_pct}
           group by month) h on h.month = b.month""", VELOCITY_CTE)
_reg("top_reliable_merchants", "select * from mrp where is_rate_reliable "
     "order by fraud_rate_pct desc, merchant_id asc limit 10", MERCHANT_METRICS_CTE)
_reg("top_velocity_users", f"""
select user_id, max(velocity_score) as max_velocity_score, count(*) as queue_rows,
       {count_if('action_required')} as action_rows
from vad group by user_id order by max_velocity_score desc, queue_rows desc, user_id limit 20""", VELOCITY_CTE)
_reg("top_merchants_by_fraud_loss", """
select merchant_name, merchant_category, cast(loss_of_name as double) as fraud_loss_inr
from (select merchant_name, merchant_category, sum(n) as trades, sum(fraud) as frauds, sum(loss) as loss_of_name
      from per_merchant join dim_merchants using (merchant_sk) group by all)
where trades >= 50 and frauds > 0 order by loss_of_name desc, merchant_name, merchant_category limit 10""", PER_MERCHANT)

# --------------------------------------------------------------- EDA
EDA_CTE = """
merged as (
  select f.transaction_id, u.user_id, m.merchant_id, f.merchant_category, f.payment_method, f.amount, f.currency,
         f.status, f.is_fraud, f.device_type, f.city, f.state, f.transaction_ts
  from fct f left join dim_users u on f.user_sk = u.user_sk left join dim_merchants m on f.merchant_sk = m.merchant_sk
),
ep as (
  select transaction_id, user_id, merchant_id, merchant_category, payment_method,
         try_cast(amount as decimal(12,2)) as amount, currency, status, coalesce(is_fraud, false) as is_fraud,
         device_type, city, state, transaction_ts, strftime(transaction_ts, '%Y-%m') as month,
         coalesce(status = 'success', false) as is_success,
         case when coalesce(is_fraud, false) then try_cast(amount as decimal(12,2)) else 0 end as fraud_amount,
         case when coalesce(status = 'success', false) then try_cast(amount as decimal(12,2)) else 0 end
           as success_amount
  from merged
)"""


def _eda(name: str, final: str, *ctes: str) -> None:
    _reg(name, final, EDA_CTE, *ctes)


_eda("eda_prepared", "select * replace (cast(amount as double) as amount, cast(fraud_amount as double) as fraud_amount, "
     "cast(success_amount as double) as success_amount) from ep")
_reg("eda_amount_coercion", f"""
select count(*) as rows,
       {count_if('amount is not null and try_cast(amount as decimal(12,2)) is null')} as coerced_to_null,
       {count_if('amount is null')} as null_amounts
from fct""")
_eda("eda_headline", f"""
select cast(coalesce(sum(amount), 0) as double) as attempt_volume,
       cast(coalesce(sum(success_amount), 0) as double) as success_gmv,
       case when coalesce(sum(amount), 0) > 0 then {rate_double('sum(success_amount)', 'coalesce(sum(amount), 0)')} end
         as capture_rate
from ep""")
_eda("eda_monthly_volume", f"""
select month, cast(sum(amount) as double) as attempt_volume, cast(sum(success_amount) as double) as success_gmv,
       {rate_double(count_if('is_success'), 'count(*)')} as success_rate
from ep group by month""")
_eda("eda_status_mix", " union all ".join(
    f"select {i + 1} as position, {q(s)} as status, "
    f"(select case when count(*) > 0 then count(*) end from ep where status = {q(s)}) as transactions"
    for i, s in enumerate(STATUSES)))
_eda("daily_success_rate_ma7", f"""
select day, pct, {round_double('avg(pct) over (order by day rows between 6 preceding and current row)', 6)} as ma7,
       (select {pct_double(count_if('is_success'), 'count(*)')} from ep) as platform_pct
from (select cast(transaction_ts as date) as day, {pct_double(count_if('is_success'), 'count(*)')} as pct
      from ep group by 1) d""")


def _snake(v: str) -> str:
    return v.lower().replace(" ", "_").replace("&", "and")


_eda("payment_mix_by_month", "select month, " + ", ".join(
    f"{pct_double(count_if(f'payment_method = {q(m)}'), count_if('payment_method in (' + in_list(PAYMENT_METHODS) + ')'))}"
    f" as share_{_snake(m)}" for m in PAYMENT_METHODS) + " from ep group by month")
_eda("success_rate_by_method", f"""
select payment_method, {rate_double(count_if('is_success'), 'count(*)')} as rate, count(*) as n
from ep group by payment_method having count(*) >= 100""")
_eda("fail_decline_by_method", f"""
select payment_method, count(*) as total, {count_if("status in ('failed', 'declined')")} as bad,
       {pct_double(count_if("status in ('failed', 'declined')"), 'count(*)')} as rate
from ep group by payment_method having count(*) >= 100""")
_eda("monthly_atv", f"""
select month, {rate_double('sum(amount)', 'count(amount)')} as attempt_atv,
       {rate_double('sum(case when success_amount > 0 then success_amount end)', count_if('success_amount > 0'))}
         as success_atv
from ep group by month""")
_eda("monthly_fraud_rate", f"""
select month, {pct_double(count_if('is_fraud'), 'count(*)')} as fraud_rate_pct,
       (select {pct_double(count_if('is_fraud'), 'count(*)')} from ep) as platform_fraud_rate_pct
from ep group by month""")
_eda("monthly_fraud_loss", "select month, cast(sum(fraud_amount) as double) as fraud_loss_inr from ep group by month")
_eda("fraud_matrix_category_method", "select merchant_category, " + ", ".join(
    f"max(case when payment_method = {q(m)} then pct end) as fraud_pct_{_snake(m)}" for m in PAYMENT_METHODS)
    + f""" from (select merchant_category, payment_method, {pct_double(count_if('is_fraud'), 'count(*)')} as pct
              from ep group by merchant_category, payment_method) c group by merchant_category""")

AMOUNT_BUCKETS = ((0, "<₹1K"), (1000, "₹1–5K"), (5000, "₹5–10K"), (10000, "₹10–25K"),
                  (25000, "₹25–50K"), (50000, "₹50K+"))
_bucket_label = "case " + " ".join(f"when amount >= {lo} then {q(n)}" for lo, n in reversed(AMOUNT_BUCKETS)) + " end"
_bucket_order = "case " + " ".join(f"when amount >= {lo} then {i}" for i, (lo, _) in reversed(list(enumerate(AMOUNT_BUCKETS)))) + " end"
_eda("fraud_by_amount_bucket", f"""
select amount_bucket, bucket_order, txns, fraud_txns, cast(loss as double) as fraud_loss,
       {pct_double('fraud_txns', 'txns')} as fraud_rate, loss > 0 as has_loss
from (select {_bucket_label} as amount_bucket, {_bucket_order} as bucket_order, count(transaction_id) as txns,
             {count_if('is_fraud')} as fraud_txns, sum(fraud_amount) as loss
      from ep where amount >= 0 group by 1, 2) b""")
DAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
_eda("fraud_matrix_dow_hour", "select dow, case dow " + " ".join(f"when {q(d)} then {i + 1}" for i, d in enumerate(DAYS))
     + " end as dow_order, " + ", ".join(f"max(case when hour = {h} then pct end) as h{h:02d}" for h in range(24))
     + f""" from (select dayname(transaction_ts) as dow, hour(transaction_ts) as hour,
                  {pct_double(count_if('is_fraud'), 'count(*)')} as pct
           from ep group by 1, 2) c group by dow""")


def _half_even_pct(num: str, den: str) -> str:
    n, d = f"(cast({num} as bigint) * 100)", f"cast({den} as bigint)"
    qq, r = f"({n} // {d})", f"({n} % {d})"
    return (f"cast({qq} + case when {r} * 2 > {d} or ({r} * 2 = {d} and {qq} % 2 = 1) then 1 else 0 end as double)")


_eda("eda_cohort_matrix", "select strftime(cohort, '%Y-%m') as cohort, " + ", ".join(
    f"{_half_even_pct(f'count(distinct case when off = {k} then user_id end)', 'count(distinct case when off = 0 then user_id end)')} as m{k}"
    for k in range(6)) + """
from (select user_id, cohort, (year(activity) - year(cohort)) * 12 + (month(activity) - month(cohort)) as off
      from (select user_id, date_trunc('month', transaction_ts) as activity,
                   min(date_trunc('month', transaction_ts)) over (partition by user_id) as cohort
            from ep where user_id is not null) a) o
where off between 0 and 5 group by cohort""")
_eda("fraud_loss_tertiles", f"""
select segment, case segment when 'Low repeat' then 1 when 'Medium repeat' then 2 else 3 end as segment_order,
       count(*) as users, {rate_double('sum(fraud_txns)', 'count(*)')} as fraud_txns,
       cast(sum(fraud_loss) as double) as fraud_loss,
       case when (select sum(fraud_loss) from pu) > 0
            then {pct_double('sum(fraud_loss)', '(select sum(fraud_loss) from pu)')} else 0.0 end as loss_share_pct
from (select *, case when fraud_txns <= (select c[1] from cuts) then 'Low repeat'
                     when fraud_txns <= (select c[2] from cuts) then 'Medium repeat' else 'High repeat' end as segment
      from pu) s
group by segment""", """
pu as (select user_id, {fc} as fraud_txns, sum(fraud_amount) as fraud_loss from ep where user_id is not null
       group by user_id),
cuts as (select quantile_cont(fraud_txns, [{a}, {b}]) as c from pu)""".format(
    fc=count_if('is_fraud'), a=repr(1.0 / 3), b=repr(2.0 / 3)))
_reg("risk_calibration", f"""
select bucket, bucket_order, {rate_double('f', 'txns')} as observed_fraud_rate, txns
from (select case when fraud_risk_score between 0 and 30 then 'Low' when fraud_risk_score between 0 and 50 then 'Med'
                  when fraud_risk_score between 0 and 70 then 'High' when fraud_risk_score between 0 and 100 then 'Critical'
             end as bucket,
             case when fraud_risk_score between 0 and 30 then 1 when fraud_risk_score between 0 and 50 then 2
                  when fraud_risk_score between 0 and 70 then 3 when fraud_risk_score between 0 and 100 then 4 end
               as bucket_order,
             count(*) as txns, {count_if('is_fraud')} as f
      from enriched where fraud_risk_score between 0 and 100 group by 1, 2) b""")
_reg("merchant_scatter", f"""
select merchant_id, cast(coalesce(volume, 0) as double) as total_volume, n as total_transactions,
       {pct('fraud', 'n')} as fraud_rate_pct,
       ['High Risk', 'Medium Risk', 'Low Risk'][list_position(
         [fraud * 100 >= 5 * n or score >= 60 * n_score, fraud * 100 >= 2 * n or score >= 40 * n_score, true], true)]
         as merchant_risk_category
from per_merchant join dim_merchants using (merchant_sk) where n >= 50""", PER_MERCHANT)
_FLAG = f"(tx_count_1h >= {C.fraud_velocity_threshold_1h} or tx_count_24h >= {C.fraud_velocity_threshold_24h})"
_reg("velocity_uplift", f"""
select base as baseline_fraud_pct, vel as flagged_fraud_pct, vn as flagged_rows,
       case when base > 0 then vel / base end as uplift
from (select {pct_double(count_if('is_fraud'), 'count(*)')} as base,
             {pct_double(count_if(f'{_FLAG} and is_fraud'), count_if(_FLAG))} as vel,
             {count_if(_FLAG)} as vn
      from enriched) a""")
_eda("data_sanity", f"""
select count(*) as rows, min(transaction_ts) as min_ts, max(transaction_ts) as max_ts,
       {rate_double(count_if('is_success'), 'count(*)')} as success_rate,
       {rate_double(count_if('is_fraud'), 'count(*)')} as fraud_rate,
       cast(coalesce(sum(case when is_fraud then amount end), 0) as double) as fraud_loss
from ep""")

# --------------------------------------------------------------- data quality
NOT_NULL = {
    "raw.transactions": ("transactions", ("transaction_id", "user_id", "merchant_id", "merchant_category",
                                          "payment_method", "amount", "currency", "status", "is_fraud", "device_type",
                                          "transaction_ts")),
    "raw.users": ("users", ("user_id", "age_group", "account_type")),
    "raw.merchants": ("merchants", ("merchant_id", "merchant_name", "merchant_category")),
    "stg_transactions": ("stg", ("transaction_id", "user_id", "merchant_id", "merchant_category", "payment_method",
                                 "amount", "currency", "status", "is_fraud", "transaction_ts", "transaction_date")),
    "int_transactions_enriched": ("enriched", ("transaction_sk", "transaction_id", "tx_count_1h", "tx_count_24h")),
    "int_user_metrics": ("um", ("user_sk", "user_id", "total_transactions", "avg_transaction_amount", "total_spend",
                                "fraud_count", "first_transaction_date", "last_transaction_date",
                                "unique_categories_used", "unique_merchants_used", "odd_hour_tx_count")),
}
USER_METRICS_CTE = f"""
um as (
  select {sk('user_id')} as user_sk, user_id,
         count(*) as total_transactions,
         {round_avg_money('sum(amount)', 'count(amount)')}
           as avg_transaction_amount,
         sum(amount) as total_spend, {count_if('is_fraud')} as fraud_count,
         min(transaction_ts) as first_transaction_date, max(transaction_ts) as last_transaction_date,
         count(distinct merchant_category) as unique_categories_used, count(distinct merchant_id) as unique_merchants_used,
         {count_if('is_odd_hour')} as odd_hour_tx_count
  from enriched group by user_id
)"""


def _checks(model: str, table: str, checks: list[tuple[str, str]], value: str = "failing_rows") -> str:
    return " union all ".join(
        f"select {q(model)} as model, {q(col)} as column_name, cast(({expr}) as bigint) as {value} from {table}"
        for col, expr in checks)


_reg("dq_not_null", " union all ".join(
    _checks(m, t, [(c, count_if(f"{c} is null")) for c in cols]) for m, (t, cols) in NOT_NULL.items()),
    USER_METRICS_CTE)
_reg("dq_null_keys", f"select {count_if('transaction_id is null or user_id is null or merchant_id is null or transaction_ts is null')} as null_key_rows from transactions")
UNIQUE = (("raw.transactions", "transactions", "transaction_id"), ("raw.users", "users", "user_id"),
          ("raw.merchants", "merchants", "merchant_id"), ("stg_transactions", "stg", "transaction_id"),
          ("int_transactions_enriched", "enriched", "transaction_sk"),
          ("int_transactions_enriched", "enriched", "transaction_id"),
          ("int_user_metrics", "um", "user_sk"), ("int_user_metrics", "um", "user_id"))
_reg("dq_unique", " union all ".join(
    f"select {q(m)} as model, {q(c)} as column_name, count(*) as duplicate_keys, "
    f"cast(coalesce(sum(n), 0) as bigint) as duplicate_rows "
    f"from (select {c}, count(*) as n from {t} where {c} is not null group by {c} having count(*) > 1) d"
    for m, t, c in UNIQUE), USER_METRICS_CTE)


def _vals(vals) -> str:
    return ", ".join("true" if v is True else "false" if v is False else q(v) for v in vals)


ACCEPTED = (
    ("raw.transactions", "transactions", {"merchant_category": MERCHANT_CATEGORIES, "payment_method": PAYMENT_METHODS,
                                          "currency": CURRENCIES, "status": STATUSES, "is_fraud": (True, False),
                                          "device_type": DEVICE_TYPES}),
    ("stg_transactions", "stg", {"is_odd_hour": (True, False), "is_high_amount": (True, False),
                                 "is_risky_merchant_category": (True, False)}),
    ("int_transactions_enriched", "enriched", {"fraud_risk_level": RISK_LEVELS, "is_velocity_spike_1h": (True, False),
                                               "is_velocity_spike_24h": (True, False)}),
)
_reg("dq_accepted_values", " union all ".join(
    _checks(m, t, [(c, count_if(f"not ({c} in ({_vals(v)}))")) for c, v in spec.items()]) for m, t, spec in ACCEPTED))
_reg("dq_accepted_range", " union all ".join([
    _checks("stg_transactions", "stg", [("tx_hour", count_if("not (tx_hour between 0 and 23)")),
                                        ("tx_day_of_week", count_if("not (tx_day_of_week between 0 and 6)"))]),
    _checks("int_transactions_enriched", "enriched",
            [("fraud_risk_score", count_if("not (fraud_risk_score between 0 and 100)"))])]))
_reg("dq_score_range", "select transaction_id, fraud_risk_score from enriched "
     "where fraud_risk_score < 0 or fraud_risk_score > 100")
_reg("dq_orphans", """
select (select count(*) from transactions t where not exists (select 1 from users u where u.user_id = t.user_id))
         as orphan_users,
       (select count(*) from transactions t
        where not exists (select 1 from merchants m where m.merchant_id = t.merchant_id)) as orphan_merchants""")
_reg("dq_row_counts", " union all ".join(f"select {q(t)} as table_name, count(*) as row_count from {t}"
                                         for t in ("users", "merchants", "transactions")))
_reg("dq_key_format", " union all ".join([
    _checks("raw.users", "users", [("user_id", count_if(f"not regexp_full_match(user_id, {q(USER_ID_PATTERN)})"))]),
    _checks("raw.merchants", "merchants",
            [("merchant_id", count_if(f"not regexp_full_match(merchant_id, {q(MERCHANT_ID_PATTERN)})"))])]))
_LO = C.target_fraud_rate_pct - C.target_fraud_tolerance_pct
_HI = C.target_fraud_rate_pct + C.target_fraud_tolerance_pct
_reg("dq_fraud_rate", f"""
select r as fraud_rate_pct, cast({_LO} as double) as lower_pct, cast({_HI} as double) as upper_pct, coalesce(r between {_LO} and {_HI}, false) as passed
from (select {pct_double(count_if('is_fraud'), 'count(is_fraud)')} as r from transactions) a""")
_reg("dq_status", f"select distinct status from transactions where status not in ({in_list(STATUSES)}) "
     "or status is null")

# --------------------------------------------------------------- ingestion scenario
FIRST = "transactions where transaction_ts < timestamp '2024-07-01 00:00:00'"
STATE_CTE = f"""
st as (select 'raw.transactions' as table_name, max(transaction_ts) as last_loaded_ts,
              count(*) as rows_loaded, timestamp '2025-07-01 00:00:00' as updated_at
       from {FIRST})"""
_reg("watermark_row", "select * from st", STATE_CTE)
_reg("incremental_filter", "select * replace (cast(amount as double) as amount) from transactions "
     "where transaction_ts > (select last_loaded_ts from st)", STATE_CTE)
_reg("insert_if_absent", f"""
select * replace (cast(amount as double) as amount) from {FIRST}
union all
select * replace (cast(amount as double) as amount, timestamp '2025-08-01 00:00:00' as created_at)
from transactions b
where b.transaction_ts >= timestamp '2024-06-01 00:00:00'
  and not exists (select 1 from {FIRST.replace('transactions where', 'transactions t where')}
                  and t.transaction_id = b.transaction_id)""")
_reg("upsert_dim", """
select user_id, age_group, account_type, registration_date,
       case when registration_date >= date '2025-01-01' then state else city end as city, state
from users""")
_reg("dq_watermark", """
select count(*) = 1 as row_exists, max(last_loaded_ts) as last_loaded_ts, max(rows_loaded) as rows_loaded,
       (select max(transaction_ts) from transactions where transaction_ts < timestamp '2024-07-01 00:00:00')
         as max_transaction_ts,
       (select count(*) from transactions where transaction_ts < timestamp '2024-07-01 00:00:00') as table_rows,
       coalesce(max(rows_loaded) = (select count(*) from transactions
                                    where transaction_ts < timestamp '2024-07-01 00:00:00'), false) as rows_match,
       coalesce(max(last_loaded_ts) = (select max(transaction_ts) from transactions
                                       where transaction_ts < timestamp '2024-07-01 00:00:00'), false)
         as mark_matches_max
from st where table_name = 'raw.transactions'""", STATE_CTE)

# --------------------------------------------------------------- export
_reg("export_velocity", "select * replace (strftime(transaction_ts, '%Y-%m-%d %H:%M:%S') as transaction_ts) from vad",
     VELOCITY_CTE)
_reg("export_cohort", f"""
select * replace (strftime(cohort_month, '%Y-%m-%d') as cohort_month),
       {ratio_of_pct('retention_1m_pct', 1)} as retention_1m_rate,
       {ratio_of_pct('retention_3m_pct', 1)} as retention_3m_rate,
       {ratio_of_pct('retention_6m_pct', 1)} as retention_6m_rate,
       {ratio_of_pct('fraud_rate_pct')} as fraud_rate_ratio
from coh""", COHORT_CTE)
_reg("export_segments", "select * from fcs", SEGMENTS_CTE)
_reg("export_hourly", "select * from hft", HOURLY_CTE)
_reg("export_merchant", f"""
select *, {ratio_of_pct('fraud_rate_pct')} as fraud_rate_ratio, {ratio_of_pct('failure_rate_pct')} as failure_rate_ratio
from mrp""", MERCHANT_METRICS_CTE)
_reg("export_daily_kpis", f"""
select cast(transaction_ts as date) as day, count(*) as total_transactions,
       count(distinct user_sk) as active_users, count(distinct merchant_sk) as active_merchants,
       cast(sum(amount) as double) as total_revenue,
       cast(sum(amount) as double) / nullif(count(amount), 0) as avg_transaction_value,
       {count_if('is_fraud')} as fraud_count,
       cast(sum(case when is_fraud then amount else 0 end) as double) as fraud_loss_amount,
       {count_if("status = 'failed'")} as failed_transactions
from fct group by cast(transaction_ts as date)""")
_reg("export_dim_users", "select * from dim_users")
_reg("export_fraud_mart", "select * replace (strftime(transaction_ts, '%Y-%m-%d %H:%M:%S') as transaction_ts) from fam",
     FRAUD_MART_CTE)

# --------------------------------------------------------------- replayed deliveries
REPLAY_CTE = """
numbered as (select *, cast(substr(transaction_id, 5, 10) as bigint) as number from transactions),
delivered as (
  select 1 as delivery, * replace (transaction_ts as transaction_ts) from numbered where transaction_ts < timestamp '2024-05-01'
  union all
  select 2, * replace (case when number % 97 <> 0 then merchant_id end as merchant_id,
                       case when number % 89 = 0 then 'USR_99999999' else user_id end as user_id)
  from numbered where transaction_ts >= timestamp '2024-04-01' and transaction_ts < timestamp '2024-09-01'
  union all
  select 3, * from numbered where transaction_ts >= timestamp '2024-09-01'
  union all
  select 3, * replace ('disputed' as status, transaction_ts + interval 1 year as transaction_ts)
  from numbered where transaction_ts >= timestamp '2024-05-01' and transaction_ts < timestamp '2024-09-01' and number % 53 = 0
),
checked as (
  select *, nullif(concat_ws(', ', case when merchant_id is null then 'merchant_id is null' end,
                             case when user_id = 'USR_99999999' then 'unknown user_id' end), '') as reject_reason
  from delivered
),
marks as (
  select d.delivery, (select max(c.transaction_ts) from checked c
                      where c.delivery < d.delivery and c.reject_reason is null) as mark
  from (values (1), (2), (3)) d(delivery)
),
fresh as (
  select c.* from checked c join marks using (delivery)
  where reject_reason is null and (mark is null or transaction_ts > mark)
),
stored as (
  select * exclude (place) from (
    select *, row_number() over (partition by transaction_id order by delivery, transaction_ts) as place from fresh)
  where place = 1
),
report as (
  select delivery, count(*) as rows_in_file, count(*) filter (where reject_reason is null and (mark is null or transaction_ts > mark)) as rows_after_mark,
         count(*) filter (where reject_reason is null and transaction_ts <= mark) as rows_skipped_late,
         count(*) filter (where reject_reason is not null) as rows_rejected
  from checked join marks using (delivery) group by delivery
)"""
_reg("replay_loads", "select * from report", REPLAY_CTE)
_reg("replay_rejected", "select reject_reason, count(*) as rows from checked where reject_reason is not null group by reject_reason", REPLAY_CTE)
_reg("replay_transactions", "select * exclude (delivery, number, reject_reason) replace (cast(amount as double) as amount) from stored", REPLAY_CTE)
_reg("dq_row_counts_replay", """
select 'users' as table_name, (select count(*) from users) as row_count, true as matches_expected
union all select 'merchants', (select count(*) from merchants), true
union all select 'transactions', (select count(*) from stored), (select count(*) from stored) = (select count(*) from transactions)""", REPLAY_CTE)
_reg("dq_watermark_replay", """
select true as row_exists, mark as last_loaded_ts, last_rows as rows_loaded, newest as max_transaction_ts, n as table_rows,
       last_rows = n as rows_match, mark = newest as mark_matches_max
from (select (select max(transaction_ts) from stored) as newest, (select max(transaction_ts) from fresh) as mark, (select count(*) from stored) as n,
             (select rows_after_mark from report where delivery = 3) as last_rows)""", REPLAY_CTE)

# --------------------------------------------------------------- text source
TEXT_CTE = """
spoilt as (
  select transaction_id, cast(substr(transaction_id, 5, 10) as bigint) as number, cast(amount as varchar) as amount,
         cast(is_fraud as varchar) as is_fraud, transaction_ts from transactions
),
texts as (
  select transaction_id, number % 109 = 0 as bad_time, number % 113 = 0 as bad_flag,
         ' ' || case when number % 107 = 0 then ' ' when number % 103 = 0 then '12,50' when number % 101 = 0 then 'n/a' else amount end as amount,
         case when number % 113 = 0 then 'maybe' else is_fraud end as is_fraud,
         case when number % 109 <> 0 then transaction_ts end as transaction_ts
  from spoilt
),
parsed as (
  select transaction_id, try_cast(trim(amount) as decimal(12, 2)) as amount, amount as amount_text, try_cast(is_fraud as boolean) as is_fraud,
         transaction_ts, trim(amount) <> '' and try_cast(trim(amount) as decimal(12, 2)) is null as bad_amount, bad_time, bad_flag
  from texts
)"""
_reg("text_amounts", """
select transaction_id, cast(amount as double) as amount, is_fraud, transaction_ts,
       concat_ws('; ', case when bad_amount then 'amount=' || amount_text end, case when bad_flag then 'is_fraud=maybe' end,
                 case when bad_time then 'transaction_ts=yesterday' end) as rejected
from parsed""", TEXT_CTE)
_reg("text_rejected_counts", """
select 'amount' as "column", count(*) as rejected, min(amount_text) as example from parsed where bad_amount having count(*) > 0
union all select 'is_fraud', count(*), 'maybe' from parsed where bad_flag having count(*) > 0
union all select 'transaction_ts', count(*), 'yesterday' from parsed where bad_time having count(*) > 0""", TEXT_CTE)
_reg("text_amount_coercion", """
select count(*) as rows, count(*) filter (where amount is null) as coerced_to_null, cast(0 as bigint) as null_amounts from parsed""", TEXT_CTE)
