"""Column functions on hand-built rows (scoring, flags, rounding, keys)."""

import datetime as dt
import hashlib
from decimal import Decimal
from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paymart.config import DEFAULT
from paymart.functions import rounding as R
from paymart.functions import scoring
from paymart.operators.staging import stage_transactions
from paymart.sources import schemas


def tx_rows(spark, rows):
    base = dict(transaction_id="T", user_id="U", merchant_id="M", merchant_category="Retail", payment_method="UPI",
                amount=Decimal("10.00"), currency="INR", status="success", is_fraud=False, device_type="mobile",
                city=None, state=None, transaction_ts=dt.datetime(2024, 1, 2, 12), created_at=None)
    data = [tuple({**base, **r}[f.name] for f in schemas.TRANSACTIONS) for r in rows]
    return spark.createDataFrame(data, schemas.TRANSACTIONS)


def test_hour_edges_and_sunday(spark):
    ts = [dt.datetime(2024, 1, 7, 0, 59, 59), dt.datetime(2024, 1, 7, 1), dt.datetime(2024, 1, 7, 5, 59, 59),
          dt.datetime(2024, 1, 7, 6)]
    df = stage_transactions(tx_rows(spark, [dict(transaction_id=str(i), transaction_ts=t) for i, t in enumerate(ts)]))
    got = {r.transaction_id: (r.is_odd_hour, r.tx_day_of_week) for r in df.collect()}
    assert got == {"0": (False, 0), "1": (True, 0), "2": (True, 0), "3": (False, 0)}


def test_amount_edges_and_null_flags(spark):
    amts = ["24999.99", "25000.00", "30000.00", "30000.01"]
    rows = [dict(transaction_id=a, amount=Decimal(a)) for a in amts]
    rows.append(dict(transaction_id="null", amount=None, merchant_category=None, is_fraud=None))
    df = stage_transactions(tx_rows(spark, rows))
    got = {r.transaction_id: (r.is_high_amount, r.is_risky_merchant_category) for r in df.collect()}
    assert got["24999.99"] == (False, False) and got["25000.00"] == (True, False)
    assert got["null"] == (False, False)


def test_reason_is_null_without_flags(spark):
    df = spark.createDataFrame([(False, False, False, False, False), (True, False, True, False, True)],
                               "is_odd_hour boolean, is_high_amount boolean, is_risky_merchant_category boolean, "
                               "is_velocity_spike_1h boolean, is_velocity_spike_24h boolean")
    out = df.select(scoring.fraud_reason().alias("r"), scoring.fraud_risk_score().alias("s")).collect()
    assert out[0].r is None and out[0].s == 0
    assert out[1].r == "Odd Hour | Risky Category | Velocity Spike (24h)" and out[1].s == 55


def test_risk_levels(spark):
    df = spark.createDataFrame([(s,) for s in (0, 29, 30, 49, 50, 69, 70, 100)], "s int")
    got = [r.l for r in df.select(scoring.risk_level("s").alias("l")).collect()]
    assert got == ["low", "low", "medium", "medium", "high", "high", "critical", "critical"]


def test_surrogate_key_matches_md5(spark):
    df = spark.createDataFrame([("USR_00000001",), (None,)], "k string")
    got = [r.sk for r in df.select(scoring.surrogate_key("k").alias("sk")).collect()]
    assert got[0] == hashlib.md5(b"USR_00000001").hexdigest()
    assert got[1] == hashlib.md5(scoring.SURROGATE_NULL_TOKEN.encode()).hexdigest()


def _half_away(fr: Fraction, digits: int) -> float:
    scaled = fr * 10 ** digits
    q = int(abs(scaled) + Fraction(1, 2))
    return (q if scaled >= 0 else -q) / 10 ** digits


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10 ** 6), st.integers(1, 10 ** 6)), min_size=1, max_size=40))
def test_pct_is_exact_half_away(spark, pairs):
    df = spark.createDataFrame(pairs, "n long, d long")
    got = [r.p for r in df.select(R.pct(F.col("n"), F.col("d")).alias("p")).collect()]
    assert got == [_half_away(Fraction(n * 100, d), 2) for n, d in pairs]


def test_round_avg_money_ties(spark):
    # 1.005 is a tie on exact decimals: half away from zero gives 1.01
    df = spark.createDataFrame([(Decimal("2.01"), 2), (Decimal("-2.01"), 2), (Decimal("0.00"), 0)],
                               "s decimal(22,2), n long")
    got = [r.a for r in df.select(R.round_avg_money(F.col("s"), F.col("n")).alias("a")).collect()]
    assert got == [1.01, -1.01, None]
