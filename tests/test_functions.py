"""Surrogate key and exact rounding."""

from __future__ import annotations

import hashlib
import random
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st

from remitlens.functions.keys import NULL_TOKEN, surrogate_key
from remitlens.functions.numeric import percent, round_ratio


def _md5(text: str) -> str:
    return hashlib.md5(text.encode()).hexdigest()


def test_surrogate_key_matches_md5_with_null_token(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None)], "x string, y string")
    got = [r.k for r in df.select(surrogate_key("x", "y").alias("k")).collect()]
    assert got == [_md5("a-b"), _md5(f"a-{NULL_TOKEN}")]


def test_surrogate_key_single_field_and_types(spark):
    df = spark.sql("select 'DNL1' as s, 12 as i, date'2024-01-05' as d, cast(1.5 as decimal(12,2)) as m")
    r = df.select(
        surrogate_key("s").alias("k1"),
        surrogate_key("i", "d", "m").alias("k3"),
    ).first()
    assert r.k1 == _md5("DNL1")
    assert r.k3 == _md5("12-2024-01-05-1.50")


def test_surrogate_key_separator_collision_is_kept(spark):
    df = spark.createDataFrame([("a-b", "c"), ("a", "b-c")], "x string, y string")
    keys = {r.k for r in df.select(surrogate_key("x", "y").alias("k")).collect()}
    assert len(keys) == 1


def _expected(p: int, q: int, scale: int, factor: int) -> Decimal | None:
    if q == 0:
        return None
    v = Fraction(factor * p, q)
    sign = -1 if v < 0 else 1
    units = (abs(v) * 10**scale * 2 + 1) // 2  # half away from zero
    return (Decimal(sign * int(units)) / Decimal(10**scale)).quantize(Decimal(1).scaleb(-scale))


@settings(max_examples=6, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.integers(min_value=-(10**15), max_value=10**15),
            st.integers(min_value=-(10**9), max_value=10**12),
        ),
        min_size=1,
        max_size=60,
    ),
    st.sampled_from([(0, 1), (1, 100), (2, 1), (3, 1)]),
)
def test_round_ratio_is_exact(spark, pairs, scale_factor):
    scale, factor = scale_factor
    df = spark.createDataFrame(pairs, "p long, q long")
    got = [r.v for r in df.select(round_ratio("p", "q", scale, factor).alias("v")).collect()]
    assert got == [_expected(p, q, scale, factor) for p, q in pairs]


def test_round_ratio_half_cases_and_decimals(spark):
    df = spark.createDataFrame(
        [(Decimal("4.725"), Decimal("1.000")), (Decimal("1.005"), Decimal("1")), (Decimal("-0.125"), Decimal("1"))],
        "p decimal(12,3), q decimal(12,3)",
    )
    got = [r.v for r in df.select(round_ratio("p", "q", 2).alias("v")).collect()]
    assert got == [Decimal("4.73"), Decimal("1.01"), Decimal("-0.13")]


def test_round_ratio_near_half_with_huge_denominator(spark):
    # p/q sits 1/(2q) below a half unit: plain decimal division at scale 6 would round up
    rnd = random.Random(7)
    rows = []
    for _ in range(50):
        q = rnd.randrange(10**7, 10**11)
        rows.append((q - 1, 2 * q))  # 0.5 - 1/(2q): exact rounding gives 0
    df = spark.createDataFrame(rows, "p long, q long")
    got = [r.v for r in df.select(round_ratio("p", "q", 0).alias("v")).collect()]
    assert got == [_expected(p, q, 0, 1) for p, q in rows] == [Decimal(0)] * len(rows)


def test_percent_type_and_null_guard(spark):
    df = spark.createDataFrame([(1, 3), (2, 0)], "a long, b long")
    out = df.select(percent("a", "b").alias("p"))
    assert out.dtypes == [("p", "decimal(5,1)")]
    assert [r.p for r in out.collect()] == [Decimal("33.3"), None]
    assert Decimal("33.3") == Decimal(100 / 3).quantize(Decimal("0.1"), ROUND_HALF_UP)
