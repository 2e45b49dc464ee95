"""Property tests for the engine-parity building blocks (hypothesis).

Each example is one Spark job over a batch of generated values, compared
against DuckDB (the SQL oracle) or exact decimal arithmetic.
"""

import decimal

import duckdb
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tradelens.functions.numeric import fround
from tradelens.sources.tables import money, money_units

SETTINGS = settings(max_examples=6, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

doubles = st.floats(min_value=-1e9, max_value=1e9, allow_nan=False, allow_infinity=False)


@SETTINGS
@given(st.lists(doubles, min_size=1, max_size=200), st.integers(min_value=0, max_value=6))
def test_fround_matches_sql_round(spark, values, scale):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(fround("x", scale)).collect()]
    con = duckdb.connect()
    want = [con.execute(f"SELECT round(?::DOUBLE, {scale})", [v]).fetchone()[0] for v in values]
    assert got == want


cents = st.integers(min_value=0, max_value=10_000_000)      # price in cents
pcts = st.integers(min_value=0, max_value=10)               # discount in percent


@SETTINGS
@given(st.lists(st.tuples(cents, pcts), min_size=1, max_size=200))
def test_money_units_equal_decimal_money(spark, rows):
    data = [(c / 100.0, p / 100.0) for c, p in rows]
    df = spark.createDataFrame(data, "price double, disc double")
    out = df.select(money(F.col("price"), F.col("disc")).alias("m"),
                    money_units(F.col("price"), F.col("disc")).alias("u")).collect()
    for (c, p), r in zip(rows, out):
        exact = decimal.Decimal(c) / 100 * (1 - decimal.Decimal(p) / 100)
        assert r["m"] == exact.quantize(decimal.Decimal("0.0001"))
        assert r["u"] == c * (100 - p)
