from decimal import Decimal

import pytest
import seed
from pyspark.sql import functions as F

from tillwise.functions import aggregates, calendar, measures, text, windows


def one(spark, col, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(col.alias("r")).first()[0]


def test_cleaning(spark):
    f = lambda fn, v: one(spark, fn(F.col("c")), c=v)
    assert f(text.clean_id, "  y001 ") == "Y001"
    assert f(text.clean_email, " A.B@X.Com ") == "a.b@x.com"
    assert f(text.clean_name, "  o'BRIEN anne-marie ") == "O'Brien Anne-Marie"
    assert f(text.clean_name, "dki  JAKARTA 2nd") == "Dki  Jakarta 2nd"
    assert f(text.clean_name, "éva ŁUKASZ") == "Éva Łukasz"
    assert f(text.clean_name, "   ") is None
    assert one(spark, text.clean_name(F.lit(None).cast("string"))) is None


def test_months(spark):
    f = lambda fn, v: one(spark, fn(F.col("c")), c=v)
    assert f(calendar.month_key, seed.D("2026-01-31")) == "2026-01"
    assert f(calendar.month_start, seed.D("2026-01-31")) == seed.D("2026-01-01")
    assert f(calendar.prev_month_key, "2026-01") == "2025-12"
    assert f(calendar.prev_month_key, "2024-03") == "2024-02"
    assert one(spark, calendar.days_between(F.col("a"), F.col("b")), a=seed.D("2026-03-01"), b=seed.D("2026-02-01")) == 28


def test_ratios_guard_zero_and_null(spark):
    f = lambda a, b, **k: one(spark, measures.ratio(F.col("a"), F.col("b"), **k), a=a, b=b)
    assert f(1, 0) is None
    assert one(spark, measures.ratio(F.lit(None).cast("int"), F.lit(1))) is None
    assert one(spark, measures.growth_pct(F.lit(5), F.lit(None).cast("int"))) is None
    assert one(spark, measures.growth_pct(F.lit(5), F.lit(0))) is None
    assert f(1, 8, scale=2) == Decimal("0.13")  # half up
    assert f(-1, 8, scale=2) == Decimal("-0.13")  # away from zero
    assert f(2, 3, pct=True) == Decimal("66.67")
    assert one(spark, measures.one_minus_ratio(F.lit(1), F.lit(3), 4)) == Decimal("0.6667")


def test_ratios_never_cut_an_operand(spark):
    f = lambda a, b, **k: one(spark, measures.ratio(F.lit(Decimal(a)), F.lit(Decimal(b)), **k))
    assert f("1", "0.004") == Decimal("250.00")
    assert f("1", "0.125", scale=4) == Decimal("8.0000")
    assert f("0.00004", "0.01", scale=6) == Decimal("0.004000")
    assert f("0.0000123", "0.00000007", pct=True) == Decimal("17571.43")
    assert one(spark, measures.growth_pct(F.lit(Decimal("0.0015")), F.lit(Decimal("0.0010")))) == 50
    with pytest.raises(Exception, match="too many digits"):
        f("1", "0.0000000001")
    with pytest.raises(Exception, match="too many digits"):
        one(spark, measures.ratio(F.lit(Decimal("123456789012345678901.25")), F.lit(1)))


def test_mean_rounds_once(spark):
    """The mean is 0.00499999...; rounding it to six digits first would give 0.01."""
    n = 3_000_000
    df = spark.range(n).select(F.when(F.col("id") < n // 2 - 1, "0.01").otherwise("0.00").cast("decimal(12,2)").alias("v"))
    assert df.agg(F.round(F.avg("v"), 2)).first()[0] == Decimal("0.01")
    assert df.agg(measures.mean("v")).first()[0] == Decimal("0.00")


def test_large_amounts(spark):
    big = spark.createDataFrame([(Decimal("99999999999999999.99"),)], "v decimal(22,2)")
    assert big.select(measures.ratio(F.col("v"), F.col("v"), pct=True)).first()[0] == 100


def test_windows(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, None), ("a", 3, 30), ("b", 1, 5)], "k string, o int, v int")
    out = df.select(
        "k", "o", windows.rank_desc(["k"], "v").alias("rank"), windows.prev("v", "o", ["k"]).alias("prev"),
        windows.running_sum("v", "o", ["k"]).alias("sum"), windows.moving_avg("v", "o", 2, keys=["k"]).alias("avg"),
    )
    assert seed.rows_of(out) == [
        ("a", 1, 3, None, 10, 10.0), ("a", 2, 1, 10, 10, 10.0), ("a", 3, 2, None, 40, 30.0), ("b", 1, 1, None, 5, 5.0),
    ]


def test_aggregates(spark):
    df = spark.createDataFrame(
        [("a", 2, "y"), ("a", 1, "x"), ("a", 3, None), ("a", 4, "x"), ("b", 1, None)], "k string, o int, v string"
    )
    out = df.groupBy("k").agg(
        aggregates.ordered_concat("v", "o", ">").alias("path"), aggregates.distinct_concat("v", ",").alias("set"),
        aggregates.count_if_distinct(F.col("o") > 1, F.col("v")).alias("n"),
        aggregates.least_row(F.col("v"), F.col("o"), payload={"o": F.col("o")})["o"].alias("first"),
    )
    assert seed.rows_of(out) == [("a", "x>y>x", "x,y", 2, 1), ("b", None, None, 0, 1)]
