import datetime as dt
import random

import pytest
import seed
from pyspark.sql import functions as F

from tillwise.functions import windows
from tillwise.operators import relational as rel
from tillwise.schemas import CODE_HISTORY, OPEN_END

D = seed.D


@pytest.fixture
def history(spark):
    return spark.createDataFrame(
        [("A", "A", D("2026-01-01"), D("2026-02-01")), ("A", "B", D("2026-02-01"), OPEN_END), ("C", "C", D("2026-01-10"), OPEN_END)],
        CODE_HISTORY,
    )


def test_batches(spark):
    times = [dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 1, 23, 59), dt.datetime(2026, 1, 2)]
    stamped = spark.createDataFrame([(t,) for t in times], "partition_time timestamp_ntz")
    assert rel.upto_batch(stamped, D("2026-01-01")).count() == 2
    assert rel.one_batch(stamped, D("2026-01-02")).count() == 1
    dated = stamped.select(F.to_date("partition_time").alias("partition_time"))
    assert rel.upto_batch(dated, D("2026-01-01")).count() == 2


def test_asof_join_edges(spark, history):
    sales = spark.createDataFrame(
        [(1, "A", D("2026-01-31")), (2, "A", D("2026-02-01")), (3, "B", D("2026-02-01")), (4, "C", D("2026-01-09")),
         (5, "Z", D("2026-01-09")), (6, None, D("2026-01-09"))], "order_id int, store_code string, order_date date")
    joined = rel.asof_version_join(sales, history, "store_code", "order_date")
    assert seed.rows_of(joined, "order_id", "initial_store_code") == [(1, "A"), (2, None), (3, "A"), (4, None), (5, None), (6, None)]
    inner = rel.asof_version_join(sales, history, "store_code", "order_date", how="inner")
    assert seed.rows_of(inner, "order_id") == [(1,), (3,)]
    orphans = rel.asof_version_join(sales, history, "store_code", "order_date", how="left_anti")
    assert seed.rows_of(orphans, "order_id") == [(2,), (4,), (5,), (6,)]


def test_status(history):
    assert rel.store_by_status(history, "active").count() == 2
    assert rel.store_by_status(history, "closed", D("2026-02-02")).count() == 1
    assert rel.store_by_status(history, "closed", D("2026-02-01")).count() == 0  # neither active nor closed yet
    assert rel.store_by_status(history, "other").count() == 3


def test_null_rules(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "k int, v string")
    assert seed.rows_of(rel.not_in(df, "v", ["a"]), "k") == [(3,)]
    target = spark.createDataFrame([("a",), (None,)], "v string")
    assert seed.rows_of(rel.not_in_target(df, target, "v"), "k") == [(2,), (3,)]


def test_first_per_group_ties_and_nulls(spark):
    df = spark.createDataFrame([("g", "y", 5), ("g", "x", 5), ("g", "z", 1), ("h", "a", 1), ("h", "b", None)], "g string, k string, v int")
    for_desc = rel.first_per_group(df, ["g"], [windows.desc("v")], "k")
    assert seed.rows_of(for_desc, "g", "k") == [("g", "x"), ("h", "b")]
    for_asc = rel.least_by(df, ["g"], [F.col("v"), F.col("k")], {"k": F.col("k"), "v": F.col("v")})
    assert seed.rows_of(for_asc) == [("g", "z", 1), ("h", "a", 1)]


def test_top_k_sum_counts_ties(spark):
    df = spark.createDataFrame([("m", v) for v in (9, 8, 7, 7, 1)], "month string, v int")
    assert seed.rows_of(rel.top_k_sum(df, "month", "v", 3, "s")) == [("m", 31)]


def test_merge_and_counts(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    changes = spark.createDataFrame([("c", 2), ("d", 3)], "v string, k int")
    assert seed.rows_of(rel.merge_rows(target, changes, ["k"])) == [(1, "a"), (2, "c"), (3, "d")]
    assert seed.rows_of(rel.row_counts({"t": target, "u": target.limit(0)})) == [("t", 2), ("u", 0)]


def test_month_joins(spark):
    a = spark.createDataFrame([("2026-01", 1), ("2026-02", 2)], "month string, a int")
    b = spark.createDataFrame([("2026-02", 3), ("2026-03", 4)], "month string, b int")
    c = spark.createDataFrame([("2026-03", 5)], "month string, c int")
    assert seed.rows_of(rel.full_join_months([a, b, c])) == [
        ("2026-01", 1, None, None), ("2026-02", 2, 3, None), ("2026-03", None, 4, 5)]
    assert seed.rows_of(rel.join_months([a, b])) == [("2026-02", 2, 3)]


def _versions(spark, rows):
    return spark.createDataFrame(rows, "k string, name string, start_date date, end_date date")


def test_sweep_equals_join(spark):
    rng, day, rows = random.Random(7), dt.date(2019, 11, 1), []
    for k in ("a", "b", None):
        at = day
        for i in range(40):  # some touch, some leave a gap
            until = at + dt.timedelta(days=rng.randint(1, 60))
            rows.append((k, f"{k}{i}", at, until))
            at = until + dt.timedelta(days=rng.choice([0, 0, 5]))
        rows.append((k, f"{k} last", at, dt.date(9999, 12, 31)))
    asked = [(rng.choice(["a", "b", "c", None]), rng.choice([None] + [day + dt.timedelta(days=rng.randint(-30, 1600)) for _ in range(9)]), i) for i in range(500)]
    asked += [("a", r[2], 1000 + i) for i, r in enumerate(rows[:41])] + [("a", r[3], 2000 + i) for i, r in enumerate(rows[:40])]
    fact = spark.createDataFrame(asked, "k string, day date, id int")
    want = rel.asof_version_join(fact, _versions(spark, rows), "k", "day")
    for span in ("year", "month"):
        got = rel.asof_version_sweep(fact, _versions(spark, rows), "k", "day", span=span)
        assert got.columns == ["k", "day", "id", "name"]
        assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))
    none = fact.limit(0)
    assert rel.asof_version_sweep(none, _versions(spark, rows), "k", "day").count() == 0
    assert rel.asof_version_sweep(fact, _versions(spark, rows[:0]), "k", "day").filter(F.col("name").isNull()).count() == len(asked)


def test_sweep_of_very_many_versions(spark):
    start = F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int"))
    versions = spark.range(10_000).select(F.lit("a").alias("k"), F.col("id").alias("version"), start.alias("start_date"), F.date_add(start, 1).alias("end_date"))
    fact = spark.range(20_000).select(F.lit("a").alias("k"), F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") % 10_001).cast("int")).alias("day"), "id")
    swept = rel.asof_version_sweep(fact, versions, "k", "day")
    assert "Join" not in swept._jdf.queryExecution().executedPlan().toString()
    right = F.when(F.col("id") % 10_001 < 10_000, F.col("id") % 10_001)
    assert swept.count() == 20_000 and swept.filter(~F.col("version").eqNullSafe(right)).count() == 0


def test_asof_join_with_columns_of_the_same_name(spark):
    fact = spark.createDataFrame([("a", dt.date(2020, 1, 5), "x", "y")], "k string, day date, _k string, _start_date string")
    versions = _versions(spark, [("a", "one", dt.date(2020, 1, 1), dt.date(2020, 2, 1))])
    assert rel.asof_version_join(fact, versions, "k", "day").collect() == [("a", dt.date(2020, 1, 5), "x", "y", "one")]
