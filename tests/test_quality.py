from decimal import Decimal

import seed

from tillwise.operators import quality
from tillwise.schemas import CODE_HISTORY, OPEN_END, SRC_SALES

D = seed.D


def test_row_checks_pass_on_null(spark):
    rows = [(1, 5, "2.00", "10.00"), (2, 0, "2.00", "11.00"), (3, -1, "2.00", "12.01"), (4, None, None, None), (4, 5, "2.00", "8.99")]
    df = spark.createDataFrame([(i, q, p and Decimal(p), t and Decimal(t)) for i, q, p, t in rows],
                               "id int, q int, p decimal(12,2), t decimal(12,2)")
    assert seed.rows_of(quality.check_positive(df, "q"), "id") == [(2,), (3,)]
    assert seed.rows_of(quality.check_total(df, "t", "q", "p"), "id", "diff") == [(2, 11), (3, 14.01), (4, 1.01)]
    assert seed.rows_of(quality.check_not_null(df, ["q", "t"]), "id") == [(4,)]
    assert seed.rows_of(quality.check_unique(df, ["id"])) == [(4, 2)]
    assert seed.rows_of(quality.check_unique(df, ["q"])) == [(5, 2)]
    assert seed.rows_of(quality.check_accepted(df, "q", [5, 0]), "id") == [(3,)]


def test_history_checks(spark):
    h = spark.createDataFrame([
        ("A", "A", D("2026-01-01"), OPEN_END), ("A", "B", D("2026-02-01"), OPEN_END),
        ("C", "C", D("2026-02-01"), D("2026-01-01")), ("E", "E", D("2026-02-01"), D("2026-02-01"))], CODE_HISTORY)
    assert seed.rows_of(quality.check_one_active(h)) == [("A", 2)]
    assert seed.rows_of(quality.check_date_range(h), "store_code") == [("C",)]
    fact = seed.sales(spark, [seed.sale(1, "2026-01-05", "A", "C", "P", 1, 1), seed.sale(2, "2025-12-31", "A", "C", "P", 1, 1)])
    assert seed.rows_of(quality.check_sales_resolve(fact, h), "order_id") == [(2,)]


def test_segments(spark):
    df = spark.createDataFrame([("a", "Loyal"), ("b", None), ("c", "loyal")], "customer_id string, customer_segment string")
    assert seed.rows_of(quality.check_segments(df), "customer_id") == [("b",), ("c",)]


def test_freshness_limits(spark):
    df = spark.createDataFrame([(D("2026-01-01"),)], "partition_time date")
    status = lambda day: quality.freshness(df, "partition_time", D(day)).first()["status"]
    assert [status(d) for d in ("2026-01-08", "2026-01-09", "2026-01-15", "2026-01-16")] == ["pass", "warn", "warn", "error"]
    assert quality.freshness(df.limit(0), "partition_time", D("2026-01-08")).first()["status"] == "error"


def test_outcomes(spark):
    rows = [seed.sale(1, "2026-01-05", "Y", "C", "P", 1, 10), seed.sale(1, "2026-01-05", "Y", None, "P", 0, 10, total=50)]
    out = quality.run_checks({"fact_sales": spark.createDataFrame(rows, SRC_SALES)})
    failed = seed.rows_of(out.filter("not passed"), "check", "column", "violations")
    assert failed == [("not_null", "customer_id", 1), ("positive", "quantity", 1), ("total_consistent", "total_amount", 1), ("unique", "order_id", 1)]
    assert out.count() == 9 + 1 + 3 + 1
    assert {r["table"] for r in out.collect()} == {"fact_sales"}


def test_keys_and_table_rules(spark):
    history = spark.createDataFrame([
        ("A", "A", D("2026-01-01"), OPEN_END), ("A", "B", D("2026-02-01"), OPEN_END), (None, "C", D("2026-01-01"), OPEN_END), (None, "D", D("2026-01-01"), OPEN_END),
        ("C", "C", D("2026-02-01"), D("2026-01-01")), ("A", "E", D("2025-02-01"), D("2026-01-01"))], CODE_HISTORY)
    rated = spark.createDataFrame([("a", "Loyal"), ("b", None), ("b", "loyal")], "customer_id string, customer_segment string")
    fact = seed.sales(spark, [seed.sale(i, day, "A", "C", "P", 1, 1) for i, day in ((1, "2026-01-05"), (2, "2024-12-31"))])
    rules = {"code_history": quality.RULES["code_history"], "sales_by_customer": quality.TableRules(unique=("customer_id",))}
    out = quality.run_checks({"code_history": history, "sales_by_customer": rated, "fact_sales": fact}, rules)
    assert {(r.check, r.column): r.violations for r in out.collect()} == {
        ("not_null", "initial_store_code"): 2, ("not_null", "store_code"): 0, ("not_null", "start_date"): 0, ("not_null", "end_date"): 0,
        ("unique", "customer_id"): 1, ("one_active_version", None): 1, ("date_range", None): 1, ("known_segment", None): 2, ("sales_resolve", None): 1,
    }


def test_one_scan_per_table(spark, tmp_path):
    for name, df in {"fact_sales": seed.sales(spark), "code_history": spark.createDataFrame([("A", "A", D("2026-01-01"), OPEN_END)], CODE_HISTORY)}.items():
        df.write.parquet(str(tmp_path / name))
    out = quality.run_checks({name: spark.read.parquet(str(tmp_path / name)) for name in ("fact_sales", "code_history")})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 + 2  # the sales that fit no version are found by a join of both
