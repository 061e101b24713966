"""Physical plans, and results under skew when nothing can be broadcast."""

import pytest
import seed
from pyspark.sql import functions as F

from tillwise.operators import customer_marts, kpis, quality, relational, sales_marts, store_marts
from tillwise.schemas import CODE_HISTORY, OPEN_END

D = seed.D


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """60,000 sales, a third of them at one store, to one customer, of one product, in one month."""
    path = str(tmp_path_factory.mktemp("skewed") / "fact")
    i, hot = F.col("id"), F.col("id") % 3 == 0
    pick = lambda prefix, n: F.concat(F.lit(prefix), F.when(hot, 0).otherwise(F.pmod(F.hash("id", F.lit(prefix)), F.lit(n))).cast("string"))
    day = F.when(hot, F.lit(D("2026-03-15"))).otherwise(F.date_add(F.lit(D("2026-01-01")), F.pmod(F.hash("id"), F.lit(180))))
    spark.range(60_000).select(
        (i / 2).cast("bigint").alias("order_id"), day.alias("order_date"), pick("S", 50).alias("store_code"),
        pick("C", 500).alias("customer_id"), pick("P", 80).alias("product_id"), (i % 5 + 1).cast("int").alias("quantity"),
        F.lit(10).cast("decimal(12,2)").alias("unit_price"), ((i % 5 + 1) * 10).cast("decimal(12,2)").alias("total_amount"),
        F.trunc(day, "MM").alias("partition_time"),
    ).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def history(spark):
    rows = [(f"S{i}", f"S{i}", D("2026-01-01"), D("2026-04-01")) for i in range(50)]
    rows += [(f"S{i}", f"S{i}", D("2026-04-01"), OPEN_END) for i in range(50)]
    return spark.createDataFrame(rows, CODE_HISTORY)


@pytest.fixture
def no_broadcast(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "5KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.files.maxPartitionBytes": "64KB", "spark.sql.files.openCostInBytes": "1KB",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


BUILDS = {
    "performance": lambda f, h: store_marts.store_performance(f, h),
    "directory": lambda f, h: store_marts.store_directory(f, h),
    "customers": lambda f, h: customer_marts.sales_by_customer(f, D("2026-10-01")),
    "products": lambda f, h: sales_marts.sales_by_product(f),
    "store_months": lambda f, h: store_marts.store_months(f, h),
    "product_months": lambda f, h: sales_marts.product_months(f),
    "retention": lambda f, h: kpis.kpi_customer_retention(f),
    "orders": lambda f, h: kpis.kpi_orders(f),
    "orphans": lambda f, h: quality.check_sales_resolve(f, h),
}


@pytest.mark.parametrize("name", BUILDS)
def test_same_result_without_broadcast(spark, skewed, history, name, request):
    want = seed.rows_of(BUILDS[name](skewed, history))
    request.getfixturevalue("no_broadcast")
    df = BUILDS[name](skewed, history)
    assert "BroadcastHashJoin" not in plan(df)
    assert seed.rows_of(df) == want


def test_hot_store_is_split(spark, skewed, history, no_broadcast):
    joined = relational.asof_version_join(skewed.select("store_code", "order_date", "order_id"), history, "store_code", "order_date")
    joined = joined.groupBy("initial_store_code").agg(F.count(F.lit(1)), F.sum("order_id"))
    joined.collect()
    assert "SortMergeJoin(skew=true)" in plan(joined)


@pytest.mark.parametrize("name", [*BUILDS])
def test_no_cartesian_and_no_single_task_over_sales(skewed, history, name):
    text = plan(BUILDS[name](skewed, history))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    single = text.find("Exchange SinglePartition")
    # whatever runs in one task reads rows that were aggregated before
    assert single < 0 or "HashAggregate" in text[single:]


def test_scan_reads_only_what_it_needs(skewed):
    text = plan(kpis.kpi_customer_retention(relational.upto_batch(skewed, D("2026-02-01"))))
    assert "ReadSchema: struct<order_date:date,customer_id:string,partition_time:date>" in text
    assert "PushedFilters: [IsNotNull(partition_time), IsNotNull(customer_id), LessThan(partition_time,2026-02-02)]" in text or "LessThan(partition_time,2026-02-02)" in text


def test_groups_are_cut_down_before_the_shuffle(skewed):
    first = plan(relational.first_per_group(skewed, ["customer_id"], [F.col("order_date")], "order_id"))
    assert first.index("WindowGroupLimit", first.index("Exchange")) > 0  # below the exchange too
    assert plan(relational.top_k_sum(skewed, "store_code", "total_amount", 3, "s")).count("WindowGroupLimit") == 2
    assert "TakeOrderedAndProject" in plan(relational.top_k(skewed, [F.col("order_id")], 5))
    month = plan(kpis.kpi_product(sales_marts.product_months(skewed)))
    assert "rank(" not in month


def test_sales_are_not_copied_or_joined_to_themselves(skewed):
    for df in (kpis.kpi_orders(skewed), sales_marts.sales_summary(skewed), sales_marts.product_months(skewed)):
        assert "Expand" not in plan(df) and "Join" not in plan(df)
    assert plan(kpis.kpi_customer_retention(skewed)).count("FileScan") == 1
    assert plan(kpis.kpi_revenue(skewed, unique_orders=True)).count("FileScan") == 1


def test_distinct_counts_read_narrow_columns(skewed):
    text = plan(kpis.kpi_orders(skewed, unique_orders=True))
    read = {frozenset(f.split(":")[0] for f in part.split(">")[0].split(",")) for part in text.split("ReadSchema: struct<")[1:]}
    assert {frozenset(("order_date", c)) for c in ("customer_id", "store_code", "product_id")} <= read


def test_distinct_aggregation(spark):
    rows = [("a", 1, "x", 2), ("a", 1, None, 3), ("a", 2, None, None), (None, None, "y", 1), (None, None, "y", 1)]
    df = spark.createDataFrame(rows, "k string, u int, v string, w int")
    out = relational.aggregate_distinct(df, {"k": F.col("k")}, {"us": "u", "vs": "v"}, F.sum("w").alias("w"))
    assert seed.rows_of(out, "k", "us", "vs", "w") == [(None, 0, 1, 2), ("a", 2, 1, 5)]


def test_customer_measures_are_hash_aggregated(spark, skewed):
    for unique in (True, False):
        assert "SortAggregate" not in plan(customer_marts.sales_by_customer(skewed, D("2026-10-01"), unique_orders=unique))


@pytest.fixture(scope="module")
def one_month(spark):
    """30,000 rows, nearly all of one month: a third of equal values, some NULL, ties, and a NULL month."""
    i = F.col("id")
    month = F.when(i % 100 > 0, "2026-03").when(i % 200 > 0, "2026-04")
    value = F.when(i % 3 == 0, 500).when(i % 50 == 1, F.lit(None)).otherwise(F.pmod(F.hash("id"), F.lit(5000)))
    return spark.range(30_000).select("id", month.alias("month"), value.cast("decimal(12,2)").alias("v"), (i % 7).alias("w"))


def test_ranks_of_slices_equal_ranks(spark, one_month):
    from tillwise.functions import windows

    want = one_month.select("id", windows.rank_desc(["month"], "v").alias("a"), windows.rank_desc(["month"], "w").alias("b"))
    got = relational.rank_in_slices(one_month, "month", {"a": "v", "b": "w"}, ["id"])
    assert got.columns == [*one_month.columns, "a", "b"] and got.schema["a"].dataType == want.schema["a"].dataType
    assert seed.rows_of(got, "id", "a", "b") == seed.rows_of(want)
    assert relational.rank_in_slices(one_month.limit(0), "month", {"a": "v"}, ["id"]).count() == 0


def test_no_task_ranks_a_whole_month(spark, one_month):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        ranked = relational.rank_in_slices(one_month, "month", {"a": "v"}, ["id"])
        per_task = ranked.groupBy(F.spark_partition_id().alias("p")).agg(F.count("id").alias("n"), F.max("a"))
        sizes = [r["n"] for r in per_task.collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert sum(sizes) == 30_000 and max(sizes) < 3_000


def _nodes(node):
    yield node
    children = node.children()
    for i in range(children.size()):
        yield from _nodes(children.apply(i))


def test_ranked_rows_are_shuffled_without_cuts(one_month):
    ranked = relational.rank_in_slices(one_month, "month", {"a": "v", "b": "w"}, ["id"])
    ranks = [n for n in _nodes(ranked._jdf.queryExecution().optimizedPlan()) if n.nodeName() == "Window"]
    assert len(ranks) == 2
    for columns in (n.schema().simpleString() for n in ranks):
        assert "array<" not in columns and "map<" not in columns


@pytest.mark.parametrize("slices", [1, 2, 5, 64])
def test_any_number_of_slices(one_month, slices):
    from tillwise.functions import windows

    few = one_month.filter("id < 3000")
    got = relational.rank_in_slices(few, "month", {"a": "v"}, ["id"], slices)
    assert seed.rows_of(got, "id", "a") == seed.rows_of(few.select("id", windows.rank_desc(["month"], "v").alias("a")))


def test_store_months_do_not_copy_sales(skewed, history):
    assert "Expand" not in plan(store_marts.store_months(skewed, history))
