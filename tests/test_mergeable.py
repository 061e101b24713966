"""Sets and months of buyers, merged from parts in any order, against plain code."""

import random

import pytest
import seed
from pyspark.sql import functions as F

from tillwise.operators import kpis, mergeable

D = seed.D


def sales(spark, random_seed, n=600):
    rng = random.Random(random_seed)
    days = [D(f"{y}-{m:02d}-{d:02d}") for y in (1999, 2000, 2004, 2005, 2010) for m in (1, 2, 11, 12) for d in (1, 28)]  # eras end with 2004 and 2009
    rows = [(rng.choice([f"C{i}" for i in range(40)] + [None]), rng.choice(days), rng.choice("XYZ")) for _ in range(n)]
    return rows, spark.createDataFrame(rows, "customer_id string, order_date date, store_code string")


@pytest.mark.parametrize("random_seed", [1, 2])
def test_retention_from_parts(spark, random_seed):
    _, fact = sales(spark, random_seed)
    want = seed.rows_of(kpis.kpi_customer_retention(fact))
    assert any(r[4] for r in want)  # some are retained
    cut = fact.withColumn("part", F.pmod(F.hash("customer_id", "order_date", "store_code"), F.lit(3)))
    parts = [mergeable.buyer_months(cut.filter(F.col("part") == i)) for i in (2, 0, 1)] + [mergeable.buyer_months(fact.limit(50))]
    got = kpis.retention_of_months(mergeable.retention_months(mergeable.merge_buyer_months(*parts)))
    assert got.columns == kpis.kpi_customer_retention(fact).columns and seed.rows_of(got) == want
    assert mergeable.merge_buyer_months(*parts).count() <= 40 * 4  # one row per customer and five years


def test_months_over_the_border_of_two_numbers(spark):
    rows = [("A", D("2004-12-31")), ("A", D("2005-01-01")), ("B", D("2004-11-01")), ("B", D("2005-01-01")), ("C", D("1969-12-01")), ("C", D("1970-01-01"))]
    fact = spark.createDataFrame(rows, "customer_id string, order_date date")
    got = mergeable.retention_months(mergeable.merge_buyer_months(mergeable.buyer_months(fact)))
    kept = {str(r._m): (r.new_customers, r.returning_customers, r.retained_from_prev_month) for r in got.collect()}
    assert kept["2005-01-01"] == (0, 2, 1) and kept["1970-01-01"] == (0, 1, 1) and kept["2004-12-01"] == (1, 0, 0)


@pytest.mark.parametrize("random_seed", [3, 4])
def test_counts_of_sets(spark, random_seed):
    rows, fact = sales(spark, random_seed)
    loads = [fact.filter("order_date < '2004-12-01'"), fact.filter("order_date >= '2004-02-01'")]  # they overlap
    numbers, parts = None, []
    for load in loads:
        fresh = mergeable.number_values(numbers, load, "customer_id", "store_code")
        numbers = fresh if numbers is None else numbers.unionByName(fresh)
        parts.append(mergeable.set_parts(load, ["order_date", "store_code"], "customer_id", numbers))
    given = [r.number for r in numbers.collect()]
    assert len(given) == len(set(given)) == 40
    assert mergeable.number_values(numbers, fact, "customer_id", "store_code").count() == 0
    both = parts[0].unionByName(parts[1])
    for keys, of in ((["store_code"], lambda r: (r[2],)), (["order_date", "store_code"], lambda r: (r[1], r[2])), ([], lambda r: ())):
        want = {}
        for r in rows:
            if r[0]:
                want.setdefault(of(r), set()).add(r[0])
        got = {tuple(r)[:-1]: r.buyers for r in mergeable.count_sets(both, keys, "buyers").collect()}
        assert got == {k: len(v) for k, v in want.items()}


def test_nothing(spark):
    _, fact = sales(spark, 5)
    none = fact.limit(0)
    assert mergeable.retention_months(mergeable.merge_buyer_months(mergeable.buyer_months(none))).count() == 0
    numbers = mergeable.number_values(None, none, "customer_id", "store_code")
    assert numbers.count() == 0 and mergeable.number_values(numbers, fact, "customer_id", "store_code").count() == 40
    assert mergeable.count_sets(mergeable.set_parts(none, ["store_code"], "customer_id", numbers), ["store_code"], "n").count() == 0


def test_sets_are_or_ed_in_place(spark):
    """Rows of a set are short and of one length, however sparse it is, and no aggregation sorts them."""
    _, fact = sales(spark, 6)
    numbers = mergeable.number_values(None, fact, "customer_id", "store_code")
    parts = mergeable.set_parts(fact, ["order_date", "store_code"], "customer_id", numbers)
    assert parts.schema["bits"].dataType.simpleString() == "bigint"
    counted = mergeable.count_sets(parts, ["store_code"], "buyers")
    assert "SortAggregate" not in counted._jdf.queryExecution().executedPlan().toString()


def test_numbers_on_both_sides_of_a_border(spark):
    """Numbers 62 to 65, 127, 128 and beyond four bytes, the sign bit among them; a value of two parts counts once."""
    given = [62, 63, 64, 65, 127, 128, (1 << 33) + 63, (1 << 33) + 64]
    numbers = spark.createDataFrame([(f"C{n}", n) for n in given], "customer_id string, number bigint")
    rows = spark.createDataFrame([("X", f"C{n}") for n in given] + [("Y", "C63")], "store_code string, customer_id string")
    parts = mergeable.set_parts(rows, ["store_code"], "customer_id", numbers)
    both = parts.unionByName(parts)
    assert seed.rows_of(mergeable.count_sets(both, ["store_code"], "n"), "store_code", "n") == [("X", len(given)), ("Y", 1)]
    assert [r.n for r in mergeable.count_sets(both, [], "n").collect()] == [len(given)]
