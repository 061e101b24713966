import random
from functools import reduce

import pytest
import seed
from pyspark.sql import functions as F

from tillwise.operators import snapshots
from tillwise.schemas import SRC_STORE_DETAIL

D = seed.D
DAYS = ["2026-01-01", "2026-02-01", "2026-03-01"]

# The three loads of the worked example (order, quantity, price) and its outcome.
LOADS = [
    [(1, 2, 50000), (2, 1, 75000), (3, 3, 50000), (4, 1, 120000), (5, 2, 75000)],
    [(1, 5, 50000), (2, 1, 75000), (3, 4, 50000), (4, 1, 120000), (5, 2, 75000), (6, 3, 30000), (7, 2, 50000)],
    [(1, 5, 50000), (2, 1, 80000), (3, 4, 50000), (4, 1, 120000), (5, 2, 75000), (6, 3, 30000), (7, 2, 50000)],
]
EXPIRED = [(1, 2, 50000, DAYS[0], DAYS[1]), (2, 1, 75000, DAYS[0], DAYS[2]), (3, 3, 50000, DAYS[0], DAYS[1])]


def load(spark, rows, day):
    return seed.sales(spark, [seed.sale(i, "2026-01-01", "S", "C", "P", q, p, batch=D(day)) for i, q, p in rows])


def test_worked_example(spark):
    dim = None
    for rows, day in zip(LOADS, DAYS):
        dim = snapshots.snapshot_sales(dim, load(spark, rows, day), D(day))
    assert dim.count() == 10
    assert snapshots.current_versions(dim).count() == 7
    text = lambda c: F.col(c).cast("date").cast("string")
    closed = dim.filter("valid_to is not null").select("order_id", "quantity", "unit_price", text("valid_from"), text("valid_to"))
    assert seed.rows_of(closed) == EXPIRED
    batches = reduce(lambda a, b: a.union(b), [load(spark, r, d) for r, d in zip(LOADS, DAYS)])
    cols = ["order_id", "quantity", "unit_price", "valid_from", "valid_to"]
    assert seed.rows_of(snapshots.sales_history(batches), *cols) == seed.rows_of(dim, *cols)


def test_null_is_a_value_and_missing_keys_stay_open(spark):
    def batch(rows):
        return spark.createDataFrame(rows, "k string, v string, note string")
    dim = snapshots.snapshot_check(None, batch([("a", None, "1"), ("b", "x", "1"), ("c", "x", "1")]), "k", ["v"], D(DAYS[0]))
    dim = snapshots.snapshot_check(dim, batch([("a", None, "2"), ("b", None, "2"), ("d", "y", "2")]), "k", ["v"], D(DAYS[1]))
    got = seed.rows_of(dim.select("k", "v", "note", F.col("valid_to").isNull().alias("open")))
    assert got == [("a", None, "1", True), ("b", None, "2", True), ("b", "x", "1", False), ("c", "x", "1", True), ("d", "y", "2", True)]


def test_customer_versions(spark):
    src = seed.customers(spark, [
        (DAYS[0], "C1", "Bronze"), (DAYS[1], "C1", "Silver"), (DAYS[2], "C1", "Gold"),
        (DAYS[0], "C2", "Bronze", "a@x"), (DAYS[1], "C2", "Bronze", "b@x"), (DAYS[2], "C2", "Bronze", "b@x "),
        (DAYS[1], "C3", "Silver"),
    ])
    history = snapshots.customer_history(src)
    folded = reduce(lambda dim, d: snapshots.snapshot_customer(dim, src, D(d)), DAYS, None)
    cols = ["customer_id", "tier", "email", "partition_date", "valid_from", "valid_to"]
    assert seed.rows_of(history, *cols) == seed.rows_of(folded, *cols)
    # raw values are compared: a trailing blank opens a version
    assert seed.rows_of(history.groupBy("customer_id").count()) == [("C1", 3), ("C2", 3), ("C3", 1)]


def test_store_detail(spark):
    def row(day, fmt):
        given = {"store_code": "S", "format": fmt, "partition_time": D(day)}
        return tuple(given.get(f.name) for f in SRC_STORE_DETAIL)
    src = spark.createDataFrame([row(DAYS[0], "small"), row(DAYS[1], "small"), row(DAYS[2], "large")], SRC_STORE_DETAIL)
    dim = reduce(lambda d, day: snapshots.snapshot_store(d, src, D(day)), DAYS, None)
    assert seed.rows_of(dim, "format") == [("large",), ("small",)]
    assert snapshots.store_history(src).count() == 2


@pytest.mark.parametrize("random_seed", [1, 2, 3])
def test_history_equals_fold_and_brute_force(spark, random_seed):
    rng = random.Random(random_seed)
    rows = [(k, rng.choice([None, "x", "y"]), rng.choice([None, 1]), d) for d in DAYS for k in "abcdef" if rng.random() < 0.7]
    odd = [(None, "x", 1, d) for d in DAYS]  # rows without a key have no history
    odd += [(k, None, w, d) for k, v, w, d in rows if v is not None and rng.random() < 0.5]  # repeats; a NULL ranks above all
    src = spark.createDataFrame(rows + odd, "k string, v string, w int, day string").withColumn("day", F.to_date("day"))
    history = snapshots.snapshot_history(src, "k", ["v", "w"], "day")
    folded = reduce(lambda dim, d: snapshots.snapshot_check(dim, src.filter(F.col("day") == d), "k", ["v", "w"], D(d)), DAYS, None)
    greatest = lambda r: tuple((x is None, x or 0 if not isinstance(x, str) else x) for x in r[1:3])
    seen = {}
    for r in rows + odd:
        if r[0] and (r[0], r[3]) not in seen or r[0] and str(greatest(r)) > str(greatest(seen[r[0], r[3]])):
            seen[r[0], r[3]] = r
    rows = [seen[r[0], r[3]] for r in rows]
    want = []
    for key in sorted({r[0] for r in rows}):
        open_row = None
        for _, v, w, d in [r for r in rows if r[0] == key]:
            if open_row is None or open_row[1:3] != [v, w]:
                if open_row:
                    want.append((*open_row, d))
                open_row = [key, v, w, d]
        want.append((*open_row, None))
    events = snapshots.events_of(snapshots.snapshot_history(src.filter(F.col("day") == DAYS[0]), "k", ["v", "w"], "day"))
    for d in DAYS[1:]:
        events = events.unionByName(snapshots.opened_versions(events, src.filter(F.col("day") == d), "k", ["v", "w"], D(d)))
    series = snapshots.versions_of(events, "k")
    cols = [F.col("k"), F.col("v"), F.col("w"), *[F.col(c).cast("date").cast("string").alias(c) for c in ("valid_from", "valid_to")]]
    assert sorted(map(tuple, history.select(*cols).collect()), key=repr) == sorted(want, key=repr)
    assert sorted(map(tuple, folded.select(*cols).collect()), key=repr) == sorted(want, key=repr)
    assert sorted(map(tuple, series.select(*cols).collect()), key=repr) == sorted(want, key=repr)


def test_ambiguous_keys(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "k string")
    assert sorted(map(tuple, snapshots.ambiguous_keys(df, "k").collect()), key=str) == [("a", 2), (None, 2)]


def test_repeated_orders_have_one_open_version(spark):
    rows = [(1, 2, 50000, DAYS[0]), (1, 2, 50000, DAYS[1]), (1, 3, 50000, DAYS[1]), (1, 3, 50000, DAYS[2])]
    loads = reduce(lambda a, b: a.union(b), [load(spark, [row[:3]], row[3]) for row in rows])
    first = snapshots.snapshot_sales(None, loads.filter(F.col("partition_time") == F.lit(D(DAYS[0]))), D(DAYS[0]))
    after = snapshots.snapshot_sales(first, loads, D(DAYS[1]))
    assert seed.rows_of(after.select("quantity", F.col("valid_to").isNull())) == [(2, False), (3, True)]


def test_events_hold_changes_only(spark):
    rows = [(f"k{i}", "a", "x") for i in range(50)]
    batch = lambda rows: spark.createDataFrame(rows, "k string, v string, note string")
    events = snapshots.events_of(snapshots.snapshot_check(None, batch(rows), "k", ["v"], D(DAYS[0])))
    assert events.count() == 50
    same = snapshots.opened_versions(events, batch([(k, v, "another note") for k, v, _ in rows]), "k", ["v"], D(DAYS[1]))
    assert same.count() == 0
    fresh = snapshots.opened_versions(events, batch([("k1", "b", "x"), ("k2", "a", "x"), ("k3", None, "x"), ("new", "a", "x"), (None, "a", "x")]), "k", ["v"], D(DAYS[1]))
    assert sorted(r.k for r in fresh.collect()) == ["k1", "k3", "new"]
