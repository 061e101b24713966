import random
from functools import reduce

import pytest
import seed
from pyspark.sql import functions as F

from tillwise.operators import identity
from tillwise.schemas import OPEN_END

D = seed.D
M1, M2, M3 = "2026-01-01", "2026-02-01", "2026-03-01"


def fold(spark, src, batches):
    first = identity.build_code_history(src, D(batches[0]))
    return reduce(lambda h, b: identity.merge_code_history(h, src, D(b), seen_before(src, b)), batches[1:], first)


def seen_before(src, batch):
    return identity.first_seen(src.filter(F.col("partition_time") < F.lit(D(batch))))


def test_codes_close_and_open(spark):
    src = seed.stores(spark, [(M1, " y1 ", "1", "1"), (M2, "Y2", "1", "1"), (M3, "y2", "1", "1"), (M2, "Z1", "2", "2")])
    want = [("Y1", "Y1", D(M1), D(M2)), ("Y1", "Y2", D(M2), OPEN_END), ("Z1", "Z1", D(M2), OPEN_END)]
    assert seed.rows_of(identity.build_code_history(src, D(M3))) == want
    assert seed.rows_of(fold(spark, src, [M1, M2, M3])) == want
    assert seed.rows_of(identity.build_code_history(src, D(M1))) == [("Y1", "Y1", D(M1), OPEN_END)]


def test_returning_code_differs_between_rebuild_and_merge(spark):
    src = seed.stores(spark, [(M1, "A", "1", "1"), (M2, "B", "1", "1"), (M3, "A", "1", "1")])
    assert seed.rows_of(identity.build_code_history(src, D(M3))) == [
        ("A", "A", D(M1), D(M2)), ("A", "B", D(M2), OPEN_END)]
    assert seed.rows_of(fold(spark, src, [M1, M2, M3])) == [
        ("A", "A", D(M1), D(M2)), ("A", "A", D(M3), OPEN_END), ("A", "B", D(M2), D(M3))]


def test_missing_location_stays_active(spark):
    src = seed.stores(spark, [(M1, "A", "1", "1"), (M1, "C", "2", "2"), (M2, "A", "1", "1")])
    assert seed.rows_of(fold(spark, src, [M1, M2])) == [("A", "A", D(M1), OPEN_END), ("C", "C", D(M1), OPEN_END)]


def test_two_codes_at_one_place(spark):
    src = seed.stores(spark, [(M1, "A", "1", "1"), (M1, "B", "1", "1"), (M2, "A", "1", "1")])
    assert seed.rows_of(identity.build_code_history(src, D(M1))) == [("A", "A", D(M1), D(M1)), ("A", "B", D(M1), OPEN_END)]
    assert identity.conflicting_codes(src, D(M1)).count() == 1
    assert identity.conflicting_codes(src, D(M2)).count() == 0


def test_coordinates_compare_as_text(spark):
    src = seed.stores(spark, [(M1, "A", "-6.1", "1"), (M2, "B", "-6.10", "1"), (M1, "N", None, "1")])
    assert seed.rows_of(identity.build_code_history(src, D(M2)), "initial_store_code", "store_code") == [("A", "A"), ("B", "B")]


def test_merge_is_idempotent(spark):
    src = seed.stores(spark, [(M1, "A", "1", "1"), (M2, "B", "1", "1")])
    once = fold(spark, src, [M1, M2])
    assert seed.rows_of(identity.merge_code_history(once, src, D(M2), seen_before(src, M2))) == seed.rows_of(once)


@pytest.mark.parametrize("random_seed", [1, 2])
def test_fold_equals_rebuild_without_returning_codes(spark, random_seed):
    rng = random.Random(random_seed)
    batches = [M1, M2, M3]
    rows, code = [], {}
    for b in batches:
        for place in range(6):
            if place not in code or rng.random() < 0.4:
                code[place] = f"S{place}-{b}-{rng.random():.3f}"
            if rng.random() < 0.8:
                rows.append((b, code[place], str(place), "0"))
    src = seed.stores(spark, rows)
    assert seed.rows_of(fold(spark, src, batches)) == seed.rows_of(identity.build_code_history(src, D(M3)))


@pytest.mark.parametrize("random_seed", [1, 2])
def test_first_seen_merges_in_any_order(spark, random_seed):
    rng = random.Random(random_seed)
    rows = [(b, rng.choice("ABC"), str(rng.randrange(8)), rng.choice(["0", None])) for b in (M1, M2, M3) for _ in range(12)]
    src = seed.stores(spark, rows)
    want = seed.rows_of(identity.first_seen(src))
    order = [M1, M2, M3]
    rng.shuffle(order)
    state, added = identity.first_seen(src.limit(0)), 0
    for b in order:
        changes = identity.first_seen_changes(identity.merge_first_seen(state), src.filter(F.col("partition_time") == F.lit(D(b))))
        added += changes.count()
        state = state.unionByName(changes)
    assert seed.rows_of(identity.merge_first_seen(state)) == want
    again = identity.first_seen_changes(identity.merge_first_seen(state), src)
    assert again.count() == 0 and added == state.count()


def test_history_of_changes(spark):
    src = seed.stores(spark, [(M1, "A", "1", "1"), (M2, "B", "1", "1"), (M3, "A", "1", "1"), (M1, "C", "2", "1"), (M3, "C", "2", "1")])
    parts = identity.build_code_history(src, D(M1)).withColumn("day", F.lit(D(M1)))
    for b in (M2, M3):
        target = identity.history_of_changes(parts, "day")
        changes = identity.code_changes(target, src, D(b), seen_before(src, b))
        assert changes.count() == 2  # one closed, one opened; the other store writes nothing
        parts = parts.unionByName(changes.withColumn("day", F.lit(D(b))))
    assert seed.rows_of(identity.history_of_changes(parts, "day")) == seed.rows_of(fold(spark, src, [M1, M2, M3]))
