"""Change history of dimensions: a new version whenever a checked column differs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.functions import windows
from tillwise.operators.relational import all_batches, current_versions, one_batch
from tillwise.schemas import CUSTOMER_CHECK_COLUMNS, SALES_CHECK_COLUMNS, STORE_CHECK_COLUMNS

_STAMP = T.TimestampNTZType()


def _stamp(ts: dt.date | dt.datetime) -> Column:
    return F.lit(ts).cast(_STAMP)


def ambiguous_keys(batch: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once in a batch, and NULL if rows lack a key."""
    return batch.groupBy(key).agg(F.count(F.lit(1)).alias("cnt")).filter((F.col("cnt") > 1) | F.col(key).isNull())


def one_per_key(rows: DataFrame, keys: Sequence[str], check_cols: Sequence[str], newest: str | None = None) -> DataFrame:
    """The row of each key that a snapshot sees; every snapshot function uses this rule.

    Rows without a key have no history and are left out. Of rows that repeat a key the newest by ``newest``
    counts, and of those the greatest by the checked columns, so that the choice never depends on row order.
    """
    order = [windows.desc(c) for c in ([newest] if newest else []) + list(check_cols)]
    known = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    return rows.filter(known).withColumn("_place", F.row_number().over(windows.by(keys, *order))).filter("_place = 1").drop("_place")


def snapshot_check(
    target: DataFrame | None, batch: DataFrame, key: str, check_cols: Sequence[str], effective_ts: dt.date, newest: str | None = None
) -> DataFrame:
    """Versions after comparing ``batch`` with the current versions of ``target``.

    Changed: old version closed, new one opened. Unseen key: opened. Unchanged, or missing from the
    batch: kept as it is. Closed versions pass through without joining the comparison. Rows without a key
    and repeated keys: see ``one_per_key``.
    """
    batch = one_per_key(batch, [key], check_cols, newest)
    opened = batch.withColumns({"valid_from": _stamp(effective_ts), "valid_to": F.lit(None).cast(_STAMP)})
    if target is None:
        return opened
    cols = target.columns
    opened = opened.select(*[F.col(c).cast(target.schema[c].dataType).alias(c) for c in cols])
    old = current_versions(target).select(F.col(key).alias("_k"), F.struct(*cols).alias("old"))
    new = opened.select(F.col(key).alias("_k"), F.struct(*cols).alias("new"))
    both = old.join(new, "_k", "full_outer")

    had, has = F.col("old").isNotNull(), F.col("new").isNotNull()
    differs = reduce(Column.__or__, [~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in check_cols])
    changed = had & has & differs
    old_now = F.when(changed, F.col("old").withField("valid_to", F.col("new.valid_from"))).otherwise(F.col("old"))
    versions = F.array(F.when(had, old_now), F.when(has & (~had | changed), F.col("new")))
    after = both.select(F.inline(F.filter(versions, lambda v: v.isNotNull()))).select(*cols)
    return target.filter(F.col("valid_to").isNotNull()).unionByName(after)


def snapshot_history(batches: DataFrame, key: str, check_cols: Sequence[str], batch_col: str) -> DataFrame:
    """All versions in one pass: what ``snapshot_check`` gives after every batch in date order.

    One shuffle on the key instead of one join per batch. ``one_per_key`` leaves a key at most one row per
    batch, so no window group of the comparison grows beyond the number of batches.
    """
    batches = one_per_key(batches, [key, batch_col], check_cols)
    w = windows.by([key], F.col(batch_col))
    state = F.struct(*check_cols)
    marked = batches.withColumn("_first", F.row_number().over(w) == 1).withColumn(
        "_same", F.lag(state).over(w).eqNullSafe(state)
    )
    starts = marked.filter("_first or not _same").drop("_first", "_same")
    return starts.withColumns(
        {"valid_from": F.col(batch_col).cast(_STAMP), "valid_to": F.lead(batch_col).over(w).cast(_STAMP)}
    )


# --- event form ------------------------------------------------------------------------------------
# A dimension as the series of its opened versions, only ever added to. A version is closed by the next one of
# its key, so nothing that is stored has to change, and a batch writes the keys that differ and no others.


def opened_versions(
    events: DataFrame, batch: DataFrame, key: str, check_cols: Sequence[str], effective_ts: dt.date, newest: str | None = None
) -> DataFrame:
    """The versions that a batch opens: unseen keys, and keys whose checked columns differ from the last event.

    Events are cut to the keys of the batch before anything is compared; other keys are read past, never
    shuffled while the batch's keys can be broadcast. Appended to ``events`` (all dated before ``effective_ts``)
    they give what ``snapshot_check`` gives. Rows without a key and repeated keys: see ``one_per_key``.
    """
    batch = one_per_key(batch, [key], check_cols, newest)
    last = events.join(batch.select(key), key, "left_semi").select(F.col(key).alias("_k"), F.struct(*check_cols).alias("_was"), "valid_from")
    last = last.withColumn("_place", F.row_number().over(windows.by(["_k"], windows.desc("valid_from")))).filter("_place = 1")
    both = batch.join(last.select("_k", "_was"), F.col(key) == F.col("_k"), "left")
    fresh = both.filter(F.col("_k").isNull() | ~F.col("_was").eqNullSafe(F.struct(*check_cols)))
    opened = fresh.withColumn("valid_from", _stamp(effective_ts))
    return opened.select(*[F.col(c).cast(events.schema[c].dataType).alias(c) for c in events.columns])


def versions_of(events: DataFrame, key: str) -> DataFrame:
    """All versions with ``valid_to``, from the events of a dimension: one window over the events of a key."""
    return events.withColumn("valid_to", F.lead("valid_from").over(windows.by([key], F.col("valid_from"))))


def events_of(versions: DataFrame) -> DataFrame:
    """The events of a history built by other means."""
    return versions.drop("valid_to")


def _dated(batch: DataFrame) -> DataFrame:
    return batch.withColumnRenamed("partition_time", "partition_date")


def snapshot_customer(target: DataFrame | None, src_customer: DataFrame, batch_date: dt.date) -> DataFrame:
    batch = _dated(one_batch(src_customer, batch_date))
    return snapshot_check(target, batch, "customer_id", CUSTOMER_CHECK_COLUMNS, batch_date)


def snapshot_store(target: DataFrame | None, src_store_detail: DataFrame, batch_date: dt.date) -> DataFrame:
    batch = _dated(one_batch(src_store_detail, batch_date))
    return snapshot_check(target, batch, "store_code", STORE_CHECK_COLUMNS, batch_date)


def snapshot_sales(target: DataFrame | None, src_sales: DataFrame, effective_ts: dt.date) -> DataFrame:
    """All loads at once: of an order that several loads hold, the newest load counts."""
    return snapshot_check(target, all_batches(src_sales), "order_id", SALES_CHECK_COLUMNS, effective_ts, "partition_time")


def customer_history(src_customer: DataFrame) -> DataFrame:
    return snapshot_history(_dated(src_customer), "customer_id", CUSTOMER_CHECK_COLUMNS, "partition_date")


def store_history(src_store_detail: DataFrame) -> DataFrame:
    return snapshot_history(_dated(src_store_detail), "store_code", STORE_CHECK_COLUMNS, "partition_date")


def sales_history(sales_batches: DataFrame) -> DataFrame:
    return snapshot_history(sales_batches, "order_id", SALES_CHECK_COLUMNS, "partition_time")
