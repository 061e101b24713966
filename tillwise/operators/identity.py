"""Stable store identity: codes change, the location does not."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions import windows
from tillwise.functions.aggregates import least_row
from tillwise.functions.text import clean_id
from tillwise.operators.relational import map_to_identity, merge_rows, one_batch, store_by_status
from tillwise.schemas import OPEN_END

HISTORY_COLUMNS = ["initial_store_code", "store_code", "start_date", "end_date"]
HISTORY_KEY = ["initial_store_code", "store_code", "start_date"]


def _located(src_store: DataFrame) -> DataFrame:
    return src_store.filter("latitude is not null and longitude is not null").select(
        clean_id(F.col("store_code")).alias("store_code"), "latitude", "longitude", "partition_time"
    )


def _first(rows: DataFrame) -> DataFrame:
    """The earliest (seen, code) of each location; of two codes at one time the lesser one."""
    first = least_row(F.col("seen"), F.col("initial_store_code"), payload={c: F.col(c) for c in ("seen", "initial_store_code")})
    return rows.groupBy("latitude", "longitude").agg(first.alias("_row")).select("latitude", "longitude", "_row.initial_store_code", "_row.seen")


def first_seen(src_store: DataFrame) -> DataFrame:
    """``(latitude, longitude, initial_store_code, seen)``: the first code ever seen at each location.

    It is a state that merges: see ``merge_first_seen``.
    """
    return _first(_located(src_store).withColumnsRenamed({"store_code": "initial_store_code", "partition_time": "seen"}))


def merge_first_seen(*states: DataFrame) -> DataFrame:
    """``first_seen`` of all batches from that of parts of them, in any order and with repeats."""
    return _first(reduce(DataFrame.unionByName, states))


def first_seen_changes(state: DataFrame, batch: DataFrame) -> DataFrame:
    """What a batch adds to the state: locations it lacks, and those the batch has seen earlier.

    Appended to ``state``, they are merged by ``merge_first_seen``; all other locations stay untouched.
    """
    place = ["latitude", "longitude"]
    known = state.join(batch.select(*place).distinct(), place, "left_semi")
    merged = merge_first_seen(known, first_seen(batch))
    return merged.join(known, [*place, "initial_store_code", "seen"], "left_anti").select(*state.columns)


def initial_store(src_store: DataFrame) -> DataFrame:
    """First code ever seen at each location, over all batches. Two codes at once: the lesser one."""
    return first_seen(src_store).select("initial_store_code", "latitude", "longitude")


def build_code_history(src_store: DataFrame, cutoff: dt.date) -> DataFrame:
    """Code versions of every store, rebuilt from all batches up to the cut-off.

    Batches collapse to one row per (location, code) before anything is compared, so the shuffles
    after the first carry as many rows as there are codes, however many batches there are.
    """
    batch_date = F.to_date("partition_time")
    codes = _located(src_store).groupBy("latitude", "longitude", "store_code").agg(
        F.min("partition_time").alias("seen"),
        F.min(F.when(batch_date <= F.lit(cutoff), batch_date)).alias("start_date"),
    )
    place = Window.partitionBy("latitude", "longitude")
    first = F.min(F.struct(F.col("seen").isNull(), "seen", "store_code")).over(place)
    named = codes.withColumn("initial_store_code", first["store_code"]).filter("start_date is not null")
    starts = named.groupBy("initial_store_code", "store_code").agg(F.min("start_date").alias("start_date"))
    end = windows.next_or_open("start_date", ["initial_store_code"], "store_code")
    return starts.withColumn("end_date", end)


def store_mapping(src_store: DataFrame, batch_date: dt.date, seen: DataFrame) -> DataFrame:
    """(initial code, code) pairs present in one batch.

    ``seen`` is ``first_seen`` of the batches before, or of more; of it only locations of the batch are kept, and
    of ``src_store`` only the batch is read.
    """
    batch = one_batch(src_store, batch_date)
    rows = _located(batch)
    places = rows.select("latitude", "longitude").distinct()
    known = merge_first_seen(seen.join(places, ["latitude", "longitude"], "left_semi"), first_seen(batch))
    mapped = map_to_identity(rows, known)
    return mapped.select("initial_store_code", "store_code").distinct().withColumn("start_date", F.lit(batch_date))


def conflicting_codes(src_store: DataFrame, batch_date: dt.date) -> DataFrame:
    """Locations that report more than one code in a batch; the merge below needs this to be empty."""
    batch = _located(one_batch(src_store, batch_date))
    codes = batch.groupBy("latitude", "longitude").agg(F.countDistinct("store_code").alias("codes"))
    return codes.filter("codes > 1")


def closed_rows(target: DataFrame, mapping: DataFrame) -> DataFrame:
    """Open versions whose store now reports another code, closed at the batch date."""
    seen = mapping.select(
        F.col("initial_store_code").alias("_id"), F.col("store_code").alias("_code"), F.col("start_date").alias("_day")
    )
    on = (F.col("initial_store_code") == F.col("_id")) & (F.col("store_code") != F.col("_code"))
    hit = store_by_status(target, "active").join(seen, on).drop("end_date")
    return hit.select(*HISTORY_KEY, F.col("_day").alias("end_date")).distinct()


def new_rows(target: DataFrame, mapping: DataFrame) -> DataFrame:
    """Codes of the batch that have no open version yet."""
    opened = store_by_status(target, "active").select("initial_store_code", "store_code")
    fresh = mapping.join(opened, ["initial_store_code", "store_code"], "left_anti")
    return fresh.withColumn("end_date", F.lit(OPEN_END)).select(*HISTORY_COLUMNS)


def code_changes(target: DataFrame, src_store: DataFrame, batch_date: dt.date, seen: DataFrame) -> DataFrame:
    """Versions that a batch closes or opens, as ``merge_rows`` takes them."""
    mapping = store_mapping(src_store, batch_date, seen)
    return closed_rows(target, mapping).unionByName(new_rows(target, mapping))


def merge_code_history(target: DataFrame, src_store: DataFrame, batch_date: dt.date, seen: DataFrame) -> DataFrame:
    """History after one more batch; ``seen`` as in ``store_mapping``.

    Equal to a rebuild as long as no code returns to a store that gave it up: the rebuild knows only
    the first start of a code, this one closes and reopens it.
    """
    changes = code_changes(target, src_store, batch_date, seen)
    return merge_rows(target.select(*HISTORY_COLUMNS), changes, HISTORY_KEY)


def history_of_changes(changes: DataFrame, order: str) -> DataFrame:
    """History from the changes of all batches: of each version the row of the last batch by ``order`` counts."""
    return changes.groupBy(*HISTORY_KEY).agg(F.max_by("end_date", order).alias("end_date"))


def active_store(history: DataFrame) -> DataFrame:
    return store_by_status(history, "active")


def closed_store(history: DataFrame, as_of: dt.date) -> DataFrame:
    return store_by_status(history, "closed", as_of)
