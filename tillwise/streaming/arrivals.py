"""Append new sales files to the fact.

The file source remembers which files it has seen, so a run reads new files only instead of every batch since the
beginning. Each micro-batch owns a directory named after its number: when it is replayed after a failure it
replaces what it wrote before, and it looks for known orders in the other directories only. So nothing is appended
twice. Of an order that one micro-batch holds several times the earliest load counts; orders without an id are an
error, as nothing could tell them apart from their copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillwise.functions import windows
from tillwise.operators.facts import arrived_rows, clean_sales
from tillwise.schemas import SRC_SALES
from tillwise.sources.tables import write_table

_FIRST = -1  # what was there before the stream


def _write(rows: DataFrame, fact_path: str, arrival: int) -> None:
    write_table(rows, f"{fact_path}/arrival={arrival}", partition_by=["partition_time"])


def start_fact(sales: DataFrame, fact_path: str) -> None:
    """The fact that arrivals are added to."""
    _write(clean_sales(_one_per_order(sales)), fact_path, _FIRST)


def read_fact(spark: SparkSession, fact_path: str) -> DataFrame:
    return spark.read.parquet(fact_path).drop("arrival")


def _one_per_order(sales: DataFrame) -> DataFrame:
    if not sales.filter("order_id is null").isEmpty():
        raise ValueError("orders without an id")
    others = [windows.asc(c) for c in sales.columns if c not in ("order_id", "partition_time")]
    place = F.row_number().over(windows.by(["order_id"], windows.asc("partition_time"), *others))
    return sales.withColumn("_place", place).filter("_place = 1").drop("_place")


def append_sales_batch(batch: DataFrame, number: int, fact_path: str) -> None:
    """Orders of a micro-batch that the fact lacks, written as its directory."""
    others = batch.sparkSession.read.parquet(fact_path).filter(F.col("arrival") != number)
    _write(arrived_rows(_one_per_order(batch), others), fact_path, number)


def append_arrivals(spark: SparkSession, source_path: str, fact_path: str, checkpoint: str) -> StreamingQuery:
    """Process all files that have arrived since the last run, then stop. The fact must have been started."""
    arrived = spark.readStream.schema(SRC_SALES).parquet(source_path)
    return (
        arrived.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(lambda batch, number: append_sales_batch(batch, number, fact_path))
        .start()
    )
