"""The sales fact: full load and append of unseen orders."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.functions.text import clean_id
from tillwise.operators.relational import not_in_target, upto_batch


def clean_sales(src_sales: DataFrame) -> DataFrame:
    return src_sales.select(
        "order_id", "order_date",
        *[clean_id(F.col(c)).alias(c) for c in ("store_code", "customer_id", "product_id")],
        "quantity", "unit_price", "total_amount", "partition_time",
    )


def build_fact_sales(src_sales: DataFrame, cutoff: dt.date) -> DataFrame:
    return clean_sales(upto_batch(src_sales, cutoff))


def new_fact_rows(src_sales: DataFrame, fact: DataFrame, cutoff: dt.date) -> DataFrame:
    """Rows to append: orders not loaded before. The first version of an order wins.

    Only the order ids of the fact are read. Orders repeated inside one load are all kept.
    """
    return clean_sales(not_in_target(upto_batch(src_sales, cutoff), fact, "order_id"))


def arrived_rows(source_rows: DataFrame, fact: DataFrame) -> DataFrame:
    """Orders among ``source_rows`` that the fact lacks, for few rows against a large fact.

    The ids of the fact are first cut to those that occur among the rows. That side can be broadcast while
    it is small, so the fact's ids are scanned but not shuffled.
    """
    ids = source_rows.select("order_id").distinct()
    loaded = fact.select("order_id").join(ids, "order_id", "left_semi")
    return clean_sales(not_in_target(source_rows, loaded, "order_id"))
