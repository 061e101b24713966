"""The given tables seen as retail sources.

Sales are orders summed over their lines. A store is a supplier; its code ends in A, B or C
depending on the date. Store batches are monthly, customer and store-detail batches yearly.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.operators import facts, identity, snapshots
from tillwise.operators.customer_marts import RfmConfig
from tillwise.operators.relational import upto_batch
from tillwise.plans.layers import Layers
from tillwise.sources.shared import store

FIRST_MONTH, LAST_MONTH = dt.date(1995, 1, 1), dt.date(2001, 8, 1)
AS_OF = LAST_MONTH
MID = dt.date(1999, 6, 1)  # a cut-off in the middle of the data
YEARS = [dt.date(y, 1, 1) for y in range(1996, 2003)]
CODE_B, CODE_C = dt.date(1997, 1, 1), dt.date(1999, 1, 1)
CORRECTIONS = [dt.date(2001, 9, 1), dt.date(2001, 10, 1), dt.date(2001, 11, 1)]
SCALED_RFM = RfmConfig(orders=(11, 8), spend=(Decimal(2400000), Decimal(1700000)))

# the widest decimal that is held as a plain long
PRICE = "decimal(18,2)"

# read by many queries, so written once
STORED = {
    "fact_sales", "sales_lines", "code_history", "dim_customer", "store_performance", "store_directory", "sales_summary",
    "sales_by_product", "sales_by_customer", "customer_profile", "kpi_revenue", "kpi_orders",
    "kpi_customer_retention", "kpi_store", "kpi_product", "kpi_exec_summary", "month_base",
    "fact_by_batch", "src_sales_files", "sales_corrections_files", "store_seen_1998",
}
# directories of stored tables: scans of single batches read nothing else
PARTITIONED = dict.fromkeys(("fact_by_batch", "src_sales_files", "sales_corrections_files"), ("partition_time",))


def store_code(key: Column, day: Column, renamed: Column) -> Column:
    """Code of a store on a day; ``renamed`` false keeps the first code for ever."""
    suffix = (
        F.when(~renamed, "A")
        .when((key % 10 == 0) & (day >= F.lit(CODE_C)), "C")
        .when((key % 5 == 0) & (day >= F.lit(CODE_B)), "B")
        .otherwise("A")
    )
    return F.concat(F.lit("S"), F.lpad(key.cast("string"), 9, "0"), suffix)


class RetailTables(Layers):
    def __init__(self, spark: SparkSession, sf_dir: str):
        # src_sales is grouped by order id
        super().__init__({}, AS_OF, keep=lambda df, name: store(df, name, partition_by=PARTITIONED.get(name, ())) if name in STORED else df, unique_orders=True)
        self.spark = spark
        self.sf_dir = sf_dir

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _build(self, name: str) -> DataFrame:
        own = getattr(self, f"_{name}", None)
        return own() if own else super()._build(name)

    def __contains__(self, name: object) -> bool:
        return hasattr(self, f"_{name}") or super().__contains__(name)

    # --- sources -----------------------------------------------------------------------------------

    def _src_sales(self) -> DataFrame:
        """One row per order. Both sides are reduced per order key first, so the join adds no shuffle."""
        lines = self.raw("lineitem").groupBy(F.col("l_orderkey").alias("order_id")).agg(
            F.min("l_suppkey").alias("sk"),
            F.min("l_partkey").alias("pk"),
            F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"),
            F.sum(F.col("l_extendedprice").cast("decimal(12,2)")).alias("total_amount"),
        )
        heads = self.raw("orders").groupBy(F.col("o_orderkey").alias("order_id")).agg(
            F.min("o_orderdate").cast("date").alias("order_date"), F.min("o_custkey").alias("ck")
        )
        code = store_code(F.col("sk"), F.col("order_date"), F.col("sk") % 17 != 0)
        return lines.join(heads, "order_id").select(
            "order_id", "order_date",
            F.concat(F.lit(" "), F.lower(code)).alias("store_code"),
            F.concat(F.lit("c"), F.col("ck").cast("string")).alias("customer_id"),
            F.concat(F.lit("p"), F.col("pk").cast("string"), F.lit(" ")).alias("product_id"),
            "quantity", F.round(F.col("total_amount") / F.col("quantity"), 2).cast(PRICE).alias("unit_price"),
            F.col("total_amount").cast(PRICE).alias("total_amount"),
            F.trunc("order_date", "MM").alias("partition_time"),
        )

    def _sales_lines(self) -> DataFrame:
        """One row per order line, so order ids repeat. Clean already."""
        lines = self.raw("lineitem").join(self.raw("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        day = F.col("o_orderdate").cast("date")
        amount = F.col("l_extendedprice").cast("decimal(12,2)")
        return lines.select(
            F.col("l_orderkey").alias("order_id"), day.alias("order_date"),
            store_code(F.col("l_suppkey"), day, F.lit(True)).alias("store_code"),
            F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("customer_id"),
            F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("product_id"),
            F.col("l_quantity").cast("bigint").alias("quantity"),
            F.round(amount / F.col("l_quantity").cast("bigint"), 2).cast(PRICE).alias("unit_price"),
            amount.cast(PRICE).alias("total_amount"), F.trunc(day, "MM").alias("partition_time"),
        )

    def _suppliers(self) -> DataFrame:
        """Suppliers dealt out to all cores: their file is small, often one task, but each of them becomes many batch rows."""
        return self.raw("supplier").repartition(self.spark.sparkContext.defaultParallelism, "s_suppkey")

    def _src_store(self) -> DataFrame:
        months = F.sequence(F.lit(FIRST_MONTH), F.lit(LAST_MONTH), F.expr("interval 1 month"))
        batches = self._suppliers().select("s_suppkey", "s_name", "s_nationkey", F.explode(months).alias("day"))
        return batches.select(
            F.lower(store_code(F.col("s_suppkey"), F.col("day"), F.lit(True))).alias("store_code"),
            F.col("s_suppkey").cast("string").alias("latitude"), F.col("s_nationkey").cast("string").alias("longitude"),
            F.col("s_name").alias("store_description"), F.lit("X").alias("country"), F.lit("area").alias("area"),
            F.lit("city").alias("city"), F.lit("district").alias("district"),
            F.col("day").cast("timestamp_ntz").alias("partition_time"),
        )

    def _src_customer(self) -> DataFrame:
        """Customers known before each yearly batch, with the tier their spend had reached by then."""
        day = F.col("o_orderdate")
        price = F.col("o_totalprice").cast("decimal(12,2)")
        spent = [F.sum(F.when(day < F.lit(y), price)).alias(f"y{y.year}") for y in YEARS]
        known = self.raw("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min(day).alias("first"), *spent)
        batches = F.array(*[
            F.struct(F.lit(y).alias("day"), F.col(f"y{y.year}").alias("spend")) for y in YEARS
        ])
        rows = known.join(self.raw("customer"), "c_custkey").select("*", F.inline(batches)).filter("spend is not null")
        key = F.col("c_custkey").cast("string")
        tier = F.when(F.col("spend") < 200000, "Bronze").when(F.col("spend") < 700000, "Silver").otherwise("Gold")
        return rows.select(
            F.concat(F.lit("c"), key).alias("customer_id"),
            F.concat(F.lit(" o'"), F.lower("c_mktsegment"), F.lit("-VAN "), key).alias("full_name"),
            F.concat(F.lit(" C"), key, F.lit("@Example.COM ")).alias("email"),
            F.lpad(key, 12, "0").alias("phone"), F.lower("c_mktsegment").alias("city"),
            F.concat(F.lit("nation "), F.col("c_nationkey").cast("string")).alias("province"),
            F.col("first").cast("date").alias("registration_date"), tier.alias("tier"), F.col("day").alias("partition_time"),
        )

    def _src_store_detail(self) -> DataFrame:
        years = F.array(*[F.lit(y) for y in YEARS])
        rows = self._suppliers().select("*", F.explode(years).alias("day"))
        key, day, area = F.col("s_suppkey"), F.col("day"), F.col("s_acctbal").cast("decimal(12,2)")
        text = key.cast("string")
        return rows.select(
            F.concat(F.lit("S"), text).alias("store_code"), F.col("s_name").alias("store_description"),
            F.lit("X").alias("country"), F.lit("area").alias("area"), F.lit("city").alias("city"),
            F.lit("district").alias("district"), F.lpad(text, 9, "0").alias("zip"),
            F.when(key % 3 == 0, "mall").otherwise("street").alias("channel_type"), area.alias("gross_area"),
            F.when((key % 6 == 0) & (day >= F.lit(YEARS[2])), area + 10).otherwise(area).cast("decimal(12,2)").alias("net_sales_area"),
            F.lit("m2").alias("area_unit"), text.alias("latitude"), F.col("s_nationkey").cast("string").alias("longitude"),
            F.lit(FIRST_MONTH).alias("opening_date"),
            F.when((key % 13 == 0) & (day >= F.lit(YEARS[5])), F.lit(YEARS[5])).alias("closing_date"),
            F.lit("EUR").alias("local_currency"),
            F.when((key % 4 == 0) & (day >= F.lit(YEARS[3])), "large").otherwise("small").alias("format"),
            day.alias("partition_time"),
        )

    def _sales_corrections(self) -> DataFrame:
        """Three loads of all sales: some orders arrive late, quantities and then prices are corrected."""
        loads = F.explode(F.array(*[F.lit(d) for d in CORRECTIONS])).alias("load")
        rows = self["fact_sales"].drop("partition_time").select("*", loads)
        order, second, third = F.col("order_id"), F.lit(CORRECTIONS[1]), F.lit(CORRECTIONS[2])
        price = F.when((order % 7 == 0) & (F.col("load") >= third), F.col("unit_price") + 1).otherwise(F.col("unit_price")).cast(PRICE)
        qty = F.when((order % 5 == 0) & (F.col("load") >= second), F.col("quantity") + 1).otherwise(F.col("quantity"))
        return rows.filter((order % 11 != 0) | (F.col("load") >= second)).select(
            "order_id", "order_date", "store_code", "customer_id", "product_id",
            qty.cast("bigint").alias("quantity"), price.alias("unit_price"), "total_amount", F.col("load").alias("partition_time"),
        )

    def _src_sales_files(self) -> DataFrame:
        """Sales as a monthly export leaves them: files, one directory per batch."""
        return self["src_sales"]

    def _sales_corrections_files(self) -> DataFrame:
        return self["sales_corrections"]

    # --- intermediate ------------------------------------------------------------------------------

    def _fact_sales(self) -> DataFrame:
        """All batches there are; no date of the test data limits it."""
        return facts.clean_sales(self["src_sales"])

    def _fact_by_batch(self) -> DataFrame:
        """The fact with one directory per batch."""
        return self["fact_sales"]

    def _code_history(self) -> DataFrame:
        return identity.build_code_history(self["src_store"], LAST_MONTH)

    def _store_seen_1998(self) -> DataFrame:
        """The stored state that the batch of January 1999 is merged into."""
        return identity.first_seen(upto_batch(self["src_store"], dt.date(1998, 12, 1)))

    def _dim_customer(self) -> DataFrame:
        return snapshots.customer_history(self["src_customer"])


_OPEN: dict[tuple, RetailTables] = {}


def _fingerprint(spark: SparkSession, sf_dir: str) -> tuple:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(sf_dir)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files))


def tables(spark: SparkSession, sf_dir: str) -> RetailTables:
    """Tables of a data directory. Stored ones are built once per session and state of the directory."""
    key = (spark.sparkContext.applicationId, sf_dir, _fingerprint(spark, sf_dir))
    if key not in _OPEN:
        _OPEN[key] = RetailTables(spark, sf_dir)
    return _OPEN[key]
