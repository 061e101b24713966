"""Source scans and table sinks on parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.schemas import SOURCES


def read_source(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A registered source table with its declared schema; no inference pass over the files."""
    return spark.read.schema(SOURCES[name]).parquet(path)


def write_table(
    df: DataFrame, path: str, *, partition_by: Sequence[str] = (), sort_by: Sequence[str] = (), mode: str = "overwrite"
) -> None:
    """Write parquet laid out for its readers.

    With ``partition_by`` rows are rebalanced on those columns first: each directory gets few files,
    and the adaptive planner splits a directory that holds much more than the others, so a hot
    month does not end up in one task. With ``sort_by`` alone rows are dealt out by ranges of those
    columns, so that a lookup by key opens the files of its range only; inside files they are sorted
    too. Overwriting replaces the whole table, whatever the session says about partitions.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    elif sort_by:
        df = df.repartitionByRange(*sort_by)
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    df.write.mode(mode).option("partitionOverwriteMode", "static").partitionBy(*partition_by).parquet(path)


def _cuts(df: DataFrame, col: str, bits: int) -> list:
    """Least values of ``2**bits`` ranges with about as many distinct values each, without the first; NULL is in the first."""
    ranges = df.select(F.col(col).alias("v")).filter("v is not null").distinct().repartitionByRange(2**bits, "v")
    least = ranges.groupBy(F.spark_partition_id()).agg(F.min("v").alias("v")).collect()
    return sorted(row.v for row in least)[1:]


def _range_number(col: Column, cuts: list) -> Column:
    """How many cuts are at or below the value, by halving."""
    def below(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(col >= F.lit(cuts[middle]), below(middle + 1, high)).otherwise(below(low, middle))
    return below(0, len(cuts))


def write_clustered(df: DataFrame, path: str, cluster_by: Sequence[str], *, files: int, bits: int = 6) -> None:
    """Write parquet that a lookup by any one of the ``cluster_by`` columns reads in part only.

    Each column is cut into at most ``2**bits`` ranges; the bits of the range numbers are interleaved, and rows are
    dealt out to ``files`` by ranges of that number, so a file holds a short stretch of every column. The cuts, not the
    rows, come to the driver. ``df`` is read once per column and once to be written.
    """
    if not cluster_by or bits * len(cluster_by) > 62:
        raise ValueError("name the columns, and at most 62 bits for all of them")
    numbers = [_range_number(F.col(c), _cuts(df, c, bits)).cast("bigint") for c in cluster_by]
    mixed = F.lit(0).cast("bigint")
    for bit in range(bits):
        for place, number in enumerate(numbers):
            single = F.shiftright(number, bit).bitwiseAND(F.lit(1).cast("bigint"))
            mixed = mixed.bitwiseOR(F.shiftleft(single, bit * len(numbers) + len(numbers) - 1 - place))
    order = [mixed, *cluster_by]
    df.repartitionByRange(files, *order).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def append_rows(df: DataFrame, path: str, *, partition_by: Sequence[str] = ()) -> None:
    write_table(df, path, partition_by=partition_by, mode="append")


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def delete_path(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


# --- files behind a table --------------------------------------------------------------------------

_FILE = {"path": "_metadata.file_path", "size": "_metadata.file_size", "modified": "_metadata.file_modification_time"}


def source_files(df: DataFrame, batch_col: str = "partition_time") -> DataFrame:
    """``(path, size, modified, batch)`` of the files that ``df`` reads, from Spark's hidden file columns.

    No column of the data is read if ``batch_col`` is a directory. ``df`` may be filtered, but not projected.
    """
    try:
        files = df.select(*[F.col(c).alias(name) for name, c in _FILE.items()], F.col(batch_col).alias("batch"))
    except AnalysisException as e:
        raise ValueError("the table has to be read from files, without a projection") from e
    return files.distinct()


def rows_of_files(df: DataFrame, paths: Sequence[str]) -> DataFrame:
    """The rows of some files; other files are not opened."""
    return df.filter(F.col("_metadata.file_path").isin(*paths))
