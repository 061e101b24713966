"""Files of a clustered table that a lookup by one column has to open."""

import pytest
from pyspark.sql import functions as F

from tillwise.sources import tables


def opened(spark, path, col, value):
    """Share of the files whose range of ``col`` holds the value."""
    file = F.col("_metadata.file_path")
    ranges = spark.read.parquet(path).groupBy(file.alias("f")).agg(F.min(col).alias("low"), F.max(col).alias("high")).collect()
    return sum(r.low is not None and r.low <= value <= r.high for r in ranges) / len(ranges)


def test_each_key_alone_opens_few_files(spark, tmp_path):
    rows = spark.range(20_000).select(
        F.concat(F.lit("S"), F.lpad((F.xxhash64("id") % 500 + 500).cast("string"), 6, "0")).alias("store"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(700)).cast("int")).alias("day"), "id",
    )
    both, one = str(tmp_path / "both"), str(tmp_path / "one")
    tables.write_clustered(rows, both, ["store", "day"], files=16)
    rows.repartitionByRange(16, "store", "day").sortWithinPartitions("store", "day").write.parquet(one)
    written = spark.read.parquet(both)
    assert written.exceptAll(rows).isEmpty() and rows.exceptAll(written).isEmpty()
    some = rows.filter("id = 77").first()
    assert opened(spark, both, "store", some.store) <= 0.5 and opened(spark, both, "day", some.day) <= 0.5
    assert opened(spark, one, "day", some.day) > 0.9  # sorted by store first, every file holds every day


def test_nulls_hot_values_and_empty_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [("hot", i % 3 or None) for i in range(300)] + [(None, 5), ("b", None), (None, None)]
    df = spark.createDataFrame(rows, "k string, n int")
    for data in (df, df.limit(0), df.filter("n is null").select(F.lit(None).cast("string").alias("k"), "n")):
        tables.write_clustered(data, path, ["k", "n"], files=4)
        written = spark.read.schema(df.schema).parquet(path)
        assert sorted(map(str, written.collect())) == sorted(map(str, data.collect()))
    with pytest.raises(ValueError):
        tables.write_clustered(df, path, [], files=4)
