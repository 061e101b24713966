"""The folder all executors share, for results that are read more than once."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from tillwise.sources.tables import delete_path, write_table

_OWN: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """This application's folder in ``spark.checkpoint.dir`` of the session.

    A local session, where driver and executors are one process, may leave the setting out and gets a
    temporary folder; elsewhere that is an error. The folder goes when the program ends, or with ``clear``.
    """
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured:
            _OWN[app] = f"{configured.rstrip('/')}/tillwise-{app}-{uuid.uuid4().hex[:8]}"
            atexit.register(clear, spark)
        elif spark.sparkContext.master.split("[")[0] == "local":
            _OWN[app] = tempfile.mkdtemp(prefix="tillwise-")
            atexit.register(shutil.rmtree, _OWN[app], ignore_errors=True)
        else:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _OWN[app]


def clear(spark: SparkSession) -> None:
    """Delete what ``store`` wrote for this application; DataFrames that read it can't be used afterwards."""
    if spark.sparkContext._jsc is None or spark.sparkContext._jsc.sc().isStopped():
        return
    path = _OWN.pop(spark.sparkContext.applicationId, None)
    if path:
        delete_path(spark, path)


def fresh_path(spark: SparkSession, name: str = "") -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_root(spark)}/{uuid.uuid4().hex}/{name}".rstrip("/")


def store(df: DataFrame, name: str, *, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once to the shared folder and read it from there; lost executors cost nothing."""
    path = fresh_path(df.sparkSession, name)
    write_table(df, path, partition_by=partition_by)
    return df.sparkSession.read.schema(df.schema).parquet(path)
