"""Tables that cut lineage in iterative plans, written where all executors can read them."""

from __future__ import annotations

import re
import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

_PATHS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's spark.checkpoint.dir; where none is set, a folder of our own on one machine, and elsewhere an error."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="spark-arbora-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", base)
    return base


def stored(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/arbora-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _PATHS[out] = path
    return out


def discard(*tables: DataFrame | None) -> None:
    """Removes stored() tables that nothing will read again; what is made of them has to be stored already."""
    for df in tables:
        if df is not None and (path := _PATHS.pop(df, None)):
            folder = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path.rpartition("/")[0])
            folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)
