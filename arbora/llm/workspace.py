"""Tables that cut lineage, in the folder that every executor shares."""

from __future__ import annotations

import re
import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

#: For the write of a stored table only: small batches for Python workers, and no shuffle file outlives its query.
WRITING = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
_PATHS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's spark.checkpoint.dir. Where none is set, a folder of our own on one machine, and elsewhere an error."""
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        return conf
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    own = tempfile.mkdtemp(prefix="spark-arbora-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def table_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/arbora-{uuid.uuid4().hex}/{name}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written once as Parquet in the shared folder and read back, so that a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = table_path(spark, name)
    before = {k: spark.conf.get(k, None) for k in WRITING}
    try:
        for k, v in WRITING.items():
            spark.conf.set(k, v)
        df.write.option("compression", "zstd").parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    out = spark.read.schema(df.schema).parquet(path)
    _PATHS[out] = path
    return out


def discard(*tables: DataFrame) -> None:
    """Removes stored() tables that nothing will read again; what is made of them has to be stored already."""
    for df in tables:
        jvm = df.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(_PATHS.pop(df).rpartition("/")[0])
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
