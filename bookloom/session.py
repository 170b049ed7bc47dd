"""Session defaults and the one way in which this library cuts lineage."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session with the settings the operators expect: UTC, AQE with skew joins, no UI."""
    builder = (
        SparkSession.builder.master(master)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; where that is unset, one of our own, on a local master only.

    On a cluster a folder of this machine would be out of the executors' reach, so an unset one is an error there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="bookloom-")
        atexit.register(shutil.rmtree, named[7:], ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", named)
    return named


def materialize(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    The written table cuts the lineage, survives the loss of executors, and is
    deleted by :func:`release`, at the end of a block of :func:`freed`, else when
    the driver's JVM ends.
    """
    spark = df.sparkSession
    path = os.path.join(shared_folder(spark), f"bookloom-{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).deleteOnExit(jvm_path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written = path
    if _open:
        _open[-1].append(out)
    return out


_open: list[list[DataFrame]] = []


@contextmanager
def freed() -> Iterator[None]:
    """Delete the tables written inside once the block ends; results must be used up or saved by then."""
    _open.append([])
    try:
        yield
    finally:
        release(*_open.pop())


def release(*tables: DataFrame) -> None:
    """Delete tables written by :func:`materialize` that nothing reads any more; others are left alone."""
    for df in tables:
        if path := getattr(df, "_written", None):
            jvm_path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            jvm_path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(jvm_path, True)
            df._written = None
