"""Session helpers shared by every operator."""

from __future__ import annotations

import io
import os
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()
_MADE: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the workers this package once per application, as ``--py-files`` would."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, f"{root.name}/{p.relative_to(root)}")
    fs, path = _path(spark, f"{work_folder(spark)}/millsheet.zip")
    out = fs.create(path, True)
    out.write(held.getvalue())
    out.close()
    sc.addPyFile(path.toString())
    _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the Parquet tables of a data folder."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Deals the rows of a few small files to all cores, for work that costs far more than its input's size.

    An input that has a part for every core, as any large one, stays as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only a local master, whose executors are this process, may do without: it takes a temporary folder. On a cluster a
    folder of the driver's machine would give back only a part of what was written, so there its absence is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if d:
        return d
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise ValueError(f"spark.checkpoint.dir must name a folder that all executors share (master {master})")
    d = os.path.join(tempfile.gettempdir(), "millsheet-shared")
    os.makedirs(d, exist_ok=True)
    return d


def _path(spark: SparkSession, path: str):  # noqa: ANN202
    """(file system, path) of Hadoop for a path."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def work_folder(spark: SparkSession) -> str:
    """This application's own folder in the shared folder; it is deleted when the application ends."""
    folder = f"{shared_folder(spark)}/millsheet-{spark.sparkContext.applicationId}"
    if folder not in _MADE:
        fs, p = _path(spark, folder)
        fs.mkdirs(p)
        fs.deleteOnExit(p)
        _MADE.add(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder and read it again.

    The files outlive the loss of any executor, and what reads them is planned afresh from their real size. They go with
    the application, or before by ``discard``.
    """
    spark = df.sparkSession
    path = f"{work_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def discard(df: DataFrame) -> None:
    """Deletes what ``cut`` wrote for ``df``, which nothing may read after that."""
    fs, p = _path(df.sparkSession, df._written_to)
    fs.delete(p, True)
