"""Tables cut out of a plan's lineage, kept in the folder that the cluster shares.

The folder is the session's ``spark.checkpoint.dir``.  A local session without
one gets a temporary folder; a cluster without one is refused, because a
machine-local folder would be lost with its machine.
"""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of this session, without a trailing slash."""
    found = spark.conf.get(SETTING, None) or spark.sparkContext.getCheckpointDir()
    if found is None:
        master = spark.sparkContext.master
        if not master.startswith("local[") and master != "local":
            raise ValueError(f"set {SETTING} to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-granary-"))
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def col(name: str) -> Column:
    """The column of just this name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def by_number(df: DataFrame) -> DataFrame:
    """The same columns named c0, c1 and so on: a function over Arrow batches is given columns by bare name, which not every name stands."""
    return df.toDF(*(f"c{k}" for k in range(len(df.columns))))


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or that with as many underscores behind it as no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def cut(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` as Parquet to the shared folder and reads it back.

    What stands above the result is computed from these files, so a lost
    executor costs the tasks that read them and not the work before them.
    """
    path = written(df, name)
    out = read_back(df.sparkSession, path)
    out.granary_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables made by ``cut`` when all that was to be read from them has been written elsewhere."""
    for t in tables:
        drop(t.sparkSession, t.granary_path)


_journals: list[list[str]] = []


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The folders of the tables that are written meanwhile."""
    paths: list[str] = []
    _journals.append(paths)
    try:
        yield paths
    finally:
        _journals.remove(paths)


def written(df: DataFrame, name: str) -> str:
    path = f"{shared_dir(df.sparkSession)}/granary-{name}-{uuid.uuid4().hex}"
    for paths in _journals:
        paths.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return path


def read_back(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def drop(spark: SparkSession, path: str) -> None:
    """Deletes a table that no later result reads."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def let_go(spark: SparkSession) -> None:
    """Has Spark delete the shuffled files of results that are written and no longer referred to, which else stay until the driver's garbage happens to be collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
