"""Reliable materialisation of intermediate results.

A result that several later steps read (a fitted model, a shared term
table) is written once as a parquet table under the session's checkpoint
folder (``spark.checkpoint.dir`` -- a shared folder on a cluster) and read
back.  That removes repeated recomputation, cuts the lineage (a lost
executor never forces the upstream plan to re-run), and gives the optimizer
the table's real size, so joins against a small model are broadcast on
evidence rather than on a guess.  Executor-local checkpoints are never used.

Tables stay until :func:`release` removes those of the application; a job
calls it when its results are written.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from insight.session import ensure_checkpoint_dir


#: Times that the tables of this process were removed.
_released = 0


def tables_root(spark: SparkSession) -> str:
    """The folder of the application's stored tables; another one after each :func:`release`."""
    app = "".join(c if c.isalnum() else "-" for c in spark.sparkContext.applicationId)
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/insight-{app}-{_released}"


def materialize(df: DataFrame, name: str = "table", compression: str = "zstd") -> DataFrame:
    """Write ``df`` under the checkpoint folder and return a scan of it."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.mode("error").option("compression", compression).parquet(path)
    return spark.read.parquet(path)


def release(spark: SparkSession) -> None:
    """Remove every table this application has materialised."""
    global _released
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(tables_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    _released += 1


def new_folder(spark: SparkSession, name: str) -> str:
    """A path under the checkpoint folder that nothing has used; :func:`release` removes it too."""
    return f"{tables_root(spark)}/{name}-{uuid.uuid4().hex}"
