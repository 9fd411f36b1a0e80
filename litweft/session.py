"""Session set-up and the few helpers that every plan needs."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


_ROOTS: set[str] = set()
_SCOPES: list[str] = []


def get_session(app: str = "litweft", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the plans are written for; on a cluster, submit-time settings win.

    Only correctness-relevant settings are fixed here (UTC). Partition counts are left to AQE: the
    initial number is deliberately generous on a cluster and coalesced at run time.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    return b.config(map={**base, **conf}).getOrCreate()


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Scan of one table of a data directory; pruning and pushdown are left to Catalyst."""
    return spark.read.parquet(f"{root}/{name}.parquet")


def spread(df: DataFrame, mb_per_task: int = 1) -> DataFrame:
    """A small scan dealt out to all cores before work that is heavy per row.

    A table of a few MB is one partition, whatever its rows cost; inputs with at least ``mb_per_task`` per
    core are left as the scan splits them, so large tables are never shuffled here.
    """
    n = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(n) if size < n * mb_per_task * 1_000_000 else df


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, as named by the cluster in ``spark.checkpoint.dir``.

    Where the setting is absent (tests, notebooks) a local folder is made once per session and
    written back to the session, so that every operator uses the same one.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or os.environ.get("LITWEFT_SHARED_DIR")
    if not d:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="litweft-")
        spark.conf.set("spark.checkpoint.dir", d)
    return d.rstrip("/")


def temporary_root(spark: SparkSession) -> str:
    """The application's own folder for intermediate tables, in shared storage; removed when the driver ends."""
    root = f"{shared_dir(spark)}/litweft-{spark.sparkContext.applicationId}"
    if root not in _ROOTS:
        _ROOTS.add(root)
        atexit.register(release, spark, root)
    return root


def release(spark: SparkSession, root: str | None = None) -> None:
    """Delete the application's intermediate tables. Frames that read them can no longer be used."""
    root = root or temporary_root(spark)
    try:
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # the JVM is gone already
        shutil.rmtree(root.removeprefix("file://"), ignore_errors=True)


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables written inside the block are deleted at its end.

    Frames made inside must be written or collected before. For long sessions; without it they stay until the
    driver ends. Blocks may be nested; they belong to one thread.
    """
    root = f"{temporary_root(spark)}/scope-{uuid.uuid4().hex}"
    _SCOPES.append(root)
    try:
        yield
    finally:
        _SCOPES.remove(root)
        release(spark, root)


def materialise(df: DataFrame, name: str = "tmp") -> DataFrame:
    """Cut the lineage by writing to the shared folder and reading back.

    Unlike a local checkpoint the result outlives any executor. Temporary tables of a session sit
    under one folder per call; they are as large as the frame itself, so callers materialise only
    aggregated or narrow frames that are read more than once.
    """
    spark = df.sparkSession
    path = f"{_SCOPES[-1] if _SCOPES else temporary_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def exchange_partitions(spark: SparkSession) -> int:
    """Number of partitions for an explicit exchange whose consumer is a Python operator (AQE does not
    coalesce those below what is asked here)."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), spark.sparkContext.defaultParallelism)
