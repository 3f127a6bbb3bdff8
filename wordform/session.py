"""Session and lineage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None, app: str = "wordform") -> SparkSession:
    """Session with AQE on and the UI off; reuses an active session."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (
        b.config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster
    (``spark.checkpoint.dir``); only when it is unset (local tests) create a
    scratch folder of our own."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a folder on shared storage that every executor can reach"
            )
        # local mode only (tests): a scratch folder of our own
        conf_dir = tempfile.mkdtemp(prefix="wordform-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def share_code(spark: SparkSession) -> None:
    """Let Python workers import this package wherever the driver was started.
    (On a cluster, install the package or ship it with ``--py-files``.)"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    known = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([root, *known])


#: Paths that the current ``cut_scope`` owns; None outside of one.
_SCOPE: ContextVar[list[str] | None] = ContextVar("cut_scope", default=None)


def cut_lineage(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as a Parquet table under the shared checkpoint folder and
    return it re-read.

    One computation (``DataFrame.checkpoint`` computes its input twice: once
    for the triggering count, once for the write), the result survives
    executor loss, and the re-read table carries exact size statistics.
    Inside a ``cut_scope`` the table belongs to that scope; outside of one it
    stays until the folder is cleaned."""
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/wordform-{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    owned = _SCOPE.get()
    if owned is not None:
        owned.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def cut_scope(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Owns the tables that ``cut_lineage`` writes inside the ``with`` block and
    deletes them at its end, also after a failure (through the Hadoop
    FileSystem API, so on any shared store). Tables of other runs stay. Yields
    a ``cut_lineage`` whose tables outlast the block: they belong to the
    enclosing scope, if there is one."""
    paths: list[str] = []
    enclosing = _SCOPE.get()
    token = _SCOPE.set(paths)

    def keep(df: DataFrame, name: str = "table") -> DataFrame:
        out = cut_lineage(df, name)
        path = paths.pop()
        if enclosing is not None:
            enclosing.append(path)
        return out

    try:
        yield keep
    finally:
        _SCOPE.reset(token)
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for path in paths:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)
