"""Session helpers.

Library operators never change session configuration as a side effect. The
helpers here are for the places that own a session: tests, ``bench.py`` and
command-line use.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Confs every local run of this library uses. On a cluster the deployment owns
# these; nothing in ``strata.operators`` relies on them being set.
LOCAL_CONFS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Delete checkpoint files once their DataFrames are garbage-collected.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def _default_driver_memory() -> str:
    """60 % of physical memory, between 2 and 16 GiB (local mode: the driver is the executor)."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    except (AttributeError, ValueError, OSError):
        return "4g"
    return f"{max(2, min(16, int(total * 0.6 / 2 ** 30)))}g"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "strata", extra: dict | None = None) -> SparkSession:
    """A ``local[cpus]`` session for tests and benchmarks."""
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("STRATA_DRIVER_MEMORY", _default_driver_memory())))
    for k, v in {**LOCAL_CONFS, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint directory, as ``spark.checkpoint.dir`` names it.

    On a cluster it has to be set, to a folder that the driver and every
    executor share. Only where the driver is the one executor (a ``local``
    master, as in tests) a fresh scratch folder is made when it is unset.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="strata-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir()


_SCRATCH: list[str | None] = []     # folders handed out by this process; None: deleted


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for written intermediates, under the checkpoint directory.

    Written tables must live on storage every executor can reach, so they go
    beside the checkpoints rather than in a machine-local temp folder.
    :func:`release_scratch` deletes them.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/strata-{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


def scratch_mark() -> int:
    """A mark for :func:`scratch_since`."""
    return len(_SCRATCH)


def scratch_since(mark: int) -> list[str]:
    """The scratch folders handed out since the mark, in order."""
    return [p for p in _SCRATCH[mark:] if p]


def delete_scratch(spark: SparkSession, paths: list[str]) -> None:
    """Delete scratch folders that nothing reads any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)
    # Folders are blanked, not taken out, so that marks taken before stay right.
    gone = set(paths)
    _SCRATCH[:] = [None if p in gone else p for p in _SCRATCH]


def release_scratch(spark: SparkSession) -> int:
    """Drop the ``strata_*`` tables and delete the scratch folders that this
    process made; returns how many folders it deleted. Call it when no
    DataFrame built on them is needed any more."""
    for t in spark.catalog.listTables():
        if t.name.startswith("strata_"):
            spark.sql(f"DROP TABLE IF EXISTS `{t.name}`")
    jvm, conf, gone = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), 0
    while _SCRATCH:
        name = _SCRATCH.pop()
        if name:
            path = jvm.org.apache.hadoop.fs.Path(name)
            gone += bool(path.getFileSystem(conf).delete(path, True))
    return gone


def materialize(df, name: str = "materialized"):
    """Write ``df`` as Parquet under the shared checkpoint folder and return it
    read back: the lineage is cut, and a lost executor re-reads files instead
    of recomputing upstream shuffles.

    Compared with ``DataFrame.checkpoint()`` (rows through the RDD checkpoint
    writer and ``spark.serializer``) this is columnar and compressed, and reads
    back with column pruning. Row order and partitioning are not kept; callers
    that need positions store them as columns first.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def conf_for(spark: SparkSession, key: str, value: str):
    """``with conf_for(...)``: one conf set for the block, then put back as it was."""
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)


def reliable_checkpoint(df):
    """``df.checkpoint(eager=True)`` into the session's checkpoint folder
    (registered from ``spark.checkpoint.dir`` when needed). Never a local
    checkpoint: executors may be lost."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
