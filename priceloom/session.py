"""SparkSession construction and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
import warnings
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings the engine relies on.  AQE re-plans joins from runtime sizes
# (a small side becomes a broadcast only once its real size is known),
# coalesces small shuffle partitions and splits skewed join partitions.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # A task of 64 MB of compressed shuffle (the default) sorts 1.5 million
    # sales of 400 bytes, beside the sort of its join: more than its share of
    # the memory of an executor of 10 GB with 4 cores, so it would spill.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Spark 4 records the Python call site of every Column operation for
    # error messages, at several JVM round trips each; plan building is
    # driver time that does not shrink with the cluster, so it is off.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "priceloom", extra: dict[str, str] | None = None) -> SparkSession:
    """Local / test session.  On a cluster, use the cluster's session and only
    apply ``ENGINE_CONF`` (see ``configure``)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(ENGINE_CONF)
    conf["spark.ui.enabled"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply runtime SQL settings to an existing session.  Results depend on
    some of them, so one that can't be set and differs is reported."""
    for k, v in ENGINE_CONF.items():
        if spark.conf.isModifiable(k):
            spark.conf.set(k, v)
        elif spark.conf.get(k, None) != v:
            warnings.warn(f"{k} is fixed at {spark.conf.get(k, None)} in this session, not {v}", stacklevel=2)
    return spark


def configure_for_scale(spark: SparkSession, fact_bytes: int,
                        target_partition_bytes: int = 256 * 1024 ** 2,
                        max_shuffle_partitions: int | None = None) -> dict[str, str]:
    """Size scan and shuffle partitions for a fact table of ``fact_bytes``.

    Scan splits and AQE's advisory shuffle size are set to the target; the
    initial shuffle partition count is the fact size over the target
    (no ceiling unless the caller gives one), and AQE coalesces down from it and splits skewed partitions
    above it.  ``parallelismFirst=false`` makes coalescing honour the target
    size instead of maximising task count.  Returns the settings applied.
    """
    parts = max(200, -(-fact_bytes // target_partition_bytes))
    if max_shuffle_partitions is not None:
        parts = min(parts, max_shuffle_partitions)
    conf = {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
    }
    configure(spark)
    for k, v in conf.items():
        spark.conf.set(k, v)
    return conf


def local_master(master: str) -> bool:
    """True for ``local``, ``local[n]``, ``local[*]`` and ``local[n,f]``: one
    machine, where a private folder is visible to every task."""
    return master == "local" or master.startswith("local[")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must already be set to shared storage and is only
    read; without it a cluster run fails fast.  A private fallback folder
    is created only for a local master with the setting absent (tests,
    local runs).
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not d:
        d = sc.getCheckpointDir()
    if not d:
        if not local_master(sc.master):
            # A driver-local folder is invisible to executors on other
            # machines: refuse instead of writing stage tables there.
            raise RuntimeError("spark.checkpoint.dir is not set; on a cluster it must name shared storage")
        d = tempfile.mkdtemp(prefix="priceloom-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # core setting may be read-only at runtime
            pass
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


_STAGES_IN: ContextVar[str | None] = ContextVar("stages_in", default=None)


@contextmanager
def stages_in(folder: str) -> Iterator[None]:
    """Stage tables written inside this context lie in ``folder`` (a place in
    the shared checkpoint folder), so that they can be deleted together."""
    token = _STAGES_IN.set(folder)
    try:
        yield
    finally:
        _STAGES_IN.reset(token)


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Deletes a folder of stage tables through the session's file system."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def fingerprint(spark: SparkSession, paths: list[str]) -> tuple:
    """Size, file count and time of change of each path: equal as long as the
    data there is the same."""
    out = []
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        store = where.getFileSystem(spark._jsc.hadoopConfiguration())
        found = store.getContentSummary(where)
        out.append((path, found.getLength(), found.getFileCount(), store.getFileStatus(where).getModificationTime()))
    return tuple(out)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written stage tables."""
    base = _STAGES_IN.get() or checkpoint_dir(spark)
    if "://" in base:
        return base.rstrip("/") + "/" + name
    return os.path.join(base, name)


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """What is run inside, is run with this setting of the session."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def freed_shuffles(spark: SparkSession):
    """The shuffle files of what is run inside go when it ends, not when the
    driver next collects garbage: for writes, whose plan isn't run again."""
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: cuts the lineage (a lost executor recomputes from these files, not
    from the raw inputs) and keeps column pruning / filter pushdown for the
    readers, which an RDD checkpoint would lose."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")
    with freed_shuffles(spark):
        df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
