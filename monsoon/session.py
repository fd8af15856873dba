"""Session settings and the shared scratch location."""

from __future__ import annotations

import atexit
import json
import math
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Recording the Python call site of every column takes longer than planning the query.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    **ADAPTIVE,
}

# For large inputs on a cluster. Bigger splits keep the number of map tasks, and with it
# the driver's shuffle bookkeeping, in bounds.
CLUSTER = {
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
}

# Shuffles start with so many partitions, or as many as keep a shuffle of the whole input at
# so many bytes each; adaptive execution joins them where there is little data.
FIRST_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
LEAST_PARTITIONS, PARTITION_BYTES = 4096, 256 << 20

ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# A stream's state lies in so many partitions: what the first setting says, or as many as there
# are cores, though not under the least, nor more than the session's shuffles have.
STATE_PARTITIONS, SHUFFLE_PARTITIONS = "spark.monsoon.state.partitions", "spark.sql.shuffle.partitions"
LEAST_STATE_PARTITIONS = 32

_local_roots: dict[str, str] = {}


def session(app: str = "monsoon", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings every job here assumes.

    On a cluster the sizes in ``CLUSTER`` are added where the cluster sets none.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if not _is_local(spark):
        widen(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def widen(spark: SparkSession) -> None:
    for key, value in CLUSTER.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def widen_for(spark: SparkSession, *paths: str) -> None:
    """Size the first partitions of shuffles by the bytes below the paths, on a cluster
    that does not set them itself."""
    if _is_local(spark) or spark.conf.get(FIRST_PARTITIONS, None) is not None:
        return
    size = 0
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = place.getFileSystem(spark._jsc.hadoopConfiguration())
        for found in files.globStatus(place) or ():
            size += files.getContentSummary(found.getPath()).getLength()
    spark.conf.set(FIRST_PARTITIONS, str(first_partitions(size)))


def first_partitions(size: int) -> int:
    return max(LEAST_PARTITIONS, math.ceil(size / PARTITION_BYTES))


def stateful(spark: SparkSession) -> dict[str, str]:
    """The settings to start a stream with state under.

    Every batch opens and commits each partition of the state, be it empty, and deals what is
    new in each to as many partitions again. So their number follows the cores, not the input.
    A stream that has a checkpoint keeps the number it began with.
    """
    cores = spark.sparkContext.defaultParallelism
    shuffled = int(spark.conf.get(SHUFFLE_PARTITIONS))
    own = spark.conf.get(STATE_PARTITIONS, None) or min(shuffled, max(LEAST_STATE_PARTITIONS, cores))
    return {**ROCKSDB, SHUFFLE_PARTITIONS: str(own)}


@contextmanager
def using(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Apply session settings for the duration of a block."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def _scratch_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session without that setting gets a folder of its own; a
    machine-local folder on a cluster would scatter the files over the nodes.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not _is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    sc = spark.sparkContext
    if sc.applicationId not in _local_roots:
        root = _local_roots[sc.applicationId] = tempfile.mkdtemp(prefix="monsoon-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
    return _local_roots[sc.applicationId]


def scratch(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared scratch folder."""
    return f"{_scratch_root(spark)}/monsoon/{label}-{uuid.uuid4().hex}"


def matches(spark: SparkSession, pattern: str) -> bool:
    """Whether any file or directory matches, on whatever file system the path names."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return found is not None and len(found) > 0


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file whole, over one of the same name, on whatever file system it is."""
    jvm = spark._jvm
    place, draft = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}._draft")
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    out = files.create(draft, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    files.delete(place, False)
    files.rename(draft, place)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The identity that a stream's checkpoint keeps over restarts."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first().value)["id"]


def settle(df: DataFrame) -> DataFrame:
    """Checkpoint a small result that several outputs read, so it is computed once."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(_scratch_root(df.sparkSession))
    return df.checkpoint()
