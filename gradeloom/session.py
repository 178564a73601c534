"""Session settings the jobs rely on, and the one way they cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

#: Rows of a table kept by `gathered` that are one partition at least.
GATHERED = 1 << 14

#: What results depend on: epoch seconds become timestamps, one zone for all readers and writers.
RUNTIME_CONF = {"spark.sql.session.timeZone": "UTC"}

#: What suits a small machine, set by `local_session` alone; a cluster keeps its own.
LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    # windows cost more than their bytes: let small shuffles keep all cores busy
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    # split a hot join key even where that costs one more exchange
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # a log already split by (learner, course) joins on (learner, course, name) as it lies
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the local bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("gradeloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        # the running windows alone compile to more classes than the default 100
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in {**RUNTIME_CONF, **LOCAL_CONF}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tuned(spark)


def tuned(spark: SparkSession) -> SparkSession:
    """Set what results depend on in a session made elsewhere; its other settings stay."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def work_folder(spark: SparkSession) -> str:
    """The shared folder for intermediates: the one the cluster names in `spark.checkpoint.dir`.

    Only a session on one machine without that setting (tests) gets a temporary one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is not None:
        return named
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return context.getCheckpointDir()
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="gradeloom-checkpoint-"))
    return context.getCheckpointDir()


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A path below the work folder that nothing uses yet."""
    return f"{work_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write `df` once to the shared work folder and go on from there.

    A reliable checkpoint. Its files go when nothing refers to them any more, provided the session sets
    `spark.cleaner.referenceTracking.cleanCheckpoints`, as `local_session` does.
    """
    context = df.sparkSession.sparkContext
    folder = work_folder(df.sparkSession)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def gathered(df: DataFrame) -> DataFrame:
    """`materialize`, and then no more partitions than one for each GATHERED rows.

    A shuffle writes files for every partition it reads, whatever its rows, so steps over few rows read few partitions.
    """
    # counted, not observed: once a session has observed, Spark's forests can't send their tasks (not serializable)
    kept = materialize(df)
    return kept.coalesce(max(1, -(-kept.count() // GATHERED)))


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def send_package(spark: SparkSession) -> None:
    """Add this package's modules to the session's files, once a session, for tasks whose Python may not find it otherwise."""
    context = spark.sparkContext
    if getattr(context, "_gradeloom_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="gradeloom-"), "gradeloom_tasks.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(target)
    context._gradeloom_shipped = True
