"""Session construction, table loading and the shared checkpoint folder.

Library functions never create a session themselves: they take the
DataFrames they work on.  ``build_session`` is for tests, ``bench.py`` and
ad-hoc use; on a cluster the job's own session (with its own
``spark.checkpoint.dir``) is used as it is.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Settings every session of this library should have.  AQE coalesces small
# shuffle partitions and splits skewed join partitions at run time; ANSI mode
# makes bad casts fail loudly unless a ``try_`` function is used on purpose.
SESSION_DEFAULTS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str = "local[8]",
    app_name: str = "tessera",
    shuffle_partitions: int = 8,
    checkpoint_dir: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the library defaults (used by tests and bench)."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(SESSION_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "16g"))
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if checkpoint_dir is not None:
        ensure_checkpoint_dir(spark, checkpoint_dir)
    return spark


def partition_settings(input_bytes: int, total_cores: int, target_bytes: int = 256 << 20,
                       max_partitions: int = 1_000_000) -> dict[str, str]:
    """Scan-split and shuffle sizes for a job over ``input_bytes`` on
    ``total_cores`` task slots, so that partitions stay near ``target_bytes``
    (they must fit in one task's share of executor memory when sorted or
    aggregated).  The shuffle starts with enough partitions for the worst
    case (shuffle as large as the input) and AQE coalesces small ones and
    splits skewed ones at run time.

    100 TB on 8,000 cores: 256 MB splits, about 410,000 initial shuffle
    partitions, AQE target 256 MB, skew threshold 1 GB.
    """
    partitions = max(2 * total_cores, min(max_partitions, -(-input_bytes // target_bytes)))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_bytes),
    }


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names for checkpoints, if any."""
    value = spark.conf.get("spark.checkpoint.dir", None)
    if value:
        return value
    current = spark.sparkContext.getCheckpointDir()
    # the context adds a per-application subfolder; report the root
    return current.rsplit("/", 1)[0] if current else None


def ensure_checkpoint_dir(spark: SparkSession, fallback: str) -> str:
    """Use the session's checkpoint folder; set ``fallback`` only when unset.

    ``fallback`` is meant for tests and local runs.  On a cluster
    ``spark.checkpoint.dir`` names a shared folder and is never replaced.
    """
    current = checkpoint_dir(spark)
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    try:
        spark.conf.set("spark.checkpoint.dir", fallback)
    except Exception:  # noqa: BLE001 - a core setting some sessions refuse at run time
        pass
    spark.sparkContext.setCheckpointDir(fallback)
    return fallback


def require_checkpoint_dir(spark: SparkSession) -> str:
    """Checkpoint folder for jobs that cut lineage or keep streaming state."""
    current = checkpoint_dir(spark)
    if not current:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; name a shared folder for it "
            "(tests call ensure_checkpoint_dir with a scratch folder)"
        )
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return current


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the checkpoint folder; Spark removes it when the driver's JVM ends."""
    path = f"{require_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(folder)
    fs.deleteOnExit(folder)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below the checkpoint folder and read again:
    cuts the lineage and survives lost executors."""
    path = f"{run_folder(df.sparkSession, name)}/table"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the test tables; Catalyst prunes columns and pushes filters."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Attribute access to the tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark = spark
        self._dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return table(self._spark, self._dir, name)
