"""Session helpers: a local session for tests and benches, and checkpoint-dir resolution.

On a cluster the caller owns the session; the library only reads its settings.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, shuffle_partitions: int | None = None, app: str = "paritas",
                  call_site_capture: bool = False) -> SparkSession:
    """Session for tests and benches on one machine (UI off, AQE on).

    PySpark's DataFrame debugging records the Python call site of every Column function
    (a stack walk and extra JVM calls each); plans here are built from many small
    expressions, so it is off unless asked for.
    """
    parts = shuffle_partitions or cores
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.python.sql.dataFrameDebugging.enabled", str(call_site_capture).lower())
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory of this session.

    Uses ``spark.checkpoint.dir`` when the cluster names one. Only a local master
    (tests, benches) gets a scratch directory of its own; on a cluster a missing
    setting is an error, since a machine-local folder would not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder (HDFS, object store)")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="paritas-ckpt-", dir="/tmp"))
    return sc.getCheckpointDir()


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Materialise ``df`` to the shared checkpoint directory and cut its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def reliable_table(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared checkpoint directory and read back. Cuts the lineage as a
    checkpoint does, and also what the optimizer knows about the columns: in a loop that computes
    columns from columns that knowledge multiplies each round, and planning with it."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
