"""Session helpers: checkpoint folder resolution and a local session for tests."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder named by the cluster.

    Order: an already-set SparkContext checkpoint folder, then the
    ``spark.checkpoint.dir`` setting.  Only a local-mode session (tests,
    bench) may fall back to a fresh temporary folder; on a cluster a missing
    setting is an error, because a machine-local folder does not survive the
    loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if sc.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="lodestar-ckpt-")
        sc.setCheckpointDir(folder)
        return folder
    raise RuntimeError(
        "spark.checkpoint.dir is not set; point it at a shared folder (HDFS/S3/ABFS)"
    )


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Materialise ``df`` into the shared checkpoint folder and cut its lineage.

    Used where later steps must see exactly the same rows and partitioning as
    an earlier action (e.g. offsets computed from per-partition counts).
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written_rows(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet into the shared checkpoint folder and read it back.

    For inputs of several passes whose last join already spreads the rows: as
    ``reliable_checkpoint``, but in compressed columns, of which a pass reads
    those it needs.
    """
    folder = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "lodestar") -> SparkSession:
    """Local session with the settings used by tests and the bench."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark
