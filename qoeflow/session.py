"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs are tuned for. AQE re-plans joins from real sizes, coalesces
# small shuffle partitions and splits skewed ones, also when that adds a shuffle
# before the aggregate that follows the join.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}
# Those the plans rely on to spread hot groups.
REQUIRED = tuple(k for k in RECOMMENDED_CONF if ".adaptive." in k and "coalesce" not in k)


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "qoeflow") -> SparkSession:
    """A local session for tests and the benchmark (no UI)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("QOE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def require(spark: SparkSession) -> None:
    """Set what the job's plans rely on, where the session has it otherwise."""
    for key in REQUIRED:
        if spark.conf.get(key, None) != RECOMMENDED_CONF[key]:
            spark.conf.set(key, RECOMMENDED_CONF[key])


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share for hand-off tables: ``spark.checkpoint.dir`` where the
    cluster names one, else a folder in the session's warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir')}/_shared").rstrip("/")


def handoff_dir(spark: SparkSession) -> str:
    """Where this application's hand-off tables are; ``drop_handoffs`` ends their life."""
    return f"{shared_dir(spark)}/qoeflow-handoff/{spark.sparkContext.applicationId}"


def handoff(df: DataFrame, name: str) -> DataFrame:
    """Write a table that several stages read, and read it back: columnar, so each reader scans only
    its columns, and with real sizes for the planner."""
    spark = df.sparkSession
    path = f"{handoff_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_handoffs(spark: SparkSession) -> None:
    """Delete the hand-off tables of this application."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(handoff_dir(spark))
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
