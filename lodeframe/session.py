"""SparkSession construction with the settings every operator assumes."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app: str = "lodeframe", cores: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "8g", **extra: str) -> SparkSession:
    """A local session; on a cluster the submitter's own settings win over these."""
    builder = SparkSession.builder.appName(app).master(f"local[{cores}]")
    settings = SETTINGS | {"spark.sql.shuffle.partitions": str(shuffle_partitions),
                           "spark.driver.memory": driver_memory} | extra
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
