"""Session factory."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def session(master: str = "local[8]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session with the engine's defaults; ``conf`` overrides them (underscores stand for dots)."""
    b = SparkSession.builder.master(master).appName("tallgrass")
    settings = DEFAULTS | {"spark.sql.shuffle.partitions": str(shuffle_partitions), "spark.driver.memory": "8g"}
    settings |= {k.replace("_", "."): v for k, v in conf.items()}
    spark = b.config(map=settings).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
