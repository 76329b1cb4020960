"""Session helpers shared by the command line, the bench and the tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Settings the plans rely on; everything else is left to the cluster.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cores: int = 8, partitions: int = 8, memory: str = "4g", **conf: str) -> SparkSession:
    """A local session for tests and benches; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("tessera")
    settings = {
        **REQUIRED,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.driver.memory": memory,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A Parquet table of the data folder; the path goes to Spark's reader only."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
