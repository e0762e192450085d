"""Session helpers: a local session for tests and tools, and lineage cutting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app: str = "fallowlens", **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def materialize(df: DataFrame) -> DataFrame:
    """Store ``df`` reliably and cut its lineage.

    The folder is the shared one named by ``spark.checkpoint.dir``, which must be set.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        sc.setCheckpointDir(folder)
    return df.checkpoint(eager=True)
