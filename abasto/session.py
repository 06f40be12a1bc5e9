"""Session settings the plans rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime settings. Months and timestamps are UTC, malformed values are errors, and joins on a hot key are split at
# run time even when the split costs one more exchange. A stage whose generated method is longer than what the JVM compiles
# (8,000 bytes of bytecode) is run operator by operator: the loads of wide text tables would be interpreted otherwise.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A one-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("abasto")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder for staged tables: the one the cluster names in ``spark.checkpoint.dir``.

    Spark gives every application a folder of its own below it; where that one is set, it is used, so that staged tables
    go when the application's checkpoints are cleared. Without either there is no folder all executors are known to reach:
    that is an error, except on one machine, where a folder in the warehouse will do.
    """
    named, own = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.getCheckpointDir()
    if own is not None and (named is None or _parts(own)[: len(_parts(named))] == _parts(named)):
        return own.rstrip("/")
    if named is None and spark.sparkContext.master.split("[")[0] == "local":
        return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/checkpoints"
    if named is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return named.rstrip("/")


def _parts(path: str) -> list[str]:
    """The folders of a path; a local path may come with or without its scheme."""
    return [part for part in path.removeprefix("file:").split("/") if part]
