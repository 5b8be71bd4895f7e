"""Session helpers: sensible defaults, and intermediate tables that survive executor loss."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# Runtime settings every session should have.  A generated method above 8000 bytes
# of bytecode is never compiled by the JVM; Spark then splits the code instead.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made elsewhere."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def local_session(name: str = "cairn", cores: str = "*", shuffle_partitions: int = 8):
    """A local session for tests and the bench; a cluster job brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    )
    return tune(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the session names in ``spark.checkpoint.dir``.

    Only when it is unset and the session runs on one machine, as in tests, is a
    temporary folder used.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="spark-ckpt-", dir="/tmp"))
    return sc.getCheckpointDir()


def stored(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and read them back.

    For a table that several branches read: it is computed once, survives lost
    executors, and each branch reads only its columns.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
