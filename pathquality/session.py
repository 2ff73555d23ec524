"""Session configuration the plans rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings: safe to set on a session somebody else created.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", app: str = "pathquality", **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession, fallback: str | None = None) -> str:
    """The folder every executor can reach. The cluster names it; only a session
    without the setting (a test) may use the fallback."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if fallback is None:
        raise ValueError("spark.checkpoint.dir is not set and no folder was given")
    return fallback


def materialise(df: DataFrame) -> DataFrame:
    """Compute once and cut the lineage, in the folder the cluster shares. Executors may be
    lost afterwards: the rows are in the file system, not in their memory."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="pathquality-"))
    return df.checkpoint(eager=True)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the shared one (a temporary one in local sessions)."""
    fallback = None
    if spark.sparkContext.master.startswith("local"):
        fallback = tempfile.gettempdir()
    return f"{shared_folder(spark, fallback).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def temporary(spark: SparkSession, folder: str) -> str:
    """The folder, which goes when the application ends."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path)  # only what exists is marked
    system.deleteOnExit(path)
    return folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write once to the folder the cluster shares and read it again: the lineage is cut, and
    executors lost later take nothing with them. The table goes when the application ends."""
    spark = df.sparkSession
    folder = scratch_folder(spark, name)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(temporary(spark, folder))
