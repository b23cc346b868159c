"""Session helpers: recommended settings and the checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

# Settings a job should run with. Nothing here depends on the machine: the number
# of shuffle partitions is only an upper bound, AQE coalesces or splits from there.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "false",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, name: str = "netforensics") -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    spark = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        # Small results of costly expressions stay spread over the cores.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
        # Call sites for error messages cost more than building the plans does.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_settings(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings the operators rely on (UTC, lenient casts, AQE)."""
    for key, value in RECOMMENDED.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; a temporary one only where a local session names none."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
            folder = tempfile.mkdtemp(prefix="netforensics-checkpoint-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, for tables that are written and read again."""
    return f"{checkpoint_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read again: rows that several steps read, or the small side of joins.

    Spark then plans with its true size from the start: a small table is broadcast and the large side
    of the join is never shuffled by a few keys; one that is not small is joined by a plain shuffle.
    The files are compressed with zstd, because ids and texts take about a third less disk than with snappy.
    """
    folder = work_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def packed(writer: DataFrameWriter) -> DataFrameWriter:
    """A writer of text files that are compressed by fast gzip: for files a job writes only to read them again."""
    return writer.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage of `df` in the shared folder."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)
