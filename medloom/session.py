"""Session helpers: table access, shared checkpoints and size-checked broadcasts."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Upper bound in bytes of the estimated size of a table that may be broadcast.
BROADCAST_LIMIT = 8 * 1024 * 1024


def local_session(cores: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and benches."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("medloom")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Read one table; only ``columns`` reach the scan when they are given."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage through a reliable checkpoint in the folder all executors share.

    The folder is ``spark.checkpoint.dir`` of the session; a temporary one is
    made only where none is set and Spark runs inside this one process.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        named = sc.getConf().get("spark.checkpoint.dir")
        if named is None:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            named = tempfile.mkdtemp(prefix="medloom-checkpoint-")
        sc.setCheckpointDir(named)
    return df.checkpoint(eager=True)


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimised plan."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Hint a broadcast only where the estimated size is within ``limit``; else a shuffle join."""
    return F.broadcast(df) if estimated_bytes(df) <= limit else df


def tokenizer_path(name: str, folder: str | None = None) -> str:
    """Path of a public vocabulary file; the folder is a parameter, never copied here."""
    return os.path.join(folder or os.environ.get("MEDLOOM_TOKENIZERS", "/opt/tokenizers"), name)
