"""Session helpers: local session for tests/bench, checkpoint dir, shared scratch paths.

On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS/S3/...). It is read
from the session. Only when it is unset in a local session do we point it at a fresh
local folder; on a cluster an unset folder is an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from domus.errors import ConfigError

_CKPT_KEY = "spark.checkpoint.dir"


def local_session(cpus: int | str | None = None, shuffle_partitions: int | None = None,
                  app: str = "domus") -> SparkSession:
    """A local session configured like the cluster one (AQE on, UTC, no UI)."""
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus) * 2))
        .config("spark.driver.memory", os.environ.get("DOMUS_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
        # Columns are built without looking up the caller's line each time (some 3 ms an expression)
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint root; set a local one only when none is configured."""
    sc = spark.sparkContext
    root = spark.conf.get(_CKPT_KEY, None) or sc.getConf().get(_CKPT_KEY, None)
    if not root:
        if not sc.master.startswith("local"):
            raise ConfigError("spark.checkpoint.dir is not set: name a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="domus-ckpt-")
        spark.conf.set(_CKPT_KEY, root)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written intermediate table, under the shared checkpoint root."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/domus-tables/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame) -> DataFrame:
    """Write a frame as Parquet under the shared checkpoint folder and read it back.

    Used where several jobs read one result: it is computed once, the lineage ends there (executors may
    be lost), and later jobs read only the columns they need.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
