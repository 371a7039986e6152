"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
#: The default 96-bit times carry no min/max, so files and row groups could not be skipped by time.
STAMPS = ("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")


def build_session(master: str | None = None, app: str = "hazgrid", **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; anything else is the cluster's to say.

    Shuffle parallelism stays with adaptive execution: it starts from
    ``spark.sql.shuffle.partitions`` and merges or splits by measured bytes.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config(*STAMPS)
        .config("spark.ui.enabled", "false")
        # a call-site record per column expression triples the driver's time to build a plan
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_utc(spark: SparkSession) -> None:
    """Event times are UTC throughout and stored with statistics; for sessions made elsewhere."""
    for key, value in (("spark.sql.session.timeZone", "UTC"), STAMPS):
        if spark.conf.get(key) != value:
            spark.conf.set(key, value)


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it.

    A machine-local folder is used only where everything runs on one machine anyway.
    """
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_KEY, None) or context.getCheckpointDir()
    if root:
        if not context.getCheckpointDir():
            context.setCheckpointDir(root)
        return root
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder all executors can reach")
    root = tempfile.mkdtemp(prefix="hazgrid-")
    context.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settled(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where an iterative job reads its input many times: the plan is cut, and
    a lost executor costs a re-read, not a recomputation.
    """
    path = scratch_path(df.sparkSession, name)
    df.hint("rebalance").write.parquet(path)  # files by size: one for a small table, many for a large one
    return df.sparkSession.read.schema(df.schema).parquet(path)
