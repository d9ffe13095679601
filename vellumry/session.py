"""Session and table helpers shared by queries, tests and the bench."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def build_session(cpus: int = 8, app: str = "vellumry", **conf: str) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    b = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEM", "8g"))
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Where a local session cuts lineage if spark.checkpoint.dir is unset; clusters name a shared folder there.
LOCAL_CHECKPOINTS = "/tmp/vellumry-checkpoints"


def set_checkpoint_dir(spark: SparkSession) -> None:
    """Make checkpoint() usable: the folder that spark.checkpoint.dir names, or in local sessions without it one of our own."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = sc.getConf().get("spark.checkpoint.dir", None)
        if not folder:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
            folder = LOCAL_CHECKPOINTS
        sc.setCheckpointDir(folder)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A folder of this application's own, with a name of its own, where driver and executors both read and write."""
    set_checkpoint_dir(spark)
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or LOCAL_CHECKPOINTS
    return f"{base.rstrip('/')}/vellumry-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of the data folder, read by Spark (any store)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
