"""Written intermediate tables: the lineage cut used by all operators here.

Tables go below ``spark.checkpoint.dir``, the folder that the driver and all
executors share, so they survive a lost executor. Only where that setting is
unset (tests, local mode) a folder under /tmp is set.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOCAL_FALLBACK = "/tmp/vellumry-checkpoints"


def shared_dir(spark: SparkSession) -> str:
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = LOCAL_FALLBACK
    return f"{base.rstrip('/')}/vellumry-{spark.sparkContext.applicationId}"


def materialize(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet below the shared folder and read it back."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of an Arrow batch at most, but for its last row.
BATCH_BYTES = 2 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Let the session hand rows to Python in batches of BATCH_BYTES at most, or fewer if it is set so.

    Else a batch holds 10,000 rows of any size, of which the JVM and the worker both keep copies. The rows are the same.
    """
    now = int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(_BATCH)))
    if not 0 < now <= BATCH_BYTES:
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def small_table(spark: SparkSession, rows: list[tuple], columns: dict[str, pa.DataType]) -> DataFrame:
    """Rows of the driver as a table. They go through Arrow: a list would start workers of another kind on the executors, which stay."""
    values = zip(*rows) if rows else [()] * len(columns)
    return spark.createDataFrame(pa.table({k: pa.array(list(v), t) for (k, t), v in zip(columns.items(), values)}))


#: Ids that are broadcast at most: about 30 MB as a hash table.
MOST_BROADCAST_IDS = 1_000_000


def only(docs: DataFrame, ids: DataFrame, name: str = "doc_id") -> DataFrame:
    """The rows of docs whose id is among ids (a written table of distinct ids with one column of that name).

    ids are counted: up to MOST_BROADCAST_IDS of them are sent to the scan of
    docs, so texts that aren't needed are never shuffled; more meet docs in a
    shuffle join. The rows are the same.
    """
    few = ids.count() <= MOST_BROADCAST_IDS
    return docs.join(F.broadcast(ids) if few else ids, name, "left_semi")
