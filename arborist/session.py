"""Session-level helpers: lineage cuts and the size bound for broadcasts."""

from __future__ import annotations

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.utils import is_remote

# A side is broadcast only when its size is proven to be at most this many
# rows and this many cells (rows x columns).  Every broadcast of the fit and
# of routing is of a part of the tree cut to these bounds: larger trees are
# worked through in batches, never by a shuffle on a node id.
BROADCAST_ROW_LIMIT = 1 << 16
BROADCAST_CELL_LIMIT = 1 << 22


def checkpoint_dir(spark: SparkSession) -> str | None:
    """Return the shared checkpoint folder named by the session.

    ``spark.checkpoint.dir`` (or an earlier ``setCheckpointDir``) is used as
    is.  Only a local-mode session without one gets a folder in its
    warehouse; a cluster session without a shared folder is an error,
    because a machine-local folder would not survive the loss of an
    executor.  A Spark Connect session has no driver context here: its
    server's setting applies, and ``None`` is returned.
    """
    if is_remote():
        return None
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a folder shared by the cluster "
                "(HDFS, S3, ...) before fitting"
            )
        configured = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_arborist_checkpoints"
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage.

    The input is persisted for the duration of the write: an eager
    checkpoint runs one job to compute the rows and another to write them,
    and without the cache the second would compute them again.
    """
    checkpoint_dir(df.sparkSession)
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return df.checkpoint(eager=True)
    finally:
        df.unpersist()


def persisted(df: DataFrame) -> DataFrame:
    """Persist ``df``: the first job that reads it computes it, and the caller
    unpersists it.

    For per-level intermediates and column-pruned inputs whose lineage is
    one scan and a few aggregations: a lost cached block is recomputed from
    that short lineage, so nothing needs writing out.
    """
    return df.persist(StorageLevel.MEMORY_AND_DISK)


# Inputs estimated below this many bytes are dealt over all cores; so many bytes a task.
SPREAD_BYTES = 256 << 20
SPREAD_TASK_BYTES = 1 << 20


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt round-robin over the cores if it is small: a file of few
    row groups gives few tasks, and a fit reads its input many times.
    Larger inputs keep the partitions of their scan.  Spark's own estimate
    of the plan's size decides, without a job."""
    if is_remote():
        return df
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size > SPREAD_BYTES:
        return df
    tasks = min(df.sparkSession.sparkContext.defaultParallelism, -(-size // SPREAD_TASK_BYTES))
    return df.repartition(tasks) if tasks > 1 else df


# Rows of a small table a task holds.
TASK_ROWS = 1 << 17


def narrowed(df: DataFrame, rows: int) -> DataFrame:
    """An aggregation of at most ``rows`` rows in no more tasks than they need.

    A small table that is persisted in as many parts as the session shuffles
    into costs that number squared of files in every later shuffle of it.
    Its input is still combined in all tasks."""
    return df.coalesce(max(1, -(-rows // TASK_ROWS)))


def small_frame(spark: SparkSession, rows: list, schema: T.StructType) -> DataFrame:
    """DataFrame of tree-sized driver-side rows (thresholds, node table).

    The rows travel as one Arrow table: values are never part of a SQL
    text, so whatever a category or label holds arrives as it is.
    """
    arrow = to_arrow_schema(schema)
    columns = list(zip(*rows)) if rows else [[] for _ in schema.fields]
    arrays = [pa.array(c, f.type, from_pandas=False) for c, f in zip(columns, arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), schema)


def batches(items: list, width: int) -> list[list]:
    """``items`` in runs whose frames of ``width`` columns stay within the
    broadcast bounds."""
    size = max(1, min(BROADCAST_ROW_LIMIT, BROADCAST_CELL_LIMIT // max(1, width)))
    return [items[i : i + size] for i in range(0, len(items), size)]


def maybe_broadcast(df: DataFrame, max_rows: int, width: int | None = None) -> DataFrame:
    """Hint a broadcast for a frame whose row count is known to be <= max_rows."""
    width = width if width is not None else len(df.columns)
    if max_rows <= BROADCAST_ROW_LIMIT and max_rows * width <= BROADCAST_CELL_LIMIT:
        return F.broadcast(df)
    return df
