"""Helpers shared by the training-data operators: shared-folder tables,
bounded broadcasts, joins on hot keys, prefix sums and components."""

from __future__ import annotations

import math
import pickle
import tempfile
import uuid

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed values of the text contracts.
SPACE = r"\x20\x09-\x0D"
WORD = f"[^{SPACE}]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# A side is broadcast only when it was counted and is below both bounds.
BROADCAST_ROWS = 50_000
BROADCAST_BYTES = 4 << 20

# Copies of the small side of a salted join.
SALTS = 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share: ``spark.checkpoint.dir``, or
    the folder set on the context.  Unset, a local session uses the temp
    folder (one machine); a cluster session is refused, because any folder
    chosen here might be one machine's own."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if spark.sparkContext.master.startswith("local"):
        return f"{tempfile.gettempdir()}/arborist-shared"
    raise RuntimeError("spark.checkpoint.dir is not set; point it at a folder shared by the cluster (HDFS, S3, ...)")


# Shuffle files of a finished query go at once, not when the driver next collects garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


# Rows of a file, at least, where the number of rows is known beforehand.
FILE_ROWS = 50_000


def written(df: DataFrame, most_rows: int | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, and
    read back from storage if an executor is lost (no lineage kept).  The
    shuffle files behind it are dropped; the table itself goes when the
    driver ends, so frames built on it live as long as the session.
    ``most_rows``, a bound of its rows, keeps small tables in few files."""
    spark = df.sparkSession
    if most_rows is not None:
        df = df.coalesce(max(1, math.ceil(most_rows / FILE_ROWS)))
    path = f"{shared_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    stored = spark._jvm.org.apache.hadoop.fs.Path(path)
    stored.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(stored)
    return spark.read.schema(df.schema).parquet(path)


def row_key(df: DataFrame, text_col: str = "text") -> Column:
    """SHA-256 of all columns of a row, 32 bytes: rows that share it agree in
    the text and the others.  It follows from the row alone, so it is the
    same in every pass, without a numbered copy of the texts."""
    others = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns if c != text_col] or [F.lit(0).alias("none")]))
    return F.unhex(F.sha2(F.concat(F.coalesce(F.sha2(F.col(text_col), 256), F.lit("")), others), 256))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bounded(df: DataFrame, rows: int, bytes_: int) -> DataFrame:
    """``df`` with a broadcast hint if its counted size is under the bounds."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS and bytes_ <= BROADCAST_BYTES else df


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], spread: Column, how: str = "inner",
                salts: int = SALTS) -> DataFrame:
    """Join on ``keys`` where a key may hold a third of the left rows: every
    key is dealt to ``salts`` tasks by ``spread``, a hash of the left row."""
    left = left.withColumn("__salt", F.pmod(spread, F.lit(salts)).cast("int"))
    right = right.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*keys, "__salt"], how).drop("__salt")


def _bin(key: str, bits: int) -> Column:
    return F.shiftrightunsigned(F.col(key), 64 - bits) if bits else F.lit(0).cast("long")


def _offsets(totals: DataFrame, group: list[str], bits: int) -> DataFrame:
    """``__before`` of every bin: the sums of the group's lower bins.  No
    window holds over 1024 bins; more bins go up one level first."""
    order = Window.partitionBy(*group).orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    if bits <= 10:
        return totals.withColumn("__before", F.coalesce(F.sum("__sum").over(order), F.lit(0)))
    totals = totals.withColumn("__up", F.shiftright("__bin", 10))
    upper = _offsets(
        totals.groupBy(*group, F.col("__up").alias("__bin")).agg(F.sum("__sum").alias("__sum")), group, bits - 10
    ).select(*group, F.col("__bin").alias("__up"), F.col("__before").alias("__above"))
    inner = Window.partitionBy(*group, "__up").orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    return (
        totals.withColumn("__in", F.coalesce(F.sum("__sum").over(inner), F.lit(0)))
        .join(upper, [*group, "__up"])
        .select(*group, "__bin", "__sum", (F.col("__in") + F.col("__above")).alias("__before"))
    )


def prefix_sums(df: DataFrame, group: list[str], key: str, ties: list[str], value: Column, out: str, n_rows: int,
                rows_per_bin: int = 4_000) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows before, within
    ``group`` (columns without nulls), in the order of the uniform 64-bit
    hash ``key`` (unsigned), then ``ties``.

    The hash range is cut into equal bins, as many as keep a bin of the
    largest possible group at ``rows_per_bin``; sums of whole bins are
    added up first, then rows inside each (group, bin).  A group that holds
    every row is still split over all bins.  Rows that agree in all of
    these columns are interchangeable.
    """
    bits = min(40, max(0, math.ceil(math.log2(max(1, n_rows / rows_per_bin)))))
    df = df.withColumn("__bin", _bin(key, bits)).withColumn("__value", value)
    order = (
        Window.partitionBy(*group, "__bin")
        .orderBy(F.col(key).bitwiseXOR(F.lit(-(1 << 63))), *ties)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    df = df.withColumn(out, F.coalesce(F.sum("__value").over(order), F.lit(0)))
    if bits:
        totals = df.groupBy(*group, "__bin").agg(F.sum("__value").alias("__sum"))
        offsets = _offsets(totals, group, bits).select(*group, "__bin", "__before")
        df = df.join(offsets, [*group, "__bin"]).withColumn(out, F.col(out) + F.col("__before")).drop("__before")
    return df.withColumn(out, F.col(out).cast("long")).drop("__bin", "__value")


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on ``(u, v)``: every node hands its neighbours (large:
    the larger ones; small: all smaller ones) to its least neighbour."""
    if large:
        near = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # A hub may hold most edges: its rows are spread over several tasks.
        out = salted_join(near.where("v > u"), least, ["u"], F.xxhash64("v")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        moved = salted_join(down, least, ["u"], F.xxhash64("v")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        out = moved.union(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` of every node of ``edges (u, v)``; ``root`` is the
    smallest node reachable.  Alternating large and small stars; each round
    is a written table, and nothing but two numbers reaches the driver."""
    edges = written(edges.where("u <> v").distinct())
    seen = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if not state[0] or state == seen:
            break
        seen = state
        # A star step gives at most one edge for each it takes, a small one one more for each node.
        edges = written(_star(_star(edges, True), False), 2 * state[0])
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def pack(*parts) -> bytes:
    """Arrays (bytes of equal rank together, so that they compress) and other values."""
    out = []
    for p in parts:
        if isinstance(p, np.ndarray):
            p = np.ascontiguousarray(p)
            out.append((p.dtype.str, p.view(np.uint8).reshape(-1, p.itemsize).T.tobytes()))
        else:
            out.append((None, p))
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(out, 5))


def unpack(blob: bytes) -> list:
    out = []
    for dtype, data in pickle.loads(zstandard.ZstdDecompressor().decompress(blob)):
        if dtype is not None:
            kind = np.dtype(dtype)
            data = np.frombuffer(data, np.uint8).reshape(kind.itemsize, -1).T.copy().view(kind).reshape(-1)
        out.append(data)
    return out


def small(a: np.ndarray) -> np.ndarray:
    """Unsigned integers in the narrowest type that holds them."""
    return a.astype(np.min_scalar_type(int(a.max(initial=0))))
