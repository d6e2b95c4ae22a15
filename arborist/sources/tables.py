"""Readers for the input tables and the labelled feature sets built from them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """CSV with a header row; the schema is inferred unless one is given
    (inference costs an extra pass, so pass a schema for large inputs)."""
    reader = spark.read.option("header", True)
    return reader.schema(schema).csv(path) if schema is not None else reader.option("inferSchema", True).csv(path)


# Types a text column may have, the most special first, each with a test of a
# value; a column has the first type that all its values pass.
CSV_TYPES = (
    ("boolean", lambda v: F.lower(v).isin("true", "false")),
    ("bigint", lambda v: v.rlike("^[+-]?[0-9]+$") & v.try_cast("bigint").isNotNull()),
    ("double", lambda v: v.rlike("^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$") | v.isin("NaN", "Infinity", "-Infinity")),
    ("date", lambda v: v.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & v.try_cast("date").isNotNull()),
    ("timestamp_ntz", lambda v: v.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9:.]+$") & v.try_cast("timestamp_ntz").isNotNull()),
)


def infer_text_types(df: DataFrame, columns=None) -> dict[str, str]:
    """Type of every string column of ``df`` from all its values (null says
    nothing; a column without a value stays a string).

    One aggregation: a flag per column and type that holds while every value
    passes.  Flags of parts combine by "and", so the result does not depend
    on how the rows are dealt out, and one row reaches the driver.
    """
    columns = list(df.columns if columns is None else columns)
    flags = []
    for i, c in enumerate(columns):
        v = F.col(f"`{c}`")
        flags += [F.bool_and(F.when(v.isNotNull(), test(v))).alias(f"f{i}_{j}") for j, (_, test) in enumerate(CSV_TYPES)]
    row = df.agg(*flags).first() if flags else {}
    return {
        c: next((name for j, (name, _) in enumerate(CSV_TYPES) if row[f"f{i}_{j}"]), "string") for i, c in enumerate(columns)
    }


def read_csv_inferred(spark: SparkSession, path: str, header: list[str], **options) -> tuple[DataFrame, DataFrame]:
    """``(rows, bad)`` of the CSV files under ``path``, whose header line names
    the columns ``header``: rows typed by :func:`infer_text_types`, and the
    lines that do not have that many fields, as ``(line, first_field, n)``.

    ``timestamp_ntz`` and ``date`` follow ISO 8601; empty unquoted fields are
    null.  The files are read as text columns twice: once for the types and
    once by whoever uses the rows."""
    broken = "__arb_line"
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header, broken]])
    # Without pruning, whatever is selected: a line's fields are counted only where all are parsed.
    fixed = {"header": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": broken, "columnPruning": "false"}
    reader = spark.read.schema(schema).options(**options, **fixed)
    raw = reader.csv(path)
    good = raw.where(F.col(broken).isNull()).drop(broken)
    types = infer_text_types(good)
    rows = good.select(*[F.col(f"`{c}`").cast(types[c]).alias(c) for c in header])
    # Spark refuses a scan of the broken-line column alone: the first field goes along.
    bad = raw.where(F.col(broken).isNotNull()).groupBy(F.col(broken).alias("line"), F.col(f"`{header[0]}`").alias("first_field"))
    return rows, bad.agg(F.count(F.lit(1)).alias("n"))


@dataclass(frozen=True)
class FeatureSet:
    """A labelled table: a row key, the label and the feature columns."""

    name: str
    key: str
    label: str
    features: tuple[str, ...]

    def load(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return LOADERS[self.name](spark, sf_dir)


def _orders(spark, sf_dir):
    return read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice", "o_custkey", "o_orderpriority"
    )


def _lineitem(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("l_key"),
        "l_returnflag", "l_quantity", "l_linenumber", "l_discount", "l_tax", "l_extendedprice", "l_linestatus",
    )


def _documents(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    lab = read_table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return d.join(lab, "doc_id").select("doc_id", "quality", "n_chars", "toxic", "lang", "source")


def _part(spark, sf_dir):
    return read_table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size", "p_retailprice", "p_brand")


LOADERS = {"orders": _orders, "lineitem": _lineitem, "documents": _documents, "part": _part}

FEATURE_SETS = {
    "orders": FeatureSet("orders", "o_orderkey", "o_orderstatus", ("o_totalprice", "o_custkey", "o_orderpriority")),
    "lineitem": FeatureSet(
        "lineitem", "l_key", "l_returnflag",
        ("l_quantity", "l_linenumber", "l_discount", "l_tax", "l_extendedprice", "l_linestatus"),
    ),
    "documents": FeatureSet("documents", "doc_id", "quality", ("n_chars", "toxic", "lang", "source")),
    "part": FeatureSet("part", "p_partkey", "p_type", ("p_size", "p_retailprice", "p_brand")),
}
