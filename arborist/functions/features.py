"""Feature kinds read from the schema (no Spark job is run)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..settings import CATEGORICAL, ORDINAL

_ORDINAL_TYPES = (
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
)


def col(name: str) -> Column:
    """Column by exact name (dots and spaces are not parsed)."""
    return F.col("`" + name.replace("`", "``") + "`")


def kind_of(data_type: T.DataType) -> str | None:
    """``ordinal`` for integer/float columns, ``categorical`` for strings.

    ``decimal(20,0)`` is how Spark reads unsigned 64-bit integers and is
    ordinal (compared as double, like all numbers here).  Any other type (boolean, other decimals, dates, timestamps, nested, binary)
    has no kind and cannot be a feature.
    """
    unsigned = isinstance(data_type, T.DecimalType) and (data_type.precision, data_type.scale) == (20, 0)
    if unsigned or isinstance(data_type, _ORDINAL_TYPES):
        return ORDINAL
    if isinstance(data_type, T.StringType):
        return CATEGORICAL
    return None


def require_columns(df: DataFrame, names) -> None:
    """Strict presence check; Spark alone ignores unknown names in renames/drops."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}; available: {df.columns}")


def require_free_output(df: DataFrame, name: str) -> None:
    """Refuse to overwrite a column of the input with a result."""
    if name.lower() in (c.lower() for c in df.columns):
        raise ValueError(f"the input already has a column {name!r}; choose another output_col")


# Column names the fit adds next to the label and features.
RESERVED_NAMES = ("node_id",)
RESERVED_PREFIX = "__"


def check_reserved(names) -> None:
    bad = [n for n in names if n in RESERVED_NAMES or n.startswith(RESERVED_PREFIX)]
    if bad:
        raise ValueError(
            f"label/feature names {bad} collide with working columns of the fit "
            f"({RESERVED_NAMES} and names starting with {RESERVED_PREFIX!r}); rename them first"
        )


def feature_kinds(df: DataFrame, label: str, features=None) -> dict[str, str]:
    """Map every feature column to its kind, in schema order.

    ``features=None`` takes every column except the label; an explicit list
    keeps its own order.  Unsupported types raise an error naming them.
    """
    require_columns(df, [label])
    fields = {f.name: f.dataType for f in df.schema.fields}
    if features is None:
        names = [n for n in df.columns if n != label]
    else:
        names = list(features)
        require_columns(df, names)
        if label in names:
            raise ValueError(f"label column {label!r} cannot also be a feature")
    check_reserved([label, *names])
    kinds, bad = {}, []
    for name in names:
        kind = kind_of(fields[name])
        if kind is None:
            bad.append(f"{name}: {fields[name].simpleString()}")
        else:
            kinds[name] = kind
    if bad:
        raise ValueError(
            "unsupported feature types (only integer, float and string columns can be "
            f"features; pass features=[...] to leave them out): {bad}"
        )
    return kinds
