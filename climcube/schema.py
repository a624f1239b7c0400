"""Fixed schemas of the tables the library reads and writes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

MANIFEST = "md5 STRING, uri STRING"

GRID = """
    variable STRING, source STRING, model STRING, experiment STRING,
    time_label DOUBLE, year INT, month INT, day INT,
    lat DOUBLE, lon DOUBLE, lat_q INT, lon_q INT, value DOUBLE, unit STRING
"""

COUNTRY = "name STRING, ring_id INT, ring ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>"

# Column groups used as grouping keys.
CELL = ("lat_q", "lon_q")
SERIES_KEYS = ("variable", "source", "model", "experiment")
BASELINE_KEYS = ("variable", "source", "model", *CELL)


class MissingColumnsError(ValueError):
    """A table lacks columns an operator needs."""


class MissingTableError(ValueError):
    """A run enables a table that it was not given."""


def require_table(df: DataFrame | None, what: str) -> DataFrame:
    if df is None:
        raise MissingTableError(f"the run enables {what}, but its table is not given")
    return df


def require_columns(df: DataFrame, *names: str, what: str = "table") -> DataFrame:
    """Fail before any job starts when ``df`` lacks one of ``names``."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise MissingColumnsError(f"{what} does not contain {', '.join(missing)}")
    return df


def struct_type(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)
