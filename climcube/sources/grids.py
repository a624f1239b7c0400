"""Gridded tables: canonical columns, readers and the partitioned sink."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from climcube import schema
from climcube.config import VARIABLE_ALIASES
from climcube.functions import geometry, names, values
from climcube.operators import catalog

PARTITIONS = ("variable", "experiment", "model")
MOST_LISTED = 10_000


def read_grid(spark: SparkSession, *paths: str, files: bool = False) -> DataFrame:
    """Scan decoded grid tables with the fixed schema; several paths are one table.

    With ``files`` every row knows the climate file it comes from, ``file_name``.
    """
    columns = schema.struct_type(schema.GRID).names
    source = [names.climate_file(F.col("_metadata.file_path")).alias("file_name")] if files else []
    return spark.read.schema(schema.GRID).parquet(*paths).select(*columns, *source)


def read_merged(spark: SparkSession, directory: str, most_listed: int = MOST_LISTED) -> DataFrame:
    """The grid in a folder of decoded files, each year of a series from one file.

    Versions are chosen on the listing.  Up to ``most_listed`` chosen paths make up the scan, so
    a file that lost is never opened; beyond that the rows meet the chosen names in a
    semi join.  The folder may hold ``x.nc.parquet`` files or ``x.nc`` folders of parts.
    """
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    found = listing.option("pathGlobFilter", "*.parquet").load(directory).select("path")
    files = found.select("path", names.climate_file(F.col("path")).alias("file_name"))
    kept = catalog.one_file_per_year(files)
    paths = [r["path"] for r in kept.select("path").limit(most_listed + 1).collect()]
    if 0 < len(paths) <= most_listed:
        return read_grid(spark, *paths, files=True)
    scan = spark.read.schema(schema.GRID).option("recursiveFileLookup", True).parquet(directory)
    rows = scan.select(
        *schema.struct_type(schema.GRID).names, names.climate_file(F.col("_metadata.file_path")).alias("file_name")
    )
    return catalog.one_file_per_year(rows, files)


def read_countries(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schema.COUNTRY).parquet(path)


def write_grid(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a grid partitioned by variable, experiment and model.

    The rebalance hint lets AQE split a partition value that holds far more
    rows than the others into several even files and merge small ones.  Rows are
    sorted along a space-filling curve over the cells and then by year: neighbours
    in both directions share row groups, so a small box skips most of them.
    """
    parts = [c for c in PARTITIONS if c in df.columns]
    order = [geometry.curve_key(F.col("lat_q"), F.col("lon_q"))] if {"lat_q", "lon_q"} <= set(df.columns) else []
    order += [F.col("year")] if "year" in df.columns else []
    (
        df.hint("rebalance", *parts)
        .sortWithinPartitions(*parts, *order)
        .write.mode(mode)
        .partitionBy(*parts)
        .parquet(path)
    )


def save_bucketed(
    df: DataFrame, table: str, buckets: int, keys: Sequence[str], path: str | None = None
) -> None:
    """Save a table bucketed by ``keys``, one file per bucket, in ``path`` or the warehouse.

    Meant for yearly grids (``plans.series.yearly_table``): their keys are
    unique, so the buckets are even.  Yearly means, rebasing and change maps
    group by these keys and then need no shuffle of the grid at all.
    """
    writer = df.repartition(buckets, *keys).write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
    (writer if path is None else writer.option("path", path)).saveAsTable(table)


def canonical_grid(raw: DataFrame, lon_min: float = -180.0) -> DataFrame:
    """Bring a decoded table to the ``GRID`` columns, once, at ingest.

    NaN becomes NULL, precipitation becomes mm/day, the longitude moves to one
    branch, and the integer cell keys and the unit are stored.  A table that was
    brought there before stays as it is, since its ``unit`` says so.  The year is the given one,
    else that of a ``time`` stamp, else a decimal ``time_label`` without its
    fraction; a table with none of the three is refused.
    """
    schema.require_columns(raw, "variable", "lat", "lon", "value", what="grid")
    years = {
        "year": lambda: F.col("year").cast("int"),
        "time": lambda: F.year("time"),
        "time_label": lambda: F.col("time_label").cast("int"),
    }
    given = [make() for name, make in years.items() if name in raw.columns]
    if not given:
        raise schema.MissingColumnsError("grid does not contain year, time or time_label")
    lon = geometry.wrap_longitude(F.col("lon"), lon_min)
    unit = F.col("unit") if "unit" in raw.columns else None
    clean = raw.withColumns(
        {
            "year": F.coalesce(*given),
            "value": values.convert_units(F.col("variable"), values.nan_to_null(F.col("value")), unit),
            "unit": values.unit_label(F.col("variable")),
            "lon": lon,
            "lat_q": geometry.cell_key(F.col("lat")),
            "lon_q": geometry.cell_key(lon),
        }
    )
    have = set(clean.columns)
    return clean.selectExpr(
        *[
            f"CAST({f.name if f.name in have else 'NULL'} AS {f.dataType.simpleString()}) AS {f.name}"
            for f in schema.struct_type(schema.GRID)
        ]
    )


def resolve_variable(wide: DataFrame, variable: str, target: str = "value") -> DataFrame:
    """First present of the names a variable may have, for one-column-per-name input."""
    present = [c for c in VARIABLE_ALIASES[variable] if c in wide.columns]
    if not present:
        raise schema.MissingColumnsError(f"no column for variable {variable!r}")
    return wide.withColumn(target, F.coalesce(*present))


def resolve_variable_rows(
    long: DataFrame, variable: str, keys: Sequence[str], name_column: str = "variable"
) -> DataFrame:
    """The same choice for long input: per series only the best alias survives.

    The best rank is a partial aggregate over the series joined back, so a
    series with very many rows is neither sorted nor gathered.
    """
    rank = alias_rank(variable, name_column)
    ranked = long.withColumn("_rank", rank).filter(F.col("_rank").isNotNull())
    best = ranked.groupBy(*keys).agg(F.min("_rank").alias("_best"))
    return (
        ranked.join(best, list(keys))
        .filter(F.col("_rank") == F.col("_best"))
        .drop("_rank", "_best")
        .withColumn(name_column, F.lit(variable))
    )


def alias_rank(variable: str, name_column: str) -> Column:
    """Place of a name among those that a variable may have, NULL for another one."""
    chain = reduce(
        lambda acc, pair: acc.when(F.col(name_column) == pair[1], F.lit(pair[0])),
        enumerate(VARIABLE_ALIASES[variable]),
        F,
    )
    return chain.otherwise(F.lit(None))


def flatten_rows(
    df: DataFrame, array_column: str, index_name: str = "lon_index", value_name: str = "value"
) -> DataFrame:
    """One row per array element, for input that stores a grid row as an array.

    A missing or empty array stays as one row without index and value.
    """
    others = [c for c in df.columns if c != array_column]
    return df.select(*others, F.posexplode_outer(array_column).alias(index_name, value_name))


def enabled_observations(df: DataFrame, sources: Sequence[str]) -> DataFrame:
    """Keep only the observation sets that take part in a run."""
    return df.filter(F.col("source").isin(list(sources)))
