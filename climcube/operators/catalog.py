"""File catalogues and manifests: filters, versions, skip and digest checks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from climcube.config import MODELS
from climcube.functions import names
from climcube.sources.manifest import parse_names

FILE_SERIES = ("variable", "model", "experiment")

# Outcome of the skip test, in the order it is made.
SKIP_REASONS = ("yearmean_exists", "v1_2_exists", "file_exists")

#: Rows without a name are dealt to so many keys.
SPREAD = 4096


def keep_models_in_uri(df: DataFrame, models: Sequence[str] | None = MODELS,
                       column: str = "uri") -> DataFrame:
    """Allow-list by substring, so a longer model name that contains one passes too."""
    return df if models is None else df.filter(names.contains_any(F.col(column), models))


def keep_models(df: DataFrame, models: Sequence[str] | None = MODELS) -> DataFrame:
    """Allow-list by equality; None keeps every model."""
    return df if models is None else df.filter(F.col("model").isin(list(models)))


def keep_wanted_variables(df: DataFrame, column: str = "file_name") -> DataFrame:
    return df.filter(names.wanted_variable(F.col(column)))


def keep_series(df: DataFrame, variable: str, experiments: Sequence[str]) -> DataFrame:
    """Files of one variable and some experiments, tested on the parsed tokens."""
    return df.filter((F.col("variable") == variable) & F.col("experiment").isin(list(experiments)))


def pick_version(files: DataFrame, column: str = "file_name") -> DataFrame:
    """One file per base name, a re-issued version first.

    Raw and reduced files of one base are different files, and one of each stays.
    ``row_number() = 1`` is trimmed per task before the shuffle.
    """
    name = F.col(column)
    w = Window.partitionBy("_base", "_reduced").orderBy(names.version_of(name).desc_nulls_last(), name)
    return (
        files.withColumns({"_base": names.version_base(name), "_reduced": names.is_yearmean(name)})
        .withColumn("_rn", F.row_number().over(w))
        .filter("_rn = 1")
        .drop("_base", "_reduced", "_rn")
    )


def pick_year_files(
    files: DataFrame, keys: Sequence[str] = FILE_SERIES, column: str = "file_name"
) -> DataFrame:
    """One file per series and year, a re-issued one first and then by name.

    ``files`` holds parsed names.  Without this a year that two files cover counts
    twice in every mean.  A year at the end of a name counts, too, which ``year`` does
    not hold; a file without any year stands for itself and its re-issue.
    """
    name = F.col(column)
    base = names.version_base(name)
    last = F.nullif(F.regexp_extract(base, "_([0-9]{4})$", 1), F.lit(""))
    same = F.coalesce(F.col("year").cast("string"), last, base)
    w = Window.partitionBy(*keys, same).orderBy(names.version_of(name).desc_nulls_last(), name)
    return files.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def one_file_per_year(
    grid: DataFrame, files: DataFrame | None = None, keys: Sequence[str] = FILE_SERIES, column: str = "file_name"
) -> DataFrame:
    """Rows of a grid that come from the chosen file of their series and year.

    ``files`` is a listing; without one the names are taken from the grid.  The
    rows meet the chosen names in a semi join *before* anything is averaged.
    """
    listed = (grid if files is None else files).select(column).distinct()
    chosen = pick_year_files(parse_names(listed, column), keys, column)
    return grid.join(chosen.select(column), column, "left_semi")


def merge_order(
    files: DataFrame, keys: Sequence[str] = FILE_SERIES, column: str = "file_name"
) -> DataFrame:
    """Position of each file in its series, ordered by year and name.

    The position is the number of files of earlier years plus the rank within
    the year.  Only the small table of counts per year is ordered per series;
    a long list of files is never gathered into one group.  Files without a
    year, or without one of the keys, come last and are not lost.
    """
    keys = list(keys)
    per_year = files.groupBy(*keys, "year").agg(F.count(F.lit(1)).alias("_n"))
    in_order = Window.partitionBy(*keys).orderBy(F.col("year").asc_nulls_last())
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    on = [*keys, "year"]
    offsets = per_year.select(
        *[F.col(k).alias(f"_of_{k}") for k in on], F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset")
    )
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in on])
    within = Window.partitionBy(*keys, "year").orderBy(column)
    return (
        files.withColumn("_rank", F.row_number().over(within))
        .join(offsets, same)
        .withColumn("position", F.col("_offset") + F.col("_rank"))
        .drop("_offset", "_rank", *[f"_of_{k}" for k in on])
    )


def file_groups(files: DataFrame, keys: Sequence[str] = FILE_SERIES) -> DataFrame:
    """Extent of each group of files."""
    return files.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_files"),
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
    )


def left_by_name(rows: DataFrame, files: DataFrame, column: str = "file_name") -> DataFrame:
    """Left join on a name that occurs once in ``files``; the name comes first.

    A row without a name meets nothing.  Such rows are spread by the hash of their texts: under a null key a single
    task would get all of them.
    """
    named = F.concat(F.lit("/"), F.col(column))  # no number begins like this
    texts = [F.col(f"`{f.name}`") for f in rows.schema if isinstance(f.dataType, T.StringType)]
    left = rows.withColumn("_name", F.coalesce(named, F.pmod(F.xxhash64(*texts), F.lit(SPREAD)).cast("string")))
    joined = left.join(files.withColumn("_name", named).drop(column), "_name", "left").drop("_name")
    return joined.select(column, *[F.col(f"`{c}`") for c in joined.columns if c != column])


def skip_existing(manifest: DataFrame, existing: DataFrame, column: str = "file_name") -> DataFrame:
    """Why a manifest row needs no work, or NULL when it does.

    Tested in this order: its yearly mean, its re-issued version, itself.
    ``existing`` has one column ``file_name``.  Both sides meet once, on the stem
    that the three names have in common; a stem has a handful of existing names,
    and the exact names are compared there.
    """
    name = F.col(column)
    wanted = (names.yearmean_name(name), names.version_name(name), name)
    have = (
        existing.select("file_name", names.stem(F.col("file_name")).alias("_stem"))
        .groupBy("_stem")
        .agg(F.collect_set("file_name").alias("_have"))
    )
    out = manifest.withColumn("_stem", names.stem(name)).join(have, "_stem", "left")
    reason = F.coalesce(
        *[F.when(F.array_contains("_have", n), F.lit(r)) for n, r in zip(wanted, SKIP_REASONS, strict=True)]
    )
    return out.select(*manifest.columns, reason.alias("skip_reason"))


def pending(manifest: DataFrame, existing: DataFrame, column: str = "file_name") -> DataFrame:
    """Manifest rows that still need work."""
    return skip_existing(manifest, existing, column).filter("skip_reason IS NULL").drop("skip_reason")


def verify_digests(manifest: DataFrame, digests: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Compare expected and actual digests; a missing file is not verified.

    ``digests`` carries 32 characters per file, so contents never travel.  Of
    several files of one name (copies in several folders) one that matches is
    enough; a manifest row stays one row.  ``known`` has further columns, one row per
    ``file_name``, which the manifest gets in the same join.
    """
    found = digests.groupBy("file_name").agg(F.collect_set("actual_md5").alias("_found"))
    if known is not None:
        found = known.join(found, "file_name", "full")
    joined = left_by_name(manifest, found)
    verified = F.coalesce(F.array_contains("_found", F.col("md5")), F.lit(False))
    status = (
        F.when(F.coalesce(F.size("_found"), F.lit(0)) <= 0, "missing")
        .when(verified, "ok")
        .otherwise("mismatch")
    )
    return joined.withColumns({"verified": verified, "status": status}).drop("_found")


def status_summary(df: DataFrame, levels: Sequence[str] = ("status", "experiment", "model")) -> DataFrame:
    """Row counts by status with subtotals; ``ALL`` marks a subtotal.

    Subtotals are sums of the counts per group, so a row of the input is counted once and not once a level.
    """
    per_group = df.groupBy(*levels).agg(F.count(F.lit(1)).alias("_n"))
    counted = per_group.rollup(*levels).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n"), *[F.grouping(c).alias(f"_g_{c}") for c in levels]
    )
    return counted.select(
        *[F.when(F.col(f"_g_{c}") == 1, "ALL").otherwise(F.col(c)).alias(c) for c in levels], "n"
    )
