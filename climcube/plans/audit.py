"""Acquisition and coverage audits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from climcube.config import MODELS
from climcube.functions import names, values
from climcube.operators import catalog, quality
from climcube.sources.manifest import parse_names, strip_fields


def audit_acquisition(
    manifest: DataFrame,
    existing: DataFrame,
    digests: DataFrame,
    models: Sequence[str] | None = MODELS,
) -> DataFrame:
    """State of every manifest file of a wanted model and variable.

    ``skip_reason`` says whether a result exists already; ``status`` is the
    digest check of a local copy (ok, mismatch or missing).
    """
    wanted = strip_fields(catalog.keep_models_in_uri(manifest, models))
    named = wanted.withColumn("file_name", names.uri_file_name(F.col("uri")))
    chosen = catalog.pick_version(catalog.keep_wanted_variables(named))
    checked = catalog.verify_digests(catalog.skip_existing(chosen, existing), digests)
    final = F.coalesce(F.col("skip_reason"), F.col("status"))
    return parse_names(checked.withColumn("status", final))


def manifest_rejects(manifest: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable manifest rows, parsed, and the others with the first reason that applies.

    Together they are as many rows as the manifest has.
    """
    rows = strip_fields(manifest)
    parsed = parse_names(rows.withColumn("file_name", F.nullif(names.uri_file_name(F.col("uri")), F.lit(""))))
    digest = F.coalesce(F.col("md5").rlike("^[0-9a-fA-F]{32}$"), F.lit(False))
    return quality.split_rejects(
        parsed,
        [
            ("no uri", F.coalesce(F.col("uri"), F.lit("")) == ""),
            ("no file name", F.col("file_name").isNull()),
            ("no digest", ~digest),
            ("no model in name", F.coalesce(F.col("model"), F.lit("")) == ""),
            ("no year in name", F.col("year").isNull()),
        ],
    )


# States of a manifest row that no file state follows, in the order they are tested.
REJECTED = ("malformed", "no uri", "no file name", "no digest", "other model", "other variable", "other version")


def account(
    manifest: DataFrame,
    existing: DataFrame,
    digests: DataFrame,
    models: Sequence[str] | None = MODELS,
) -> DataFrame:
    """Every manifest row with exactly one ``status``.

    ``status`` is why a row is not used (``REJECTED``), else why it needs no work, else the digest check of the
    local copy (ok, mismatch or missing).  Rows are marked and never filtered, so the counts per status add up
    to the manifest.  ``manifest`` may have the column ``malformed`` of ``read_manifest_rows``.
    """
    uri, name = F.col("uri"), F.col("file_name")
    rows = strip_fields(manifest)
    if "malformed" not in rows.columns:
        rows = rows.withColumn("malformed", F.lit(None).cast("string"))
    named = rows.withColumn("file_name", F.nullif(names.uri_file_name(uri), F.lit("")))
    other_model = F.lit(False) if models is None else ~names.contains_any(uri, models)
    why = (
        F.when(F.col("malformed").isNotNull(), "malformed")
        .when(F.coalesce(uri, F.lit("")) == "", "no uri")
        .when(name.isNull(), "no file name")
        .when(~F.coalesce(F.col("md5").rlike("^[0-9a-fA-F]{32}$"), F.lit(False)), "no digest")
        .when(other_model, "other model")
        .when(~names.wanted_variable(name), "other variable")
    )
    marked = named.withColumn("_why", values.finished(why))
    # a chosen name stands for all its rows, however often it is listed, so the files on disk are met once a name
    usable = marked.filter("_why IS NULL").select("file_name").distinct()
    best = catalog.skip_existing(catalog.pick_version(usable), existing)
    best = best.select("file_name", "skip_reason", F.lit(True).alias("_best"))
    checked = catalog.verify_digests(marked, digests, best)
    other = F.when(F.col("_best").isNull(), "other version")
    status = F.coalesce(F.col("_why"), other, F.col("skip_reason"), F.col("status"))
    return parse_names(checked.select("md5", "uri", "malformed", "file_name", status.alias("status")))


def acquisition_status(
    manifest: DataFrame,
    existing: DataFrame,
    digests: DataFrame,
    models: Sequence[str] | None = MODELS,
) -> DataFrame:
    """Counts per status with subtotals per experiment and model."""
    return catalog.status_summary(audit_acquisition(manifest, existing, digests, models))


def audit_coverage(
    observed: DataFrame, keys: Sequence[str], first_year: int, last_year: int
) -> DataFrame:
    """Number of missing months per series and year (only years with a gap)."""
    masks = quality.month_masks(observed, keys, first_year, last_year)
    missing = (F.lit(12) - F.bit_count("mask")).cast("bigint")
    return masks.select(*keys, "year", missing.alias("n_missing")).filter("n_missing > 0")
