"""One query per operator and analysis, over the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from climcube.config import HISTORICAL, LEVEL_EDGES, MODELS, REGIONS, Region
from climcube.functions import names, values
from climcube.operators import anomaly, catalog, countries, ensemble, quality, space, temporal
from climcube.plans import audit, labels, maps, series
from climcube.schema import CELL, SERIES_KEYS
from climcube.sources import calendar, grids, incremental
from climcube.sources.manifest import parse_names, skip_empty
from climcube.sources.store import scratch_folder
from climcube.workload import bindings as b

DIGITS = 6
Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register under the function's name; doubles are rounded for comparison."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return tidy(fn(spark, sf_dir))

    _REGISTRY[fn.__name__] = run
    return run


def tidy(df: DataFrame) -> DataFrame:
    """Round doubles; adding 0.0 turns a negative zero into zero."""
    return df.select(
        *[
            (F.round(f.name, DIGITS) + F.lit(0.0)).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f.name)
            for f in df.schema
        ]
    )


def registry() -> dict[str, Query]:
    return dict(_REGISTRY)


def _on_cells(df: DataFrame, *columns: str) -> DataFrame:
    return series.with_degrees(df).select("lat", "lon", *columns)


# --- reductions along time -------------------------------------------------


@query
def yearly_mean(spark, sf_dir):
    means = temporal.yearly_mean(b.grid(spark, sf_dir))
    return _on_cells(means, "model", "experiment", "year", "value", "n_steps")


@query
def climatology(spark, sf_dir):
    yearly = temporal.yearly_mean(b.model_grid(spark, sf_dir))
    return _on_cells(temporal.climatology(yearly, *b.BASELINE), "model", "clim", "n_steps")


@query
def reference_mean(spark, sf_dir):
    yearly = temporal.yearly_mean(b.reanalysis_grid(spark, sf_dir))
    return _on_cells(temporal.climatology(yearly, *b.BASELINE, experiment=None), "clim", "n_steps")


@query
def period_mean(spark, sf_dir):
    yearly = temporal.yearly_mean(b.grid(spark, sf_dir))
    means = temporal.period_mean(yearly, *b.FUTURE)
    return _on_cells(means, "model", "experiment", "value", "n_steps")


@query
def monthly_to_annual(spark, sf_dir):
    return _on_cells(temporal.monthly_to_annual(b.station_climatology(spark, sf_dir, whole=True)), "climatology")


@query
def dedupe_time(spark, sf_dir):
    first = temporal.dedupe_time(b.order_times(spark, sf_dir), ["series"], [F.col("step")])
    return first.select("series", "year", "step", "value")


@query
def time_normalise(spark, sf_dir):
    """Half of the labels are timestamps, the others decimal years."""
    steps = b.order_times(spark, sf_dir)
    as_date = F.when(F.col("variable").isin("1-URGENT", "2-HIGH"), F.col("ts"))
    decimal = F.year("ts") + (F.dayofyear("ts") - 0.5) / 366
    as_label = F.when(as_date.isNull(), decimal)
    year = values.year_of_time(as_date, as_label)
    return (
        steps.withColumn("normal_year", year)
        .groupBy("variable", "normal_year")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    )


# --- boxes, regions, spatial means ------------------------------------------


def _cell_totals(df: DataFrame) -> DataFrame:
    return df.groupBy("lat", "lon").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")
    )


@query
def box_select(spark, sf_dir):
    box = Region("tropics_east", -30.0, 30.0, 0.0, 180.0)
    return _cell_totals(space.select_box(b.raw_grid(spark, sf_dir), box, wrap=False))


@query
def box_select_wrap(spark, sf_dir):
    return _cell_totals(space.select_box(b.raw_grid(spark, sf_dir), REGIONS["europe"]))


@query
def region_join(spark, sf_dir):
    placed = space.assign_regions(b.grid(spark, sf_dir), tuple(REGIONS.values()))
    return placed.groupBy("region", "experiment").agg(
        F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean_value")
    )


@query
def region_join_table(spark, sf_dir):
    clim = series.with_degrees(
        temporal.climatology(temporal.yearly_mean(b.grid(spark, sf_dir)), *b.BASELINE, None)
    )
    placed = space.region_cells(clim, b.customer_regions(spark, sf_dir))
    return placed.groupBy("region").agg(
        F.count(F.lit(1)).alias("n_cells"), F.avg("clim").alias("mean_clim")
    )


def _yearly_fields(spark, sf_dir) -> DataFrame:
    return series.with_degrees(temporal.yearly_mean(b.grid(spark, sf_dir)))


@query
def field_mean_area(spark, sf_dir):
    keys = ("model", "experiment", "year")
    return space.field_mean(_yearly_fields(spark, sf_dir), "value", keys, "area", spacing=15.0)


@query
def field_mean_plain(spark, sf_dir):
    keys = ("model", "experiment", "year")
    return space.field_mean(_yearly_fields(spark, sf_dir), "value", keys, "none")


# --- anomalies -----------------------------------------------------------------


@query
def grid_subtract(spark, sf_dir):
    """All time steps of all experiments against the historical climatology."""
    grid = b.model_grid(spark, sf_dir)
    clim = temporal.climatology(temporal.yearly_mean(grid), *b.BASELINE)
    steps = anomaly.anomalies(grid, clim)
    return steps.groupBy("lat", "lon", "model", "experiment").agg(
        F.count("anomaly").alias("n"),
        F.min("anomaly").alias("lowest"),
        F.max("anomaly").alias("highest"),
        F.avg("anomaly").alias("mean_anomaly"),
    )


@query
def absolute_from_anomaly(spark, sf_dir):
    annual = temporal.monthly_to_annual(b.station_climatology(spark, sf_dir))
    steps = anomaly.align(b.station_anomalies(spark, sf_dir), annual, ("lat_q", "lon_q"))
    absolute = anomaly.add(steps, "temperature", "climatology", "absolute")
    return absolute.groupBy("lat", "lon", "year").agg(
        F.count("absolute").alias("n"), F.avg("absolute").alias("absolute")
    )


@query
def models_without_baseline(spark, sf_dir):
    grid = b.model_grid(spark, sf_dir)
    return anomaly.series_without_baseline(grid, *b.BASELINE).select("model", "experiment")


# --- series ----------------------------------------------------------------------


@query
def model_anomaly_series(spark, sf_dir):
    return series.model_series(b.model_grid(spark, sf_dir), b.CONFIG_ALL_REGIONS)


@query
def reanalysis_series(spark, sf_dir):
    return series.reanalysis_series(b.reanalysis_grid(spark, sf_dir), b.CONFIG)


@query
def station_series(spark, sf_dir):
    return series.station_series(
        b.station_anomalies(spark, sf_dir), b.station_climatology(spark, sf_dir), b.CONFIG
    )


def _all_series(spark, sf_dir) -> DataFrame:
    return series.all_series(
        b.model_grid(spark, sf_dir),
        b.CONFIG,
        b.reanalysis_grid(spark, sf_dir),
        b.station_anomalies(spark, sf_dir),
        b.station_climatology(spark, sf_dir),
    )


@query
def all_series(spark, sf_dir):
    return _all_series(spark, sf_dir)


@query
def precipitation_series(spark, sf_dir):
    return series.all_series(b.model_grid(spark, sf_dir, "pr"), b.CONFIG_PR)


@query
def precipitation_all_series(spark, sf_dir):
    """Models and reanalysis; the station set holds temperature only."""
    return series.all_series(
        b.model_grid(spark, sf_dir, "pr"), b.CONFIG_PR_ALL, b.reanalysis_grid(spark, sf_dir, "pr")
    )


@query
def merge_time_versions(spark, sf_dir):
    """Climatology of files of which some years have two versions: each year counts once."""
    merged = catalog.one_file_per_year(b.grid_of_files(spark, sf_dir))
    keys = ("variable", "model", "experiment")
    yearly = temporal.yearly_mean(parse_names(merged).withColumn("source", F.lit("CMIP6")))
    clim = temporal.climatology(yearly, *b.BASELINE, experiment=None, keys=(*keys, *CELL))
    return _on_cells(clim, *keys, "clim", "n_steps")


@query
def incremental_yearly(spark, sf_dir):
    """Yearly means of a state that met the files of some years first and then all of them."""
    rows = b.grid(spark, sf_dir)
    # a file per variable, experiment, model and month; the later ones arrive with the second listing
    path = F.concat_ws("/", "variable", "experiment", "model", F.col("year").cast("string"), F.col("month").cast("string"))
    files = rows.select(*incremental.PARTITIONS, path.alias("path"), F.lit("1").alias("stamp")).distinct()
    state = incremental.YearlyState(spark, scratch_folder(spark, "yearly-state"))

    def read(paths):
        return rows.withColumn("path", path).join(paths, "path", "left_semi")

    state.update(files.filter("year < 1997 OR (year = 1997 AND path NOT LIKE '%/12')"), read)
    state.update(files, read)
    return _on_cells(state.yearly(), "source", "model", "experiment", "year", "value", "n_steps")


@query
def series_load(spark, sf_dir):
    """Values of provider files after name, unit, time and repeats are settled."""
    loaded = series.load_series(b.series_of_files(spark, sf_dir), "tas")
    return loaded.select(F.col("model").alias("file_name"), "experiment", "year", "anomaly", "n_repeats")


@query
def spread_from_files(spark, sf_dir):
    return series.spread_from_files(b.series_of_files(spark, sf_dir), b.CONFIG, "global_north")


@query
def field_mean_bounds(spark, sf_dir):
    """Area mean on an axis of unequal steps with rows on the poles."""
    yearly = temporal.yearly_mean(b.polar_grid(spark, sf_dir), ("model", "lat_q"))
    weighted = space.with_band_weights(yearly, ("model",))
    return space.field_mean(weighted, "value", ("model", "year"), "column")


@query
def region_join_mixed(spark, sf_dir):
    """Boxes from the globe down to single cells, over the cells of a fine and of a coarse grid."""
    fine = grids.canonical_grid(b.fine_grid(spark, sf_dir)).select("lat", "lon")
    coarse = b.grid(spark, sf_dir).select("lat", "lon")
    cells = fine.union(coarse).groupBy("lat", "lon").agg(F.count(F.lit(1)).alias("n"))
    placed = space.region_cells(cells, b.mixed_regions(spark, sf_dir))
    return placed.groupBy("region").agg(F.count(F.lit(1)).alias("n_cells"), F.sum("n").alias("n_rows"))


@query
def cells_in_country(spark, sf_dir):
    """Cells inside polygons with holes and islands, given as corners."""
    cells = b.grid(spark, sf_dir).groupBy("lat", "lon").agg(F.count(F.lit(1)).alias("n"))
    edges = countries.edges_from_points(b.country_points(spark, sf_dir))
    return countries.cells_in_countries(cells, edges).select("name", "lat", "lon", "n")


@query
def acquisition_accounting(spark, sf_dir):
    """Every manifest row under exactly one status."""
    found = audit.account(
        b.careless_manifest(spark, sf_dir), b.existing_files(spark, sf_dir), b.local_digests(spark, sf_dir)
    )
    return catalog.status_summary(found)


# --- ensembles ----------------------------------------------------------------------


@query
def ensemble_quantiles(spark, sf_dir):
    return ensemble.ensemble_quantiles(series.model_series(b.model_grid(spark, sf_dir), b.CONFIG))


@query
def ensemble_running_mean(spark, sf_dir):
    """Median and quartiles of every scenario and observation set, smoothed."""
    return series.ensemble_spread(_all_series(spark, sf_dir), b.CONFIG)


@query
def dense_alignment(spark, sf_dir):
    dense = ensemble.dense_alignment(
        series.model_series(b.model_grid(spark, sf_dir), b.CONFIG), b.BOUND_MODELS
    )
    return dense.select("experiment", "year", "model", "anomaly")


@query
def ensemble_map(spark, sf_dir):
    return maps.change_map(b.model_grid(spark, sf_dir), b.CONFIG)


@query
def ensemble_map_levels(spark, sf_dir):
    return maps.classified_map(b.model_grid(spark, sf_dir), b.CONFIG, digits=DIGITS)


@query
def precipitation_map_levels(spark, sf_dir):
    return maps.classified_map(b.model_grid(spark, sf_dir, "pr"), b.CONFIG_PR, digits=DIGITS)


@query
def map_sign_shares(spark, sf_dir):
    change = maps.change_map(b.model_grid(spark, sf_dir), b.CONFIG)
    return ensemble.sign_shares(change.withColumn("anomaly", F.round("anomaly", DIGITS)))


@query
def level_census(spark, sf_dir):
    """Display level of every single time step, counted."""
    grid = b.grid(spark, sf_dir, "pr")
    shown = ensemble.classify(
        grid.withColumn("value", F.round(F.col("value") - 0.3, DIGITS)), LEVEL_EDGES["pr"], "value"
    )
    return shown.groupBy("experiment", "level").agg(F.count(F.lit(1)).alias("n"))


@query
def model_availability(spark, sf_dir):
    grid = catalog.keep_models(b.model_grid(spark, sf_dir), b.BOUND_MODELS)
    found = ensemble.availability(grid, b.BASELINE, b.FUTURE)
    kept = found.filter((F.col("experiment") != HISTORICAL) & F.col("has_baseline") & (F.col("n_cells") > 0))
    return kept.select("model", "experiment", "n_cells")


@query
def availability_gaps(spark, sf_dir):
    """Pairs of model and scenario that have no result, and why."""
    grid = b.model_grid(spark, sf_dir)
    return ensemble.availability_gaps(grid, b.BASELINE, b.FUTURE, b.CONFIG.scenarios).select(
        "model", "experiment", "reason"
    )


@query
def trend_variability(spark, sf_dir):
    found = series.model_series(b.model_grid(spark, sf_dir), b.CONFIG)
    return ensemble.trend(found, ("model", "experiment"))


@query
def scenario_rank(spark, sf_dir):
    spread = ensemble.ensemble_quantiles(
        series.model_series(b.model_grid(spark, sf_dir), b.CONFIG_ALL_REGIONS)
    )
    ranked = ensemble.scenario_rank(spread, *b.FUTURE)
    return ranked.select("region", "experiment", "change", "position")


# --- quality -----------------------------------------------------------------------


@query
def duplicate_report(spark, sf_dir):
    return quality.duplicate_report(b.order_times(spark, sf_dir), ["series"])


@query
def series_profile(spark, sf_dir):
    profile = quality.series_profile(b.order_times(spark, sf_dir), ["series"])
    return profile.withColumn("variables", F.array_join("variables", ","))


@query
def coverage_gaps(spark, sf_dir):
    grid = b.grid(spark, sf_dir)
    return quality.coverage_gaps(grid, ["model", "experiment"], 1994, 2002)


@query
def coverage_by_year(spark, sf_dir):
    wanted = calendar.request_calendar(spark, 1994, 2002)
    return quality.missing_months(wanted, b.grid(spark, sf_dir))


@query
def coverage_audit(spark, sf_dir):
    grid = b.grid(spark, sf_dir)
    found = audit.audit_coverage(grid, ["model", "experiment", *CELL], 1995, 2001)
    return _on_cells(found, "model", "experiment", "year", "n_missing")


@query
def rejected_files(spark, sf_dir):
    """Raw names without a re-issue tag carry no ``_YYYY_`` and are turned away."""
    parsed = parse_names(b.file_names(spark, sf_dir).select("file_name"))
    rules = [
        ("no year in name", F.col("year").isNull()),
        ("unwanted variable", ~names.wanted_variable(F.col("file_name"))),
    ]
    _, rejected = quality.split_rejects(parsed, rules)
    return rejected.groupBy("variable", "reason").agg(F.count(F.lit(1)).alias("n"))


@query
def missing_values(spark, sf_dir):
    """NaN marks missing steps; means skip them and all-missing cells stay missing."""
    raw = b.raw_grid(spark, sf_dir)
    with_gaps = raw.withColumn(
        "value", F.when(F.col("value") > 40, float("nan")).otherwise(F.col("value"))
    )
    means = temporal.yearly_mean(grids.canonical_grid(with_gaps))
    return _on_cells(means, "model", "experiment", "year", "value", "n_steps")


@query
def unit_conversion(spark, sf_dir):
    both = b.raw_grid(spark, sf_dir).unionByName(b.raw_grid(spark, sf_dir, "pr"))
    converted = grids.canonical_grid(grids.canonical_grid(both))
    return converted.groupBy("variable", "unit", "experiment").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean_value"), F.max("value").alias("highest")
    )


def _aliased(spark, sf_dir) -> DataFrame:
    """One column per alias, as in files of three different providers."""
    item = b.table(spark, sf_dir, "lineitem")

    def when(flag: str):
        return F.when(F.col("l_returnflag") == flag, F.col("l_quantity"))

    open_ = F.col("l_linestatus") == "O"
    return item.select(
        F.col("l_suppkey").alias("series"),
        when("A").alias("tas"),
        F.when(open_, F.col("l_quantity") + 100).alias("var167"),
        when("R").alias("temperature_anomaly"),
    )


@query
def variable_resolver(spark, sf_dir):
    found = grids.resolve_variable(_aliased(spark, sf_dir), "tas")
    return found.groupBy("series").agg(F.count("value").alias("n"), F.sum("value").alias("total"))


@query
def variable_resolver_rows(spark, sf_dir):
    """The alias is a column of the rows; each order takes the best it has."""
    item = b.table(spark, sf_dir, "lineitem")
    alias = (
        F.when(F.col("l_returnflag") == "A", "tas")
        .when(F.col("l_returnflag") == "N", "var167")
        .when(F.col("l_linestatus") == "F", "temperature_anomaly")
        .otherwise("hurs")
    )
    rows = item.select(
        F.col("l_orderkey").alias("series"), alias.alias("variable"), F.col("l_quantity").alias("value")
    )
    best = grids.resolve_variable_rows(rows, "tas", ["series"])
    return best.groupBy("series", "variable").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")
    )


@query
def flatten_rows(spark, sf_dir):
    rows = b.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    flat = grids.flatten_rows(rows, "embedding")
    return flat.select("vec_id", "lon_index", F.col("value").cast("double").alias("value"))


@query
def observation_sources(spark, sf_dir):
    kept = grids.enabled_observations(_all_series(spark, sf_dir), b.CONFIG.observations)
    return kept.groupBy("source").agg(F.count(F.lit(1)).alias("n_years"))


# --- files and manifests ---------------------------------------------------------------


@query
def uri_file_name(spark, sf_dir):
    pages = b.table(spark, sf_dir, "pages")
    return pages.select("page_id", names.uri_file_name(F.col("url")).alias("file_name"))


@query
def file_name_parse(spark, sf_dir):
    reduced = names.yearmean_name(F.col("file_name"))
    parsed = parse_names(b.file_names(spark, sf_dir).select(reduced.alias("file_name")))
    return parsed.groupBy("variable", "frequency", "model", "experiment", "grid", "year", "version").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("member").alias("n_members")
    )


@query
def series_label(spark, sf_dir):
    parsed = parse_names(b.file_names(spark, sf_dir).select("file_name"))
    label = names.series_label(F.col("model"), F.col("experiment"))
    return parsed.groupBy(
        label.alias("label"),
        F.upper("experiment").alias("title"),
        F.lower("model").alias("model_lower"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query
def file_groups(spark, sf_dir):
    return catalog.file_groups(parse_names(b.yearmean_files(spark, sf_dir)))


@query
def merge_order(spark, sf_dir):
    ordered = catalog.merge_order(parse_names(b.yearmean_files(spark, sf_dir)))
    return ordered.select("variable", "model", "experiment", "year", "file_name", "position")


@query
def version_pick(spark, sf_dir):
    files = b.file_names(spark, sf_dir).select("file_name").distinct()
    return catalog.pick_version(files)


@query
def version_pick_reduced(spark, sf_dir):
    """Reduced files with and without a re-issue tag: one of each base stays."""
    return catalog.pick_version(b.yearmean_files(spark, sf_dir))


@query
def merge_order_raw(spark, sf_dir):
    """Raw names, most of which have no year; they come last and none is lost."""
    files = b.file_names(spark, sf_dir).select("file_name").distinct()
    ordered = catalog.merge_order(parse_names(files))
    return ordered.select("variable", "model", "experiment", "year", "file_name", "position")


@query
def acquisition_rejects(spark, sf_dir):
    """Manifest rows that can be used and those that cannot, by reason."""
    good, bad = audit.manifest_rejects(b.careless_manifest(spark, sf_dir))
    rows = good.select("variable", F.lit("usable").alias("reason")).union(bad.select("variable", "reason"))
    return rows.groupBy("variable", "reason").agg(F.count(F.lit(1)).alias("n"))


@query
def box_select_edges(spark, sf_dir):
    """Cells of a tenth of a degree on the edges of a box."""
    grid = grids.canonical_grid(b.fine_grid(spark, sf_dir))
    found = space.select_box(grid, Region("fine", 50.1, 50.7, 5.1, 5.5))
    keyed = found.groupBy("lat_q", "lon_q").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return keyed


@query
def model_filter_substring(spark, sf_dir):
    kept = catalog.keep_models_in_uri(b.file_names(spark, sf_dir), MODELS, "file_name")
    return parse_names(kept).groupBy("model").agg(F.count(F.lit(1)).alias("n"))


@query
def model_filter_exact(spark, sf_dir):
    kept = catalog.keep_models(parse_names(b.file_names(spark, sf_dir)), MODELS)
    return kept.groupBy("model").agg(F.count(F.lit(1)).alias("n"))


@query
def variable_filter(spark, sf_dir):
    kept = catalog.keep_wanted_variables(b.file_names(spark, sf_dir))
    return parse_names(kept).groupBy("variable", "experiment").agg(F.count(F.lit(1)).alias("n"))


@query
def series_filter(spark, sf_dir):
    parsed = parse_names(b.file_names(spark, sf_dir))
    kept = catalog.keep_series(parsed, "tas", b.CONFIG.experiments)
    return kept.groupBy("variable", "model", "experiment").agg(F.count(F.lit(1)).alias("n"))


@query
def derived_name(spark, sf_dir):
    name = F.col("file_name")
    return b.file_names(spark, sf_dir).select("file_name").distinct().select(
        "file_name",
        names.version_base(name).alias("base"),
        names.version_name(name).alias("reissued"),
        names.yearmean_name(name).alias("yearmean"),
    )


@query
def checksum_verify(spark, sf_dir):
    return catalog.verify_digests(
        b.document_manifest(spark, sf_dir), b.document_digests(spark, sf_dir)
    )


@query
def skip_existing(spark, sf_dir):
    files = b.file_names(spark, sf_dir).select("file_name").distinct()
    return catalog.skip_existing(files, b.existing_files(spark, sf_dir))


@query
def pending_files(spark, sf_dir):
    files = b.file_names(spark, sf_dir).select("file_name").distinct()
    left = catalog.pending(files, b.existing_files(spark, sf_dir))
    return parse_names(left).groupBy("variable", "model").agg(F.count(F.lit(1)).alias("n"))


@query
def status_summary(spark, sf_dir):
    files = b.file_names(spark, sf_dir).select("file_name").distinct()
    checked = catalog.skip_existing(files, b.existing_files(spark, sf_dir))
    status = F.coalesce("skip_reason", F.lit("pending")).alias("status")
    return catalog.status_summary(parse_names(checked).withColumn("status", status))


@query
def acquisition_audit(spark, sf_dir):
    return audit.acquisition_status(
        b.manifest(spark, sf_dir), b.existing_files(spark, sf_dir), b.local_digests(spark, sf_dir)
    )


@query
def path_list(spark, sf_dir):
    lines = b.table(spark, sf_dir, "documents").select(
        "doc_id", F.explode(F.split("text", "\n")).alias("value")
    )
    return skip_empty(lines, "value").groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_paths"), F.sum(F.length("value")).alias("n_chars")
    )


@query
def manifest_strip(spark, sf_dir):
    text = F.concat(F.lit("\t "), F.col("text"), F.lit(" \n"))
    return b.table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.md5(names.strip_whitespace(text)).alias("stripped_md5")
    )


# --- countries ------------------------------------------------------------------------


@query
def country_centroid(spark, sf_dir):
    return countries.centroids(b.nation_countries(spark, sf_dir))


@query
def country_in_box(spark, sf_dir):
    return countries.meets_box(b.customer_countries(spark, sf_dir), REGIONS["central_asia"])


@query
def country_select(spark, sf_dir):
    chosen = ("NATION_1", "NATION_4", "NATION_9", "NATION_16", "NATION_24")
    return labels.selected_labels(b.nation_countries(spark, sf_dir), chosen)


@query
def country_labels(spark, sf_dir):
    return labels.labels_in_box(b.customer_countries(spark, sf_dir), REGIONS["europe"])


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ensemble spread of every scenario and observation set by year."""
    return registry()["ensemble_running_mean"](spark, sf_dir)


__all__ = ["SERIES_KEYS", "flagship", "query", "registry", "tidy"]
