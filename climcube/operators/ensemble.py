"""Statistics across models, and of ensemble series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from climcube.config import HISTORICAL, SCENARIOS
from climcube.functions import values
from climcube.schema import CELL

GROUP = ("variable", "experiment", "region")
QUANTILES = (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))


def ensemble_quantiles(
    series: DataFrame,
    value: str = "anomaly",
    keys: Sequence[str] = (*GROUP, "year"),
    probs: Sequence[tuple[str, float]] = QUANTILES,
) -> DataFrame:
    """Exact quantiles over models with linear interpolation, missing skipped.

    ``series`` holds one row per model and key (``field_mean`` and
    ``dedupe_time`` make that so), hence a group is as large as the number of
    models.  A year that one model lacks is missing only there.
    """
    names = [n for n, _ in probs]
    levels = F.array(*[F.lit(p) for _, p in probs])
    found = series.groupBy(*keys).agg(
        F.percentile(value, levels).alias("_q"), F.count(value).alias("n_models")
    )
    return found.select(
        *keys, *[F.get("_q", F.lit(i)).alias(n) for i, n in enumerate(names)], "n_models"
    )


def running_mean(
    df: DataFrame,
    columns: Sequence[str],
    width: int,
    partition: Sequence[str] = GROUP,
    order: str = "year",
    suffix: str = "_rm",
) -> DataFrame:
    """Centred mean over ``width`` rows; incomplete windows are missing."""
    before = width // 2
    w = Window.partitionBy(*partition).orderBy(order).rowsBetween(-before, width - 1 - before)
    return df.withColumns(
        {
            c + suffix: F.when(F.count(c).over(w) == width, F.avg(c).over(w))
            for c in columns
        }
    )


def ensemble_mean(
    grid: DataFrame,
    value: str = "anomaly",
    keys: Sequence[str] = ("variable", "experiment", *CELL),
) -> DataFrame:
    """Mean over models per cell, each model with equal weight."""
    return grid.groupBy(*keys).agg(F.avg(value).alias(value), F.count(value).alias("n_models"))


def change_per_model(
    yearly: DataFrame,
    baseline: tuple[int, int],
    future: tuple[int, int],
    scenarios: Sequence[str],
) -> DataFrame:
    """Future mean minus historical baseline, per model, scenario and cell.

    Baseline and all scenarios are conditional means of *one* aggregation, so
    the grid is read once and nothing is joined.  Equal to ``period_mean``
    joined with ``climatology``: a cell needs rows on both sides.
    """
    is_base = (F.col("experiment") == HISTORICAL) & F.col("year").between(*baseline)
    in_future = F.col("year").between(*future)
    wanted = is_base | (F.col("experiment").isin(list(scenarios)) & in_future)
    means, counts = [], []
    for s in scenarios:
        rows = (F.col("experiment") == s) & in_future
        means.append(F.avg(F.when(rows, F.col("value"))).alias(f"_mean_{s}"))
        counts.append(F.count(F.when(rows, F.lit(1))).alias(f"_rows_{s}"))
    keys = ("variable", "source", "model", *CELL)
    summary = (
        yearly.filter(wanted)
        .groupBy(*keys)
        .agg(
            F.avg(F.when(is_base, F.col("value"))).alias("clim"),
            F.count(F.when(is_base, F.lit(1))).alias("_base_rows"),
            *means,
            *counts,
        )
    )
    per_scenario = [
        F.struct(
            F.lit(s).alias("experiment"),
            (F.col(f"_mean_{s}") - F.col("clim")).alias("anomaly"),
            F.col(f"_rows_{s}").alias("rows"),
        )
        for s in scenarios
    ]
    return (
        summary.filter("_base_rows > 0")
        .select(*keys, F.explode(F.array(*per_scenario)).alias("_s"))
        .filter("_s.rows > 0")
        .select(*keys, "_s.experiment", "_s.anomaly")
    )


def classify(maps: DataFrame, edges: Sequence[float], value: str = "anomaly") -> DataFrame:
    """Add the index of the discrete map level."""
    return maps.withColumn("level", values.level_index(F.col(value), edges))


def dense_alignment(series: DataFrame, models: Sequence[str],
                    keys: Sequence[str] = (*GROUP, "year")) -> DataFrame:
    """Every listed model at every time of its group, missing where it has no value.

    One aggregation gathers the values of a group, as many as there are models,
    and the list of models, which comes from the configuration, is unfolded
    over it.  The series is computed once and joined with nothing.
    """
    wanted = F.col("model").isin(list(models))
    groups = series.groupBy(*keys).agg(
        F.collect_list(F.when(wanted, F.struct("model", "anomaly"))).alias("_found")
    )
    frame = groups.select("*", F.explode(F.array(*[F.lit(m) for m in models])).alias("_model"))
    own = F.filter("_found", lambda x: x["model"] == F.col("_model"))
    return frame.select(*keys, F.col("_model").alias("model"), F.explode_outer(own).alias("_own")).select(
        *keys, "model", F.col("_own.anomaly").alias("anomaly")
    )


def availability(
    yearly: DataFrame, baseline: tuple[int, int], future: tuple[int, int],
    keys: Sequence[str] = ("variable", "model"),
) -> DataFrame:
    """Per model and experiment whether there is a baseline and how many cells the future has.

    One aggregation over (model, experiment, cell) and a small one on top: the grid is
    read once.  ``has_baseline`` holds for all experiments of a model.
    """
    is_base = (F.col("experiment") == HISTORICAL) & F.col("year").between(*baseline)
    in_future = F.col("year").between(*future)
    cells = yearly.groupBy(*keys, "experiment", *CELL).agg(
        F.bool_or(is_base).alias("_base"), F.bool_or(in_future).alias("_future")
    )
    found = cells.groupBy(*keys, "experiment").agg(
        F.bool_or("_base").alias("_base"), F.count_if("_future").alias("n_cells")
    )
    of_model = Window.partitionBy(*keys)
    return found.withColumn("has_baseline", F.bool_or("_base").over(of_model)).drop("_base")


def availability_gaps(
    yearly: DataFrame, baseline: tuple[int, int], future: tuple[int, int], scenarios: Sequence[str],
    keys: Sequence[str] = ("variable", "model"),
) -> DataFrame:
    """Model and scenario pairs that the analyses leave out, with the reason."""
    found = availability(yearly, baseline, future, keys)
    of_model = found.groupBy(*keys).agg(
        F.bool_or("has_baseline").alias("_base"),
        F.collect_set(F.when(F.col("n_cells") > 0, F.col("experiment"))).alias("_have"),
    )
    rows = of_model.select("*", F.explode(F.array(*[F.lit(s) for s in scenarios])).alias("experiment"))
    reason = F.when(~F.col("_base"), "no baseline").when(
        ~F.array_contains("_have", F.col("experiment")), "no scenario result"
    )
    return rows.select(*keys, "experiment", reason.alias("reason")).filter("reason IS NOT NULL")


def available_models(per_model: DataFrame, clim: DataFrame,
                     keys: Sequence[str] = ("variable", "model")) -> DataFrame:
    """Model and scenario pairs with both a climatology and a regional result."""
    return per_model.join(clim.select(*keys).distinct(), list(keys), "left_semi")


def trend(series: DataFrame, keys: Sequence[str], value: str = "anomaly") -> DataFrame:
    """Linear trend per year and interannual variability of a series."""
    return series.groupBy(*keys).agg(
        F.regr_slope(F.col(value), F.col("year")).alias("trend"),
        F.stddev_samp(value).alias("variability"),
        F.count(value).alias("n_years"),
    )


def scenario_rank(
    ensemble: DataFrame, first: int, last: int, value: str = "p50",
    within: Sequence[str] = ("variable", "region"), scenarios: Sequence[str] = SCENARIOS,
) -> DataFrame:
    """Period mean per scenario and its rank, the largest change first.

    History and observations are no scenarios and take no rank.
    """
    means = (
        ensemble.filter(F.col("year").between(first, last) & F.col("experiment").isin(list(scenarios)))
        .groupBy(*within, "experiment")
        .agg(F.avg(value).alias("change"))
    )
    w = Window.partitionBy(*within).orderBy(F.desc("change"))
    return means.withColumn("position", F.rank().over(w))


def sign_shares(maps: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Share of cells that become wetter (warmer) and drier (cooler), per region if the maps name one."""
    keys = [k for k in GROUP if k in maps.columns] if keys is None else keys

    def share(test):
        return F.avg(F.when(F.col("anomaly").isNotNull(), test.cast("double")))

    return maps.groupBy(*keys).agg(
        share(F.col("anomaly") > 0).alias("share_up"),
        share(F.col("anomaly") < 0).alias("share_down"),
        F.count("anomaly").alias("n_cells"),
    )
