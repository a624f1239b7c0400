"""The library's input tables, derived from the driver's relational tables.

Grid cells are 15 by 30 degrees, stored with longitudes from 0 to 360.  Every line
item is a row of the whole grid, where ``source`` tells observations (the flags
RO) and model output apart.  Analyses that combine sets by their meaning get
each set from it; all other queries run over the whole grid.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from climcube.config import MODELS, REANALYSIS, REGIONS, RunConfig
from climcube.functions import geometry, names
from climcube.sources.grids import canonical_grid

# Two models outside the priority list; the last one has no historical run.
BOUND_MODELS = (*MODELS, "EC-Earth3-Veg-LR", "NorESM2-LM")
NO_HISTORY = len(BOUND_MODELS) - 1
FLAG_EXPERIMENTS = {"AF": "historical", "AO": "ssp126", "NF": "ssp245", "NO": "ssp370", "RF": "ssp585"}
POLAR_AXIS = (-90.0, -80.0, -65.0, -45.0, -30.0, -10.0, 0.0, 5.0, 20.0, 50.0, 75.0, 90.0)
FILE_VARIABLES = ("tas", "tasmin", "tasmax", "pr", "hurs")
BASELINE = (1995, 1997)
FUTURE = (2000, 2001)

CONFIG = RunConfig(baseline=BASELINE, future=FUTURE, running_years=3)
CONFIG_PR = RunConfig(variable="pr", baseline=BASELINE, future=FUTURE, running_years=3, observations=())
CONFIG_PR_ALL = RunConfig(variable="pr", baseline=BASELINE, future=FUTURE, running_years=3, observations=(REANALYSIS,))
CONFIG_ALL_REGIONS = RunConfig(
    baseline=BASELINE, future=FUTURE, running_years=3, regions=tuple(REGIONS.values())
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(options: tuple[str, ...], index: str) -> Column:
    listed = ", ".join(f"'{o}'" for o in options)
    return F.expr(f"element_at(array({listed}), CAST({index} % {len(options)} + 1 AS INT))")


def _flags() -> Column:
    return F.concat("l_returnflag", "l_linestatus")


def _model() -> Column:
    return _pick(BOUND_MODELS, "l_suppkey * 7")


def _experiment() -> Column:
    """By the two flags of a line item; NULL marks an observation."""
    cases = " ".join(f"WHEN '{flags}' THEN '{name}'" for flags, name in FLAG_EXPERIMENTS.items())
    return F.expr(
        f"""CASE WHEN l_suppkey * 7 % {len(BOUND_MODELS)} = {NO_HISTORY}
                  AND l_returnflag = 'A' AND l_linestatus = 'F' THEN 'hist-aer'
             ELSE CASE l_returnflag || l_linestatus {cases} END END"""
    )


def _cell() -> dict[str, Column]:
    return {
        "lat": F.expr("CAST((l_partkey % 12) * 15 - 82.5D AS DOUBLE)"),
        "lon": F.expr("CAST((l_partkey DIV 12 % 12) * 30 + 15 AS DOUBLE)"),
    }


def _raw_value(variable: str) -> Column:
    """Temperature as it is; precipitation as a flux in kg/m²/s.

    The many digits keep means off the halves of the last digit that comparisons keep.
    """
    return F.expr("l_quantity" if variable == "tas" else "l_discount * 6.371823947D / 86400")


def raw_grid(spark: SparkSession, sf_dir: str, variable: str = "tas") -> DataFrame:
    """Every line item as a row of one grid, with longitudes from 0 to 360 and unconverted units."""
    observed = _flags() == "RO"
    return table(spark, sf_dir, "lineitem").select(
        F.lit(variable).alias("variable"),
        F.when(observed, REANALYSIS).otherwise("CMIP6").alias("source"),
        F.when(observed, REANALYSIS).otherwise(_model()).alias("model"),
        F.when(observed, REANALYSIS).otherwise(_experiment()).alias("experiment"),
        F.year("l_shipdate").alias("year"),
        F.month("l_shipdate").alias("month"),
        *[c.alias(n) for n, c in _cell().items()],
        _raw_value(variable).alias("value"),
    )


def grid(spark: SparkSession, sf_dir: str, variable: str = "tas") -> DataFrame:
    """The whole grid: model output and reanalysis."""
    return canonical_grid(raw_grid(spark, sf_dir, variable))


def model_grid(spark: SparkSession, sf_dir: str, variable: str = "tas") -> DataFrame:
    return canonical_grid(raw_grid(spark, sf_dir, variable).filter(F.col("source") != REANALYSIS))


def reanalysis_grid(spark: SparkSession, sf_dir: str, variable: str = "tas") -> DataFrame:
    return canonical_grid(raw_grid(spark, sf_dir, variable).filter(F.col("source") == REANALYSIS))


def _station_cells(spark: SparkSession, sf_dir: str, whole: bool = False) -> DataFrame:
    lon = geometry.wrap_longitude(_cell()["lon"], -180.0)
    rows = table(spark, sf_dir, "lineitem")
    return (rows if whole else rows.filter(_flags() == "RO")).select(
        "*",
        _cell()["lat"].alias("lat"),
        lon.alias("lon"),
        geometry.cell_key(_cell()["lat"]).alias("lat_q"),
        geometry.cell_key(lon).alias("lon_q"),
    )


def station_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _station_cells(spark, sf_dir)
    return cells.select(
        F.year("l_shipdate").alias("year"), "lat", "lon", "lat_q", "lon_q",
        (F.col("l_quantity") - 25).alias("temperature"),
    )


def station_climatology(spark: SparkSession, sf_dir: str, whole: bool = False) -> DataFrame:
    """Monthly layers of the station set, or of all line items."""
    cells = _station_cells(spark, sf_dir, whole)
    return cells.groupBy(
        F.month("l_shipdate").alias("month_number"), "lat", "lon", "lat_q", "lon_q"
    ).agg(F.avg(F.col("l_tax") * 100).alias("climatology"))


def _file_name() -> Column:
    version = F.when(F.col("l_tax") > 0.04, names.VERSION_TAG).otherwise("")
    return F.concat(
        _pick(FILE_VARIABLES, "l_linenumber"),
        F.lit("_day_"), _model(), F.lit("_"), F.coalesce(_experiment(), F.lit("obs")),
        F.lit("_r"), (F.col("l_orderkey") % 100 + 1).cast("string"), F.lit("i1p1f1_gn_"),
        F.year("l_shipdate").cast("string"), version, F.lit(".nc"),
    )


def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item with the name of the model file it belongs to.

    The name passes through a generator: a filter on it then tests the finished
    column, as on a stored one, and not copies of the expression.
    """
    return table(spark, sf_dir, "lineitem").select(
        "l_discount", F.explode(F.array(_file_name())).alias("file_name")
    )


def grid_of_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A grid whose rows know the reduced file that they were read from; some years have two versions."""
    name = names.yearmean_name(_file_name())
    return table(spark, sf_dir, "lineitem").select(
        F.explode(F.array(name)).alias("file_name"), F.year("l_shipdate").alias("year"),
        *[c.alias(n) for n, c in _cell().items()],
        *[geometry.cell_key(c).alias(f"{n}_q") for n, c in _cell().items()],
        F.col("l_quantity").alias("value"),
    )


def series_of_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reduced series as providers write them.

    A line item is a value of the file of its supplier and flags.  Files of different suppliers use
    different names for the variable, some mix two; times are timestamps or decimal years, and years repeat.
    """
    first = F.expr("l_suppkey % 3 = 0")
    alias = (
        F.when(first & (F.col("l_linenumber") % 2 == 0), "tas").when(first, "var167")
        .when(F.col("l_suppkey") % 3 == 1, "var167")
        .when(F.col("l_linenumber") % 4 == 0, "hurs").otherwise("temperature_anomaly")
    )
    stamped = F.col("l_suppkey") % 2 == 0
    decimal = F.year("l_shipdate") + (F.dayofyear("l_shipdate") - 0.5) / 366
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("s"), F.col("l_suppkey").cast("string"), _flags()).alias("file_name"),
        F.coalesce(F.when(_flags() == "RO", REANALYSIS), _experiment()).alias("experiment"),
        alias.alias("variable"),
        F.when(stamped, F.col("l_shipdate").cast("timestamp_ntz")).alias("time"),
        F.when(~stamped, decimal).alias("time_label"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("position"),
        (F.col("l_quantity") - 25).alias("value"),
    )


def polar_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole grid on an axis with unequal steps and rows on both poles."""
    lat = F.expr("element_at(array(" + ", ".join(f"{x}D" for x in POLAR_AXIS) + "), CAST(l_partkey % 12 + 1 AS INT))")
    return table(spark, sf_dir, "lineitem").select(
        F.when(_flags() == "RO", REANALYSIS).otherwise(_model()).alias("model"),
        F.year("l_shipdate").alias("year"), lat.alias("lat"), geometry.cell_key(lat).alias("lat_q"),
        F.col("l_quantity").alias("value"),
    )


def mixed_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A box per supplier: the globe, half of it, a wide and thin band, a few degrees, and single fine cells."""
    k = F.col("s_suppkey")
    kind = k % 5
    east = (k * 7 % 360).cast("double")
    lat = ((k * 3 % 100) * 0.1 + 45).cast("double")
    fine = F.round(F.lit(50.0) + k % 10 * 0.1, 1)

    def pick(*values):
        return reduce(lambda acc, v: acc.when(kind == v[0], v[1]), enumerate(values), F)

    low, high = F.lit(-90.0), F.lit(90.0)
    return table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("region"),
        pick(low, low, lat, lat, fine).alias("lat_min"),
        pick(high, high, F.round(lat + 0.1, 1), lat + 8, fine).alias("lat_max"),
        pick(F.lit(-180.0), east, F.lit(-180.0), east - 180, F.lit(5.0)).alias("lon_min"),
        pick(F.lit(180.0), east + 180, F.lit(180.0), east - 172, F.lit(5.0)).alias("lon_max"),
    )


def country_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corners of polygons as rows, one country per nation.

    Each customer adds a square ring; every third of them has a smaller ring inside, which is a hole and runs
    the same way as its outer ring.
    """
    k = F.col("c_custkey")
    x, y = (k % 34) * 10 - 180, (k * 5 % 16) * 10 - 85
    width, height = k % 7 * 4 + 12, k % 5 * 4 + 12
    outer = [(x, y), (x + width, y), (x + width, y + height), (x, y + height)]
    inner = [(x + 3, y + 3), (x + width - 3, y + 3), (x + width - 3, y + height - 3), (x + 3, y + height - 3)]

    def ring(number, corners):
        points = F.array(*[F.struct(F.lit(i).alias("seq"), a.cast("double").alias("x"), b.cast("double").alias("y"))
                           for i, (a, b) in enumerate(corners)])
        return F.struct((k * 2 + number).alias("ring_id"), points.alias("points"))

    rings = F.when(k % 3 == 0, F.array(ring(0, outer), ring(1, inner))).otherwise(F.array(ring(0, outer)))
    rows = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("n_nationkey"), F.explode(rings).alias("r"))
    named = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("name"))
    corners = rows.select("n_nationkey", "r.ring_id", F.explode("r.points").alias("p"))
    return corners.join(named, "n_nationkey").select("name", "ring_id", "p.seq", "p.x", "p.y")


def yearmean_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct names of reduced files, the input of the analyses."""
    return file_names(spark, sf_dir).select(
        names.yearmean_name(F.col("file_name")).alias("file_name")
    ).distinct()


def file_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct raw file names; ``state`` decides what lies on disk already."""
    return file_names(spark, sf_dir).groupBy("file_name").agg(
        F.round(F.min("l_discount") * 100).cast("int").alias("state")
    )


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Padded digests and URIs, as a careless index file has them."""
    uri = F.expr(
        "concat(' https://data.example.org/files/', split_part(file_name, '_', 3), '/', file_name, '?x=1\t')"
    )
    md5 = F.concat(F.lit("\t"), F.md5("file_name"), F.lit(" "))
    listed = file_names(spark, sf_dir).select("file_name").distinct()
    return listed.select(md5.alias("md5"), F.explode(F.array(uri)).alias("uri"))


def careless_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest row per line item; some lack the URI, the file name or the digest, or hold a brace."""
    k = F.col("l_orderkey") % 10
    rows = table(spark, sf_dir, "lineitem").select(k.alias("k"), F.explode(F.array(_file_name())).alias("file_name"))
    uri = (
        F.when(F.col("k") == 0, F.lit(" \t"))
        .when(F.col("k") == 1, F.lit("https://data.example.org/files/"))
        .when(F.col("k") == 2, F.concat(F.lit("https://data.example.org/{a b}/"), "file_name", F.lit("#x")))
        .otherwise(F.concat(F.lit("https://data.example.org/files/"), "file_name", F.lit("?x=1")))
    )
    md5 = F.when(F.col("k") == 3, F.lit("none")).otherwise(F.md5("file_name"))
    return rows.select(md5.alias("md5"), uri.alias("uri"))


def fine_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A grid of 0.1 degrees around 50 N 5 E with longitudes from 0 to 360."""
    return table(spark, sf_dir, "lineitem").select(
        F.lit("tas").alias("variable"), F.lit("CMIP6").alias("source"), _model().alias("model"),
        F.lit("historical").alias("experiment"), F.year("l_shipdate").alias("year"),
        (F.lit(50.0) + F.col("l_partkey") % 10 * 0.1).alias("lat"),
        (F.lit(365.0) + F.floor(F.col("l_partkey") / 10) % 10 * 0.1).alias("lon"),
        F.col("l_quantity").alias("value"),
    )


def existing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names on disk: a yearly mean, a re-issued version or the file itself."""
    name = F.col("file_name")
    kept = (
        F.when(F.col("state") == 0, names.yearmean_name(name))
        .when(F.col("state") == 1, names.version_name(name))
        .when(F.col("state") == 2, name)
    )
    return file_states(spark, sf_dir).select(kept.alias("file_name")).filter("file_name IS NOT NULL")


def local_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of downloaded copies, some of them corrupted."""
    digest = F.when(F.col("state") == 5, F.md5(F.lit("corrupted"))).otherwise(F.md5("file_name"))
    return (
        file_states(spark, sf_dir)
        .filter(F.col("state").between(3, 5))
        .select("file_name", digest.alias("actual_md5"))
    )


def document_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with an expected digest; those of low quality expect another one."""
    digests = table(spark, sf_dir, "documents").select(
        "doc_id", F.md5("text").alias("plain"), F.md5(F.concat("text", F.lit("!"))).alias("marked")
    )
    low = table(spark, sf_dir, "labels").filter("quality = 0").select("doc_id", F.lit(True).alias("low"))
    expected = F.when(F.col("low"), F.col("marked")).otherwise(F.col("plain"))
    return digests.join(low, "doc_id", "left").select(
        F.col("doc_id").cast("string").alias("file_name"), expected.alias("md5")
    )


def document_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actual digests of the documents that were fetched, which are the labelled ones."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("actual_md5"))
    fetched = docs.join(table(spark, sf_dir, "labels"), "doc_id", "left_semi")
    return fetched.select(F.col("doc_id").cast("string").alias("file_name"), "actual_md5")


def _triangle() -> Column:
    """A triangle on the globe per customer, with its own width and height."""
    x = "CAST((c_custkey % 34) * 10 - 180 AS DOUBLE)"
    y = "CAST((c_custkey * 5 % 16) * 10 - 85 AS DOUBLE)"
    corners = [
        (x, y),
        (f"{x} + c_custkey % 7 + 3", y),
        (x, f"{y} + c_custkey % 5 + 2"),
    ]
    return F.expr("array(" + ", ".join(f"struct({cx} AS x, {cy} AS y)" for cx, cy in corners) + ")")


def customer_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One country with one ring per customer."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"), F.lit(0).alias("ring_id"), _triangle().alias("ring")
    )


def nation_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One country per nation; each of its customers adds a ring."""
    rings = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("n_nationkey"),
        F.col("c_custkey").cast("int").alias("ring_id"),
        _triangle().alias("ring"),
    )
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("name"))
    return rings.join(nation, "n_nationkey").select("name", "ring_id", "ring")


def customer_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A box per customer; some cross the 180th meridian."""
    k = F.col("c_custkey")
    lat_min = ((k % 15) * 10 - 80).cast("double")
    lon_min = ((F.floor(k / 15) % 24) * 15 - 180).cast("double")
    return table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("region"),
        lat_min.alias("lat_min"),
        (lat_min + 5 + k % 20).alias("lat_max"),
        lon_min.alias("lon_min"),
        (lon_min + 10 + k % 50).alias("lon_max"),
    )


def order_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as the time steps of one series per customer; years repeat."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("series"),
        F.col("o_orderkey").alias("step"),
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
        F.col("o_orderdate").alias("ts"),
        F.col("o_orderpriority").alias("variable"),
        F.col("o_totalprice").alias("value"),
    )
