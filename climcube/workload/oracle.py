"""Independent SQL for every query, for a second engine on the same tables.

Each statement spells the computation out in its textbook form (joins and
nested aggregates), whatever plan the library chooses.
"""

from __future__ import annotations

from climcube.config import LEVEL_EDGES, MODELS, REGIONS

_BASE = "BETWEEN 1995 AND 1997"
_FUTURE = "BETWEEN 2000 AND 2001"


def _list(items) -> str:
    return "[" + ", ".join(f"'{i}'" for i in items) + "]"


def _in(items) -> str:
    return "(" + ", ".join(f"'{i}'" for i in items) + ")"


def _r(expression: str, name: str) -> str:
    return f"round({expression}, 6) + 0.0 AS {name}"


_MODEL_LIST = _list([*MODELS, "EC-Earth3-Veg-LR", "NorESM2-LM"])
_MODEL = f"{_MODEL_LIST}[CAST(1 + l_suppkey * 7 % 12 AS INTEGER)]"
_EXPERIMENT = """CASE l_returnflag || l_linestatus
    WHEN 'AF' THEN CASE WHEN l_suppkey * 7 % 12 = 11 THEN 'hist-aer' ELSE 'historical' END
    WHEN 'AO' THEN 'ssp126' WHEN 'NF' THEN 'ssp245' WHEN 'NO' THEN 'ssp370'
    WHEN 'RF' THEN 'ssp585' END"""
_LAT = "CAST((l_partkey % 12) * 15 - 82.5 AS DOUBLE)"
_LON = "CAST(((l_partkey // 12) % 12) * 30 + 15 AS DOUBLE)"
_WRAPPED = f"(CASE WHEN {_LON} >= 180 THEN {_LON} - 360 ELSE {_LON} END)"
_YEAR = "CAST(year(l_shipdate) AS INTEGER)"
_MONTH = "CAST(month(l_shipdate) AS INTEGER)"
_TAS = "l_quantity"
_PR = "(l_discount * 6.371823947::DOUBLE / 86400) * 86400"


def _grid(value: str = _TAS, lon: str = _WRAPPED) -> str:
    return f"""grid AS (
  SELECT {_MODEL} AS model, {_EXPERIMENT} AS experiment, {_YEAR} AS year, {_MONTH} AS month,
         {_LAT} AS lat, {lon} AS lon, {value} AS value
  FROM lineitem WHERE l_returnflag || l_linestatus <> 'RO')"""


def _whole(value: str = _TAS, lon: str = _WRAPPED) -> str:
    """Model output and reanalysis in one table."""
    observed = "l_returnflag || l_linestatus = 'RO'"
    return f"""grid AS (
  SELECT CASE WHEN {observed} THEN 'ERA5' ELSE 'CMIP6' END AS source,
         CASE WHEN {observed} THEN 'ERA5' ELSE {_MODEL} END AS model,
         CASE WHEN {observed} THEN 'ERA5' ELSE {_EXPERIMENT} END AS experiment, {_YEAR} AS year, {_MONTH} AS month,
         {_LAT} AS lat, {lon} AS lon, {value} AS value FROM lineitem)"""


def _obs(value: str = _TAS, where: str = "l_returnflag || l_linestatus = 'RO'") -> str:
    return f"""obs AS (
  SELECT {_YEAR} AS year, {_MONTH} AS month, {_LAT} AS lat, {_WRAPPED} AS lon,
         {value} AS value, l_quantity - 25 AS temperature, l_tax * 100 AS tax
  FROM lineitem WHERE {where})"""


_OBS = _obs()

_YEARLY = """yearly AS (
  SELECT model, experiment, lat, lon, year, avg(value) AS value, count(value) AS n_steps
  FROM grid GROUP BY ALL)"""

_CLIM = f"""clim AS (
  SELECT model, lat, lon, avg(value) AS clim, count(value) AS n_steps FROM yearly
  WHERE experiment = 'historical' AND year {_BASE} GROUP BY ALL)"""

_ANOM = f"""anom AS (
  SELECT y.model, y.experiment, y.lat, y.lon, y.year, y.value - c.clim AS anomaly
  FROM yearly y JOIN clim c USING (model, lat, lon)
  WHERE y.experiment IN ('historical', 'ssp126', 'ssp245', 'ssp370', 'ssp585'))"""

_REGIONS = "regions(region, lat_min, lat_max, lon_min, lon_max) AS (VALUES " + ", ".join(
    f"('{r.name}', {r.lat_min}, {r.lat_max}, {r.lon_min}, {r.lon_max})" for r in REGIONS.values()
) + ")"

_AREA = "sum(anomaly * cos(radians(lat))) / sum(CASE WHEN anomaly IS NOT NULL THEN cos(radians(lat)) END)"

# The active region is the northern half of the globe.
_MODEL_SERIES = f"""model_series AS (
  SELECT model, experiment, 'global_north' AS region, year, {_AREA} AS anomaly, count(anomaly) AS n_cells
  FROM anom WHERE lat BETWEEN 0 AND 90 GROUP BY model, experiment, year)"""

_REGION_SERIES = f"""region_series AS (
  SELECT model, experiment, region, year, {_AREA} AS anomaly, count(anomaly) AS n_cells
  FROM anom JOIN regions ON lat BETWEEN lat_min AND lat_max AND lon BETWEEN lon_min AND lon_max
  GROUP BY model, experiment, region, year)"""

_ERA = f"""era_yearly AS (SELECT lat, lon, year, avg(value) AS value FROM obs GROUP BY ALL),
era_clim AS (SELECT lat, lon, avg(value) AS clim FROM era_yearly WHERE year {_BASE} GROUP BY ALL),
era_anom AS (SELECT lat, lon, year, value - clim AS anomaly FROM era_yearly JOIN era_clim USING (lat, lon)),
era_series AS (
  SELECT year, {_AREA} AS anomaly, count(anomaly) AS n_cells
  FROM era_anom WHERE lat BETWEEN 0 AND 90 GROUP BY year)"""

_MONTHLY = """monthly AS (
  SELECT month, lat, lon, avg(tax) AS climatology FROM obs GROUP BY ALL),
annual AS (SELECT lat, lon, avg(climatology) AS climatology FROM monthly GROUP BY ALL)"""

_STATION = f"""{_MONTHLY},
st_yearly AS (SELECT lat, lon, year, avg(temperature) AS temperature FROM obs GROUP BY ALL),
st_abs AS (SELECT lat, lon, year, temperature + climatology AS absolute
           FROM st_yearly JOIN annual USING (lat, lon)),
st_ref AS (SELECT lat, lon, avg(absolute) AS ref FROM st_abs WHERE year {_BASE} GROUP BY ALL),
st_series AS (
  SELECT year, avg(absolute - ref) AS anomaly, count(absolute - ref) AS n_cells
  FROM st_abs JOIN st_ref USING (lat, lon) WHERE lat BETWEEN 0 AND 90 GROUP BY year)"""

_ALL = """all_series AS (
  SELECT 'tas' AS variable, 'CMIP6' AS source, model, experiment, region, year, anomaly, n_cells
  FROM model_series
  UNION ALL SELECT 'tas', 'ERA5', 'ERA5', 'ERA5', 'global_north', year, anomaly, n_cells FROM era_series
  UNION ALL SELECT 'tas', 'Berkeley', 'Berkeley', 'Berkeley', 'global_north', year, anomaly, n_cells
  FROM st_series)"""

_ALL_CTES = ", ".join([_grid(), _OBS, _YEARLY, _CLIM, _ANOM, _MODEL_SERIES, _ERA, _STATION, _ALL])

_SERIES_OUT = f"variable, source, model, experiment, region, year, {_r('anomaly', 'anomaly')}, n_cells"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _series_ctes(value: str = _TAS) -> tuple[str, ...]:
    return _grid(value), _YEARLY, _CLIM, _ANOM


_MODEL_CTES = (*_series_ctes(), _MODEL_SERIES)
_REGION_CTES = (*_series_ctes(), _REGIONS, _REGION_SERIES)

_MAP = f"""fut AS (
  SELECT model, experiment, lat, lon, avg(value) AS value FROM yearly
  WHERE experiment LIKE 'ssp%' AND year {_FUTURE} GROUP BY ALL),
change AS (
  SELECT f.model, f.experiment, f.lat, f.lon, f.value - c.clim AS anomaly
  FROM fut f JOIN clim c USING (model, lat, lon)
  WHERE f.model IN {_in(MODELS)} AND f.lat BETWEEN 0 AND 90),
maps AS (
  SELECT experiment, lat, lon, avg(anomaly) AS anomaly, count(anomaly) AS n_models
  FROM change GROUP BY experiment, lat, lon)"""


def _map_ctes(value: str = _TAS) -> tuple[str, ...]:
    return _grid(value), _YEARLY, _CLIM, _MAP


def _level(value: str, variable: str) -> str:
    edges = "[" + ", ".join(f"{e!r}::DOUBLE" for e in LEVEL_EDGES[variable]) + "]"
    return (
        f"CASE WHEN {value} IS NOT NULL THEN "
        f"CAST(len(list_filter({edges}, lambda e: e <= {value})) - 1 AS INTEGER) END"
    )


def _map_levels(variable: str, value: str) -> str:
    return _with(*_map_ctes(value)) + f"""SELECT '{variable}' AS variable, experiment, 'global_north' AS region, lat, lon,
  anomaly, n_models, {_level('anomaly', variable)} AS level
FROM (SELECT experiment, lat, lon, {_r('anomaly', 'anomaly')}, n_models FROM maps)"""


_QUANTILES = """spread AS (
  SELECT variable, experiment, region, year,
         quantile_cont(anomaly, 0.25) AS p25, quantile_cont(anomaly, 0.5) AS p50,
         quantile_cont(anomaly, 0.75) AS p75, count(anomaly) AS n_models
  FROM all_series GROUP BY ALL)"""


def _running(column: str) -> str:
    return _r(
        f"CASE WHEN count({column}) OVER w = 3 THEN avg({column}) OVER w END", f"{column}_rm"
    )


# --- files -------------------------------------------------------------------

_FILE = f"""['tas', 'tasmin', 'tasmax', 'pr', 'hurs'][CAST(1 + l_linenumber % 5 AS INTEGER)]
  || '_day_' || {_MODEL} || '_' || coalesce({_EXPERIMENT}, 'obs') || '_r'
  || CAST(l_orderkey % 100 + 1 AS VARCHAR) || 'i1p1f1_gn_' || CAST(year(l_shipdate) AS VARCHAR)
  || CASE WHEN l_tax > 0.04 THEN '_v1.2' ELSE '' END || '.nc'"""

_FILES = f"files AS (SELECT {_FILE} AS file_name, l_discount FROM lineitem)"


def _token(position: int, column: str = "file_name") -> str:
    return f"string_split({column}, '_')[{position + 1}]"


_NAME_YEAR = "TRY_CAST(nullif(regexp_extract(file_name, '_([0-9]{4})_', 1), '') AS INTEGER)"
_VERSION = "CASE WHEN contains(file_name, '_v1.2') THEN 'v1.2' END"
_STEM = """CASE WHEN contains(file_name, '_v1.2') THEN regexp_extract(file_name, '^(.*)_v1[.]2', 1)
  ELSE regexp_replace(file_name, '[.]nc$', '') END"""
_YEARMEAN = "replace(file_name, '.nc', '_yearmean.nc')"

_REDUCED = f"""reduced AS (
  SELECT file_name, {_token(0)} AS variable, {_token(1)} AS frequency, {_token(2)} AS model,
         {_token(3)} AS experiment, {_token(4)} AS member, {_token(5)} AS grid,
         {_NAME_YEAR} AS year, {_VERSION} AS version
  FROM (SELECT {_YEARMEAN} AS file_name FROM files))"""

_STATES = """states AS (
  SELECT file_name, CAST(round(min(l_discount) * 100) AS INTEGER) AS state FROM files GROUP BY file_name)"""

_EXISTING = f"""existing AS (
  SELECT DISTINCT CASE state WHEN 0 THEN {_YEARMEAN} WHEN 1 THEN ({_STEM}) || '_v1.2.nc'
                       ELSE file_name END AS existing_name
  FROM states WHERE state <= 2)"""

_SKIPPED = f"""skipped AS (
  SELECT file_name, CASE
    WHEN {_YEARMEAN} IN (SELECT existing_name FROM existing) THEN 'yearmean_exists'
    WHEN ({_STEM}) || '_v1.2.nc' IN (SELECT existing_name FROM existing) THEN 'v1_2_exists'
    WHEN file_name IN (SELECT existing_name FROM existing) THEN 'file_exists' END AS skip_reason
  FROM (SELECT DISTINCT file_name FROM files))"""

_SKIP_CTES = (_FILES, _STATES, _EXISTING, _SKIPPED)
_WANTED = """((contains(file_name, 'tas') AND NOT contains(file_name, 'tasmin')
  AND NOT contains(file_name, 'tasmax')) OR contains(file_name, 'pr'))"""
_ANY_MODEL = "(" + " OR ".join(f"contains(file_name, '{m}')" for m in MODELS) + ")"


def _rollup(table: str) -> str:
    return f"""SELECT CASE WHEN grouping(status) = 1 THEN 'ALL' ELSE status END AS status,
  CASE WHEN grouping(experiment) = 1 THEN 'ALL' ELSE experiment END AS experiment,
  CASE WHEN grouping(model) = 1 THEN 'ALL' ELSE model END AS model, count(*) AS n
FROM {table} GROUP BY ROLLUP (status, experiment, model)"""


# --- countries -----------------------------------------------------------------

_X = "CAST((c_custkey % 34) * 10 - 180 AS DOUBLE)"
_Y = "CAST((c_custkey * 5 % 16) * 10 - 85 AS DOUBLE)"
_W = "CAST(c_custkey % 7 + 3 AS DOUBLE)"
_H = "CAST(c_custkey % 5 + 2 AS DOUBLE)"

_EDGES = f"""corners AS (SELECT c_name, c_nationkey, {_X} AS x, {_Y} AS y, {_W} AS w, {_H} AS h FROM customer),
edges AS (
  SELECT c_name, c_nationkey, x AS x1, y AS y1, x + w AS x2, y AS y2 FROM corners
  UNION ALL SELECT c_name, c_nationkey, x + w, y, x, y + h FROM corners
  UNION ALL SELECT c_name, c_nationkey, x, y + h, x, y FROM corners)"""

_CROSS = "(x1 * y2 - x2 * y1)"
_CENTROID = (
    f"{_r(f'sum((x1 + x2) * {_CROSS}) / (3 * sum({_CROSS}))', 'x')}, "
    f"{_r(f'sum((y1 + y2) * {_CROSS}) / (3 * sum({_CROSS}))', 'y')}"
)


def _hits(region: str) -> str:
    """Right triangles with legs along the axes meet a box where clamping says so."""
    r = REGIONS[region]
    # The point of the box nearest to the right-angled corner in both directions.
    px = f"greatest(x, {r.lon_min})"
    py = f"greatest(y, {r.lat_min})"
    return f"""hits AS (SELECT c_name AS name FROM corners
  WHERE {px} <= {r.lon_max} AND {py} <= {r.lat_max} AND ({px} - x) / w + ({py} - y) / h <= 1)"""


def statements() -> dict[str, str]:
    sql: dict[str, str] = {}

    sql["yearly_mean"] = _with(_whole(), _YEARLY) + f"""
SELECT lat, lon, model, experiment, year, {_r('value', 'value')}, n_steps FROM yearly"""
    sql["climatology"] = _with(_grid(), _YEARLY, _CLIM) + f"""
SELECT lat, lon, model, {_r('clim', 'clim')}, n_steps FROM clim"""
    sql["reference_mean"] = _with(_OBS) + f"""
SELECT lat, lon, {_r('avg(value)', 'clim')}, count(value) AS n_steps
FROM (SELECT lat, lon, year, avg(value) AS value FROM obs GROUP BY ALL)
WHERE year {_BASE} GROUP BY lat, lon"""
    sql["period_mean"] = _with(_whole(), _YEARLY) + f"""
SELECT lat, lon, model, experiment, {_r('avg(value)', 'value')}, count(value) AS n_steps
FROM yearly WHERE year {_FUTURE} GROUP BY lat, lon, model, experiment"""
    sql["monthly_to_annual"] = _with(_obs(where="true"), _MONTHLY) + f"""
SELECT lat, lon, {_r('climatology', 'climatology')} FROM annual"""
    sql["dedupe_time"] = f"""
SELECT o_custkey AS series, CAST(year(o_orderdate) AS INTEGER) AS year,
       min(o_orderkey) AS step, {_r('arg_min(o_totalprice, o_orderkey)', 'value')}
FROM orders GROUP BY o_custkey, year(o_orderdate)"""
    sql["time_normalise"] = f"""
SELECT o_orderpriority AS variable, CAST(year(o_orderdate) AS INTEGER) AS normal_year,
       count(*) AS n, {_r('sum(o_totalprice)', 'total')}
FROM orders GROUP BY 1, 2"""

    sql["box_select"] = _with(_whole(lon=_LON)) + f"""
SELECT lat, lon, count(*) AS n, {_r('sum(value)', 'total')} FROM grid
WHERE lat BETWEEN -30 AND 30 AND lon BETWEEN 0 AND 180 GROUP BY lat, lon"""
    sql["box_select_wrap"] = _with(_whole()) + f"""
SELECT lat, lon, count(*) AS n, {_r('sum(value)', 'total')} FROM grid
WHERE lat BETWEEN 35 AND 72 AND lon BETWEEN -25 AND 45 GROUP BY lat, lon"""
    sql["region_join"] = _with(_whole(), _REGIONS) + f"""
SELECT region, experiment, count(*) AS n, {_r('avg(value)', 'mean_value')}
FROM grid JOIN regions ON lat BETWEEN lat_min AND lat_max AND lon BETWEEN lon_min AND lon_max
GROUP BY region, experiment"""
    sql["region_join_table"] = _with(_whole(), _YEARLY) + f""",
clim AS (SELECT model, lat, lon, avg(value) AS clim FROM yearly WHERE year {_BASE} GROUP BY ALL),
boxes AS (
  SELECT c_name AS region, c_custkey, CAST((c_custkey % 15) * 10 - 80 AS DOUBLE) AS lat_min,
         CAST(((c_custkey // 15) % 24) * 15 - 180 AS DOUBLE) AS lon_min FROM customer)
SELECT region, count(*) AS n_cells, {_r('avg(clim)', 'mean_clim')}
FROM boxes JOIN clim ON lat BETWEEN lat_min AND lat_min + 5 + c_custkey % 20
  AND (lon BETWEEN lon_min AND lon_min + 10 + c_custkey % 50
       OR lon + 360 BETWEEN lon_min AND lon_min + 10 + c_custkey % 50)
GROUP BY region"""
    band = "(sin(radians(least(lat + 7.5, 90))) - sin(radians(greatest(lat - 7.5, -90))))"
    sql["field_mean_area"] = _with(_whole(), _YEARLY) + f"""
SELECT model, experiment, year, {_r(f'sum(value * {band}) / sum({band})', 'value')},
       count(value) AS n_cells FROM yearly GROUP BY model, experiment, year"""
    sql["field_mean_plain"] = _with(_whole(), _YEARLY) + f"""
SELECT model, experiment, year, {_r('avg(value)', 'value')}, count(value) AS n_cells
FROM yearly GROUP BY model, experiment, year"""

    sql["grid_subtract"] = _with(_grid(), _YEARLY, _CLIM) + f"""
SELECT lat, lon, model, experiment, count(value - clim) AS n, {_r('min(value - clim)', 'lowest')},
       {_r('max(value - clim)', 'highest')}, {_r('avg(value - clim)', 'mean_anomaly')}
FROM grid JOIN clim USING (model, lat, lon) GROUP BY lat, lon, model, experiment"""
    sql["absolute_from_anomaly"] = _with(_OBS, _MONTHLY) + f"""
SELECT lat, lon, year, count(temperature + climatology) AS n,
       {_r('avg(temperature + climatology)', 'absolute')}
FROM obs JOIN annual USING (lat, lon) GROUP BY lat, lon, year"""
    sql["models_without_baseline"] = _with(_grid()) + f"""
SELECT DISTINCT model, experiment FROM grid WHERE model NOT IN (
  SELECT model FROM grid WHERE experiment = 'historical' AND year {_BASE})"""

    sql["model_anomaly_series"] = _with(*_REGION_CTES) + f"""
SELECT 'tas' AS variable, 'CMIP6' AS source, model, experiment, region, year,
       {_r('anomaly', 'anomaly')}, n_cells FROM region_series"""
    sql["reanalysis_series"] = _with(_OBS, _ERA) + f"""
SELECT 'tas' AS variable, 'ERA5' AS source, 'ERA5' AS model, 'ERA5' AS experiment,
       'global_north' AS region, year, {_r('anomaly', 'anomaly')}, n_cells FROM era_series"""
    sql["station_series"] = _with(_OBS, _STATION) + f"""
SELECT 'tas' AS variable, 'Berkeley' AS source, 'Berkeley' AS model, 'Berkeley' AS experiment,
       'global_north' AS region, year, {_r('anomaly', 'anomaly')}, n_cells FROM st_series"""
    sql["all_series"] = _with(_ALL_CTES) + f"SELECT {_SERIES_OUT} FROM all_series"
    sql["precipitation_series"] = _with(*_series_ctes(_PR), _MODEL_SERIES) + f"""
SELECT 'pr' AS variable, 'CMIP6' AS source, model, experiment, region, year,
       {_r('anomaly', 'anomaly')}, n_cells FROM model_series"""
    sql["precipitation_all_series"] = _with(*_series_ctes(_PR), _MODEL_SERIES, _obs(_PR), _ERA) + f"""
SELECT 'pr' AS variable, 'CMIP6' AS source, model, experiment, region, year,
       {_r('anomaly', 'anomaly')}, n_cells FROM model_series
UNION ALL SELECT 'pr', 'ERA5', 'ERA5', 'ERA5', 'global_north', year, {_r('anomaly', 'anomaly')}, n_cells FROM era_series"""
    sql["merge_time_versions"] = f"""
WITH files AS (SELECT {_FILE} AS file_name, {_YEAR} AS year, {_LAT} AS lat, {_LON} AS lon, l_quantity AS value FROM lineitem),
named AS (SELECT {_token(0)} AS variable, {_token(2)} AS model, {_token(3)} AS experiment, * FROM files),
chosen AS (
  SELECT variable, model, experiment, year, coalesce(min(file_name) FILTER (contains(file_name, '_v1.2')), min(file_name)) AS file_name
  FROM named GROUP BY variable, model, experiment, year),
yearly AS (SELECT variable, model, experiment, lat, lon, year, avg(value) AS value
           FROM named SEMI JOIN chosen USING (variable, model, experiment, year, file_name) GROUP BY ALL)
SELECT variable, model, experiment, lat, lon, {_r('avg(value)', 'clim')}, count(value) AS n_steps
FROM yearly WHERE year {_BASE} GROUP BY variable, model, experiment, lat, lon"""
    sql["incremental_yearly"] = _with(_whole()) + f"""
SELECT source, model, experiment, lat, lon, year, {_r('avg(value)', 'value')}, count(value) AS n_steps
FROM grid GROUP BY source, model, experiment, lat, lon, year"""
    loaded = f"""values AS (
  SELECT 's' || CAST(l_suppkey AS VARCHAR) || l_returnflag || l_linestatus AS file_name,
         CASE WHEN l_returnflag || l_linestatus = 'RO' THEN 'ERA5' ELSE {_EXPERIMENT} END AS experiment, {_YEAR} AS year,
         CASE l_suppkey % 3 WHEN 0 THEN l_linenumber % 2 WHEN 1 THEN 1
              ELSE CASE WHEN l_linenumber % 4 <> 0 THEN 2 END END AS place,
         l_orderkey * 10 + l_linenumber AS position, l_quantity - 25 AS value FROM lineitem),
best AS (SELECT *, min(place) OVER (PARTITION BY file_name, experiment) AS least FROM values),
loaded AS (SELECT file_name, experiment, year, arg_min(value, ROW(position, value)) AS anomaly, count(*) - 1 AS n_repeats
           FROM best WHERE place = least GROUP BY file_name, experiment, year)"""
    sql["series_load"] = _with(loaded) + f"""
SELECT file_name, experiment, year, {_r('anomaly', 'anomaly')}, n_repeats FROM loaded"""
    sql["spread_from_files"] = _with(loaded, """all_series AS (
  SELECT 'tas' AS variable, experiment, 'global_north' AS region, year, anomaly FROM loaded)""", _QUANTILES) + f"""
SELECT variable, experiment, region, year, {_r('p25', 'p25')}, {_r('p50', 'p50')}, {_r('p75', 'p75')},
       n_models, {_running('p25')}, {_running('p50')}, {_running('p75')}
FROM spread WINDOW w AS (PARTITION BY variable, experiment, region ORDER BY year
                         ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)"""
    axis = "[-90, -80, -65, -45, -30, -10, 0, 5, 20, 50, 75, 90]"
    sql["field_mean_bounds"] = f"""
WITH polar AS (
  SELECT CASE WHEN l_returnflag || l_linestatus = 'RO' THEN 'ERA5' ELSE {_MODEL} END AS model, {_YEAR} AS year,
         CAST({axis}[CAST(l_partkey % 12 + 1 AS INTEGER)] AS DOUBLE) AS lat, l_quantity AS value FROM lineitem),
yearly AS (SELECT model, lat, year, avg(value) AS value FROM polar GROUP BY ALL),
bands AS (SELECT model, lat, sin(radians(coalesce((lat + lead(lat) OVER w) / 2, 90)))
                             - sin(radians(coalesce((lat + lag(lat) OVER w) / 2, -90))) AS weight
          FROM (SELECT DISTINCT model, lat FROM polar) WINDOW w AS (PARTITION BY model ORDER BY lat))
SELECT model, year, {_r('sum(value * weight) / sum(weight)', 'value')}, count(value) AS n_cells
FROM yearly JOIN bands USING (model, lat) GROUP BY model, year"""
    sql["region_join_mixed"] = f"""
WITH cells AS (
  SELECT y, x, count(*) AS n FROM (
    SELECT 500 + l_partkey % 10 AS y, 50 + l_partkey // 10 % 10 AS x FROM lineitem
    UNION ALL SELECT l_partkey % 12 * 150 - 825, (l_partkey // 12 % 12 * 300 + 150 + 1800) % 3600 - 1800 FROM lineitem)
  GROUP BY y, x),
boxes AS (
  SELECT s_name AS region, k % 5 AS kind, k * 7 % 360 * 10 AS east, k * 3 % 100 + 450 AS lat, 500 + k % 10 AS fine
  FROM (SELECT s_name, s_suppkey AS k FROM supplier)),
bounds AS (
  SELECT region, CASE kind WHEN 4 THEN fine WHEN 3 THEN lat WHEN 2 THEN lat ELSE -900 END AS y1,
         CASE kind WHEN 4 THEN fine WHEN 3 THEN lat + 80 WHEN 2 THEN lat + 1 ELSE 900 END AS y2,
         CASE kind WHEN 4 THEN 50 WHEN 3 THEN east - 1800 WHEN 1 THEN east ELSE -1800 END AS x1,
         CASE kind WHEN 4 THEN 0 WHEN 3 THEN 80 WHEN 1 THEN 1800 ELSE 3600 END AS width FROM boxes)
SELECT region, count(*) AS n_cells, CAST(sum(n) AS BIGINT) AS n_rows
FROM bounds JOIN cells ON y BETWEEN y1 AND y2 AND (x - x1 + 7200) % 3600 <= width GROUP BY region"""
    sql["cells_in_country"] = _with(_whole()) + """,
squares AS (
  SELECT n_name AS name, k, (k % 34) * 10 - 180 AS x, (k * 5 % 16) * 10 - 85 AS y, k % 7 * 4 + 12 AS w, k % 5 * 4 + 12 AS h
  FROM (SELECT c_nationkey AS n_nationkey, c_custkey AS k FROM customer) JOIN nation USING (n_nationkey)),
rings AS (SELECT name, x AS x1, x + w AS x2, y AS y1, y + h AS y2 FROM squares
          UNION ALL SELECT name, x + 3, x + w - 3, y + 3, y + h - 3 FROM squares WHERE k % 3 = 0),
sides AS (SELECT name, x1 AS x, y1, y2 FROM rings UNION ALL SELECT name, x2, y1, y2 FROM rings),
west AS (SELECT name, min(x1) AS x0 FROM rings GROUP BY name),
cells AS (SELECT lat, lon, count(*) AS n FROM grid GROUP BY lat, lon),
turned AS (SELECT name, lat, lon, n, lon + 360 * ceil((x0 - lon) / 360) AS east FROM cells, west)
SELECT name, lat, lon, n FROM turned JOIN sides USING (name)
WHERE (y1 > lat) <> (y2 > lat) AND east < x GROUP BY name, lat, lon, n HAVING count(*) % 2 = 1"""
    sql["acquisition_accounting"] = _with(*_SKIP_CTES) + f""",
listed AS (SELECT l_orderkey % 10 AS k, {_FILE} AS file_name FROM lineitem),
first AS (
  SELECT CASE WHEN k > 1 THEN file_name END AS file_name,
         CASE WHEN k = 0 THEN 'no uri' WHEN k = 1 THEN 'no file name' WHEN k = 3 THEN 'no digest'
              WHEN NOT {_ANY_MODEL} THEN 'other model' WHEN NOT {_WANTED} THEN 'other variable' END AS why FROM listed),
best AS (
  SELECT coalesce(max(CASE WHEN contains(file_name, '_v1.2') THEN file_name END), max(file_name)) AS file_name, true AS best
  FROM first WHERE why IS NULL GROUP BY {_STEM}),
st AS (
  SELECT coalesce(why, CASE WHEN best IS NULL THEN 'other version' END, skip_reason,
                  CASE WHEN state IN (3, 4) THEN 'ok' WHEN state = 5 THEN 'mismatch' ELSE 'missing' END) AS status,
         {_token(3)} AS experiment, {_token(2)} AS model
  FROM first LEFT JOIN best USING (file_name) LEFT JOIN skipped USING (file_name) LEFT JOIN states USING (file_name))
{_rollup('st')}"""
    sql["observation_sources"] = _with(_ALL_CTES) + """
SELECT source, count(*) AS n_years FROM all_series WHERE source IN ('ERA5', 'Berkeley') GROUP BY source"""

    sql["ensemble_quantiles"] = _with(*_MODEL_CTES) + f"""
SELECT 'tas' AS variable, experiment, region, year,
       {_r('quantile_cont(anomaly, 0.25)', 'p25')}, {_r('quantile_cont(anomaly, 0.5)', 'p50')},
       {_r('quantile_cont(anomaly, 0.75)', 'p75')}, count(anomaly) AS n_models
FROM model_series GROUP BY experiment, region, year"""
    sql["ensemble_running_mean"] = _with(_ALL_CTES, _QUANTILES) + f"""
SELECT variable, experiment, region, year, {_r('p25', 'p25')}, {_r('p50', 'p50')}, {_r('p75', 'p75')},
       n_models, {_running('p25')}, {_running('p50')}, {_running('p75')}
FROM spread WINDOW w AS (PARTITION BY variable, experiment, region ORDER BY year
                         ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)"""
    sql["dense_alignment"] = _with(*_MODEL_CTES) + f"""
SELECT t.experiment, t.year, m.model, {_r('s.anomaly', 'anomaly')}
FROM (SELECT DISTINCT experiment, year FROM model_series) t
CROSS JOIN (SELECT unnest({_MODEL_LIST}) AS model) m
LEFT JOIN model_series s ON s.experiment = t.experiment AND s.year = t.year AND s.model = m.model"""
    sql["ensemble_map"] = _with(*_map_ctes()) + f"""
SELECT 'tas' AS variable, experiment, 'global_north' AS region, lat, lon, {_r('anomaly', 'anomaly')}, n_models FROM maps"""
    sql["ensemble_map_levels"] = _map_levels("tas", _TAS)
    sql["precipitation_map_levels"] = _map_levels("pr", _PR)
    sql["map_sign_shares"] = _with(*_map_ctes()) + f"""
SELECT 'tas' AS variable, experiment, 'global_north' AS region,
       {_r('avg(CASE WHEN a > 0 THEN 1.0 WHEN a IS NOT NULL THEN 0.0 END)', 'share_up')},
       {_r('avg(CASE WHEN a < 0 THEN 1.0 WHEN a IS NOT NULL THEN 0.0 END)', 'share_down')},
       count(a) AS n_cells
FROM (SELECT experiment, round(anomaly, 6) AS a FROM maps) GROUP BY experiment"""
    sql["level_census"] = _with(_whole(_PR)) + f"""
SELECT experiment, {_level('v', 'pr')} AS level, count(*) AS n
FROM (SELECT experiment, round(value - 0.3, 6) AS v FROM grid) GROUP BY 1, 2"""
    sql["model_availability"] = _with(_grid(), _YEARLY, _CLIM) + f"""
SELECT model, experiment, count(*) AS n_cells FROM (
  SELECT DISTINCT model, experiment, lat, lon FROM yearly
  WHERE experiment <> 'historical' AND year {_FUTURE})
WHERE model IN (SELECT model FROM clim) GROUP BY model, experiment"""
    sql["trend_variability"] = _with(*_MODEL_CTES) + f"""
SELECT model, experiment, {_r('regr_slope(anomaly, year)', 'trend')},
       {_r('stddev_samp(anomaly)', 'variability')}, count(anomaly) AS n_years
FROM model_series GROUP BY model, experiment"""
    sql["scenario_rank"] = _with(*_REGION_CTES) + f"""
SELECT region, experiment, {_r('change', 'change')},
       CAST(rank() OVER (PARTITION BY region ORDER BY change DESC) AS INTEGER) AS position
FROM (SELECT region, experiment, avg(p50) AS change FROM (
        SELECT region, experiment, year, quantile_cont(anomaly, 0.5) AS p50
        FROM region_series GROUP BY region, experiment, year)
      WHERE year {_FUTURE} AND experiment LIKE 'ssp%' GROUP BY region, experiment)"""

    sql["duplicate_report"] = """
SELECT o_custkey AS series, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n_rows
FROM orders GROUP BY 1, 2 HAVING count(*) > 1"""
    sql["series_profile"] = """
SELECT o_custkey AS series, CAST(min(year(o_orderdate)) AS INTEGER) AS first_year,
       CAST(max(year(o_orderdate)) AS INTEGER) AS last_year,
       count(DISTINCT year(o_orderdate)) AS n_years, count(*) AS n_rows,
       array_to_string(list_sort(list(DISTINCT o_orderpriority)), ',') AS variables
FROM orders GROUP BY o_custkey"""
    sql["coverage_gaps"] = _with(_whole()) + """
SELECT s.model, s.experiment, CAST(y.year AS INTEGER) AS year, CAST(m.month AS INTEGER) AS month
FROM (SELECT DISTINCT model, experiment FROM grid) s
CROSS JOIN (SELECT unnest(range(1994, 2003)) AS year) y
CROSS JOIN (SELECT unnest(range(1, 13)) AS month) m
WHERE NOT EXISTS (SELECT 1 FROM grid g WHERE g.model = s.model AND g.experiment = s.experiment
                  AND g.year = y.year AND g.month = m.month)"""
    sql["coverage_by_year"] = _with(_obs(where="true")) + """
SELECT CAST(y.year AS INTEGER) AS year, 12 - count(DISTINCT o.month) AS n_missing
FROM (SELECT unnest(range(1994, 2003)) AS year) y LEFT JOIN obs o ON o.year = y.year GROUP BY y.year"""
    sql["coverage_audit"] = _with(_whole()) + """,
span AS (SELECT model, experiment, lat, lon, y.year AS year
  FROM (SELECT DISTINCT model, experiment, lat, lon FROM grid)
  CROSS JOIN (SELECT CAST(unnest(range(1995, 2002)) AS INTEGER) AS year) y),
have AS (SELECT model, experiment, lat, lon, year, count(DISTINCT month) AS n FROM grid GROUP BY ALL)
SELECT model, experiment, lat, lon, year, 12 - coalesce(n, 0) AS n_missing
FROM span LEFT JOIN have USING (model, experiment, lat, lon, year) WHERE coalesce(n, 0) < 12"""
    sql["rejected_files"] = _with(_FILES) + f"""
SELECT {_token(0)} AS variable,
       CASE WHEN {_NAME_YEAR} IS NULL THEN 'no year in name' ELSE 'unwanted variable' END AS reason,
       count(*) AS n
FROM files WHERE {_NAME_YEAR} IS NULL OR NOT {_WANTED} GROUP BY 1, 2"""
    sql["missing_values"] = _with(_whole("CASE WHEN l_quantity <= 40 THEN l_quantity END"), _YEARLY) + f"""
SELECT lat, lon, model, experiment, year, {_r('value', 'value')}, n_steps FROM yearly"""
    sql["unit_conversion"] = _with(_whole(f"{_TAS} AS tas, {_PR}")) + f"""
SELECT 'tas' AS variable, '°C' AS unit, experiment, count(tas) AS n,
       {_r('avg(tas)', 'mean_value')}, {_r('max(tas)', 'highest')} FROM grid GROUP BY experiment
UNION ALL
SELECT 'pr', 'mm/day', experiment, count(value),
       {_r('avg(value)', 'mean_value')}, {_r('max(value)', 'highest')} FROM grid GROUP BY experiment"""
    sql["variable_resolver"] = f"""
SELECT l_suppkey AS series, count(v) AS n, {_r('sum(v)', 'total')}
FROM (SELECT l_suppkey, CASE WHEN l_returnflag = 'A' THEN l_quantity
             WHEN l_linestatus = 'O' THEN l_quantity + 100
             WHEN l_returnflag = 'R' THEN l_quantity END AS v FROM lineitem)
GROUP BY l_suppkey"""
    sql["variable_resolver_rows"] = f"""
WITH ranked AS (
  SELECT l_orderkey AS series, l_quantity AS value,
         CASE WHEN l_returnflag = 'A' THEN 0 WHEN l_returnflag = 'N' THEN 1
              WHEN l_linestatus = 'F' THEN 2 END AS place FROM lineitem)
SELECT series, 'tas' AS variable, count(*) AS n, {_r('sum(value)', 'total')}
FROM (SELECT *, min(place) OVER (PARTITION BY series) AS best FROM ranked WHERE place IS NOT NULL)
WHERE place = best GROUP BY series"""
    sql["flatten_rows"] = f"""
SELECT vec_id, CAST(i AS INTEGER) AS lon_index, {_r('CAST(embedding[i + 1] AS DOUBLE)', 'value')}
FROM (SELECT vec_id, embedding, unnest(range(0, len(embedding))) AS i FROM embeddings)"""

    sql["uri_file_name"] = """
SELECT page_id, regexp_extract(regexp_replace(regexp_replace(url, '[?#].*$', ''),
                               '^[a-z]+://[^/]*', ''), '([^/]*)$', 1) AS file_name FROM pages"""
    sql["file_name_parse"] = _with(_FILES, _REDUCED) + """
SELECT variable, frequency, model, experiment, grid, year, version, count(*) AS n,
       count(DISTINCT member) AS n_members FROM reduced GROUP BY ALL"""
    sql["series_label"] = _with(_FILES) + f"""
SELECT {_token(2)} || '_' || {_token(3)} AS label, upper({_token(3)}) AS title,
       lower({_token(2)}) AS model_lower, count(*) AS n FROM files GROUP BY 1, 2, 3"""
    sql["file_groups"] = _with(_FILES, _REDUCED) + """
SELECT variable, model, experiment, count(DISTINCT file_name) AS n_files,
       min(year) AS first_year, max(year) AS last_year FROM reduced GROUP BY variable, model, experiment"""
    sql["merge_order"] = _with(_FILES, _REDUCED) + """
SELECT variable, model, experiment, year, file_name,
       row_number() OVER (PARTITION BY variable, model, experiment ORDER BY year, file_name) AS position
FROM (SELECT DISTINCT variable, model, experiment, year, file_name FROM reduced)"""
    sql["version_pick"] = _with(_FILES) + f"""
SELECT coalesce(max(CASE WHEN contains(file_name, '_v1.2') THEN file_name END), max(file_name)) AS file_name
FROM files GROUP BY {_STEM}"""
    sql["version_pick_reduced"] = _with(_FILES) + """
SELECT coalesce(max(CASE WHEN contains(file_name, '_v1.2') THEN file_name END), max(file_name)) AS file_name
FROM (SELECT DISTINCT replace(file_name, '.nc', '_yearmean.nc') AS file_name FROM files)
GROUP BY regexp_replace(file_name, '(_v1[.]2)?_yearmean[.]nc$', '')"""
    sql["merge_order_raw"] = _with(_FILES) + f"""
SELECT variable, model, experiment, year, file_name,
       row_number() OVER (PARTITION BY variable, model, experiment ORDER BY year NULLS LAST, file_name) AS position
FROM (SELECT DISTINCT {_token(0)} AS variable, {_token(2)} AS model, {_token(3)} AS experiment,
             {_NAME_YEAR} AS year, file_name FROM files)"""
    sql["acquisition_rejects"] = f"""
WITH files AS (SELECT l_orderkey % 10 AS k, {_FILE} AS file_name FROM lineitem)
SELECT CASE WHEN k > 1 THEN {_token(0)} END AS variable,
       CASE WHEN k = 0 THEN 'no uri' WHEN k = 1 THEN 'no file name' WHEN k = 3 THEN 'no digest'
            WHEN {_NAME_YEAR} IS NULL THEN 'no year in name' ELSE 'usable' END AS reason, count(*) AS n
FROM files GROUP BY 1, 2"""
    sql["box_select_edges"] = f"""
SELECT CAST(500000 + l_partkey % 10 * 1000 AS INTEGER) AS lat_q,
       CAST(50000 + l_partkey // 10 % 10 * 1000 AS INTEGER) AS lon_q, count(*) AS n, {_r('sum(l_quantity)', 'total')}
FROM lineitem WHERE l_partkey % 10 BETWEEN 1 AND 7 AND l_partkey // 10 % 10 BETWEEN 1 AND 5 GROUP BY 1, 2"""
    sql["availability_gaps"] = _with(_grid()) + f"""
SELECT model, experiment, CASE WHEN NOT has_base THEN 'no baseline' ELSE 'no scenario result' END AS reason
FROM (SELECT m.model, s.experiment,
             EXISTS (SELECT 1 FROM grid g WHERE g.model = m.model AND g.experiment = 'historical' AND g.year {_BASE}) AS has_base,
             EXISTS (SELECT 1 FROM grid g WHERE g.model = m.model AND g.experiment = s.experiment AND g.year {_FUTURE}) AS has_future
      FROM (SELECT DISTINCT model FROM grid) m
      CROSS JOIN (VALUES ('ssp126'), ('ssp245'), ('ssp370'), ('ssp585')) s(experiment))
WHERE NOT has_base OR NOT has_future"""
    sql["model_filter_substring"] = _with(_FILES) + f"""
SELECT {_token(2)} AS model, count(*) AS n FROM files WHERE {_ANY_MODEL} GROUP BY 1"""
    sql["model_filter_exact"] = _with(_FILES) + f"""
SELECT {_token(2)} AS model, count(*) AS n FROM files WHERE {_token(2)} IN {_in(MODELS)} GROUP BY 1"""
    sql["variable_filter"] = _with(_FILES) + f"""
SELECT {_token(0)} AS variable, {_token(3)} AS experiment, count(*) AS n
FROM files WHERE {_WANTED} GROUP BY 1, 2"""
    sql["series_filter"] = _with(_FILES) + f"""
SELECT {_token(0)} AS variable, {_token(2)} AS model, {_token(3)} AS experiment, count(*) AS n
FROM files WHERE {_token(0)} = 'tas'
  AND {_token(3)} IN ('historical', 'ssp126', 'ssp245', 'ssp370', 'ssp585') GROUP BY 1, 2, 3"""
    sql["derived_name"] = _with(_FILES) + f"""
SELECT DISTINCT file_name, {_STEM} AS base, ({_STEM}) || '_v1.2.nc' AS reissued,
       {_YEARMEAN} AS yearmean FROM files"""
    sql["checksum_verify"] = """
SELECT CAST(doc_id AS VARCHAR) AS file_name,
       md5(text || CASE WHEN quality = 0 THEN '!' ELSE '' END) AS md5,
       quality IS NOT NULL AND quality <> 0 AS verified,
       CASE WHEN quality IS NULL THEN 'missing' WHEN quality = 0 THEN 'mismatch' ELSE 'ok' END AS status
FROM (SELECT d.doc_id, d.text, l.quality FROM documents d LEFT JOIN labels l USING (doc_id))"""
    sql["skip_existing"] = _with(*_SKIP_CTES) + "SELECT file_name, skip_reason FROM skipped"
    sql["pending_files"] = _with(*_SKIP_CTES) + f"""
SELECT {_token(0)} AS variable, {_token(2)} AS model, count(*) AS n
FROM skipped WHERE skip_reason IS NULL GROUP BY 1, 2"""
    sql["status_summary"] = _with(*_SKIP_CTES) + f""",
st AS (SELECT coalesce(skip_reason, 'pending') AS status, {_token(3)} AS experiment,
              {_token(2)} AS model FROM skipped)
{_rollup('st')}"""
    sql["acquisition_audit"] = _with(*_SKIP_CTES) + f""",
wanted AS (SELECT DISTINCT file_name FROM files WHERE {_ANY_MODEL} AND {_WANTED}),
picked AS (
  SELECT coalesce(max(CASE WHEN contains(file_name, '_v1.2') THEN file_name END), max(file_name)) AS file_name
  FROM wanted GROUP BY {_STEM}),
st AS (
  SELECT coalesce(skip_reason, CASE WHEN state IN (3, 4) THEN 'ok' WHEN state = 5 THEN 'mismatch'
                  ELSE 'missing' END) AS status,
         {_token(3)} AS experiment, {_token(2)} AS model
  FROM picked JOIN skipped USING (file_name) JOIN states USING (file_name))
{_rollup('st')}"""
    sql["path_list"] = """
SELECT doc_id, count(*) AS n_paths, CAST(sum(length(line)) AS BIGINT) AS n_chars
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
WHERE length(line) > 0 GROUP BY doc_id"""
    sql["manifest_strip"] = """
SELECT conv_id, turn, md5(regexp_replace(regexp_replace(chr(9) || ' ' || text || ' ' || chr(10),
       '^\\s+', ''), '\\s+$', '')) AS stripped_md5 FROM conversations"""

    sql["country_centroid"] = _with(_EDGES) + f"""
SELECT n_name AS name, {_CENTROID} FROM edges JOIN nation ON n_nationkey = c_nationkey GROUP BY n_name"""
    sql["country_in_box"] = _with(_EDGES, _hits("central_asia")) + "SELECT name FROM hits"
    sql["country_select"] = _with(_EDGES) + f"""
SELECT n_name AS name, {_CENTROID} FROM edges JOIN nation ON n_nationkey = c_nationkey
WHERE n_name IN ('NATION_1', 'NATION_4', 'NATION_9', 'NATION_16', 'NATION_24') GROUP BY n_name"""
    sql["country_labels"] = _with(_EDGES, _hits("europe")) + f"""
SELECT c_name AS name, {_CENTROID} FROM edges WHERE c_name IN (SELECT name FROM hits) GROUP BY c_name"""
    return sql
