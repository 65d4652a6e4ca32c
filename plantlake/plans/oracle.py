"""Oracle SQL for every query key, written for DuckDB over the driver's tables.

Written independently of the Spark specs, in the shape of the original SQL: the
``date_trunc + interval * floor(minute / 15)`` bucket, ``round(avg)``, ``round(max - min)``,
a subquery for the nested daily radiation, and a five-way join for the daily balance.
Rounding is stated here on its own: half-up from the sixth decimal, plain where a decimal cannot hold the value.
"""

from __future__ import annotations

def R(x: str, digits: int = 1) -> str:
    return (
        f"CASE WHEN abs({x}) < 1e31 THEN CAST(round(TRY_CAST({x} AS DECIMAL(38,6)), {digits}) AS DOUBLE) "
        f"ELSE round(CAST({x} AS DOUBLE), {digits}) END"
    )


T15 = "date_trunc('hour', fecha) + INTERVAL 15 MINUTE * CAST(floor(date_part('minute', fecha) / 15) AS INTEGER)"

# Plant-shaped projections of events, mirroring sources.standins.
BRONZE_CTES = {
    "aarr": "SELECT ts AS fecha, event_type AS equipo, value AS pa, CAST(event_id AS DOUBLE) AS ea_import, "
    "CAST(user_id AS DOUBLE) AS ea_export FROM events",
    "inversor": "SELECT ts AS fecha, event_type AS equipo, value AS pa, CAST(user_id AS DOUBLE) AS regulacion, "
    "CAST(event_id AS DOUBLE) AS ea_diaria, value AS v FROM events",
    "emi": "SELECT ts AS fecha, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS radiacion FROM events",
    "logger": "SELECT ts AS fecha, value AS pa, CAST(user_id AS DOUBLE) AS pa_bat, "
    "CAST(event_id AS DOUBLE) AS ea_diaria FROM events",
    "variador": "SELECT ts AS fecha, event_type AS equipo, value AS pa_motor, "
    "CAST(user_id AS DOUBLE) AS frec_motor FROM events",
    "pcs": "SELECT ts AS fecha, event_type AS equipo, value AS pa, CAST(event_id AS DOUBLE) AS ea_import, "
    "CAST(user_id AS DOUBLE) AS ea_export FROM events",
    "bateria": "SELECT ts AS fecha, event_type AS equipo, value AS pa, CAST(user_id AS DOUBLE) AS soc, "
    "CAST(event_id AS DOUBLE) AS ea_import_hoy, value AS ea_export_hoy FROM events",
    "rack": "SELECT ts AS fecha, event_type AS equipo, value AS pa, CAST(user_id AS DOUBLE) AS soc, "
    "value / CAST(2 AS DOUBLE) AS soh, value * CAST(3 AS DOUBLE) AS dod, CAST(user_id AS DOUBLE) + value AS capacidad_carga, "
    "CAST(user_id AS DOUBLE) - value AS capacidad_descarga, CAST(event_id AS DOUBLE) AS ea_carga_hoy, "
    "CAST(user_id AS DOUBLE) AS ea_descarga_hoy FROM events",
    "prediccion_meteo": "SELECT ts AS fecha, value AS radiacion, CAST(user_id AS DOUBLE) AS temperatura FROM events",
}


def mean(x: str, name: str | None = None) -> str:
    return f"{R(f'avg({x})')} AS {name or x}"


def delta(x: str, name: str | None = None) -> str:
    return f"{R(f'max({x}) - min({x})')} AS {name or x}"


def total(x: str, name: str | None = None) -> str:
    return f"{R(f'sum({x})')} AS {name or x}"


def _with(*tables: str, extra: str = "") -> str:
    ctes = [f"b_{t} AS ({BRONZE_CTES[t]})" for t in tables]
    if extra:
        ctes.append(extra)
    return "WITH " + ",\n".join(ctes) + "\n"


SILVER_SELECTS = {
    "aarr": f"SELECT {T15} AS time_interval, {mean('pa')}, {delta('ea_import')}, {delta('ea_export')} "
    "FROM b_aarr GROUP BY 1",
    "inversor": f"SELECT {T15} AS time_interval, equipo, {mean('pa')}, {mean('regulacion')}, "
    f"{delta('ea_diaria', 'ea_gen')} FROM b_inversor GROUP BY 1, 2",
    "logger": f"SELECT {T15} AS time_interval, {mean('pa', 'pa_gen')}, {mean('pa_bat')}, "
    f"{delta('ea_diaria', 'ea_gen')} FROM b_logger GROUP BY 1",
    "variador": f"SELECT {T15} AS time_interval, equipo, {mean('pa_motor', 'pa')}, "
    f"{mean('frec_motor', 'frecuencia')} FROM b_variador GROUP BY 1, 2",
    "pcs": f"SELECT {T15} AS time_interval, equipo, {mean('pa')}, {delta('ea_import')}, {delta('ea_export')} "
    "FROM b_pcs GROUP BY 1, 2",
    "bateria": f"SELECT {T15} AS time_interval, equipo, {mean('pa')}, {mean('soc')}, "
    f"{delta('ea_import_hoy', 'ea_carga')}, {delta('ea_export_hoy', 'ea_descarga')} "
    "FROM b_bateria WHERE equipo = 'click' OR equipo = 'view' GROUP BY 1, 2",
    "prediccion_meteo": f"SELECT date_trunc('hour', fecha) AS time_interval, {mean('radiacion')}, "
    f"{mean('temperatura')} FROM b_prediccion_meteo GROUP BY 1",
    "emi": f"SELECT {T15} AS time_interval, {mean('radiacion')} FROM b_emi GROUP BY 1",
    "strings": f"SELECT {T15} AS time_interval, equipo, "
    + ", ".join(mean(f"v * CAST({i} AS DOUBLE)", f"Is{i}") for i in range(1, 21))
    + " FROM b_inversor GROUP BY 1, 2",
    "rack": f"SELECT {T15} AS time_interval, equipo, {mean('pa')}, {mean('soc')}, {mean('soh')}, {mean('dod')}, "
    f"{mean('capacidad_carga')}, {mean('capacidad_descarga')}, {delta('ea_carga_hoy', 'ea_carga')}, "
    f"{delta('ea_descarga_hoy', 'ea_descarga')} FROM b_rack GROUP BY 1, 2",
}
SILVER_SOURCE = {"strings": "inversor"}

GOLD_SELECTS = {
    "aarr": f"SELECT CAST(time_interval AS DATE) AS fecha, {total('ea_import')}, {total('ea_export')} "
    "FROM s_aarr GROUP BY 1",
    # the day's sum of hourly means, the means unrounded
    "emi": f"SELECT day AS fecha, {R('sum(hour_mean)')} AS radiacion FROM hourly_emi GROUP BY day",
    "logger": f"SELECT CAST(time_interval AS DATE) AS fecha, {total('ea_gen')} FROM s_logger GROUP BY 1",
    "bateria": f"SELECT CAST(time_interval AS DATE) AS fecha, {R('max(soc)')} AS max_soc, "
    f"{R('min(soc)')} AS min_soc, {total('ea_carga')}, {total('ea_descarga')} FROM s_bateria GROUP BY 1",
    "prediccion_meteo": f"SELECT CAST(time_interval AS DATE) AS fecha, {total('radiacion')} "
    "FROM s_prediccion_meteo GROUP BY 1",
}


def silver_sql(table: str) -> str:
    source = SILVER_SOURCE.get(table, table)
    return _with(source) + SILVER_SELECTS[table]


HOURLY_EMI = (
    "hourly_emi AS (SELECT CAST(time_interval AS DATE) AS day, date_part('hour', time_interval) AS hour_of_day, "
    "avg(radiacion) AS hour_mean FROM s_emi GROUP BY day, hour_of_day)"
)


def gold_sql(table: str) -> str:
    silver = f"s_{table} AS ({SILVER_SELECTS[table]})" + (f",\n{HOURLY_EMI}" if table == "emi" else "")
    return _with(table, extra=silver) + GOLD_SELECTS[table]


def explore_pcs_sql() -> str:
    return _with("pcs") + (
        f"SELECT {T15} AS time_interval, equipo, {mean('pa')}, {delta('ea_import', 'ea_carga')}, "
        f"{delta('ea_export', 'ea_descarga')} FROM b_pcs GROUP BY 1, 2"
    )


DAILY = ("aarr", "bateria", "logger", "emi", "prediccion_meteo")


def daily_balance_sql() -> str:
    ctes = [f"b_{t} AS ({BRONZE_CTES[t]})" for t in DAILY]
    ctes += [f"s_{t} AS ({SILVER_SELECTS[t]})" for t in DAILY]
    ctes += [HOURLY_EMI, *(f"g_{t} AS ({GOLD_SELECTS[t]})" for t in DAILY)]
    return "WITH " + ",\n".join(ctes) + f"""
SELECT g_aarr.fecha, g_aarr.ea_import, g_aarr.ea_export,
       g_bateria.ea_carga, g_bateria.ea_descarga,
       g_logger.ea_gen,
       {R('g_aarr.ea_import + g_bateria.ea_descarga + g_logger.ea_gen - g_aarr.ea_export - g_bateria.ea_carga')}
           AS ea_consumo,
       g_emi.radiacion,
       g_prediccion_meteo.radiacion AS rad_pred
FROM g_aarr
JOIN g_bateria ON g_bateria.fecha = g_aarr.fecha
JOIN g_logger ON g_logger.fecha = g_aarr.fecha
JOIN g_emi ON g_emi.fecha = g_aarr.fecha
JOIN g_prediccion_meteo ON g_prediccion_meteo.fecha = g_aarr.fecha
"""


LINEITEM_CTE = (
    "SELECT l_shipdate AS fecha, l_linenumber AS equipo, l_extendedprice AS pa, l_quantity AS ea_import, "
    "l_discount AS ea_export FROM lineitem"
)


def lineitem_sql(table: str, gold: bool = False) -> str:
    silver = SILVER_SELECTS[table].replace(f"FROM b_{table} ", "FROM b_lineitem ")
    if not gold:
        return f"WITH b_lineitem AS ({LINEITEM_CTE})\n{silver}"
    return f"WITH b_lineitem AS ({LINEITEM_CTE}),\ns_{table} AS ({silver})\n{GOLD_SELECTS[table]}"


def oracle_queries() -> dict[str, str]:
    q = {
        "time_grid": "SELECT event_id, "
        + T15.replace("fecha", "ts")
        + " AS time_interval, date_trunc('hour', ts) AS hora, CAST(ts AS DATE) AS fecha FROM events",
        "json_unpack": "SELECT event_id, json_extract_string(props, '$.k') AS radiacion, "
        "json_extract_string(props, '$.k1') AS radiacion1, json_extract_string(props, '$.k2') AS radiacion2 "
        "FROM events",
        "silver_meter": silver_sql("aarr"),
        "silver_inverter": silver_sql("inversor"),
        "silver_logger": silver_sql("logger"),
        "silver_drive": silver_sql("variador"),
        "silver_pcs": silver_sql("pcs"),
        "silver_battery": silver_sql("bateria"),
        "silver_forecast": silver_sql("prediccion_meteo"),
        "silver_radiation": silver_sql("emi"),
        "silver_strings": silver_sql("strings"),
        "silver_rack": silver_sql("rack"),
        "explore_pcs": explore_pcs_sql(),
        "preview_pcs": explore_pcs_sql() + " ORDER BY time_interval, equipo LIMIT 20",
        "preview_rack": silver_sql("rack") + " ORDER BY time_interval, equipo LIMIT 20",
        "gold_meter": gold_sql("aarr"),
        "gold_radiation": gold_sql("emi"),
        "gold_logger": gold_sql("logger"),
        "gold_battery": gold_sql("bateria"),
        "gold_forecast": gold_sql("prediccion_meteo"),
        "daily_balance": daily_balance_sql(),
        "silver_pcs_lineitem": lineitem_sql("pcs"),
        "silver_pcs_exact": lineitem_sql("pcs"),
        "gold_meter_lineitem": lineitem_sql("aarr", gold=True),
        "view_sql": silver_sql("aarr"),
        "bronze_extract_and": "SELECT * FROM lineitem WHERE l_linenumber = 1 AND l_suppkey = 1",
        "bronze_extract_eq": "SELECT * FROM lineitem WHERE l_linenumber = 1",
        "bronze_extract_text": "SELECT * FROM orders WHERE o_orderstatus = 'F'",
        "bronze_extract_all": "SELECT * FROM orders",
    }
    return q
