"""Plant-shaped bronze inputs derived from the driver's ``events`` table.

The plant's own readings are not available, so each bronze table is a projection of
``events`` with the plant's column names; the plant specs then run on it unchanged.
Every stand-in reads the whole table.  Mapping:

    fecha      <- ts           (timestamp_ntz)
    equipo     <- event_type   (five devices)
    power-like <- value
    counters   <- event_id     (grows with ts), user_id
    JSON       <- props        (emi radiation, key ``k``)
    i_s        <- JSON object Is1..Is20 built from value (Is<i> = value * i)

All are plain projections, so column pruning reaches the parquet scan and a rollup
reads only the columns its measures use.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantlake.plans.plant import STRING_COUNT, string_keys

# JSON keys of the stand-in radiation column (events.props has only "k").
STANDIN_EMI_KEYS = ("k", "k1", "k2")
# Two of the five stand-in devices play the battery devices.
STANDIN_BATTERY_DEVICES = ("click", "view")


def _d(c: str) -> Column:
    return F.col(c).cast("double")


def string_currents_json(value: str = "value", n: int = STRING_COUNT) -> Column:
    """JSON object ``{"Is1": v*1, ..., "Isn": v*n}`` built from one double column."""
    fields = []
    for i, k in enumerate(string_keys(n), start=1):
        fields += [F.lit(k), F.col(value) * F.lit(float(i))]
    return F.to_json(F.named_struct(*fields))


def _aarr(e: DataFrame) -> DataFrame:
    return e.select(
        F.col("ts").alias("fecha"),
        F.col("event_type").alias("equipo"),
        F.col("value").alias("pa"),
        _d("event_id").alias("ea_import"),
        _d("user_id").alias("ea_export"),
    )


def _inversor(e: DataFrame) -> DataFrame:
    return e.select(
        F.col("ts").alias("fecha"),
        F.col("event_type").alias("equipo"),
        F.col("value").alias("pa"),
        _d("user_id").alias("regulacion"),
        _d("event_id").alias("ea_diaria"),
        string_currents_json().alias("i_s"),
    )


def _emi(e: DataFrame) -> DataFrame:
    return e.select(F.col("ts").alias("fecha"), F.col("props").alias("radiacion"))


def _logger(e: DataFrame) -> DataFrame:
    return e.select(
        F.col("ts").alias("fecha"),
        F.col("value").alias("pa"),
        _d("user_id").alias("pa_bat"),
        _d("event_id").alias("ea_diaria"),
    )


def _variador(e: DataFrame) -> DataFrame:
    return e.select(
        F.col("ts").alias("fecha"),
        F.col("event_type").alias("equipo"),
        F.col("value").alias("pa_motor"),
        _d("user_id").alias("frec_motor"),
    )


def _pcs(e: DataFrame) -> DataFrame:
    return e.select(
        F.col("ts").alias("fecha"),
        F.col("event_type").alias("equipo"),
        F.col("value").alias("pa"),
        _d("event_id").alias("ea_import"),
        _d("user_id").alias("ea_export"),
    )


def _bateria(e: DataFrame) -> DataFrame:
    return e.select(
        F.col("ts").alias("fecha"),
        F.col("event_type").alias("equipo"),
        F.col("value").alias("pa"),
        _d("user_id").alias("soc"),
        _d("event_id").alias("ea_import_hoy"),
        F.col("value").alias("ea_export_hoy"),
    )


def _rack(e: DataFrame) -> DataFrame:
    return e.select(
        F.col("ts").alias("fecha"),
        F.col("event_type").alias("equipo"),
        F.col("value").alias("pa"),
        _d("user_id").alias("soc"),
        (F.col("value") / F.lit(2.0)).alias("soh"),
        (F.col("value") * F.lit(3.0)).alias("dod"),
        (_d("user_id") + F.col("value")).alias("capacidad_carga"),
        (_d("user_id") - F.col("value")).alias("capacidad_descarga"),
        _d("event_id").alias("ea_carga_hoy"),
        _d("user_id").alias("ea_descarga_hoy"),
    )


def _prediccion_meteo(e: DataFrame) -> DataFrame:
    return e.select(
        F.col("ts").alias("fecha"),
        F.col("value").alias("radiacion"),
        _d("user_id").alias("temperatura"),
    )


STANDINS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "aarr": _aarr,
    "inversor": _inversor,
    "emi": _emi,
    "logger": _logger,
    "variador": _variador,
    "pcs": _pcs,
    "rack": _rack,
    "bateria": _bateria,
    "prediccion_meteo": _prediccion_meteo,
}


class LazyTables(Mapping):
    """Tables by name, each projected when it is first asked for."""

    def __init__(self, source: DataFrame, makers: Mapping[str, Callable[[DataFrame], DataFrame]]) -> None:
        self._source, self._makers, self._made = source, makers, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name](self._source)
        return self._made[name]

    def __contains__(self, name: object) -> bool:
        return name in self._makers

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


def standin_bronze(events: DataFrame) -> Mapping[str, DataFrame]:
    """The nine plant bronze tables as lazy projections of ``events``; a query pays for those that it uses."""
    return LazyTables(events, STANDINS)


def lineitem_bronze(lineitem: DataFrame) -> dict[str, DataFrame]:
    """Meter and battery-converter shapes from ``lineitem``: six times the rows of ``events``.

    ``l_shipdate``->fecha (whole days), ``l_linenumber``->equipo, ``l_extendedprice``->pa,
    ``l_quantity``->ea_import, ``l_discount``->ea_export.
    """
    shaped = lineitem.select(
        F.col("l_shipdate").alias("fecha"),
        F.col("l_linenumber").alias("equipo"),
        F.col("l_extendedprice").alias("pa"),
        F.col("l_quantity").alias("ea_import"),
        F.col("l_discount").alias("ea_export"),
    )
    return {"aarr": shaped, "pcs": shaped}
