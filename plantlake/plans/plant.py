"""Specs of the plant: bronze extracts, silver and gold rollups, and the joined daily table.

Everything a site changes (site id, meter id, town, battery devices, JSON keys) is a
parameter of ``plant_specs``; table and column names are the ones downstream
dashboards read, so they are kept as they are.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from plantlake.functions.jsoncols import JsonUnpack
from plantlake.functions.measures import avg, delta, high, low, mean, total
from plantlake.operators.daily_join import DaySide, energy_balance
from plantlake.operators.rollup import Chain, Rollup, sql_in, sql_literal

# ---------------------------------------------------------------------------
# Layer names, table names, default site parameters, JSON keys.
# ---------------------------------------------------------------------------
BRONZE, SILVER, GOLD = "bronze", "silver", "gold"
BRONZE_TABLES = (
    "aarr",
    "inversor",
    "emi",
    "logger",
    "variador",
    "pcs",
    "rack",
    "bateria",
    "prediccion_meteo",
)
DEFAULT_SITE = 11
DEFAULT_METER = 42
DEFAULT_TOWN = "cieza"
DEFAULT_BATTERY_DEVICES = (98, 99)
EMI_JSON_KEYS = ("radiacion", "radiacion1", "radiacion2")
STRING_COUNT = 20  # string currents Is1 ... Is20 of each inverter
JOINED_TABLE = "conjunto"


def string_keys(n: int = STRING_COUNT) -> tuple[str, ...]:
    return tuple(f"Is{i}" for i in range(1, n + 1))


@dataclass(frozen=True)
class Extract:
    """A bronze extract: every column of ``source`` rows matching ``where`` (SQL, pushed to the source).

    ``split_by`` is the column a parallel read splits into ranges (the reading time), so each
    bronze file also covers one time range and later rollups aggregate it compactly.
    ``hash_by`` is a key column whose hash deals rows to queries where time cannot.
    """

    table: str
    source: str
    where: str | None
    split_by: str | None = "fecha"
    hash_by: str | None = None


@dataclass(frozen=True)
class Step:
    """A derived table: ``spec`` applied to ``source`` (a table of the previous layer)."""

    table: str
    source: str
    spec: Rollup | Chain


@dataclass(frozen=True)
class Plant:
    bronze: tuple[Extract, ...]
    silver: tuple[Step, ...]
    gold: tuple[Step, ...]
    joined_sides: tuple[DaySide, ...]
    exploratory: tuple[Step, ...] = field(default_factory=tuple)

    def silver_step(self, table: str) -> Step:
        return _find(self.silver, table)

    def gold_step(self, table: str) -> Step:
        return _find(self.gold, table)

    def exploratory_step(self, table: str) -> Step:
        return _find(self.exploratory, table)


def _find(steps: tuple[Step, ...], table: str) -> Step:
    for s in steps:
        if s.table == table:
            return s
    raise KeyError(table)


def joined_output():
    """Columns of the joined daily table, in order."""
    return (
        "fecha",
        "ea_import",
        "ea_export",
        "ea_carga",
        "ea_descarga",
        "ea_gen",
        ("ea_consumo", energy_balance()),
        "radiacion",
        "rad_pred",
    )


def plant_specs(
    site: int = DEFAULT_SITE,
    meter: int = DEFAULT_METER,
    town: str = DEFAULT_TOWN,
    battery_devices: tuple = DEFAULT_BATTERY_DEVICES,
    emi_keys: tuple[str, ...] = EMI_JSON_KEYS,
    strings: tuple[str, ...] | None = None,
    with_market_prices: bool = False,
    market_key: str | None = None,
    silver_sums: str = "plain",
) -> Plant:
    """The specs of one site.

    The daily facts add with order-free sums: their inputs are small, and a refresh then repeats to the last bit.
    ``silver_sums="exact"`` makes the quarter-hour means do so too.
    """
    strings = strings or string_keys()
    site_eq = f"instalacion = {int(site)}"
    bronze = [
        Extract("aarr", "aarr", f"{site_eq} AND equipo = {int(meter)}"),
        *(Extract(t, t, site_eq) for t in BRONZE_TABLES[1:-1]),
        Extract("prediccion_meteo", "prediccion_meteo", f"localidad = {sql_literal(town)}"),
    ]
    if with_market_prices:
        bronze.append(Extract("omie", "omie", None, split_by=None, hash_by=market_key))

    dev = ("equipo",)

    def mean_(source: str, name: str | None = None):
        return mean(source, name, sums=silver_sums)

    silver = (
        Step("aarr", "aarr", Rollup("aarr", (mean_("pa"), delta("ea_import"), delta("ea_export")))),
        Step(
            "inversor",
            "inversor",
            Rollup(
                "inversor",
                (mean_("pa"), mean_("regulacion"), delta("ea_diaria", "ea_gen")),
                by=dev,
            ),
        ),
        Step(
            "logger",
            "logger",
            Rollup("logger", (mean_("pa", "pa_gen"), mean_("pa_bat"), delta("ea_diaria", "ea_gen"))),
        ),
        Step(
            "variador",
            "variador",
            Rollup("variador", (mean_("pa_motor", "pa"), mean_("frec_motor", "frecuencia")), by=dev),
        ),
        Step(
            "pcs",
            "pcs",
            Rollup("pcs", (mean_("pa"), delta("ea_import"), delta("ea_export")), by=dev),
        ),
        Step(
            "bateria",
            "bateria",
            Rollup(
                "bateria",
                (
                    mean_("pa"),
                    mean_("soc"),
                    delta("ea_import_hoy", "ea_carga"),
                    delta("ea_export_hoy", "ea_descarga"),
                ),
                by=dev,
                where=sql_in("equipo", battery_devices),
            ),
        ),
        Step(
            "prediccion_meteo",
            "prediccion_meteo",
            Rollup("prediccion_meteo", (mean_("radiacion"), mean_("temperatura")), grain="1 hour"),
        ),
        Step(
            "emi",
            "emi",
            Rollup(
                "emi",
                (mean_("radiacion"),),
                json=JsonUnpack("radiacion", tuple(emi_keys), EMI_JSON_KEYS),
            ),
        ),
        Step(
            "strings",
            "inversor",
            Rollup(
                "strings",
                tuple(mean_(k) for k in string_keys(len(strings))),
                by=dev,
                json=JsonUnpack("i_s", tuple(strings), string_keys(len(strings))),
            ),
        ),
        Step(
            "rack",
            "rack",
            Rollup(
                "rack",
                (
                    mean_("pa"),
                    mean_("soc"),
                    mean_("soh"),
                    mean_("dod"),
                    mean_("capacidad_carga"),
                    mean_("capacidad_descarga"),
                    delta("ea_carga_hoy", "ea_carga"),
                    delta("ea_descarga_hoy", "ea_descarga"),
                ),
                by=dev,
            ),
        ),
    )

    def total_(source: str):
        return total(source, sums="exact")

    def daily(name: str, *measures) -> Rollup:
        return Rollup(name, tuple(measures), time="time_interval", grain="1 day", key="fecha")

    gold = (
        Step("aarr", "aarr", daily("aarr", total_("ea_import"), total_("ea_export"))),
        Step(
            "emi",
            "emi",
            Chain(
                "emi",
                (
                    Rollup("emi_hourly", (avg("radiacion", sums="exact"),), time="time_interval", grain="1 hour", key="hora"),
                    Rollup("emi", (total_("radiacion"),), time="hora", grain="1 day", key="fecha"),
                ),
            ),
        ),
        Step("logger", "logger", daily("logger", total_("ea_gen"))),
        Step(
            "bateria",
            "bateria",
            daily(
                "bateria",
                high("soc", "max_soc"),
                low("soc", "min_soc"),
                total_("ea_carga"),
                total_("ea_descarga"),
            ),
        ),
        Step("prediccion_meteo", "prediccion_meteo", daily("prediccion_meteo", total_("radiacion"))),
    )

    joined_sides = (
        DaySide("aarr", ("ea_import", "ea_export")),
        DaySide("bateria", ("ea_carga", "ea_descarga")),
        DaySide("logger", ("ea_gen",)),
        DaySide("emi", ("radiacion",)),
        DaySide("prediccion_meteo", (("radiacion", "rad_pred"),)),
    )

    exploratory = (
        Step(
            "pcs",
            "pcs",
            Rollup(
                "pcs",
                (mean("pa"), delta("ea_import", "ea_carga"), delta("ea_export", "ea_descarga")),
                by=dev,
            ),
        ),
    )
    return Plant(tuple(bronze), silver, gold, joined_sides, exploratory)
