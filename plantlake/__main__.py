"""Command line for the layer jobs, in the order bronze -> silver -> gold -> joined.

    python -m plantlake bronze            # JDBC extracts (PLANTLAKE_JDBC_* from the environment)
    python -m plantlake silver
    python -m plantlake gold
    python -m plantlake joined
    python -m plantlake all               # the four jobs above in one process
    python -m plantlake explore           # preview the exploratory rollups (nothing stored)
    python -m plantlake drop silver gold  # empty and drop layers

The catalog comes from ``PLANTLAKE_CATALOG`` (session catalog when unset).  Jobs run as
separate processes need a persistent catalog; a plain local session keeps its catalog in
memory, so there use ``all``.  Site
parameters: ``--site``, ``--meter``, ``--town``, ``--battery-devices``.
"""

from __future__ import annotations

import argparse

from plantlake.plans import jobs
from plantlake.plans.plant import (
    BRONZE,
    DEFAULT_BATTERY_DEVICES,
    DEFAULT_METER,
    DEFAULT_SITE,
    DEFAULT_TOWN,
    GOLD,
    SILVER,
    plant_specs,
)
from plantlake.session import build_session, lake_catalog


def _device(text: str) -> int | str:
    return int(text) if text.lstrip("-").isdigit() else text


def main(argv: list[str] | None = None, spark=None) -> int:
    """Run one job; a given ``spark`` session is used and left running."""
    p = argparse.ArgumentParser(prog="plantlake")
    p.add_argument("job", choices=["bronze", "silver", "gold", "joined", "all", "explore", "drop"])
    p.add_argument("layers", nargs="*", default=[SILVER, GOLD], help="layers for 'drop'")
    p.add_argument("--site", type=int, default=DEFAULT_SITE)
    p.add_argument("--meter", type=int, default=DEFAULT_METER)
    p.add_argument("--town", default=DEFAULT_TOWN)
    p.add_argument(
        "--battery-devices", type=_device, nargs="+", default=list(DEFAULT_BATTERY_DEVICES), help="device ids or names"
    )
    p.add_argument("--source-schema", default="public", help="schema of the source tables (bronze)")
    p.add_argument("--market-prices", action="store_true", help="also extract the market price table")
    p.add_argument("--market-key", help="column whose hash deals the market price table to parallel reads")
    p.add_argument("--jdbc-partitions", type=int, default=0, help="range reads per extracted table (0: by its row count)")
    p.add_argument("--rows", type=int, default=20, help="rows shown by 'explore'")
    p.add_argument("--parallel", type=int, default=1, help="tables of a layer refreshed at the same time")
    p.add_argument("--publish", choices=["swap", "view"], default="swap", help="how a refreshed table replaces the old one on the session catalog")
    args = p.parse_args(argv)

    plant = plant_specs(
        site=args.site,
        meter=args.meter,
        town=args.town,
        battery_devices=tuple(args.battery_devices),
        with_market_prices=args.market_prices,
        market_key=args.market_key,
    )
    own_session = spark is None
    spark = spark or build_session()
    catalog = lake_catalog()
    try:
        if args.job in ("bronze", "all"):
            from plantlake.sources.jdbc import JdbcSource, source_reader

            source = JdbcSource.from_env(num_partitions=args.jdbc_partitions)
            reader = source_reader(spark, source, args.source_schema)
            if args.job == "all":
                done = [jobs.run_all(spark, plant, reader, catalog, parallel=args.parallel, publish=args.publish)]
            else:
                done = jobs.run_bronze(spark, plant, reader, catalog, BRONZE, parallel=args.parallel, publish=args.publish)
        elif args.job == "silver":
            done = jobs.run_silver(spark, plant, catalog, parallel=args.parallel, publish=args.publish)
        elif args.job == "gold":
            done = jobs.run_gold(spark, plant, catalog, parallel=args.parallel, publish=args.publish)
        elif args.job == "joined":
            done = [jobs.run_joined(spark, plant, catalog, publish=args.publish)]
        elif args.job == "explore":
            done = []
            for name, df in jobs.explore(spark, plant, catalog, n=args.rows).items():
                print(name)
                df.show(args.rows, truncate=False)
        else:
            done = [f"{layer}: {tables}" for layer, tables in jobs.drop_layers(spark, catalog, *args.layers).items()]
        for line in done:
            print(line)
    finally:
        if own_session:
            spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
