"""Spark session for the plant jobs.

Catalog, storage endpoint and credentials come from the environment, never from code.
When ``PLANTLAKE_CATALOG`` is unset the built-in session catalog is used.

    PLANTLAKE_CATALOG            name of the lake catalog (v2 catalog plugin)
    PLANTLAKE_CATALOG_IMPL       class of the catalog plugin
    PLANTLAKE_CATALOG_OPTIONS    extra options, ``key=value`` pairs separated by ``;``
    PLANTLAKE_TIMEZONE           session time zone (default UTC)
"""

from __future__ import annotations

import os

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

# Defaults chosen for large inputs; a setting that was submitted with the job or stands in the cluster's conf wins.
# Broadcasts are decided only from sizes measured at runtime (AQE), never from the static
# estimate, which is derived from compressed file sizes and bounds nothing.
SCALE_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    # AQE merges small shuffle partitions but cannot split a large one for an aggregate, so
    # shuffles start fine-grained (about 25 MB each for a 50 GB shuffle) and are coalesced.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "2000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
}


def catalog_conf_from_env(env: dict[str, str] | None = None) -> dict[str, str]:
    env = os.environ if env is None else env
    name = env.get("PLANTLAKE_CATALOG")
    if not name:
        return {}
    conf = {}
    impl = env.get("PLANTLAKE_CATALOG_IMPL")
    if impl:
        conf[f"spark.sql.catalog.{name}"] = impl
    for pair in filter(None, (env.get("PLANTLAKE_CATALOG_OPTIONS") or "").split(";")):
        key, _, value = pair.partition("=")
        conf[f"spark.sql.catalog.{name}.{key.strip()}"] = value.strip()
    return conf


def lake_catalog(env: dict[str, str] | None = None) -> str | None:
    env = os.environ if env is None else env
    return env.get("PLANTLAKE_CATALOG") or None


def build_session(app_name: str = "plantlake", master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    # the JVM has to be up, with what it must know at its start, before a SparkConf sees what was submitted
    SparkContext._ensure_initialized(conf=SparkConf().setAll(list((conf or {}).items())))
    submitted = SparkConf()  # what spark-submit and the cluster's defaults say
    defaults = {**SCALE_DEFAULTS, "spark.sql.session.timeZone": "UTC"}
    settings = {k: v for k, v in defaults.items() if not submitted.contains(k)}
    if zone := os.environ.get("PLANTLAKE_TIMEZONE"):
        settings["spark.sql.session.timeZone"] = zone
    settings |= {**catalog_conf_from_env(), **(conf or {})}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

