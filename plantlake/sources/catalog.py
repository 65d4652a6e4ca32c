"""Catalog sinks and table lifecycle: namespaces per layer, full-refresh writes, drops.

A v2 catalog (``spark.sql.catalog.<name>`` set, e.g. a lakehouse table format) gets an
atomic ``writeTo(...).createOrReplace()``.  The built-in session catalog has no
replace-as-select, so there the new rows are first written in full to a staging table
with a unique name, and only then swapped in (drop the old table, rename the staging
one).  A job that fails while writing leaves the previous table untouched; only the
short swap is not atomic.

``publish="view"`` closes that gap: the rows are written to a table of their own (a version),
and a view of the published name is pointed at it in one catalog call, so a reader finds the
old rows or the new ones and never neither.  The version before stays for readers that
have begun; older ones are dropped.  Nothing is renamed, so nothing is copied on an object store.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SESSION_CATALOG = "spark_catalog"


def _quote(part: str) -> str:
    return "`" + part.replace("`", "``") + "`"


def qualified(*parts: str | None) -> str:
    return ".".join(_quote(p) for p in parts if p)


def is_v2_catalog(spark: SparkSession, catalog: str | None) -> bool:
    """Whether tables of ``catalog`` (default: the session's) are kept by a catalog plugin."""
    catalog = catalog or spark.conf.get("spark.sql.defaultCatalog", SESSION_CATALOG)
    return spark.conf.get(f"spark.sql.catalog.{catalog}", "builtin") != "builtin"


def _same_name(spark: SparkSession, a: str, b: str) -> bool:
    return a == b or (spark.conf.get("spark.sql.caseSensitive", "false") == "false" and a.lower() == b.lower())


def check_warehouse(spark: SparkSession) -> None:
    """On a cluster a warehouse in a local folder would be scattered over the executors' disks."""
    if spark.sparkContext.master.startswith("local"):  # local[..] and the one-machine local-cluster
        return
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    default_fs = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
    if warehouse.startswith("file:") or ("://" not in warehouse and default_fs.startswith("file:")):
        raise ValueError(f"spark.sql.warehouse.dir is a local folder ({warehouse}); set one that all executors share")


def ensure_layer(spark: SparkSession, catalog: str | None, layer: str) -> None:
    """``CREATE NAMESPACE IF NOT EXISTS <catalog>.<layer>``."""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {qualified(catalog, layer)}")


def layer_exists(spark: SparkSession, catalog: str | None, layer: str) -> bool:
    where = f" IN {qualified(catalog)}" if catalog else ""
    pattern = layer.replace("'", "\\'")
    rows = spark.sql(f"SHOW NAMESPACES{where} LIKE '{pattern}'").collect()  # filtered by the catalog
    return any(_same_name(spark, r[0], layer) for r in rows)


def layer_tables(spark: SparkSession, catalog: str | None, layer: str) -> list[str]:
    """Names of the (non-temporary) tables of a layer; empty when the layer is absent."""
    if not layer_exists(spark, catalog, layer):
        return []
    rows = spark.sql(f"SHOW TABLES IN {qualified(catalog, layer)}").collect()  # catalog listing
    views = set(layer_views(spark, catalog, layer))
    return sorted(r["tableName"] for r in rows if not r["isTemporary"] and r["tableName"] not in views)


def layer_views(spark: SparkSession, catalog: str | None, layer: str) -> list[str]:
    """Names of the stored views of a layer; a v2 catalog without views has none."""
    if is_v2_catalog(spark, catalog) or not layer_exists(spark, catalog, layer):
        return []
    rows = spark.sql(f"SHOW VIEWS IN {qualified(catalog, layer)}").collect()  # catalog listing
    return sorted(r["viewName"] for r in rows if not r["isTemporary"])


STAGING_MARK = "__staging_"


VERSION_MARK = "__version_"
PUBLISH = ("swap", "view")


def replace_table(df: DataFrame, catalog: str | None, layer: str, table: str, publish: str = "swap") -> str:
    """Full refresh of ``<catalog>.<layer>.<table>``: new data and new schema."""
    if publish not in PUBLISH:
        raise ValueError(f"unknown publish {publish!r}; use one of {PUBLISH}")
    name = qualified(catalog, layer, table)
    spark = df.sparkSession
    if is_v2_catalog(spark, catalog):
        df.writeTo(name).createOrReplace()
        return name
    check_warehouse(spark)
    if publish == "view":
        return publish_version(df, catalog, layer, table)
    staging = qualified(catalog, layer, f"{table}{STAGING_MARK}{uuid.uuid4().hex[:12]}")
    df.write.mode("errorifexists").saveAsTable(staging)
    _drop_published(spark, catalog, layer, table)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    # the session catalog takes the new name as <database>.<table>
    spark.sql(f"ALTER TABLE {staging} RENAME TO {qualified(layer, table)}")
    return name


@contextmanager
def stored(df: DataFrame, catalog: str | None, layer: str, name: str) -> Iterator[DataFrame]:
    """``df`` written once to a staging table of the layer, to be read several times; dropped at the end."""
    spark = df.sparkSession
    if not is_v2_catalog(spark, catalog):
        check_warehouse(spark)
    staging = qualified(catalog, layer, f"{name}{STAGING_MARK}{uuid.uuid4().hex[:12]}")
    try:
        df.write.mode("errorifexists").saveAsTable(staging)
        yield spark.table(staging)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {staging}")


def table_versions(spark: SparkSession, catalog: str | None, layer: str, table: str) -> list[str]:
    """Stored versions of a published table, oldest first."""
    mark = f"{table}{VERSION_MARK}".lower()
    return [t for t in layer_tables(spark, catalog, layer) if t.lower().startswith(mark)]


def publish_version(df: DataFrame, catalog: str | None, layer: str, table: str, keep: int = 1) -> str:
    """Write ``df`` as a new version and point the published view at it; ``keep`` versions before it stay.

    A failed write leaves the view as it was, and an unfinished version that the next publish drops.  A plain table of
    that name becomes the version before, once, which takes two calls.
    """
    spark = df.sparkSession
    name = qualified(catalog, layer, table)
    version = f"{table}{VERSION_MARK}{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"
    df.write.mode("errorifexists").saveAsTable(qualified(catalog, layer, version))
    if any(_same_name(spark, t, table) for t in layer_tables(spark, catalog, layer)):
        spark.sql(f"ALTER TABLE {name} RENAME TO {qualified(layer, f'{table}{VERSION_MARK}{0:020d}')}")
    shown = _shown_version(spark, catalog, layer, table)
    _point_view(spark, catalog, layer, table, version)
    older = [v for v in table_versions(spark, catalog, layer, table) if not _same_name(spark, v, version)]
    # the version that readers saw until now comes first among those to keep, unfinished ones last
    older.sort(key=lambda v: (shown is not None and _same_name(spark, v, shown), v))
    for v in older[: max(0, len(older) - keep)]:
        spark.sql(f"DROP TABLE IF EXISTS {qualified(catalog, layer, v)}")
    return name


def _shown_version(spark: SparkSession, catalog: str | None, layer: str, table: str) -> str | None:
    if not any(_same_name(spark, v, table) for v in layer_views(spark, catalog, layer)):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {qualified(catalog, layer, table)}").where("col_name = 'View Text'").collect()  # one row
    return rows[0]["data_type"].rsplit("`", 2)[1] if rows else None


def _point_view(spark: SparkSession, catalog: str | None, layer: str, table: str, version: str) -> None:
    """The flip: one catalog call."""
    spark.sql(f"CREATE OR REPLACE VIEW {qualified(catalog, layer, table)} AS SELECT * FROM {qualified(catalog, layer, version)}")


def _drop_published(spark: SparkSession, catalog: str | None, layer: str, table: str) -> None:
    """Remove the view and the versions of a published table, if it is one."""
    versions = table_versions(spark, catalog, layer, table)
    if versions and any(_same_name(spark, v, table) for v in layer_views(spark, catalog, layer)):
        spark.sql(f"DROP VIEW IF EXISTS {qualified(catalog, layer, table)}")
        for v in versions:
            spark.sql(f"DROP TABLE IF EXISTS {qualified(catalog, layer, v)}")


def drop_layer(spark: SparkSession, catalog: str | None, layer: str) -> list[str]:
    """Drop every view and table the layer holds (as listed by the catalog), then the namespace.

    Absent layer: nothing happens.  Returns the dropped table names; versions count under their published name.
    """
    dropped = layer_tables(spark, catalog, layer)
    for v in layer_views(spark, catalog, layer):
        spark.sql(f"DROP VIEW IF EXISTS {qualified(catalog, layer, v)}")
    for t in dropped:
        spark.sql(f"DROP TABLE IF EXISTS {qualified(catalog, layer, t)}")
    spark.sql(f"DROP NAMESPACE IF EXISTS {qualified(catalog, layer)}")
    return sorted({t.split(VERSION_MARK)[0] for t in dropped})


def register_view(df: DataFrame, name: str) -> str:
    """Session-scoped name for a DataFrame, usable from ``spark.sql``."""
    df.createOrReplaceTempView(name)
    return name
