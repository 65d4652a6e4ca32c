"""Layer refresh jobs, run in the order bronze -> silver -> gold -> joined table.

Each job reads the previous layer from the catalog and fully refreshes its own tables.
Writing a layer is also where lineage is cut: a later job starts from stored tables,
so a lost executor costs at most the stage being computed, never the whole chain.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from plantlake.operators.fusion import FusedRollup, fuse
from plantlake.plans.layers import build_step, joined_frame
from plantlake.plans.plant import BRONZE, GOLD, JOINED_TABLE, SILVER, Extract, Plant, Step
from plantlake.sources.catalog import drop_layer, ensure_layer, qualified, replace_table, stored


def _refresh(writes: list[Callable], parallel: int) -> list:
    """Run the table refreshes of one layer, ``parallel`` Spark jobs at a time.

    The refreshes are independent, so with ``parallel > 1`` they are submitted from a few
    driver threads and share the executors: a small table no longer waits for a big one.
    """
    if parallel <= 1:
        return [w() for w in writes]
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        return list(pool.map(lambda w: w(), writes))


def _layer_inputs(spark: SparkSession, catalog: str | None, layer: str, names: set[str]) -> dict[str, DataFrame]:
    return {n: spark.table(qualified(catalog, layer, n)) for n in sorted(names)}


def run_bronze(
    spark: SparkSession,
    plant: Plant,
    read_source: Callable[[Extract], DataFrame],
    catalog: str | None = None,
    layer: str = BRONZE,
    parallel: int = 1,
    publish: str = "swap",
) -> list[str]:
    """Extract each source table into the bronze layer.

    ``read_source(extract)`` returns the rows of ``extract.source`` matching ``extract.where``;
    the JDBC reader (``sources.jdbc.source_reader``) has the database evaluate the predicate.
    """
    ensure_layer(spark, catalog, layer)
    writes = [
        lambda x=x: replace_table(bronze_frame(x, read_source), catalog, layer, x.table, publish) for x in plant.bronze
    ]
    return _refresh(writes, parallel)


def bronze_frame(x: Extract, read_source: Callable[[Extract], DataFrame]) -> DataFrame:
    """Rows of one extract, sorted by reading time inside each task (a local sort, no shuffle).

    Each stored file and row group then covers a narrow time range: later rollups read splits
    that touch few buckets, so their map-side partial aggregates stay small, and time
    filters can skip row groups by their min/max statistics.
    """
    df = read_source(x)
    return df.sortWithinPartitions(x.split_by) if x.split_by else df


def run_silver(
    spark: SparkSession,
    plant: Plant,
    catalog: str | None = None,
    source_layer: str = BRONZE,
    layer: str = SILVER,
    ordered: bool = True,
    parallel: int = 1,
    publish: str = "swap",
) -> list[str]:
    """Refresh the silver tables; rollups of one bronze table with the same groups share one scan of it."""
    ensure_layer(spark, catalog, layer)
    inputs = _layer_inputs(spark, catalog, source_layer, {s.source for s in plant.silver})
    writes = [lambda g=g: _refresh_group(spark, g, inputs, catalog, layer, ordered, publish) for g in fuse(plant.silver)]
    done = {name for names in _refresh(writes, parallel) for name in names}
    return [n for s in plant.silver if (n := qualified(catalog, layer, s.table)) in done]


def _refresh_group(
    spark: SparkSession, group: list[Step], inputs: dict[str, DataFrame], catalog: str | None, layer: str, ordered: bool, publish: str
) -> list[str]:
    """Write the tables of rollups that share a scan: the wide aggregate is stored, and each table is taken from it."""
    if len(group) == 1:
        (step,) = group
        return [replace_table(build_step(step, inputs, ordered), catalog, layer, step.table, publish)]
    fused = FusedRollup(tuple((s.table, s.spec) for s in group))
    with stored(fused.build(inputs[group[0].source]), catalog, layer, "_".join(s.table for s in group)) as wide:
        return [replace_table(fused.part(wide, s.table, ordered), catalog, layer, s.table, publish) for s in group]


def run_gold(
    spark: SparkSession,
    plant: Plant,
    catalog: str | None = None,
    source_layer: str = SILVER,
    layer: str = GOLD,
    ordered: bool = True,
    parallel: int = 1,
    publish: str = "swap",
) -> list[str]:
    ensure_layer(spark, catalog, layer)
    inputs = _layer_inputs(spark, catalog, source_layer, {s.source for s in plant.gold})
    writes = [lambda s=s: replace_table(build_step(s, inputs, ordered), catalog, layer, s.table, publish) for s in plant.gold]
    return _refresh(writes, parallel)


def run_joined(
    spark: SparkSession, plant: Plant, catalog: str | None = None, layer: str = GOLD, table: str = JOINED_TABLE, publish: str = "swap"
) -> str:
    inputs = _layer_inputs(spark, catalog, layer, {s.table for s in plant.joined_sides})
    return replace_table(joined_frame(plant, inputs), catalog, layer, table, publish)


def run_all(
    spark: SparkSession,
    plant: Plant,
    read_source: Callable[[Extract], DataFrame],
    catalog: str | None = None,
    layers: tuple[str, str, str] = (BRONZE, SILVER, GOLD),
    parallel: int = 1,
    publish: str = "swap",
) -> str:
    bronze, silver, gold = layers
    run_bronze(spark, plant, read_source, catalog, bronze, parallel=parallel, publish=publish)
    run_silver(spark, plant, catalog, bronze, silver, parallel=parallel, publish=publish)
    run_gold(spark, plant, catalog, silver, gold, parallel=parallel, publish=publish)
    return run_joined(spark, plant, catalog, gold, publish=publish)


def explore(
    spark: SparkSession, plant: Plant, catalog: str | None = None, source_layer: str = BRONZE, n: int = 20
) -> dict[str, DataFrame]:
    """The exploratory rollups (pcs with charge/discharge names, racks), ordered, as previews; nothing is stored."""
    steps = [*plant.exploratory, plant.silver_step("rack")]
    inputs = _layer_inputs(spark, catalog, source_layer, {s.source for s in steps})
    return {s.table: preview(build_step(s, inputs, ordered=True), n) for s in steps}


def drop_layers(spark: SparkSession, catalog: str | None, *layers: str) -> dict[str, list[str]]:
    """Empty and drop each layer (silver and gold together, or one of them)."""
    return {layer: drop_layer(spark, catalog, layer) for layer in layers}


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """First ``n`` rows for a look at the data; kept out of the refresh jobs."""
    return df.limit(n)
