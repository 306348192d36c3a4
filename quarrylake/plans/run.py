"""Build a lake layer by layer: landing files, bronze, silver, gold."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarrylake.operators.quality import Parted
from quarrylake.plans import bronze, gold, refresh, silver
from quarrylake.sources.tables import read_table, write_table
from quarrylake.spec import Lake

# Each cleaned table with the function that makes it and the cleaned tables it looks things up in.
CLEANERS: dict[str, tuple[Callable[..., Parted], tuple[str, ...]]] = {
    "cities": (silver.cities, ()),
    "operators": (silver.operators, ()),
    "plans": (silver.plans, ()),
    "zones": (silver.zones, ()),
    "riders_cdc": (silver.riders, ("operators",)),
    "vehicles": (silver.vehicles, ("operators",)),
    "maintenance": (silver.maintenance, ()),
    "weather": (silver.weather, ()),
    "rides": (silver.rides, ("cities",)),
    "payments": (silver.payments, ("rides",)),
    "telemetry": (silver.telemetry, ("vehicles", "cities")),
}


def run_bronze(spark: SparkSession, lake: Lake) -> dict[str, int]:
    """Load references and all new files; returns the number of new files per source."""
    bronze.load_references(spark, lake)
    return {name: bronze.load_new(spark, lake, name) for name in lake.sources}


def run_silver(spark: SparkSession, lake: Lake, whole: bool = False) -> list[str]:
    """Bring every loaded table up to date, in dependency order; returns all tables there are.

    A table without new batches, whose parents did not change, is left alone. One that
    is laid out by folder is refreshed where its changes fall (`refresh.py`), any
    other, and every table with `whole`, is replaced by what all of bronze gives: so no
    stale folder, repeated reject or unredacted reject stays behind. A changed parent
    that is not looked up by its keys alone calls for the whole table too. Sources that
    never delivered are passed over.
    """
    versions: dict[str, int] = {}
    for table, (clean, needs) in CLEANERS.items():
        raw = bronze.read_bronze(spark, lake, table)
        if raw is None:
            continue
        last = refresh.last_commit(spark, lake, table)
        batches = frozenset(bronze.committed_batches(spark, lake, table))
        seen = {name: versions.get(name, 0) for name in needs}
        version = last.version + 1 if last else 1
        if last and not whole and (last.batches, last.parents) == (batches, seen):
            versions[table] = last.version
            continue
        parents = [_parent(spark, lake, name, list(versions)) for name in needs]
        moved = None if whole or not last else _moved(spark, lake, table, last, seen, batches)
        refreshed = False
        if moved is not None:
            new = bronze.read_bronze(spark, lake, table, sorted(batches - last.batches))
            refreshed = refresh.refresh(spark, lake, table, clean, parents, raw, new, moved, version)
        if not refreshed:
            refresh.replace_whole(spark, clean(raw, *parents), lake, table, version)
        refresh.commit(spark, lake, table, refresh.Commit(version, batches, seen), not refreshed)
        versions[table] = version
    return list(versions)


def _moved(spark: SparkSession, lake: Lake, table: str, last: refresh.Commit, seen: dict[str, int], batches: frozenset[str]) -> dict[str, DataFrame] | None:
    """Keys that came or went in the parents since the table was made; None if it must be made whole."""
    if table not in refresh.DELTAS or not last.batches <= batches:
        return None
    moved = {}
    for parent, version in seen.items():
        if version == last.parents.get(parent, 0):
            continue
        keys = None
        if parent in refresh.DELTAS[table].members:
            keys = refresh.parent_changes(spark, lake, parent, last.parents.get(parent, 0), version)
        if keys is None:
            return None
        moved[parent] = keys
    return moved


# The key of each table others look things up in.
PARENT_KEYS = {"operators": "operator_id", "vehicles": "vehicle_id", "rides": "ride_id", "cities": "city_id"}


def _parent(spark: SparkSession, lake: Lake, name: str, done: list[str]) -> DataFrame:
    if name in done:
        return read_table(spark, lake.silver(name))
    return spark.createDataFrame([], f"{PARENT_KEYS[name]} string, timezone string")


def run_gold(spark: SparkSession, lake: Lake, tables: list[str]) -> list[str]:
    """Write every dimension whose cleaned table changed since it was written, and the fixed
    ones once; returns all dimensions there are."""
    def table(name: str) -> DataFrame:
        return read_table(spark, lake.silver(name))

    builders: dict[str, tuple[str | None, Callable[[], DataFrame]]] = {
        "dim_dates": (None, lambda: gold.dates(spark)),
        "dim_time_of_day": (None, lambda: gold.time_of_day(spark)),
    }
    for ref in lake.references.values():
        if ref.name in tables:
            builders[f"dim_{ref.name}"] = ref.name, lambda ref=ref: gold.reference(table(ref.name), ref)
    per_table = {
        "vehicles": ("dim_vehicles", gold.vehicles),
        "riders_cdc": ("dim_riders", gold.riders),
        "payments": ("dim_payment_method", gold.payment_method),
        "weather": ("dim_weather_day", gold.weather_day),
        "rides": ("dim_ride_context", gold.ride_context),
    }
    for name, (dim, build) in per_table.items():
        if name in tables:
            builders[dim] = name, lambda name=name, build=build: build(table(name))
    for dim, (name, build) in builders.items():
        made = refresh.last_commit(spark, lake, name) if name else None
        version = made.version if made else 0
        built = refresh.last_commit(spark, lake, dim)
        if built is None or built.version < version:
            write_table(build(), lake.gold(dim))
            refresh.commit(spark, lake, dim, refresh.Commit(version, frozenset(), {}), True)
    return list(builders)


def run(spark: SparkSession, lake: Lake) -> dict[str, object]:
    files = run_bronze(spark, lake)
    tables = run_silver(spark, lake)
    return {"files": files, "tables": tables, "dimensions": run_gold(spark, lake, tables)}


