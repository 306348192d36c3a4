"""Structural column work: flattening, cast lists, reordering, blanking."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(*path: str) -> Column:
    """Column reference that survives dots and spaces in field names."""
    return F.col(".".join(f"`{name}`" for name in path))


def leaf_paths(schema: T.StructType, above: tuple[str, ...] = ()) -> Iterator[tuple[tuple[str, ...], T.DataType]]:
    """Every non-struct field below `schema`, with the path that reaches it."""
    for field in schema.fields:
        path = (*above, field.name)
        if isinstance(field.dataType, T.StructType):
            yield from leaf_paths(field.dataType, path)
        else:
            yield path, field.dataType


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """One text column per leaf, named `parent_child`; lists and maps become JSON text.

    The column list comes from the schema, so the work is a plain projection.
    When two leaves get the same name the later one wins.
    """
    flat: dict[str, Column] = {}
    for path, dtype in leaf_paths(df.schema):
        leaf = quoted(*path)
        is_nested = isinstance(dtype, (T.ArrayType, T.MapType))
        flat[sep.join(path)] = F.to_json(leaf) if is_nested else leaf.cast("string")
    return df.select(*[value.alias(name) for name, value in flat.items()])


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the listed columns in place; text that does not fit becomes null."""
    texts = {c for c, kind in df.dtypes if kind == "string"}

    def cast(c: str) -> Column:
        # an empty text fits no type, and telling it apart is cheaper than a failing cast
        filled = F.nullif(quoted(c), F.lit("")) if c in texts else quoted(c)
        return filled.try_cast(types[c]).alias(c)

    return df.select(*[cast(c) if c in types else quoted(c) for c in df.columns])


def unreadable(df: DataFrame, types: Mapping[str, str]) -> Column:
    """True where any listed text column is filled but does not fit its type."""
    tests = [
        quoted(c).isNotNull() & (F.trim(quoted(c)) != "") & quoted(c).try_cast(t).isNull()
        for c, t in types.items()
        if c in df.columns
    ]
    bad = F.lit(False)
    for test in tests:
        bad = bad | test
    return bad


def with_declared(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Add the declared text columns that no input file carried, as nulls."""
    absent = {name: F.lit(None).cast("string") for name in names if name not in df.columns}
    return df.withColumns(absent) if absent else df


def key_first(df: DataFrame, *keys: str) -> DataFrame:
    """Move the key columns to the front; the rest keep their order."""
    return df.select(*keys, *[quoted(c) for c in df.columns if c not in keys])


def sorted_columns(df: DataFrame) -> DataFrame:
    """Columns in name order, as a ragged union of files has no natural one."""
    return df.select(*[quoted(c) for c in sorted(df.columns)])


def blank_where(df: DataFrame, condition: Column, keep: Iterable[str]) -> DataFrame:
    """Null every column outside `keep` on the rows where `condition` holds."""
    kept = set(keep)
    return df.select(
        *[quoted(c) if c in kept else F.when(condition, None).otherwise(quoted(c)).alias(c) for c in df.columns]
    )


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Union of frames with different column sets, missing columns null."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first
