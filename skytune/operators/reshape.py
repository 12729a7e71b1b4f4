"""Landing shapes: parallel arrays, positional variables, records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parallel_arrays_to_rows(df: DataFrame, container: str, fields: Sequence[str]) -> DataFrame:
    """A struct of parallel arrays to one row per index, one column per array."""
    return _exploded(df, {f: F.col(f"{container}.{f}") for f in fields})


def positional_to_rows(
    df: DataFrame, variables: str, names: Sequence[str], axis: str | None = None
) -> DataFrame:
    """An array of arrays to rows; ``names`` gives the request order of the variables.

    Names come from the request, never from a guess at the position. ``axis`` is an array
    column of the same length, for example the time axis.
    """
    arrays = {axis: F.col(axis)} if axis else {}
    arrays |= {n: F.element_at(variables, i) for i, n in enumerate(names, start=1)}
    return _exploded(df, arrays)


def _exploded(df: DataFrame, arrays: dict[str, Column]) -> DataFrame:
    """One row per index; arrays of unequal length are an error, as padding would lie."""
    staged = df.select(*(a.alias(f"_a{i}") for i, a in enumerate(arrays.values())))
    columns = {n: F.col(f"_a{i}") for i, n in enumerate(arrays)}
    names = list(columns)
    first, *others = (F.size(c) for c in columns.values())
    same = F.lit(True)
    for size in others:
        same = same & (size == first)
    entries = F.when(same, F.arrays_zip(*columns.values())).otherwise(
        F.raise_error(F.lit("parallel arrays differ in length"))
    )
    return staged.select(F.inline(entries)).toDF(*names)


def to_records(df: DataFrame, name: str = "record") -> DataFrame:
    """Each row as one JSON text; NULL fields stay present."""
    packed = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    return df.select(packed.alias(name))
