"""Schema and layout evolution over data written under older definitions."""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Promotions that keep every stored value.
WIDENINGS = {("int", "bigint"), ("float", "double"), ("date", "timestamp")}


class NarrowingRefused(TypeError):
    """The change would lose stored values."""


def check_widening(old: str, new: str) -> str:
    """Allow a type change only if every stored value survives it."""
    if old == new or (old, new) in WIDENINGS:
        return new
    a, b = (T.DataType.fromDDL(x) for x in (old, new))
    if (isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType)
            and b.scale == a.scale and b.precision >= a.precision):
        return new
    raise NarrowingRefused(f"{old} cannot become {new}")


@dataclass(frozen=True)
class Field:
    """A column of the current table: a lasting id, today's name and type."""

    id: int
    name: str
    type: str


def rename(fields: Sequence[Field], old: str, new: str) -> list[Field]:
    return [Field(f.id, new if f.name == old else f.name, f.type) for f in fields]


def add(fields: Sequence[Field], name: str, dtype: str) -> list[Field]:
    return [*fields, Field(max(f.id for f in fields) + 1, name, dtype)]


def drop(fields: Sequence[Field], name: str) -> list[Field]:
    return [f for f in fields if f.name != name]


def widen(fields: Sequence[Field], name: str, dtype: str) -> list[Field]:
    return [Field(f.id, f.name, check_widening(f.type, dtype)) if f.name == name else f for f in fields]


def reorder(fields: Sequence[Field], names: Sequence[str]) -> list[Field]:
    by_name = {f.name: f for f in fields}
    return [by_name[n] for n in names]


def read_as(df: DataFrame, written: Sequence[Field], current: Sequence[Field]) -> DataFrame:
    """Old data under the current schema: matched by id, later columns NULL, dropped ones gone."""
    names = {f.id: f.name for f in written}
    return df.select(*[
        (F.col(names[f.id]) if f.id in names else F.lit(None)).cast(f.type).alias(f.name) for f in current])


def union_layouts(parts: Sequence[DataFrame], columns: Sequence[str]) -> DataFrame:
    """One logical table over data sets partitioned in different ways."""
    return reduce(DataFrame.unionByName, [p.select(*columns) for p in parts])
