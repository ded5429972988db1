"""Typed staging of raw frames.

A ``StagingSpec`` declares the staged columns of one table, their types, the
date parsing mode of date columns and what happens to raw columns that are
not declared: ``drop`` keeps only the declared columns (in declared order),
``keep`` rewrites the declared columns in place and passes the rest through
in their raw position. Every cast is NULL-tolerant.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from strata.functions.casts import type_name
from strata.functions.dates import parse_date_sql


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type: str
    date_mode: str = "cast"  # only read for date columns: "cast" or "legacy"


@dataclass(frozen=True)
class StagingSpec:
    table: str
    key: tuple[str, ...]
    columns: tuple[ColumnSpec, ...]
    extra_columns: str = "drop"  # "drop" or "keep"
    description: str = ""
    column_comments: dict[str, str] = field(default_factory=dict)
    buckets: int | None = None  # hash buckets by key for the staged table (None: unbucketed)

    @property
    def key_csv(self) -> str:
        return ",".join(self.key)


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _typed_sql(df: DataFrame, spec: ColumnSpec) -> str:
    source_type = df.schema[spec.name].dataType
    if type_name(spec.type) == "date":
        return parse_date_sql(spec.name, spec.date_mode, source_type)
    return f"try_cast({_q(spec.name)} AS {type_name(spec.type)})"


def stage(df: DataFrame, spec: StagingSpec) -> DataFrame:
    """Apply a staging spec to a raw frame: one projection, no shuffle,
    written as SQL expressions so a table costs one driver call."""
    missing = [c.name for c in spec.columns if c.name not in df.columns]
    if missing:
        raise ValueError(f"{spec.table}: raw input lacks columns {missing}; has {df.columns}")
    typed = {c.name: f"{_typed_sql(df, c)} AS {_q(c.name)}" for c in spec.columns}
    if spec.extra_columns == "drop":
        return df.selectExpr(*[typed[c.name] for c in spec.columns])
    if spec.extra_columns == "keep":
        return df.selectExpr(*[typed.get(name, _q(name)) for name in df.columns])
    raise ValueError(f"extra_columns must be 'drop' or 'keep', not {spec.extra_columns!r}")
