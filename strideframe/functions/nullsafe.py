"""Group keys that keep rows whose key is NULL.

A plain equi-join drops NULL keys, and a null-safe join is planned on other
expressions than a window over the same columns, so its input would move twice.
``key_columns`` replaces each key by two columns that are never NULL (the value
or a fixed stand-in, and whether it is NULL); windows and joins on them agree
in their partitioning and keep every row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strideframe.functions.sizing import broadcast_if_small


def _stand_in(kind: T.DataType) -> Column:
    if isinstance(kind, T.DateType):
        return F.lit("1970-01-01").cast(kind)
    if isinstance(kind, T.StringType):
        return F.lit("")
    if isinstance(kind, T.BooleanType):
        return F.lit(False)
    return F.lit(0).cast(kind)


def key_columns(df: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str]]:
    """Add stand-in columns for those of ``keys`` that can be NULL; returns the frame and the names to group by."""
    added: dict[str, Column] = {}
    names: list[str] = []
    taken = set(df.columns)
    for k in keys:
        field = df.schema[k]
        if not field.nullable:
            names.append(k)
            continue
        name = f"_key_{k}"
        while name in taken or f"{name}_null" in taken:
            name += "_"
        added[name] = F.coalesce(F.col(k), _stand_in(field.dataType))
        added[f"{name}_null"] = F.col(k).isNull()
        names += [name, f"{name}_null"]
    return df.withColumns(added) if added else df, names


def join_by(df: DataFrame, table: DataFrame, keys: list[str], how: str = "inner", broadcast: bool = True) -> DataFrame:
    """Join a (small) table of one row per group; NULL keys meet NULL keys.

    The table is broadcast when its counted size allows; else the planner joins
    by shuffle, where skewed keys of ``df`` are split by AQE.
    """
    names = [f"_on{i}" for i in range(2 * len(keys))]
    pairs = [c for k in keys for c in (F.coalesce(F.col(k), _stand_in(df.schema[k].dataType)), F.col(k).isNull())]
    left = df.withColumns(dict(zip(names, pairs, strict=True)))
    right = table.withColumns(dict(zip(names, pairs, strict=True))).drop(*keys)
    return left.join(broadcast_if_small(right) if broadcast else right, names, how).drop(*names)
