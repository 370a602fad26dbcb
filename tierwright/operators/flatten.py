"""Nested objects to flat columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def flatten_structs(df: DataFrame, sep: str = "_") -> DataFrame:
    """Replace each struct by its leaves, named ``parent<sep>child``, in place."""

    def leaves(struct: T.StructType, path: tuple[str, ...]) -> list[str]:
        found: list[str] = []
        for field in struct:
            here = (*path, field.name)
            if isinstance(field.dataType, T.StructType):
                found += leaves(field.dataType, here)
            else:
                source = ".".join(f"`{p}`" for p in here)
                found.append(f"{source} AS `{sep.join(here)}`")
        return found

    return df.selectExpr(*leaves(df.schema, ()))
