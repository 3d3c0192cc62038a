"""Fields by dotted path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def path_or_null(df: DataFrame, path: str) -> Column:
    """The column at a dotted path through structs; null if the path leads nowhere.

    A step through an array or a map leads nowhere: a path names one value per row.
    """
    kind = df.schema
    for step in path.split("."):
        if not isinstance(kind, StructType) or step not in kind.fieldNames():
            return F.lit(None)
        kind = kind[step].dataType
    return F.col(".".join(f"`{step}`" for step in path.split(".")))
