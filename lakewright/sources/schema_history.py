"""Additive schema evolution for file tables.

The schema a table has grown to is kept as one small row per change in a folder
beside the data files. Readers pass it to Spark, which fills columns a file does
not have with null: no footer merge over the whole table is ever needed.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructField, StructType

_HISTORY = "_schema_history"  # the leading underscore hides it from data readers
_ROW = "version int, schema_json string"


def path_is_missing(err: AnalysisException) -> bool:
    return err.getCondition() == "PATH_NOT_FOUND"


class SchemaConflict(ValueError):
    """The new schema drops a column or changes its type."""


def _merge_type(old: DataType, new: DataType, path: str) -> DataType:
    if isinstance(old, StructType) and isinstance(new, StructType):
        return _merge_struct(old, new, path)
    if isinstance(old, ArrayType) and isinstance(new, ArrayType):
        return ArrayType(_merge_type(old.elementType, new.elementType, path + "[]"), True)
    if isinstance(old, MapType) and isinstance(new, MapType):
        key = _merge_type(old.keyType, new.keyType, path + "{key}")
        return MapType(key, _merge_type(old.valueType, new.valueType, path + "{value}"), True)
    if old != new:
        raise SchemaConflict(f"{path}: {old.simpleString()} cannot become {new.simpleString()}")
    return old


def _merge_struct(old: StructType, new: StructType, path: str) -> StructType:
    incoming = {f.name: f for f in new.fields}
    gone = [f.name for f in old.fields if f.name not in incoming]
    if gone:
        raise SchemaConflict(f"{path or 'table'}: columns {gone} are missing from the new schema")
    known = {f.name for f in old.fields}
    kept = [
        StructField(f.name, _merge_type(f.dataType, incoming[f.name].dataType, f"{path}.{f.name}".lstrip(".")), True)
        for f in old.fields
    ]
    added = [StructField(f.name, f.dataType, True) for f in new.fields if f.name not in known]
    return StructType(kept + added)


def evolve(old: StructType, new: StructType) -> StructType:
    """``old`` plus the columns ``new`` adds, by name and at any depth."""
    return _merge_struct(old, new, "")


def latest_schema(spark: SparkSession, table: str) -> StructType | None:
    """The last schema recorded for the table, or None.

    Two writers may have recorded the same version; it is then all they added.
    """
    try:
        history = spark.read.schema(_ROW).json(f"{table.rstrip('/')}/{_HISTORY}")
        last = history.agg(F.max("version")).scalar()
        found = [StructType.fromJson(json.loads(r.schema_json)) for r in history.where(F.col("version") == last).orderBy("schema_json").collect()]
    except AnalysisException as err:
        if path_is_missing(err):
            return None
        raise
    return reduce(_combined, found) if found else None


def _combined(one: StructType, other: StructType) -> StructType:
    """Two schemas that grew from the same one, joined by name; conflicting types are refused."""
    fields = {f.name: f for f in one.fields}
    return _merge_struct(one, StructType([*fields.values(), *[f for f in other.fields if f.name not in fields]]), "")


def record_schema(spark: SparkSession, table: str, schema: StructType) -> StructType:
    """Evolve the recorded schema to ``schema`` if it differs, and return the result."""
    current = latest_schema(spark, table)
    merged = schema if current is None else evolve(current, schema)
    if merged != current:
        path = f"{table.rstrip('/')}/{_HISTORY}"
        version = 1 if current is None else spark.read.schema(_ROW).json(path).agg(F.max("version")).first()[0] + 1
        spark.createDataFrame([(version, merged.json())], _ROW).coalesce(1).write.mode("append").json(path)
    return merged


def union_versions(*versions: DataFrame) -> DataFrame:
    """One DataFrame over tables of successive schema versions, checked by name."""
    merged = versions[0].schema
    for df in versions[1:]:
        merged = evolve(merged, df.schema)
    out = versions[0]
    for df in versions[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out.select(*merged.fieldNames())
