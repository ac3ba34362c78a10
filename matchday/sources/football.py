"""Readers for football tables stored with camelCase or snake_case names.

Event feeds and match sheets often come with camelCase fields (``matchId``,
``homeTeamData.substitution1.playerIn``, ``firstname``).  These readers
return the snake_case schemas of ``matchday.schemas``; nested structs are
rebuilt field by field *by name* (never by position), and a missing
substitution stays null rather than becoming a struct of nulls.  Everything
is a projection on top of the scan, so column pruning and filter pushdown
still reach the Parquet files.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchday import schemas
from matchday.schemas import require_columns

# Source field spellings that are not plain camelCase.
ALIASES = {"firstname": "first_name"}


def snake(name: str) -> str:
    """``homeTeamData`` -> ``home_team_data``; snake_case names are unchanged."""
    if name in ALIASES:
        return ALIASES[name]
    return re.sub(r"(?<=[a-z0-9])([A-Z])", r"_\1", name).lower()


def _source_field(schema: T.StructType, wanted: str) -> T.StructField | None:
    for field in schema.fields:
        if snake(field.name) == wanted:
            return field
    return None


def _conform(col: Column, source: T.DataType, target: T.DataType) -> Column:
    """Rebuild ``col`` (of type ``source``) as ``target``, matching struct
    fields by snake_case name."""
    if isinstance(target, T.StructType):
        parts = []
        for field in target.fields:
            src = _source_field(source, field.name)
            if src is None:
                parts.append(F.lit(None).cast(field.dataType).alias(field.name))
            else:
                parts.append(_conform(col[src.name], src.dataType, field.dataType).alias(field.name))
        return F.when(col.isNotNull(), F.struct(*parts))
    if isinstance(target, T.ArrayType) and isinstance(target.elementType, T.StructType):
        return F.transform(col, lambda x: _conform(x, source.elementType, target.elementType))
    if isinstance(target, T.IntegralType) and isinstance(source, T.IntegralType):
        return col  # an id keeps its width
    if (
        isinstance(target, T.ArrayType)
        and isinstance(target.elementType, T.IntegralType)
        and isinstance(source.elementType, T.IntegralType)
    ):
        return col
    return col.cast(target)


def conform(df: DataFrame, target: T.StructType, what: str) -> DataFrame:
    """Select ``target``'s columns from ``df`` whatever their naming style."""
    cols = []
    missing = []
    for field in target.fields:
        src = _source_field(df.schema, field.name)
        if src is None:
            missing.append(field.name)
            continue
        cols.append(_conform(F.col(f"`{src.name}`"), src.dataType, field.dataType).alias(field.name))
    if missing:
        raise schemas.SchemaError(f"{what}: missing columns {missing}; has {df.columns}")
    out = df.select(*cols)
    return require_columns(out, target, what)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Match events as ``schemas.EVENTS``."""
    return conform(spark.read.parquet(path), schemas.EVENTS, "events")


def read_matches(spark: SparkSession, path: str) -> DataFrame:
    """Match sheets as ``schemas.MATCHES``."""
    return conform(spark.read.parquet(path), schemas.MATCHES, "matches")


def read_players(spark: SparkSession, path: str) -> DataFrame:
    """Players as ``schemas.PLAYERS``."""
    return conform(spark.read.parquet(path), schemas.PLAYERS, "players")


def read_measurements(spark: SparkSession, path: str) -> DataFrame:
    """Minute measurements as ``schemas.MEASUREMENTS``."""
    return conform(spark.read.parquet(path), schemas.MEASUREMENTS, "measurements")
