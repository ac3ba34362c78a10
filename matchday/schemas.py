"""Table schemas and column checks.

Column names are snake_case versions of the source tables' fields.  Inputs are
read with their file schema and checked here, so a missing or mistyped column
fails at plan time with a clear message instead of deep inside a job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

SUBSTITUTION = T.StructType(
    [
        T.StructField("player_in", T.IntegerType()),
        T.StructField("player_out", T.IntegerType()),
        T.StructField("minute", T.IntegerType()),
    ]
)

TEAM_SHEET = T.StructType(
    [
        T.StructField("team", T.StringType()),
        T.StructField("lineup", T.ArrayType(T.IntegerType())),
        T.StructField("substitution1", SUBSTITUTION),
        T.StructField("substitution2", SUBSTITUTION),
        T.StructField("substitution3", SUBSTITUTION),
    ]
)

EVENTS = T.StructType(
    [
        T.StructField("match_id", T.IntegerType()),
        T.StructField("competition", T.StringType()),
        T.StructField("season", T.StringType()),
        T.StructField("home_team", T.StringType()),
        T.StructField("away_team", T.StringType()),
        T.StructField("event_team", T.StringType()),
        T.StructField("event", T.StringType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("event_period", T.StringType()),
        # seconds since the start of the period
        T.StructField("event_time", T.DoubleType()),
    ]
)

MATCHES = T.StructType(
    [
        T.StructField("match_id", T.IntegerType()),
        T.StructField("competition", T.StringType()),
        T.StructField("season", T.StringType()),
        T.StructField("home_team_data", TEAM_SHEET),
        T.StructField("away_team_data", TEAM_SHEET),
    ]
)

PLAYERS = T.StructType(
    [
        T.StructField("player_id", T.IntegerType()),
        T.StructField("first_name", T.StringType()),
        T.StructField("last_name", T.StringType()),
        T.StructField("birth_area", T.StringType()),
        T.StructField("role", T.StringType()),
    ]
)

MEASUREMENT_FEATURES = [
    "temperature",
    "humidity",
    "wind_speed",
    "power_tenants",
    "power_maintenance",
    "power_solar_panels",
    "electricity_price",
]

MEASUREMENTS = T.StructType(
    [T.StructField("time", T.LongType())]
    + [T.StructField(name, T.DoubleType()) for name in MEASUREMENT_FEATURES]
)

# One row per trained model (classifier, features, label, four metrics).
MODEL_REPORT = T.StructType(
    [
        T.StructField("classifier", T.StringType()),
        T.StructField("input", T.StringType()),
        T.StructField("label", T.StringType()),
        T.StructField("correct", T.DoubleType()),
        T.StructField("within_one", T.DoubleType()),
        T.StructField("within_two", T.DoubleType()),
        T.StructField("avg_prob", T.DoubleType()),
    ]
)


class SchemaError(ValueError):
    """Raised when an input DataFrame lacks a required column."""


def _field_map(schema: T.StructType) -> dict[str, T.DataType]:
    return {f.name.lower(): f.dataType for f in schema.fields}


def require_columns(df: DataFrame, expected: T.StructType | list[str], what: str = "input") -> DataFrame:
    """Check that ``df`` has the named columns (and types, for a StructType).

    Numeric types are accepted for numeric fields (an int id read as bigint is
    fine); structs and arrays are checked field by field.  Returns ``df`` so
    the call can be chained.
    """
    have = _field_map(df.schema)
    if isinstance(expected, list):
        missing = [c for c in expected if c.lower() not in have]
        if missing:
            raise SchemaError(f"{what}: missing columns {missing}; has {sorted(have)}")
        return df
    problems = []
    for field in expected.fields:
        actual = have.get(field.name.lower())
        if actual is None:
            problems.append(f"missing {field.name}")
        elif not _compatible(actual, field.dataType):
            problems.append(f"{field.name}: {actual.simpleString()} is not {field.dataType.simpleString()}")
    if problems:
        raise SchemaError(f"{what}: " + "; ".join(problems))
    return df


def _compatible(actual: T.DataType, wanted: T.DataType) -> bool:
    if isinstance(wanted, T.NumericType):
        return isinstance(actual, T.NumericType)
    if isinstance(wanted, T.ArrayType):
        return isinstance(actual, T.ArrayType) and _compatible(actual.elementType, wanted.elementType)
    if isinstance(wanted, T.StructType):
        if not isinstance(actual, T.StructType):
            return False
        have = _field_map(actual)
        return all(
            f.name.lower() in have and _compatible(have[f.name.lower()], f.dataType) for f in wanted.fields
        )
    return type(actual) is type(wanted)
