"""Schemas of events and published tables, and the contract check over them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("source_id", T.StringType()),
        T.StructField("tracker_id", T.IntegerType()),
        T.StructField("vehicle_type", T.StringType()),
        T.StructField("speed_kmh", T.DoubleType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("processing_time", T.StringType()),
        T.StructField("frame", T.IntegerType()),
        T.StructField(
            "position_meters",
            T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())]),
        ),
        T.StructField("trajectory_length", T.IntegerType()),
    ]
)

LIVE_SNAPSHOT_SCHEMA = T.StructType(
    [
        T.StructField("source_id", T.StringType(), False),
        T.StructField("window_start", T.TimestampNTZType()),
        T.StructField("window_end", T.TimestampNTZType()),
        T.StructField("total_count", T.IntegerType()),
        T.StructField("avg_speed", T.DecimalType(6, 2)),
        T.StructField("max_speed", T.DecimalType(6, 2)),
        T.StructField("min_speed", T.DecimalType(6, 2)),
        T.StructField("avg_confidence", T.DecimalType(4, 3)),
        T.StructField("traffic_status", T.StringType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("updated_at", T.TimestampNTZType()),
    ]
)

HOURLY_SUMMARY_SCHEMA = T.StructType(
    [
        T.StructField("window_start", T.TimestampNTZType(), False),
        T.StructField("window_end", T.TimestampNTZType(), False),
        T.StructField("source_id", T.StringType(), False),
        T.StructField("total_vehicles", T.IntegerType(), False),
        T.StructField("avg_speed_kmh", T.DoubleType()),
    ]
)

HOURLY_BY_TYPE_SCHEMA = T.StructType(
    [
        T.StructField("window_start", T.TimestampNTZType(), False),
        T.StructField("window_end", T.TimestampNTZType(), False),
        T.StructField("source_id", T.StringType(), False),
        T.StructField("vehicle_type", T.StringType(), False),
        T.StructField("vehicle_count", T.IntegerType(), False),
        T.StructField("avg_speed_kmh", T.DoubleType()),
        T.StructField("avg_observations", T.DoubleType()),
    ]
)

# The history of 5-second windows per camera and vehicle type.
LIVE_HISTORY_SCHEMA = T.StructType(
    [
        T.StructField("source_id", T.StringType(), False),
        T.StructField("vehicle_type", T.StringType(), False),
        T.StructField("window_start", T.TimestampNTZType(), False),
        T.StructField("window_end", T.TimestampNTZType(), False),
        T.StructField("total_count", T.IntegerType()),
        T.StructField("avg_speed", T.DecimalType(6, 2)),
        T.StructField("max_speed", T.DecimalType(6, 2)),
        T.StructField("min_speed", T.DecimalType(6, 2)),
        T.StructField("avg_confidence", T.DecimalType(4, 3)),
        T.StructField("traffic_status", T.StringType()),
        T.StructField("created_at", T.TimestampNTZType()),
    ]
)

# Lengths and defaults of the published tables; "now" is the time of writing.
LENGTHS = {
    "live_history": {"source_id": 20, "vehicle_type": 20, "traffic_status": 20},
    "hourly_summary": {"source_id": 50},
    "hourly_by_type": {"source_id": 50, "vehicle_type": 50},
}
DEFAULTS = {
    "live_history": {"total_count": 0, "created_at": "now"},
    "hourly_summary": {"total_vehicles": 0, "created_at": "now"},
    "hourly_by_type": {"vehicle_count": 0, "created_at": "now"},
}

LIVE_KEY = ["source_id"]
SUMMARY_KEY = ["window_start", "source_id"]
TYPE_KEY = ["window_start", "source_id", "vehicle_type"]


def schema_violations(df: DataFrame, expected: T.StructType) -> list[tuple[str, str, str]]:
    """(column, problem, detail) for each declared column that is absent or typed differently."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for field in expected.fields:
        if field.name not in actual:
            problems.append((field.name, "missing", field.dataType.simpleString()))
        elif actual[field.name] != field.dataType:
            problems.append((field.name, "type", actual[field.name].simpleString()))
    return problems


def with_defaults(df: DataFrame, defaults: dict, stamp: Column | None = None) -> DataFrame:
    """Add the columns that are absent, filled with their defaults, and fill nulls of those present."""
    now = F.current_timestamp().cast("timestamp_ntz") if stamp is None else stamp
    values = {c: now if v == "now" else F.lit(v) for c, v in defaults.items()}
    return df.withColumns({c: F.coalesce(F.col(c), v) if c in df.columns else v for c, v in values.items()})


def column_listing(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type and whether it may be null."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields, 1)]
    return df.sparkSession.createDataFrame(
        rows, "position int, column_name string, data_type string, is_nullable boolean"
    )


def contract_violations(
    df: DataFrame,
    not_null: list[str] = (),
    max_length: dict[str, int] | None = None,
    key: list[str] = (),
) -> DataFrame:
    """One row (check, column_name, violations) per declared rule, zero counts included.

    Null and length rules are counted in one pass; key uniqueness needs one shuffle of
    pre-aggregated key counts. ``violations`` of a key is its number of surplus rows.
    """
    rules = [("not_null", c, F.count_if(F.col(c).isNull())) for c in not_null]
    rules += [
        ("max_length", c, F.count_if(F.length(c) > n)) for c, n in (max_length or {}).items()
    ]
    parts = []
    if rules:
        counted = df.agg(*[rule.alias(f"r{i}") for i, (_, _, rule) in enumerate(rules)])
        listed = F.array(
            *[
                F.struct(
                    F.lit(check).alias("check"),
                    F.lit(column).alias("column_name"),
                    F.col(f"r{i}").alias("violations"),
                )
                for i, (check, column, _) in enumerate(rules)
            ]
        )
        parts.append(counted.select(F.inline(listed)))
    if key:
        parts.append(
            df.groupBy(*key)
            .agg(F.count("*").alias("_rows"))
            .agg(F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0).cast("bigint")).alias("violations"))
            .select(
                F.lit("unique").alias("check"),
                F.lit(",".join(key)).alias("column_name"),
                "violations",
            )
        )
    if not parts:
        return df.sparkSession.createDataFrame([], "check string, column_name string, violations bigint")
    return reduce(DataFrame.unionByName, parts)


def sample_rows(df: DataFrame, n: int = 5) -> DataFrame:
    """First rows of a table, for inspection."""
    return df.limit(n)
