"""Views the dashboard needs: pivots, timelines, latest rows, top lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadpulse import constants as C
from roadpulse.functions import traffic
from roadpulse.operators import filters


def pivot_cameras(history: DataFrame, roster: list[str]) -> DataFrame:
    """One column per rostered camera over all times, zeros where a camera has no value."""
    return (
        history.where(F.col("source_id").isin(roster))
        .groupBy("recorded_at")
        .pivot("source_id", roster)
        .agg(F.sum("vehicle_count"))
        .na.fill(0, roster)
        .orderBy("recorded_at")
    )


def camera_times(by_type: DataFrame, camera: str) -> DataFrame:
    """Distinct times of one camera."""
    return (
        by_type.where(F.col("source_id") == camera)
        .select(F.col("window_end").alias("recorded_at"))
        .distinct()
    )


def union_times(by_type: DataFrame, cameras: list[str]) -> DataFrame:
    """Distinct times at which any of the cameras has a value, in order."""
    times = by_type.where(F.col("source_id").isin(cameras))
    return times.select(F.col("window_end").alias("recorded_at")).distinct().orderBy("recorded_at")


def type_timeline(by_type: DataFrame) -> DataFrame:
    """Per camera every one of its times with every one of its types, zeros where absent.

    Long form: one row per (camera, time, type, metric). A camera's types are gathered beside its rows, so
    the input is computed once, and each (camera, time) is expanded in place: no pairs are formed. Rows
    without a type are left out; of repeated rows the one with the most vehicles counts.
    """
    typed = by_type.where(F.col("vehicle_type").isNotNull())
    of_camera = F.collect_set("vehicle_type").over(Window.partitionBy("source_id"))
    value = F.struct(
        "vehicle_type",
        F.coalesce("vehicle_count", F.lit(0)).alias("vehicle_count"),
        F.coalesce("avg_speed_kmh", F.lit(0.0)).alias("avg_speed_kmh"),
    )
    at = (
        typed.withColumn("types", of_camera)
        .groupBy("source_id", F.col("window_end").alias("recorded_at"))
        .agg(F.sort_array(F.collect_list(value)).alias("seen"), F.any_value("types").alias("types"))
    )
    own = F.filter("seen", lambda v: v["vehicle_type"] == F.col("vehicle_type"))
    dense = (
        at.select("source_id", "recorded_at", "seen", F.explode("types").alias("vehicle_type"))
        .withColumn("value", F.try_element_at(own, F.lit(-1)))
        .select(
            "source_id",
            "recorded_at",
            "vehicle_type",
            F.coalesce("value.vehicle_count", F.lit(0)).cast("double").alias("count"),
            F.coalesce("value.avg_speed_kmh", F.lit(0.0)).alias("speed"),
        )
    )
    return dense.unpivot(
        ["source_id", "recorded_at", "vehicle_type"], ["count", "speed"], "metric", "value"
    )


def pivot_types(by_type: DataFrame, camera: str, types: list[str]) -> DataFrame:
    """Wide form for one camera: a count and a speed column per type, zeros where absent."""
    metrics = [f"{t}_{m}" for t in types for m in ("count", "speed")]
    return (
        by_type.where((F.col("source_id") == camera) & F.col("vehicle_type").isin(types))
        .groupBy(F.col("window_end").alias("recorded_at"))
        .pivot("vehicle_type", types)
        .agg(F.sum("vehicle_count").alias("count"), F.max("avg_speed_kmh").alias("speed"))
        .na.fill(0, metrics)
        .orderBy("recorded_at")
    )


def latest_by_type(by_type: DataFrame) -> DataFrame:
    """Per camera and type the most recent values, the largest count first."""
    newest = F.max_by(F.struct("window_end", "vehicle_count", "avg_speed_kmh"), "window_end")
    return (
        by_type.groupBy("source_id", "vehicle_type")
        .agg(newest.alias("r"))
        .select("source_id", "vehicle_type", "r.*")
        .orderBy("source_id", F.desc("vehicle_count"), "vehicle_type")
    )


def tail_intervals(history: DataFrame, n: int = 24) -> DataFrame:
    """The last n times of each camera, in order.

    Spark cuts each map task's rows to n per camera before the shuffle (window group limit).
    """
    newest = Window.partitionBy("source_id").orderBy(F.desc("recorded_at"))
    return (
        history.withColumn("_rank", F.row_number().over(newest))
        .where(F.col("_rank") <= n)
        .drop("_rank")
        .orderBy("recorded_at", "source_id")
    )


def alert_rows(incidents: DataFrame) -> DataFrame:
    return incidents.select(
        traffic.alert_title(F.col("source_id"), F.col("traffic_status")).alias("title"),
        traffic.alert_time(F.col("last_update")).alias("time"),
        traffic.alert_severity(F.col("traffic_status")).alias("severity"),
    )


def _or_waiting(snapshot: DataFrame, waiting: DataFrame) -> DataFrame:
    """The snapshot's rows with ``_live`` true, or where there are none those of ``waiting``.

    A snapshot has a row per camera; it is computed once.
    """
    both = snapshot.withColumn("_live", F.lit(True)).unionByName(
        waiting.withColumn("_live", F.lit(False)), allowMissingColumns=True
    )
    some = F.max("_live").over(Window.partitionBy(F.lit(0)))
    return both.withColumn("_some", some).where(F.col("_live") == F.col("_some")).drop("_some")


def top_alerts(spark: SparkSession, snapshot: DataFrame, n: int = 3) -> DataFrame:
    """The first n incidents by camera; one information row when there is no snapshot at all."""
    rows = _or_waiting(snapshot, spark.range(1).select(F.lit("").alias("source_id")))
    shown = rows.where(~F.col("_live") | filters.is_incident()).orderBy("source_id").limit(n)
    texts = {"title": C.NO_LIVE_DATA_TITLE, "time": C.NO_LIVE_DATA_TIME, "severity": C.SEVERITY_INFO}
    own = {
        "title": traffic.alert_title(F.col("source_id"), F.col("traffic_status")),
        "time": traffic.alert_time(F.col("last_update")),
        "severity": traffic.alert_severity(F.col("traffic_status")),
    }
    return shown.select(*[F.when(F.col("_live"), own[c]).otherwise(F.lit(texts[c])).alias(c) for c in own])


def camera_cards(snapshot: DataFrame, n: int = 2) -> DataFrame:
    """The first n cameras with label and place."""
    source = F.col("source_id")
    return (
        snapshot.orderBy("source_id")
        .limit(n)
        .withColumns(
            {"label": traffic.camera_label(source), "place": traffic.camera_place(source)}
        )
    )


def route_cards(snapshot: DataFrame, n: int = 3) -> DataFrame:
    """The first n cameras with their road load; two fixed cards when there is no snapshot at all."""
    fixed = snapshot.sparkSession.createDataFrame(
        C.WAITING_ROUTE_CARDS, "source_id string, _load int, traffic_status string"
    )
    load = traffic.load_score(F.col("avg_speed"), F.col("total_vehicles"))
    return (
        _or_waiting(snapshot, fixed)
        .orderBy("source_id")
        .limit(n)
        .select(
            F.col("source_id").alias("name"),
            F.when(F.col("_live"), load).otherwise(F.col("_load")).alias("load"),
            F.col("traffic_status").alias("status"),
        )
    )


def dashboard_payload(
    network: DataFrame, snapshot: DataFrame, points: DataFrame, by_type: DataFrame
) -> dict[str, DataFrame]:
    """The four tables behind one dashboard refresh, in serving order."""
    return {
        "summary": network,
        "cameras": snapshot.orderBy("source_id"),
        "points": points.orderBy("recorded_at"),
        "byType": by_type.orderBy("window_end", "source_id", "vehicle_type"),
    }
