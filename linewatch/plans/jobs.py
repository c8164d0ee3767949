"""Runnable jobs over named tables: bronze, silver, gold, riders, dispatch.

Every job takes the session and a :class:`Layout`; nothing happens on import.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linewatch.functions.sql import create_alert_history, create_matching_preferences
from linewatch.operators.context import alert_context
from linewatch.operators.delivery import delivery_log, outcomes, raise_on_failure
from linewatch.operators.riders import HISTORY_DAYS, PENDING_DAYS, pending
from linewatch.operators.upsert import mark_notified
from linewatch.plans import gold, silver
from linewatch.plans.dispatch import notify_by_day
from linewatch.schemas import CLUSTERS, CURVES, KEYS, PARTITIONS, TABLES
from linewatch.session import ensure_checkpoint_dir
from linewatch.sinks import ledger
from linewatch.sinks.layout import cluster_days
from linewatch.sinks.tables import (
    append_table, create_table, ensure_database, merge_native, merge_table, replace_partitions, replace_table,
)
from linewatch.sources.lookups import read_routes, read_stations
from linewatch.streaming.ingest import append_stream, upsert_stream
from linewatch.streaming.parse import parse_forecast, parse_rail, parse_weather

# Delivery marks are set after gold; a gold rerun must not erase them.
ALERT_MARKS = ["notification_status", "notified_at"]

SILVER = ("rail_silver", "weather_silver", "forecast_silver")

_PARSERS = {"rail_bronze": parse_rail, "weather_bronze": parse_weather, "forecast_bronze": parse_forecast}


@dataclass(frozen=True)
class Layout:
    """Where tables, lookup files and stream checkpoints live, and how much a micro-batch may be.

    ``bronze_files`` is the number of files that one of bronze writes a day: one for each 128 MB
    of it. ``silver_bytes`` bounds what one of silver reads. Keyed tables are made in ``table_format``; in
    one other than parquet they are upserted by MERGE.
    """

    database: str
    lookups: str = ""
    checkpoints: str = ""
    bronze_files: int = 1
    silver_bytes: int = 8 << 30
    table_format: str = "parquet"

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def merge(self, rows: DataFrame, table: str, keys: list[str], **how: object) -> None:
        """Upsert into a full table name."""
        (merge_table if self.table_format == "parquet" else merge_native)(rows, table, keys, **how)


def create_tables(spark: SparkSession, at: Layout) -> None:
    ensure_database(spark, at.database)
    for table, schema in TABLES.items():
        if not table.endswith("_bronze"):  # a bronze table is made by its stream
            order = silver.ORDER if table in SILVER else {}
            fmt = at.table_format if table in KEYS else "parquet"
            create_table(spark, at.name(table), schema | order, PARTITIONS.get(table, ()), fmt)


def run_bronze(spark: SparkSession, at: Layout, topics: Mapping[str, DataFrame]) -> None:
    """Drain the given topics (bronze table: stream) side by side, into partitions by the broker's day."""
    ensure_database(spark, at.database)
    running = [
        append_stream(
            _PARSERS[table](stream).withColumn("kafka_date", F.to_date("kafka_timestamp")),
            f"{at.checkpoints}/bronze/{table}",
            table=at.name(table),
            partition_by=["kafka_date"],
            files=at.bronze_files,
        )
        for table, stream in topics.items()
    ]
    for query in running:
        query.awaitTermination()


def _noting(spark: SparkSession, at: Layout, table: str) -> Callable[[list[tuple]], None]:
    """Notes the days of ``table`` that a merge is about to change."""
    return lambda values: ledger.note_days(spark, at.name("touched_days"), table, [v[0] for v in values])


def run_silver(spark: SparkSession, at: Layout) -> None:
    rail = silver.train_events(
        spark.table(at.name("rail_bronze")), read_stations(spark, at.lookups), read_routes(spark, at.lookups), ordered=True
    )
    weather = silver.weather_current(spark.table(at.name("weather_bronze")), ordered=True)
    forecast = silver.weather_forecast(spark.table(at.name("forecast_bronze")), ordered=True)
    for table, rows in zip(SILVER, (rail, weather, forecast)):
        at.merge(rows, at.name(table), KEYS[table], newer_by=silver.ORDER_COLUMN, touching=_noting(spark, at, table))


def stream_silver(spark: SparkSession, at: Layout) -> None:
    """Silver from the bronze rows that are new since the last call.

    The same cleaning per micro-batch, upserted by key, so corrected messages replace
    what was there unless the broker had that later, and the cost follows the new
    rows alone. Batches in any order give what one batch would, and one that was merged before a
    break is not merged again.
    """
    stations, routes = read_stations(spark, at.lookups), read_routes(spark, at.lookups)
    steps = {
        "rail": lambda bronze: silver.train_events(bronze, stations, routes, ordered=True),
        "weather": lambda bronze: silver.weather_current(bronze, ordered=True),
        "forecast": lambda bronze: silver.weather_forecast(bronze, ordered=True),
    }
    for name, step in steps.items():
        table = f"{name}_silver"
        upsert_stream(
            spark.readStream.option("maxBytesPerTrigger", str(at.silver_bytes)).table(at.name(f"{name}_bronze")),
            f"{at.checkpoints}/silver/{name}",
            at.name(table),
            KEYS[table],
            prepare=step,
            newer_by=silver.ORDER_COLUMN,
            touching=_noting(spark, at, table),
            merged=at.name("merged_batches"),
            merge=None if at.table_format == "parquet" else at.merge,
        ).awaitTermination()


Days = Callable[[str, int, int], Column]


def _since(first: date) -> Days:
    """Rows of the partitions from ``first`` (less a margin of days) on, and those without a day."""
    return lambda c, before, after: (F.col(c) >= F.lit(first - timedelta(days=before))) | F.col(c).isNull()


def _among(days: set[date | None]) -> Days:
    """Rows of the partitions of ``days`` and as many days beside them as the margins say."""

    def inside(c: str, before: int, after: int) -> Column:
        wanted = {d + timedelta(days=i) for d in days if d is not None for i in range(-before, after + 1)}
        hit = F.col(c).isin(sorted(wanted)) if wanted else F.lit(False)
        return hit | F.col(c).isNull() if None in days else hit

    return inside


def _gold(spark: SparkSession, at: Layout, days: Days | None) -> None:
    """Gold of the chosen days, or of all."""

    def read(table: str, day: str = "event_date", before: int = 0, after: int = 0) -> DataFrame:
        rows = spark.table(at.name(table))
        return rows if days is None else rows.where(days(day, before, after))

    trains, seen, ahead = (
        read(table, before=before, after=after).drop(silver.ORDER_COLUMN)
        for table, (before, after) in zip(SILVER, ((0, 0), (1, 0), (0, 1)))
    )
    for table, rows in (
        ("gold_weather_train", gold.with_current_weather(trains, seen)),
        ("gold_forecast_train", gold.with_forecast(trains, ahead)),
    ):
        at.merge(rows, at.name(table), KEYS[table], cluster_by=CLUSTERS[table])
    for table, rows in (
        ("gold_station_reliability", gold.station_reliability(trains)),
        ("gold_route_reliability", gold.route_reliability(trains)),
    ):
        if days is None:
            replace_table(rows, at.name(table), PARTITIONS[table])
        else:
            replace_partitions(rows, at.name(table))
    context = alert_context(
        read("gold_weather_train"),
        read("gold_forecast_train"),
        read("gold_route_reliability", "date"),
        read("gold_station_reliability", "date"),
    ).withColumn("ingest_timestamp", F.current_timestamp())
    at.merge(context, at.name("alerts"), KEYS["alerts"], preserve=ALERT_MARKS)


def run_gold(spark: SparkSession, at: Layout, since: date | None = None) -> None:
    """Enrichment, metrics and alerts; with ``since`` only for that day and later.

    Every gold row depends on its own day, and on weather at most hours away, so
    a run over the newest days leaves the older partitions as they are.
    """
    _gold(spark, at, None if since is None else _since(since))


# A change of weather reaches movements up to a day later, one of forecasts those up to a day earlier.
_REACHES = {"rail_silver": (0,), "weather_silver": (0, 1), "forecast_silver": (0, -1)}


def run_gold_changes(spark: SparkSession, at: Layout) -> set[date | None]:
    """Gold of exactly the days that silver has changed since the last call, however old they are.

    Returns them. The days are those that silver's merges have noted, and count as done when all of gold is
    written, so a run that breaks off is made up for by the next. Silver and gold take turns.
    """
    for table in ("touched_days", "consumed_days"):
        spark.catalog.refreshTable(at.name(table))
    notes = ledger.open_days(spark.table(at.name("touched_days")), spark.table(at.name("consumed_days")), "gold", SILVER)
    ensure_checkpoint_dir(spark)
    notes = notes.checkpoint()  # a merge may note more while this runs
    found = notes.select("source", "event_date").distinct().collect()  # a row for each table and day
    days = {r.event_date and r.event_date + timedelta(days=i) for r in found for i in _REACHES[r.source]}
    if days:
        _gold(spark, at, _among(days))
        ledger.close_days(notes, at.name("consumed_days"), "gold")
    return days


def run_clustering(spark: SparkSession, at: Layout, days: set[date | None] | None = None) -> None:
    """Large files in curve order for the tables that are read by place and hour; of ``days`` or all.

    Merges leave files by day; this is for days that have settled, and changes no row.
    """
    for table, columns in CURVES.items():
        cluster_days(spark, at.name(table), columns, days)


def run_riders(spark: SparkSession, at: Layout, prefs: DataFrame) -> None:
    """Refresh the preference snapshot and the two SQL functions."""
    replace_table(prefs, at.name("rider_preferences"))
    create_matching_preferences(spark, at.name("rider_preferences"), at.name("get_matching_preferences"))
    create_alert_history(spark, at.name("alerts"), at.name("get_alert_history"))


def run_dispatch(
    spark: SparkSession, at: Layout, as_of: Column | None = None, lookback_days: int = PENDING_DAYS
) -> None:
    """Draft pending notifications, then move the cursor past their alerts.

    Alerts, cursor and outbox are read for the days that can matter: those looked back on, and for
    the history of an alert the days before. An alert that concerns no rider is marked at once.
    """
    ensure_checkpoint_dir(spark)
    today = F.current_date() if as_of is None else as_of
    alerts = spark.table(at.name("alerts"))

    def recent(df: DataFrame, more: int = 0) -> DataFrame:
        return df.where(F.col("event_date") >= F.date_sub(today, lookback_days + more))

    # Settled once, so that outbox and cursor speak of the same alerts.
    waiting = pending(alerts, spark.table(at.name("dispatch_cursor")), today, lookback_days, large_cursor=True).checkpoint()
    outbox, cursor = notify_by_day(waiting, spark.table(at.name("rider_preferences")), recent(alerts, HISTORY_DAYS))
    known = recent(spark.table(at.name("dispatch_outbox"))).select("notification_id")
    append_table(outbox.join(known, "notification_id", "left_anti"), at.name("dispatch_outbox"))
    spark.catalog.refreshTable(at.name("dispatch_outbox"))
    told = recent(spark.table(at.name("dispatch_outbox"))).select("event_id")
    unheard = waiting.where("notification_status IS NULL").join(told, "event_id", "left_anti")
    at.merge(mark_notified(unheard, unheard), at.name("alerts"), KEYS["alerts"])
    append_table(cursor, at.name("dispatch_cursor"))


def record_deliveries(
    spark: SparkSession, at: Layout, results: DataFrame, final: bool = False, since: date | None = None
) -> None:
    """Log delivery results (``notification_id, delivered``), mark alerts as sent,
    then raise if any of these notifications is not delivered by now.

    Each result is a try; the log holds for each notification the outcome of all its tries, so results in any
    order and split over calls end as one call would. Notifications without one wait for a later call, and an
    alert is marked once none of its notifications waits. ``final`` says that no
    more will come, so that what waits has failed; a result that comes all the same still counts.

    Results may carry the outbox's ``event_date``: then only days from their first on are read, or from
    ``since`` on, if that is earlier. Without either all days are.
    """
    ensure_checkpoint_dir(spark)
    if "event_date" in results.columns:
        oldest = results.agg(F.min("event_date")).first()[0]
        since = min([d for d in (since, oldest) if d is not None], default=None)

    def read(table: str) -> DataFrame:
        spark.catalog.refreshTable(at.name(table))
        rows = spark.table(at.name(table))
        return rows if since is None else rows.where(F.col("event_date") >= F.lit(since))

    outbox = read("dispatch_outbox")
    tried_at = F.col("attempted_at").cast("timestamp") if "attempted_at" in results.columns else F.current_timestamp()
    tries = results.select("notification_id", "delivered", tried_at.alias("attempted_at"))
    tries = tries.join(outbox.select("notification_id", "event_date"), "notification_id").checkpoint()
    append_table(tries, at.name("delivery_attempts"))
    now = outbox.join(tries.select("notification_id"), "notification_id", "left_semi")
    if final:
        logged = read("delivery_log").select("notification_id")
        now = now.unionByName(outbox.join(logged, "notification_id", "left_anti")).dropDuplicates(["notification_id"])
    log = delivery_log(now, outcomes(read("delivery_attempts")), missing_fails=final).checkpoint()
    at.merge(log, at.name("delivery_log"), KEYS["delivery_log"])
    waiting = outbox.join(read("delivery_log").select("notification_id"), "notification_id", "left_anti")
    done = read("dispatch_cursor").select("event_id").join(waiting.select("event_id"), "event_id", "left_anti")
    open_alerts = read("alerts").where("notification_status IS NULL").join(done, "event_id", "left_semi")
    at.merge(mark_notified(open_alerts, done), at.name("alerts"), KEYS["alerts"])
    raise_on_failure(log)
