"""Every registered query: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linewatch import operators
from linewatch.functions import calendar, casts, keys, sql, texts, weather
from linewatch.operators import clean, context, delivery, lookup, ranges, reliability, riders, temporal, train_sets, upsert, windows
from linewatch.plans import dispatch, gold, silver
from linewatch.schemas import conform
from linewatch.session import staged
from linewatch.sources.lookups import rider_preferences
from linewatch.sources.topics import envelope
from linewatch.streaming.ingest import drained
from linewatch.streaming.parse import parse_forecast, parse_rail, parse_weather
from testbed import frames as fx

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# Reporting date of the rider queries and the days they look back.
AS_OF, PENDING_DAYS = "2024-01-31", 7


# --- shared steps -----------------------------------------------------------

def rail_bronze(spark, sf):
    return parse_rail(envelope(fx.rail_topic(spark, sf)))


def weather_bronze(spark, sf):
    return parse_weather(envelope(fx.weather_topic(spark, sf)))


def forecast_bronze(spark, sf):
    return parse_forecast(envelope(fx.forecast_topic(spark, sf)))


# Between layers the jobs have tables. Queries that run several layers stage the
# frames that more than one later step reads.

def rail_silver(spark, sf):
    return silver.train_events(rail_bronze(spark, sf), fx.stations(spark, sf), fx.routes(spark, sf))


def silver_layer(spark, sf, *names):
    """The named silver frames (rail, weather, forecast), staged."""
    parse = {"rail": rail_bronze, "weather": weather_bronze, "forecast": forecast_bronze}
    bronze = [parse[n](spark, sf) for n in names]
    clean_up = {
        "rail": lambda b: silver.train_events(b, fx.stations(spark, sf), fx.routes(spark, sf)),
        "weather": silver.weather_current,
        "forecast": silver.weather_forecast,
    }
    return staged(*[clean_up[n](b) for n, b in zip(names, bronze)])


def alerts(spark, sf):
    trains, seen, ahead = silver_layer(spark, sf, "rail", "weather", "forecast")
    return context.alert_context(
        gold.with_current_weather(trains, seen),
        gold.with_forecast(trains, ahead),
        gold.route_reliability(trains),
        gold.station_reliability(trains),
    )


def prefs(spark, sf):
    return rider_preferences(fx.riders(spark, sf))


def as_of():
    return F.lit(AS_OF).cast("date")


# --- sources, parsing, typing -----------------------------------------------

@query
def scan_events(spark, sf):
    return fx.table(spark, sf, "events")


@query
def rider_preferences_snapshot(spark, sf):
    return prefs(spark, sf)


QUERIES["rider_preferences"] = QUERIES.pop("rider_preferences_snapshot")


@query
def parse_rail_events(spark, sf):
    bronze = rail_bronze(spark, sf).drop("raw_json")
    flat = bronze.withColumns({"header_source": F.col("header")["source"], "header_type": F.col("header")["msg_type"]})
    return fx.plain(flat.drop("header"))


@query
def json_map(spark, sf):
    return rail_bronze(spark, sf).select("event_key", F.explode("header").alias("name", "content"))


@query
def parse_weather_events(spark, sf):
    return fx.plain(weather_bronze(spark, sf).drop("raw_json"))


@query
def parse_forecast_events(spark, sf):
    return fx.plain(forecast_bronze(spark, sf).drop("raw_json"))


@query
def json_extract(spark, sf):
    return fx.table(spark, sf, "events").select("event_id", fx.k_of().alias("k"))


@query
def epoch_to_timestamp(spark, sf):
    instant = F.col("ts").cast("timestamp")
    return fx.plain(
        fx.table(spark, sf, "events").select(
            "event_id",
            casts.from_epoch_millis(F.unix_millis(instant).cast("string")).alias("from_millis"),
            casts.from_epoch_seconds(F.unix_seconds(instant).cast("string")).alias("from_seconds"),
        )
    )


@query
def parse_timestamp(spark, sf):
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return fx.plain(fx.table(spark, sf, "events").select("event_id", casts.wall_clock(text).alias("parsed")))


@query
def conform_schema(spark, sf):
    wanted = {
        "event_id": "string", "user_id": "int", "value": "int", "event_date": "date",
        "event_type": "string", "props": "double", "missing": "string",
    }
    return conform(fx.table(spark, sf, "events").withColumn("event_date", F.col("ts")), wanted)


@query
def typed_casts(spark, sf):
    b = rail_bronze(spark, sf)
    flags = ["correction_ind", "offroute_ind", "train_terminated", "delay_monitoring_point"]
    numbers = ["timetable_variation", "next_report_run_time", "toc_id"]
    return b.select(
        "event_key",
        *[casts.as_bool(F.col(c)).alias(c) for c in flags],
        *[casts.as_int(F.col(c)).alias(c) for c in numbers],
    )


@query
def clean_not_null(spark, sf):
    kept = clean.require(weather_bronze(spark, sf), "city_name", "weather_timestamp", "wind_gust")
    return kept.select("event_key", "city_name", "wind_gust")


@query
def dedupe_keys(spark, sf):
    item = fx.table(spark, sf, "lineitem")
    keep = ["l_orderkey", "l_linenumber"]
    return clean.dedupe(item, keep, clean.newest("l_shipdate")).select(keep)


@query
def dedupe_latest(spark, sf):
    item = fx.table(spark, sf, "lineitem")
    keep = ["l_orderkey", "l_linenumber"]
    rest = [c for c in item.columns if c not in (*keep, "l_shipdate")]
    return clean.dedupe(item, keep, clean.newest("l_shipdate", *rest))


@query
def surrogate_key(spark, sf):
    bronze = rail_bronze(spark, sf)
    keyed = keys.add_key(bronze, "event_id", ["train_id", "actual_timestamp", "loc_stanox"])
    return keyed.select("event_key", "event_id")


@query
def unique_surrogate_key(spark, sf):
    """Parts with separators and backslashes in them, and unknown ones."""
    parts = fx.table(spark, sf, "events").select(
        "event_id",
        "ts",
        F.concat("event_type", F.when(F.col("user_id") % 2 == 0, "_").otherwise("\\")).alias("kind"),
        F.when(F.col("value") > 20, F.col("user_id")).alias("rider"),
    )
    return parts.select("event_id", keys.unique_key(["kind", "ts", "rider"], dict(parts.dtypes)).alias("id"))


# --- lookups and silver -----------------------------------------------------

@query
def broadcast_left_lookup(spark, sf):
    take = {"current_station_name": "FULL_NAME", "route": "Route_Description"}
    found = lookup(rail_bronze(spark, sf), fx.stations(spark, sf), "loc_stanox", "STANOX_NO", take)
    return found.select("event_key", "loc_stanox", *take)


@query
def role_playing_lookup(spark, sf):
    places = fx.stations(spark, sf)
    here = lookup(
        rail_bronze(spark, sf), places, "loc_stanox", "STANOX_NO", {"current_station_name": "FULL_NAME"}
    )
    both = lookup(here, places, "next_report_stanox", "STANOX_NO", {"next_station_name": "FULL_NAME"})
    return both.select("event_key", "current_station_name", "next_station_name")


@query
def silver_train_events(spark, sf):
    return fx.plain(rail_silver(spark, sf))


@query
def silver_weather_current(spark, sf):
    return fx.plain(silver.weather_current(weather_bronze(spark, sf)))


@query
def silver_weather_forecast(spark, sf):
    return fx.plain(silver.weather_forecast(forecast_bronze(spark, sf)))


# --- features ---------------------------------------------------------------

@query
def calendar_features(spark, sf):
    return calendar.add_calendar(fx.table(spark, sf, "events").select("event_id", "ts"), "ts")


@query
def disruption_flags(spark, sf):
    events = fx.table(spark, sf, "events").select(
        "event_id", F.floor("value").cast("int").alias("delay_minutes"), fx.status().alias("variation_status")
    )
    return calendar.add_disruption_flags(events)


@query
def weather_severity(spark, sf):
    events = fx.table(spark, sf, "events").select(
        "event_id", fx.word(fx.k_of()).alias("now"), fx.word(F.floor("value").cast("int")).alias("later")
    )
    return events.select(
        "event_id",
        weather.severity(F.col("now")).alias("severity_now"),
        weather.severity(F.col("later")).alias("severity_later"),
        weather.is_disruptive(F.col("now")).alias("disruptive"),
        weather.trend(F.col("now"), F.col("later")).alias("trend"),
    )


# --- joins on time ----------------------------------------------------------

def _positions(spark, sf):
    return fx.city_events(spark, sf, fx.STATUS).select(
        "event_id", "city_name", F.date_trunc("second", "ts").alias("actual_timestamp")
    )


def _readings(spark, sf, kind="view", ts="weather_timestamp"):
    return fx.city_events(spark, sf, [kind]).select(
        "city_name", F.date_trunc("second", "ts").alias(ts), F.col("value").alias("temperature")
    )


def _backward(spark, sf, **how):
    return fx.plain(
        temporal.asof_join(
            _positions(spark, sf), _readings(spark, sf), ["city_name"], "actual_timestamp", "weather_timestamp",
            gold.WEATHER_REACH, tie_order=[F.col("temperature").desc()], **how,
        )
    )


def _forward(spark, sf, **how):
    return fx.plain(
        temporal.asof_join(
            _positions(spark, sf), _readings(spark, sf, "click", "forecast_timestamp"), ["city_name"],
            "actual_timestamp", "forecast_timestamp", gold.FORECAST_REACH, direction="forward",
            tie_order=[F.col("temperature").desc()], **how,
        )
    )


@query
def interval_join(spark, sf):
    """Wall-clock times from the start, since there are far more pairs than rows."""
    return temporal.interval_join(
        fx.plain(_positions(spark, sf)), fx.plain(_readings(spark, sf)), ["city_name"], "actual_timestamp", "weather_timestamp",
        before=gold.WEATHER_REACH,
    )


@query
def asof_backward(spark, sf):
    return _backward(spark, sf, sub_second=False)


@query
def asof_forward(spark, sf):
    return _forward(spark, sf, sub_second=False)


@query
def asof_backward_range(spark, sf):
    """The same partners by the path that is safe for any instants."""
    return _backward(spark, sf)


@query
def asof_forward_range(spark, sf):
    return _forward(spark, sf)


def _by_kind(spark, sf, kinds, ts, value):
    events = fx.table(spark, sf, "events").where(F.col("event_type").isin(*kinds))
    return events.select("event_id", F.col("user_id").alias("rider"), F.col("ts").alias(ts), F.col("value").alias(value))


@query
def asof_backward_fill(spark, sf):
    """Sub-second instants: every movement with its rider's last view of the day before."""
    moves = _by_kind(spark, sf, fx.STATUS, "ts", "amount")
    views = _by_kind(spark, sf, ["view"], "view_ts", "view_amount").drop("event_id")
    return temporal.asof_join(
        moves, views, ["rider"], "ts", "view_ts", timedelta(days=1),
        tie_order=[F.col("view_amount").desc()], sub_second=True,
    )


@query
def asof_forward_fill(spark, sf):
    """Sub-second instants: every movement with its rider's next click within six hours."""
    moves = _by_kind(spark, sf, fx.STATUS, "ts", "amount")
    clicks = _by_kind(spark, sf, ["click"], "click_ts", "click_amount").drop("event_id")
    return temporal.asof_join(
        moves, clicks, ["rider"], "ts", "click_ts", timedelta(hours=6), direction="forward",
        tie_order=[F.col("click_amount").desc()], sub_second=True,
    )


@query
def top1_latest(spark, sf):
    return clean.dedupe(fx.table(spark, sf, "events"), ["user_id", "event_type"], clean.newest("ts", "event_id"))


@query
def top1_earliest(spark, sf):
    order = [F.col("ts").asc(), F.col("event_id").asc()]
    return clean.dedupe(fx.table(spark, sf, "events"), ["user_id", "event_type"], order)


@query
def gold_weather_train(spark, sf):
    return fx.plain(gold.with_current_weather(*silver_layer(spark, sf, "rail", "weather")))


@query
def gold_forecast_train(spark, sf):
    return fx.plain(gold.with_forecast(*silver_layer(spark, sf, "rail", "forecast")))


# --- reliability ------------------------------------------------------------

@query
def train_daily_status_station(spark, sf):
    return reliability.train_daily_status(fx.movement_history(spark, sf), gold.STATION_DIMS)


@query
def train_daily_status_route(spark, sf):
    return reliability.train_daily_status(fx.movement_history(spark, sf), gold.ROUTE_DIMS)


@query
def station_reliability(spark, sf):
    return fx.plain(gold.station_reliability(fx.movement_history(spark, sf)))


@query
def route_reliability(spark, sf):
    return fx.plain(gold.route_reliability(fx.movement_history(spark, sf)))


@query
def route_reliability_signed(spark, sf):
    return fx.plain(gold.route_reliability(fx.movement_history(spark, sf), on_time_rule="signed"))


def _merged_sets(spark, sf, dims, **options):
    """Movements in two deliveries, the second of late ones; each is summed up by itself."""
    moves = fx.movement_history(spark, sf)
    later = F.col("delay_minutes") >= 40
    first, second = (train_sets.train_sets(moves.where(w), dims) for w in (~later | later.isNull(), later))
    return train_sets.metrics_of_sets(train_sets.merge_sets(first, second), dims, **options)


@query
def station_reliability_merged(spark, sf):
    return _merged_sets(spark, sf, gold.STATION_DIMS)


@query
def route_reliability_merged(spark, sf):
    return _merged_sets(spark, sf, gold.ROUTE_DIMS)


@query
def route_reliability_merged_signed(spark, sf):
    return _merged_sets(spark, sf, gold.ROUTE_DIMS, on_time_rule="signed")


# --- upserts ----------------------------------------------------------------

@query
def upsert_single_key(spark, sf):
    orders = fx.table(spark, sf, "orders")
    target = orders.where("o_orderstatus <> 'O'")
    source = orders.where("o_orderstatus <> 'F'").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    return upsert(target, source, ["o_orderkey"], preserve=["o_orderpriority"])


@query
def upsert_out_of_order(spark, sf):
    """Corrections of some days earlier or later than what they correct; older ones change nothing."""
    orders = fx.table(spark, sf, "orders")
    shift = (F.col("o_orderkey") % 5 - 2).cast("int")
    late = orders.where("o_orderkey % 3 > 0").withColumns({"o_orderdate": F.col("o_orderdate") + F.make_dt_interval(shift), "o_totalprice": F.col("o_totalprice") + 1})
    return upsert(orders.where("o_orderkey % 7 > 0"), conform(late, dict(orders.dtypes)), ["o_orderkey"], newer_by="o_orderdate")


@query
def upsert_by_time(spark, sf):
    """Corrections of open and pending orders, earlier or later than the finished and open ones they meet: every order is on a side."""
    orders = fx.table(spark, sf, "orders")
    shift = (F.col("o_custkey") % 5 - 2).cast("int")
    late = orders.where("o_orderstatus <> 'F'").withColumns({"o_orderdate": F.col("o_orderdate") + F.make_dt_interval(shift), "o_totalprice": F.col("o_totalprice") + 1})
    return upsert(orders.where("o_orderstatus <> 'P'"), conform(late, dict(orders.dtypes)), ["o_orderkey"], newer_by="o_orderdate")


@query
def upsert_composite_key(spark, sf):
    """The third key part is unknown for undiscounted items."""
    item = fx.table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_discount") > 0, F.col("l_shipdate")).alias("shipped"),
        "l_quantity",
        "l_returnflag",
    )
    key = ["l_orderkey", "l_linenumber", "shipped"]
    target = clean.dedupe(item.where("l_returnflag <> 'N'"), key, clean.newest("l_quantity", "l_returnflag"))
    source = clean.dedupe(item.where("l_returnflag <> 'A'"), key, clean.newest("l_quantity", "l_returnflag"))
    return upsert(target, source.withColumn("l_quantity", F.col("l_quantity") + 100), key)


@query
def mark_notified(spark, sf):
    """Alerts of finished orders were sent; now those of open orders are, too."""
    opened = fx.table(spark, sf, "orders").where("o_orderstatus = 'O'")
    done = opened.select(F.col("o_orderkey").cast("string").alias("event_id"))
    at = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    return operators.mark_notified(fx.simple_alerts(spark, sf), done, at).drop("next_station")


# --- alerts and riders ------------------------------------------------------

@query
def alert_context(spark, sf):
    return fx.plain(alerts(spark, sf))


@query
def pending_alerts(spark, sf):
    waiting = riders.pending(fx.simple_alerts(spark, sf), fx.sent_events(spark, sf), as_of(), PENDING_DAYS)
    return waiting.select("event_id", "event_date", "delay_minutes")


@query
def match_riders(spark, sf):
    return riders.match_riders(fx.simple_alerts(spark, sf), prefs(spark, sf))


@query
def match_riders_udtf(spark, sf):
    prefs(spark, sf).createOrReplaceTempView("linewatch_prefs")
    sql.create_matching_preferences(spark, "linewatch_prefs", "linewatch_matching_preferences", temporary=True)
    return spark.sql(
        "SELECT * FROM linewatch_matching_preferences('line 3', 'Supplier#000000010 ', 20, true, false)"
    )


@query
def alert_history(spark, sf):
    every = fx.simple_alerts(spark, sf)
    return riders.alert_history(every, every).drop("next_station")


@query
def alert_history_udtf(spark, sf):
    every = fx.simple_alerts(spark, sf)
    every.withColumn("notified_at", F.col("notified_at").cast("timestamp")).createOrReplaceTempView("linewatch_alerts")
    sql.create_alert_history(spark, "linewatch_alerts", "linewatch_alert_history", temporary=True)
    found = spark.sql("SELECT * FROM linewatch_alert_history('Line 2', 'Supplier#000000001', DATE'2024-01-20', 7)")
    return fx.plain(found.drop("next_station"))


@query
def alert_prompt(spark, sf):
    return alerts(spark, sf).select("event_id", texts.prompt_text(texts.SUMMARY_FIELDS).alias("prompt"))


@query
def draft_notifications(spark, sf):
    return delivery.draft_notifications(staged(alerts(spark, sf)), prefs(spark, sf))


@query
def extract_drafts(spark, sf):
    return delivery.extract_drafts(fx.traces(spark, sf))


def _simple_outbox(spark, sf):
    matched = riders.match_riders(fx.simple_alerts(spark, sf), prefs(spark, sf))
    texted = matched.withColumns({"subject": F.lit("s"), "message": F.col("route")})
    return delivery.outbox_rows(texted)


@query
def outbox_rows(spark, sf):
    return fx.plain(_simple_outbox(spark, sf))


def _sent_alerts(spark, sf):
    """Alerts of the whole pipeline; those at noon and later were sent."""
    marked = F.when(F.hour("actual_timestamp") >= 12, "SENT")
    return staged(alerts(spark, sf).withColumn("notification_status", marked))


@query
def dispatch_outbox(spark, sf):
    every = _sent_alerts(spark, sf)
    cursor = every.where("notification_status = 'SENT'").select("event_id")
    outbox, _ = dispatch.dispatch(every, prefs(spark, sf), cursor, as_of(), PENDING_DAYS)
    return fx.plain(outbox)


@query
def cursor_append(spark, sf):
    """The cursor after a run: what it held and what was pending."""
    cursor = fx.sent_events(spark, sf)
    waiting = riders.pending(fx.simple_alerts(spark, sf), cursor, as_of(), PENDING_DAYS)
    return cursor.unionByName(fx.plain(delivery.cursor_rows(waiting)))


def _simple_tries(spark, sf):
    """The outbox's ids with their riders' segments, which join the riders before these become many matches."""
    customer = fx.table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("user_id"), "c_mktsegment")
    known = prefs(spark, sf).join(customer, "user_id")
    matched = riders.match_riders(fx.simple_alerts(spark, sf), known, of_rider=["c_mktsegment"])
    return matched.select(delivery.notification_id().alias("notification_id"), "c_mktsegment")


def _simple_log(spark, sf, **how):
    """Riders in furniture report nothing, those in automobile report a failure."""
    results = _simple_tries(spark, sf).where("c_mktsegment <> 'FURNITURE'").select(
        "notification_id", (F.col("c_mktsegment") != "AUTOMOBILE").alias("delivered")
    )
    return delivery.delivery_log(_simple_outbox(spark, sf), results, **how)


@query
def delivery_log(spark, sf):
    return fx.plain(_simple_log(spark, sf))


@query
def delivery_partial(spark, sf):
    """Only what has a result is logged; the rest waits for its own."""
    return fx.plain(_simple_log(spark, sf, missing_fails=False))


@query
def delivery_outcomes(spark, sf):
    """Three deliveries of results that contradict each other, folded and logged."""
    at = lambda day: F.lit(f"2024-02-0{day} 00:00:00").cast("timestamp_ntz").alias("attempted_at")
    segment = F.col("c_mktsegment")
    first = F.struct((segment == "BUILDING").alias("delivered"), at(1))
    second = F.when(segment != "FURNITURE", F.struct((segment == "MACHINERY").alias("delivered"), at(3)))
    third = F.when(segment == "HOUSEHOLD", F.struct(F.lit(None).cast("boolean").alias("delivered"), at(2)))
    tries = F.inline(F.array_compact(F.array(third, second, first)))
    return delivery.outcomes(_simple_tries(spark, sf).select("notification_id", tries))


@query
def delivery_summary(spark, sf):
    return delivery.delivery_summary(_simple_log(spark, sf))


# --- web events -------------------------------------------------------------

@query
def tumbling_event_counts(spark, sf):
    events = fx.table(spark, sf, "events").select(
        F.col("ts").alias("event_time"), F.col("event_type").alias("host"), F.col("user_id").alias("ip")
    )
    return windows.tumbling_counts(events, width="1 hour")


@query
def tumbling_event_counts_stream(spark, sf):
    """The same from a stream of the events, for the windows that its watermark closes."""
    schema = fx.table(spark, sf, "events").schema
    # a pattern, since a stream takes no path of a single file
    events = spark.readStream.schema(schema).parquet(f"{sf}/events.parque[t]").select(
        F.col("ts").cast("timestamp").alias("event_time"), F.col("event_type").alias("host"), F.col("user_id").alias("ip")
    )
    return fx.plain(drained(windows.tumbling_counts(events, width="1 hour", watermark="2 hours")))


@query
def geo_enrich(spark, sf):
    customer = fx.table(spark, sf, "customer")
    geo = customer.join(fx.regions(spark, sf), customer.c_nationkey == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("ip"),
        F.col("n_name").alias("country"),
        F.col("r_name").alias("region"),
        F.col("c_mktsegment").alias("city"),
        F.col("c_acctbal").cast("string").alias("latitude"),
        F.col("c_nationkey").cast("string").alias("longitude"),
    )
    events = fx.table(spark, sf, "events").select("event_id", F.col("user_id").alias("ip"))
    return fx.plain(windows.geo_enrich(events, geo))


@query
def locate_by_range(spark, sf):
    """Ranges that nest and overlap: one for each customer, as wide as the balance, and one for each supplier's block."""
    customer, supplier = fx.table(spark, sf, "customer"), fx.table(spark, sf, "supplier")
    own = customer.select(
        F.col("c_custkey").alias("range_start"),
        (F.col("c_custkey") + F.floor(F.col("c_acctbal") / 100)).alias("range_end"),
        F.col("c_name").alias("holder"),
        F.col("c_mktsegment").alias("kind"),
    )
    blocks = supplier.select(
        (F.col("s_suppkey") * 64).alias("range_start"), (F.col("s_suppkey") * 64 + 63).alias("range_end"), F.col("s_name").alias("holder"), F.lit(None).cast("string").alias("kind")
    )
    events = fx.table(spark, sf, "events").select("event_id", (F.col("user_id") * 40 + F.floor("value")).alias("address"))
    return ranges.locate(events, own.unionByName(blocks), "address", ["holder", "kind"])
