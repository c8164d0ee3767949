"""The supplied tables seen as rail data.

``events`` plays the three topics: ``view`` rows are weather observations,
``click`` rows are forecasts, all others are train movements. ``supplier`` plays
the stations (four to a line), ``nation`` and ``region`` place them in cities and
``customer`` plays the riders. ``lineitem`` is a year-grained movement history for
the metrics, ``orders`` says which alerts were already sent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WEATHER_WORDS = [
    "clear sky", "few clouds", "scattered clouds", "broken clouds", "overcast clouds", "mist",
    "fog", "light rain", "moderate rain", "heavy snow", "thunderstorm", "high wind",
    "light wind", "wind", "cold", "mild cold", "heat haze", "light winds, sunny", "extreme heat", "extreme cold",
    "icy roads", "heavy rain", "light snow", "drizzle", "sleet", "freezing rain", "hail", "tropical storm",
    "dense fog", "warm", "breezy", "high winds and rain", "overcast, light drizzle",
]
STATUS = {"error": "LATE", "purchase": "EARLY", "signup": "CANCELLED"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain(df: DataFrame) -> DataFrame:
    """Without run-time stamps, and with wall-clock times, so that runs compare."""
    stamps = ("ingest_timestamp", "ingest_time", "recorded_at", "dispatched_at", "created_at", "enriched_at")
    return df.select(
        *[
            F.col(c).cast("timestamp_ntz").alias(c) if t == "timestamp" else F.col(c)
            for c, t in df.dtypes
            if c not in stamps
        ]
    )


def k_of(props: str = "props") -> Column:
    return F.get_json_object(props, "$.k").cast("int")


def word(index: Column) -> Column:
    words = F.array(*[F.lit(w) for w in WEATHER_WORDS])
    return F.element_at(words, (index % len(WEATHER_WORDS) + 1).cast("int"))


def status() -> Column:
    first, *others = STATUS.items()
    out = F.when(F.col("event_type") == first[0], first[1])
    for kind, label in others:
        out = out.when(F.col("event_type") == kind, label)
    return out


def line(number: Column) -> Column:
    return F.concat(F.lit("Line "), F.floor(number).cast("string"))


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "n_name", "r_name")


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.lpad(F.col("s_suppkey").cast("string"), 8, "0").alias("STANOX_NO"),
        F.col("s_name").alias("FULL_NAME"),
        line(F.col("s_suppkey") / 4).alias("Route_Description"),
    )


def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    placed = supplier.join(regions(spark, sf_dir), supplier.s_nationkey == F.col("n_nationkey"))
    return placed.groupBy(line(F.col("s_suppkey") / 4).alias("Route")).agg(
        F.min_by("r_name", "s_suppkey").alias("City")
    )


def _message(df: DataFrame, payload: Column) -> DataFrame:
    return df.select(
        F.col("event_id").cast("string").cast("binary").alias("key"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.to_json(F.struct(payload.alias("raw_payload"))).cast("binary").alias("value"),
    )


def rail_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").where(F.col("event_type").isin(*STATUS))
    instant = F.unix_millis(F.col("ts").cast("timestamp"))
    minutes = F.floor("value").cast("bigint")
    place = F.col("user_id").cast("string")
    planned = (instant - minutes * 60000).cast("string")
    body = {
        "train_id": k_of().cast("string"),
        "actual_timestamp": instant.cast("string"),
        "loc_stanox": place,
        "gbtt_timestamp": planned,
        "planned_timestamp": planned,
        "planned_event_type": F.lit("ARRIVAL"),
        "event_type": F.when(F.hour("ts") < 12, "ARRIVAL").otherwise("DEPARTURE"),
        "event_source": F.lit("AUTOMATIC"),
        "correction_ind": (F.col("value") > 100).cast("string"),
        "offroute_ind": (F.col("value") > 200).cast("string"),
        "train_service_code": F.concat(F.lit("S"), place),
        "division_code": F.lit("D"),
        "toc_id": place,
        "timetable_variation": minutes.cast("string"),
        "variation_status": status(),
        "next_report_stanox": minutes.cast("string"),
        "next_report_run_time": F.floor(F.col("value") / 10).cast("string"),
        "train_terminated": (F.col("event_type") == "signup").cast("string"),
        "delay_monitoring_point": F.when(F.col("value") < 50, "true").otherwise(""),
        "reporting_stanox": place,
    }
    header = F.struct(F.lit("events").alias("source"), F.col("event_type").alias("msg_type"))
    inner = F.struct(*[v.alias(c) for c, v in body.items()])
    return _message(events, F.struct(header.alias("header"), inner.alias("body")))


def city_events(spark: SparkSession, sf_dir: str, kinds) -> DataFrame:
    """Events of the given kinds with the city of their rider."""
    events = table(spark, sf_dir, "events").where(F.col("event_type").isin(*kinds))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return (
        events.join(customer, events.user_id == customer.c_custkey)
        .join(regions(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"))
        .withColumnRenamed("r_name", "city_name")
    )


def _weather_parts() -> dict[str, Column]:
    main = F.struct(
        F.col("value").alias("temp"),
        F.round(F.col("value") - 2, 2).alias("feels_like"),
        F.round(F.col("value") - 5, 2).alias("temp_min"),
        F.round(F.col("value") + 5, 2).alias("temp_max"),
        (F.col("k") + 950).alias("pressure"),
        F.col("k").alias("humidity"),
        (F.col("k") + 1000).alias("sea_level"),
        (F.col("k") + 900).alias("grnd_level"),
    )
    wind = F.struct(
        (F.floor("value") / 10).alias("speed"),
        (F.col("k") * 3).alias("deg"),
        F.when(F.col("value") < 100, F.floor("value") / 4).alias("gust"),
    )
    return {"main": main, "wind": wind}


def weather_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _weather_parts()
    sky = F.array(F.struct(word(F.col("k")).alias("description")))
    payload = F.struct(
        F.col("city_name").alias("name"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("dt"),
        parts["main"].alias("main"),
        sky.alias("weather"),
        parts["wind"].alias("wind"),
    )
    return _message(city_events(spark, sf_dir, ["view"]).withColumn("k", k_of()), payload)


def forecast_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _weather_parts()
    sky = F.array(F.struct(word(F.floor("value").cast("int")).alias("description")))
    payload = F.struct(
        F.struct(F.col("city_name").alias("name")).alias("city"),
        F.struct(
            F.unix_seconds(F.col("ts").cast("timestamp")).alias("dt"),
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("dt_txt"),
            parts["main"].alias("main"),
            sky.alias("weather"),
            parts["wind"].alias("wind"),
            (F.col("k") * 100).alias("visibility"),
            F.round(F.col("k") / 100, 2).alias("pop"),
        ).alias("forecast"),
    )
    return _message(city_events(spark, sf_dir, ["click"]).withColumn("k", k_of()), payload)


def riders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Preferences: names in another case and with blanks, some without a station."""
    customer, supplier = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    near = supplier.select(F.col("s_suppkey").alias("_near"), "s_name")
    return customer.join(near, F.floor(F.col("c_acctbal") / 100) == F.col("_near"), "left").select(
        F.col("c_custkey").alias("user_id"),
        F.concat(F.lower(F.regexp_replace("c_name", "#", ".")), F.lit("@example.com")).alias("email"),
        F.concat(F.lit(" LINE "), F.floor(F.col("c_custkey") / 60).cast("string"), F.lit("  ")).alias("route"),
        F.lower("s_name").alias("station"),
        F.floor(F.abs(F.col("c_acctbal")) / 200).cast("int").alias("delay_threshold_minute"),
        (F.col("c_mktsegment") != "BUILDING").alias("notify_delay"),
        (F.col("c_mktsegment") != "MACHINERY").alias("notify_cancellation"),
        (F.col("c_acctbal") > 0).alias("is_active"),
    )


def sent_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events already dispatched: those whose order is finished."""
    orders = table(spark, sf_dir, "orders")
    return orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").cast("string").alias("event_id"))


def simple_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late and cancelled events at known stations, with their delivery marks."""
    events = table(spark, sf_dir, "events").where(F.col("event_type").isin("error", "signup"))
    supplier = table(spark, sf_dir, "supplier")
    delay = F.floor("value").cast("int")
    late = F.col("event_type") == "error"
    sent = sent_events(spark, sf_dir).withColumnRenamed("event_id", "_sent")
    rows = events.join(supplier, events.user_id == supplier.s_suppkey).select(
        F.col("event_id").cast("string").alias("event_id"),
        line(F.col("s_suppkey") / 4).alias("route"),
        F.col("s_name").alias("current_station"),
        F.lit(None).cast("string").alias("next_station"),
        F.when(F.hour("ts") < 12, "ARRIVAL").otherwise("DEPARTURE").alias("event_type"),
        F.to_date("ts").alias("event_date"),
        delay.alias("delay_minutes"),
        (late & (delay > 5)).alias("is_delayed"),
        (late & (delay >= 15)).alias("is_major_delay"),
        (F.col("event_type") == "signup").alias("is_cancelled"),
        F.col("ts").alias("_ts"),
    )
    marked = F.col("_sent").isNotNull()
    return (
        rows.join(sent, rows.event_id == sent["_sent"], "left")
        .withColumn("notification_status", F.when(marked, "SENT"))
        .withColumn("notified_at", F.when(marked, F.col("_ts")))
        .drop("_sent", "_ts")
    )


def movement_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Movements by train, station, route and year, for the metrics."""
    item, supplier = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "supplier")
    placed = item.join(supplier, item.l_suppkey == supplier.s_suppkey).join(
        regions(spark, sf_dir), supplier.s_nationkey == F.col("n_nationkey")
    )
    return placed.select(
        F.col("l_partkey").alias("train_id"),
        F.col("s_name").alias("current_station_name"),
        F.col("n_name").alias("route"),
        F.col("l_linestatus").alias("event_type"),
        F.date_trunc("year", F.col("l_shipdate")).alias("actual_timestamp"),
        F.when(F.col("l_returnflag") == "R", "LATE")
        .when(F.col("l_returnflag") == "A", "EARLY")
        .alias("variation_status"),
        F.col("l_quantity").cast("int").alias("delay_minutes"),
    )


def traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recorded responses: one per order, each with an unrelated call and two drafts."""
    orders = table(spark, sf_dir, "orders")
    rider = F.col("o_custkey").cast("string")

    def draft(user: Column, email: Column | None) -> Column:
        return F.struct(
            user.alias("user_id"),
            *([] if email is None else [email.alias("email")]),
            F.col("o_orderpriority").alias("subject"),
            F.concat(F.lit('said "'), F.col("o_orderkey").cast("string"), F.lit('"')).alias("message"),
        )

    arguments = F.concat(
        F.lit('{"event_id":"'), rider, F.lit('","drafts":['),
        F.to_json(draft(rider, F.concat(rider, F.lit("@example.com")))), F.lit(","),
        F.to_json(draft(F.lit("second"), None)), F.lit("]}"),
    )
    call = lambda name, args: F.struct(F.lit(name).alias("name"), args.alias("arguments"))
    output = F.array(call("get_matching_preferences", F.lit("{}")), call("record_notifications", arguments))
    return orders.select(
        F.timestamp_add("SECOND", F.col("o_orderkey").cast("int"), F.col("o_orderdate").cast("timestamp")).alias("trace_ts"),
        F.to_json(F.struct(output.alias("output"))).alias("response"),
    )
