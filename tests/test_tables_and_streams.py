import json
import os
import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from linewatch.operators.windows import geo_enrich, tumbling_counts
from linewatch.plans import jobs
from linewatch.plans.jobs import Layout
from linewatch.operators.delivery import DispatchFailed
from linewatch.schemas import KEYS, PARTITIONS, TABLES
from linewatch.sinks.tables import (
    append_table, create_table, ensure_database, merge_native, merge_table, partition_columns, replace_table,
)
from linewatch.sources.topics import read_topic
from linewatch.streaming.ingest import append_stream, dedupe_stream, drained, upsert_stream
from linewatch.streaming.parse import parse_rail

SCHEMA = {"k": "string", "v": "int", "mark": "string", "day": "date"}
D1, D2, D3 = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)


@pytest.fixture
def db(spark, request):
    name = f"t_{abs(hash(request.node.name))}"
    ensure_database(spark, name)
    ensure_database(spark, name)
    return name


def put(spark, name, *rows):
    return spark.createDataFrame(list(rows), "k string, v int, mark string, day date"), f"{name}.t"


def content(spark, table):
    return sorted(tuple(r) for r in spark.table(table).select("k", "v", "mark", "day").collect())


def test_every_table_can_be_declared(spark, db):
    for name, schema in TABLES.items():
        create_table(spark, f"{db}.{name}", schema, PARTITIONS.get(name, ()))
        create_table(spark, f"{db}.{name}", schema, PARTITIONS.get(name, ()))
        assert sorted(spark.table(f"{db}.{name}").dtypes) == sorted(schema.items())
        assert partition_columns(spark, f"{db}.{name}") == PARTITIONS.get(name, [])
    assert all(set(KEYS[t]) <= set(TABLES[t]) for t in KEYS)


@pytest.mark.parametrize("parts", [[], ["day"]])
def test_merge_is_repeatable(spark, db, parts):
    create_table(spark, f"{db}.t", SCHEMA, parts)
    first, table = put(spark, db, ("a", 1, "SENT", D1), ("b", 1, "x", D2), (None, 1, "x", D1))
    append_table(first.select("day", "v", "mark", "k"), table)
    second, _ = put(spark, db, ("a", 2, None, D1), ("c", 2, None, D3), (None, 2, None, D1))
    for _ in range(2):
        merge_table(second, table, ["k"], preserve=["mark"])
        assert sorted(map(str, content_unsorted(spark, table))) == sorted(
            map(str, [("a", 2, "SENT", D1), ("b", 1, "x", D2), ("c", 2, None, D3), (None, 2, "x", D1)])
        )


def content_unsorted(spark, table):
    return [tuple(r) for r in spark.table(table).select("k", "v", "mark", "day").collect()]


def test_merge_leaves_other_partitions_alone(spark, db):
    create_table(spark, f"{db}.t", SCHEMA, ["day"])
    first, table = put(spark, db, ("a", 1, "x", D1), ("b", 1, "x", D2))
    append_table(first, table)
    files = {f for f in spark.table(table).where(F.col("day") == F.lit(D2)).inputFiles()}
    merge_table(put(spark, db, ("a", 2, "y", D1))[0], table, ["k"])
    assert {f for f in spark.table(table).where(F.col("day") == F.lit(D2)).inputFiles()} == files
    assert content(spark, table) == [("a", 2, "y", D1), ("b", 1, "x", D2)]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_merge_moves_a_row_to_its_new_partition(spark, db):
    create_table(spark, f"{db}.t", SCHEMA, ["day"])
    first, table = put(spark, db, ("a", 1, "x", D1), ("b", 1, "x", D2), ("c", 1, "x", D2))
    append_table(first, table)
    merge_table(put(spark, db, ("a", 2, "y", D3), ("b", 2, "y", D3))[0], table, ["k"], partition_is_stable=False)
    assert content(spark, table) == [("a", 2, "y", D3), ("b", 2, "y", D3), ("c", 1, "x", D2)]


def test_merge_of_nothing(spark, db):
    create_table(spark, f"{db}.t", SCHEMA, ["day"])
    first, table = put(spark, db, ("a", 1, "x", D1))
    append_table(first, table)
    merge_table(put(spark, db)[0], table, ["k"])
    assert content(spark, table) == [("a", 1, "x", D1)]


def test_replace_changes_the_schema(spark, db):
    df, table = put(spark, db, ("a", 1, "x", D1))
    replace_table(df, table, ["day"])
    replace_table(df.select("k", F.lit(1.5).alias("w")), table)
    assert spark.table(table).columns == ["k", "w"]


def test_native_merge_needs_a_format_that_has_it(spark, db):
    df, table = put(spark, db, ("a", 1, "x", D1))
    replace_table(df, table)
    with pytest.raises(Exception, match="MERGE"):
        merge_native(df, table, ["k"])


def topic_file(folder, name, *values):
    folder.mkdir(exist_ok=True)
    lines = [
        json.dumps({"key": str(i), "timestamp": t, "value": json.dumps({"raw_payload": v}) if not isinstance(v, str) else v})
        for i, (t, v) in enumerate(values)
    ]
    (folder / name).write_text("\n".join(lines))


def move(train, minute, station="00101", delay="20", status="LATE", **more):
    ms = int(datetime(2024, 1, 10, 8, minute).timestamp() * 1000)
    body = {
        "train_id": train, "actual_timestamp": str(ms), "planned_timestamp": str(ms - 60000), "loc_stanox": station,
        "event_type": "ARRIVAL", "timetable_variation": delay, "variation_status": status, "next_report_stanox": "102",
        "offroute_ind": "false", "train_terminated": "", **more,
    }
    return {"header": {"h": "1"}, "body": body}


def seconds(minute):
    return int(datetime(2024, 1, 10, 8, minute).timestamp())


def test_append_stream_goes_on_where_it_ended(spark, db, tmp_path):
    source, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")

    def drain():
        stream = read_topic(spark, {"maxFilesPerTrigger": "1"}, "json", path=str(source))
        append_stream(parse_rail(stream), mark, path=out).awaitTermination()
        return spark.read.parquet(out).count()

    topic_file(source, "1.json", ("2024-01-10T08:00:00Z", move("a", 1)), ("2024-01-10T08:00:00Z", "broken"))
    assert drain() == 2
    assert drain() == 2
    topic_file(source, "2.json", ("2024-01-10T08:05:00Z", move("b", 2)))
    topic_file(source, "3.json", ("2024-01-10T08:06:00Z", move("c", 3)))
    assert drain() == 4
    assert spark.read.parquet(out).where("train_id = 'b'").first().header == {"h": "1"}
    with pytest.raises(ValueError):
        append_stream(spark.readStream.format("rate").load(), mark)


def test_upsert_stream_takes_late_corrections(spark, db, tmp_path):
    create_table(spark, f"{db}.t", SCHEMA, ["day"])
    source = tmp_path / "in"
    source.mkdir()

    def drain(mark="mark"):
        stream = spark.readStream.schema("k string, v int, mark string, day date").json(str(source))
        upsert_stream(stream, str(tmp_path / mark), f"{db}.t", ["k"], ["v"]).awaitTermination()
        return content(spark, f"{db}.t")

    (source / "1.json").write_text('{"k":"a","v":1,"mark":"m","day":"2024-01-01"}\n{"k":"a","v":5,"mark":"m","day":"2024-01-01"}')
    assert drain() == [("a", 5, "m", D1)]
    (source / "2.json").write_text('{"k":"a","v":2,"mark":"late","day":"2024-01-01"}\n{"k":"b","v":1,"mark":"m","day":"2024-01-02"}')
    expected = [("a", 2, "late", D1), ("b", 1, "m", D2)]
    assert drain() == expected


def test_stream_dedupe_and_windows(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    lines = [("a", "2024-01-01T00:01:00Z", "1"), ("a", "2024-01-01T00:02:00Z", "2"), ("a", "2024-01-01T00:02:00Z", "2"),
             ("b", "2024-01-01T00:11:00Z", "1"), ("b", "2024-01-01T02:00:00Z", "1")]
    (source / "1.json").write_text("\n".join(json.dumps({"host": h, "event_time": t, "ip": i}) for h, t, i in lines))
    schema = "host string, event_time timestamp, ip string"

    def read():
        return spark.readStream.schema(schema).json(str(source))

    def drain(df, name):
        append_stream(df, str(tmp_path / f"{name}_mark"), path=str(tmp_path / name)).awaitTermination()
        return spark.read.schema(df.schema).parquet(str(tmp_path / name))

    counts = drain(tumbling_counts(read(), watermark="10 minutes"), "windows")
    batch = tumbling_counts(spark.read.schema(schema).json(str(source)))
    closed = sorted(tuple(r) for r in counts.collect())
    assert closed == sorted(tuple(r) for r in batch.where("window_start < timestamp'2024-01-01 01:00:00Z'").collect())
    assert [(r[2], r[3], r[4]) for r in closed] == [("a", 3, 2), ("b", 1, 1)]
    assert drain(dedupe_stream(read(), ["host", "ip", "event_time"], "event_time", "1 hour"), "dedupe").count() == 4
    with pytest.raises(ValueError):
        tumbling_counts(read())
    geo = spark.createDataFrame([("1", "UK", "Kent", "Dover", "51", "1")], "ip string, country string, region string, city string, latitude string, longitude string")
    placed = drain(geo_enrich(read(), geo), "geo")
    assert placed.count() == 5 and placed.where("city = 'Dover'").count() == 3


def test_streamed_unique_counts_equal_the_batch(spark, tmp_path):
    """Files in random order, late ones among them, unknown ips and hosts, one hot window."""
    rng = random.Random(7)
    source = tmp_path / "in"
    source.mkdir()
    schema = "host string, event_time timestamp, ip string"
    rows = [("hot", f"2024-01-01T03:{rng.randrange(20):02d}:00Z", str(rng.randrange(40))) for _ in range(400)]
    rows += [(rng.choice(["a", "b", None]), f"2024-01-01T0{rng.randrange(8)}:{rng.randrange(60):02d}:30.5Z", rng.choice(["1", "2", None])) for _ in range(600)]
    rng.shuffle(rows)
    for i in range(5):
        (source / f"{i}.json").write_text("\n".join(json.dumps(dict(zip(("host", "event_time", "ip"), r))) for r in rows[i::5]))
    (source / "9.json").write_text(json.dumps({"host": "end", "event_time": "2024-01-02T12:00:00Z", "ip": "1"}))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(source))
    counted = tumbling_counts(stream, watermark="12 hours")
    batch = tumbling_counts(spark.read.schema(schema).json(str(source))).where("host <> 'end' OR host IS NULL")

    def plain(df):
        return sorted(map(str, df.collect()))

    assert plain(drained(counted)) == plain(batch)
    exact = {}
    for host, at, ip in rows:
        exact.setdefault((host, at[:15]), []).append(ip)
    want = sorted(map(str, [(host, len(ips), len(set(ips) - {None})) for (host, _), ips in exact.items()]))
    assert sorted(map(str, map(tuple, batch.select("host", "event_count", "unique_ips").collect()))) == want
    plan = counted._jdf.queryExecution().toString()
    assert "approx" not in plan and plan.count("Aggregate [") >= 2


def weather(city, minute, sky):
    return {"name": city, "dt": seconds(minute), "main": {"temp": 1.0}, "weather": [{"description": sky}], "wind": {"deg": 5}}


def forecast(city, minute, sky):
    return {"city": {"name": city}, "forecast": {"dt": seconds(minute), "weather": [{"description": sky}]}}


def test_the_whole_line(spark, db, tmp_path):
    """Topics to notifications, twice: a second run changes nothing but what is new."""
    lookups = tmp_path / "lookup"
    lookups.mkdir()
    (lookups / "station_codes.csv").write_text(
        "STANOX_NO,FULL_NAME,Route_Description\n101,Dover,Kent\n102,Deal,Kent\n103,Lost,Nowhere\n"
    )
    (lookups / "mapping.csv").write_text("Route,City\nKent,Canterbury\n")
    at = Layout(db, str(lookups), str(tmp_path / "marks"))
    jobs.create_tables(spark, at)
    t = "2024-01-10T08:00:00Z"
    topic_file(
        tmp_path / "rail", "1.json",
        (t, move("late", 30)), (t, move("late", 30)), (t, move("small", 31, delay="3")),
        (t, move("gone", 32, "102", "0", "CANCELLED")), (t, move("lost", 33, "103")), (t, move("x", 34, "999")),
        (t, {"body": {"train_id": "t", "loc_stanox": "101", "variation_status": "CANCELLED"}}),
    )
    topic_file(tmp_path / "weather", "1.json", (t, weather("Canterbury", 0, "heavy rain")), (t, weather("Canterbury", 31, "fog")))
    topic_file(tmp_path / "forecast", "1.json", (t, forecast("Canterbury", 40, "light rain")), (t, forecast("Canterbury", 50, "fog")))

    def topics():
        return {
            f"{n}_bronze": read_topic(spark, {}, "json", path=str(tmp_path / n)) for n in ("rail", "weather", "forecast")
        }

    prefs = spark.createDataFrame(
        [("u1", "u1@x", "kent", None, 5, True, True, True), ("u2", "u2@x", None, "Deal", 5, True, True, True)],
        "user_id string, email string, route string, station string, delay_threshold_minute int, "
        "notify_delay boolean, notify_cancellation boolean, is_active boolean",
    )
    as_of = F.lit(date(2024, 1, 10))

    def run(again=False):
        jobs.run_bronze(spark, at, topics())
        if again:
            jobs.stream_silver(spark, at)
            jobs.run_gold(spark, at, since=date(2024, 1, 10))
        else:
            jobs.run_silver(spark, at)
            jobs.run_gold(spark, at)
        jobs.run_riders(spark, at, prefs)
        jobs.run_dispatch(spark, at, as_of)

    def ids(table, *cols):
        return sorted(tuple(r) for r in spark.table(f"{db}.{table}").select(*cols).collect())

    for again in (False, True):
        run(again)
        assert spark.table(f"{db}.rail_bronze").count() == 7
        assert spark.table(f"{db}.rail_silver").count() == 4  # the unknown time counts once
        weathered = {r.train_id: r for r in spark.table(f"{db}.gold_weather_train").collect()}
        assert weathered["late"].current_weather_description == "heavy rain"
        assert weathered["gone"].current_weather_description == "fog"
        assert weathered["t"].current_weather_description is None
        alerts = {r.train_id: r for r in spark.table(f"{db}.alerts").collect()}
        assert set(alerts) == {"late", "gone", "t"}
        assert alerts["late"].forecast_weather_description == "light rain"
        assert (alerts["late"].route_scheduled_trains, alerts["late"].route_on_time_trains) == (3, 1)
        assert alerts["late"].next_station == "Deal"
        outbox = ids("dispatch_outbox", "event_id", "user_id")
        assert [u for _, u in outbox] == ["u1", "u2", "u1"]
        assert len(ids("dispatch_cursor", "event_id")) == 2  # the alert without a date is never recent

    texts = {r.event_id: r.message for r in spark.table(f"{db}.dispatch_outbox").collect()}
    assert any("linked to heavy rain in the area; conditions are expected to ease" in m for m in texts.values())
    results = spark.table(f"{db}.dispatch_outbox").select("notification_id", (F.col("user_id") == "u1").alias("delivered"))
    first = spark.createDataFrame(results.where("delivered").orderBy("notification_id").limit(1).collect(), results.schema)
    jobs.record_deliveries(spark, at, first)  # results come in parts: one alert or none is complete
    assert ids("delivery_log", "delivery_status") == [("SENT",)]
    assert None in {r.notification_status for r in spark.table(f"{db}.alerts").where("train_id <> 't'").collect()}
    with pytest.raises(DispatchFailed):
        jobs.record_deliveries(spark, at, results)
    marks = {r.train_id: r.notification_status for r in spark.table(f"{db}.alerts").collect()}
    assert marks == {"late": "SENT", "gone": "SENT", "t": None}
    run()  # a gold rerun keeps the marks
    assert {r.train_id: r.notification_status for r in spark.table(f"{db}.alerts").collect()} == marks
    assert ids("delivery_log", "delivery_status") == [("FAILED",), ("SENT",), ("SENT",)]
    spark.sql(f"USE {db}")  # table functions are called without a database name
    try:
        found = spark.sql("SELECT * FROM get_alert_history('Kent', 'Dover', DATE'2024-01-11', 7)")
        assert found.count() == 2
        assert spark.sql("SELECT * FROM get_matching_preferences('Kent ', 'x', 9, true, false)").count() == 1
    finally:
        spark.sql("USE default")


def test_staged_frames_go_and_local_folders_are_refused_on_a_cluster(spark, monkeypatch):
    from types import SimpleNamespace

    from linewatch import session

    frame = session.staged(spark.range(5))
    path = frame.inputFiles()[0].removeprefix("file:").removeprefix("//")
    assert os.path.exists(path) and frame.count() == 5
    monkeypatch.setattr(session, "_STAGED", session._STAGED[-1:])
    session.drop_staged(spark)
    assert not os.path.exists(path)

    context = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: {}, master="spark://host:7077", setCheckpointDir=lambda d: None)
    elsewhere = SimpleNamespace(
        sparkContext=context, _jvm=spark._jvm, _jsc=spark._jsc,
        conf=SimpleNamespace(get=lambda key, default=None: "file:/tmp/warehouse" if key == "spark.sql.warehouse.dir" else default),
    )
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(elsewhere)
    context.master = "local[4]"
    session.ensure_checkpoint_dir(elsewhere)
