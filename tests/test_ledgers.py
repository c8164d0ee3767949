"""What later runs know of earlier ones: days, batches, deliveries, keys that cannot collide."""

from __future__ import annotations

import glob
import json
import os
from datetime import date, datetime
from itertools import permutations

import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame
from pyspark.sql.readwriter import DataFrameWriter
from test_tables_and_streams import forecast, move, topic_file, weather

from linewatch.functions import keys
from linewatch.functions import weather as wording
from linewatch.operators.delivery import DispatchFailed, outcomes
from linewatch.operators.riders import pending
from linewatch.plans import gold, jobs, silver
from linewatch.plans.jobs import Layout
from linewatch.schemas import KEYS, TABLES, conform
from linewatch.sinks import ledger
from linewatch.sinks.tables import append_table, create_table, ensure_database, merge_table
from linewatch.sources.topics import read_topic
from linewatch.streaming import ingest

D1, D2, D3 = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)
SCHEMA = {"k": "string", "v": "int", "day": "date"}


@pytest.fixture
def db(spark, request):
    name = f"l_{abs(hash(request.node.name))}"
    ensure_database(spark, name)
    return name


def plan_of(df):
    return df._jdf.queryExecution().toString()


# --- keys -------------------------------------------------------------------

def test_different_keys_look_different(table):
    parts = ["a", "a_b", "b", "_", "\\", "\\N", "\\_", "", None]
    rows = [(x, y) for x in parts for y in parts]
    df = table("a string, b string", *rows)
    ids = [r[0] for r in df.select(keys.unique_key(["a", "b"], dict(df.dtypes))).collect()]
    assert len(set(ids)) == len(rows) and None not in ids


def test_ordinary_keys_read_as_before(table):
    df = table("a string, t timestamp, c int", ("x", datetime(2024, 1, 2, 3, 4, 5), 9))
    assert keys.add_key(df, "id", ["a", "t", "c"]).select("id", keys.unique_key(["a", "t", "c"], dict(df.dtypes)).alias("u")).first()[:] == ("x_2024-01-02 03:04:05_9",) * 2
    df = table("t timestamp", (datetime(2024, 1, 2, 3, 4, 5, 120000),), (datetime(2024, 1, 2, 3, 4, 5, 7),), (datetime(2024, 1, 2, 3, 4, 50),), (None,))
    assert [r[0] for r in df.select(keys.unique_key(["t"], dict(df.dtypes))).collect()] == ["2024-01-02 03:04:05.12", "2024-01-02 03:04:05.000007", "2024-01-02 03:04:50", "\\N"]


def bronze_moves(table, *moves):
    schema = "event_key string, kafka_timestamp timestamp, train_id string, actual_timestamp timestamp, loc_stanox string, timetable_variation string, variation_status string"
    raw = table(schema, *[(str(i), datetime(2024, 1, 1), *m) for i, m in enumerate(moves)])
    return conform(raw, TABLES["rail_bronze"])


@pytest.fixture
def lookups(table):
    stations = table("STANOX_NO string, FULL_NAME string, Route_Description string", ("101", "Dover", "Kent"), ("x_101", "Deal", "Kent"))
    return stations, table("Route string, City string", ("Kent", "Canterbury"))


def test_movements_whose_keys_run_together_both_reach_gold(table, lookups):
    at = datetime(2024, 1, 1, 8)
    bronze = bronze_moves(table, ("a_" + at.strftime("%Y-%m-%d %H:%M:%S") + "_x", None, "101", "9", "LATE"), ("a", at, "x_101", "9", "LATE"), ("a", None, "101", "1", "LATE"), ("a", at, "101", "1", "LATE"))
    trains = silver.train_events(bronze, *lookups)
    sky = table("city_name string, weather_timestamp timestamp", ("Canterbury", at))
    found = gold.with_current_weather(trains, conform(sky, TABLES["weather_silver"])).collect()
    assert len(found) == 4 == len({r.event_id for r in found})
    ahead = conform(sky.withColumnRenamed("weather_timestamp", "forecast_timestamp"), TABLES["forecast_silver"])
    assert gold.with_forecast(trains, ahead).count() == 4


def test_gold_sorts_no_events_and_silver_looks_up_before_it_sorts(spark, table, lookups):
    trains = conform(table("event_id string", ("x",)), TABLES["rail_silver"])
    sky = conform(table("city_name string", ("x",)), TABLES["weather_silver"])
    assert not any("windowspecdefinition(event_id" in plan_of(f) for f in (gold.with_current_weather(trains, sky), gold.with_forecast(trains, conform(sky, TABLES["forecast_silver"]))))
    plan = silver.train_events(bronze_moves(table, ("a", None, "101", "9", "LATE")), *lookups)._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    sort = next(i for i, line in enumerate(lines) if "Window [row_number() windowspecdefinition(train_id" in line)
    assert any("Join LeftSemi" in line for line in lines[sort:]) and not any("Join LeftSemi" in line for line in lines[:sort])


# --- merges -----------------------------------------------------------------

@pytest.fixture
def writes(monkeypatch):
    seen = []
    for owner, name in ((DataFrame, "checkpoint"), (DataFrameWriter, "parquet"), (DataFrameWriter, "insertInto"), (DataFrameWriter, "saveAsTable")):
        plain = getattr(owner, name)
        monkeypatch.setattr(owner, name, lambda self, *a, _p=plain, _n=name, **k: (seen.append(_n), _p(self, *a, **k))[1])
    return seen


@pytest.mark.parametrize("parts", [["day"], []])
def test_a_merge_writes_twice_and_leaves_nothing_behind(spark, table, db, writes, parts):
    create_table(spark, f"{db}.t", SCHEMA, parts)
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    append_table(table("k string, v int, day date", ("a", 1, D1), ("b", 1, D2)), f"{db}.t")
    before = set(glob.glob(f"{folder}/**/staged-*", recursive=True))
    writes.clear()
    merge_table(table("k string, v int, day date", ("a", 2, D1), ("c", 2, D3)), f"{db}.t", ["k"])
    assert len(writes) == 2
    assert set(glob.glob(f"{folder}/**/staged-*", recursive=True)) == before
    assert sorted(tuple(r) for r in spark.table(f"{db}.t").select("k", "v").collect()) == [("a", 2), ("b", 1), ("c", 2)]


def test_a_merge_may_read_its_own_table(spark, table, db):
    create_table(spark, f"{db}.t", SCHEMA, ["day"])
    append_table(table("k string, v int, day date", *[(str(i), i, [D1, D2][i % 2]) for i in range(50)]), f"{db}.t")
    own = spark.table(f"{db}.t").where("v < 25").withColumn("v", F.col("v") + 100)
    merge_table(own, f"{db}.t", ["k"])
    assert spark.table(f"{db}.t").agg(F.sum("v"), F.count("k")).first()[:] == (sum(range(50)) + 2500, 50)


def test_merges_tell_the_days_before_they_change_them(spark, table, db):
    create_table(spark, f"{db}.t", SCHEMA, ["day"])
    told = []

    def touching(values):
        told.append((sorted(values), spark.table(f"{db}.t").count()))

    merge_table(table("k string, v int, day date", ("a", 1, D1), ("b", 1, D3)), f"{db}.t", ["k"], touching=touching)
    merge_table(table("k string, v int, day date"), f"{db}.t", ["k"], touching=touching)
    assert told == [([(D1,), (D3,)], 0)]


def test_a_layout_chooses_how_to_merge(spark, table, monkeypatch):
    called = []
    monkeypatch.setattr(jobs, "merge_table", lambda *a, **k: called.append(("files", a[1:], k)))
    monkeypatch.setattr(jobs, "merge_native", lambda *a, **k: called.append(("native", a[1:], k)))
    rows = table("k string", ("a",))
    Layout("d").merge(rows, "d.t", ["k"], preserve=["m"])
    Layout("d", table_format="other").merge(rows, "d.t", ["k"], newer_by="v")
    assert called == [("files", ("d.t", ["k"]), {"preserve": ["m"]}), ("native", ("d.t", ["k"]), {"newer_by": "v"})]


# --- days and batches -------------------------------------------------------

def test_open_days_are_closed_once_per_consumer(spark, db):
    for name in ("touched_days", "consumed_days"):
        create_table(spark, f"{db}.{name}", TABLES[name])
    ledger.note_days(spark, f"{db}.touched_days", "a", [D1, None])
    ledger.note_days(spark, f"{db}.touched_days", "b", [D2])
    ledger.note_days(spark, f"{db}.touched_days", "b", [])

    def open_for(consumer, *sources):
        for name in ("touched_days", "consumed_days"):
            spark.catalog.refreshTable(f"{db}.{name}")
        return ledger.open_days(spark.table(f"{db}.touched_days"), spark.table(f"{db}.consumed_days"), consumer, sources)

    assert sorted((r.source, str(r.event_date)) for r in open_for("x", "a", "b").collect()) == [("a", "2024-01-01"), ("a", "None"), ("b", "2024-01-02")]
    ledger.close_days(open_for("x", "a").checkpoint(), f"{db}.consumed_days", "x")
    assert [r.source for r in open_for("x", "a", "b").collect()] == ["b"]
    assert open_for("y", "a").count() == 2


def test_a_batch_that_was_merged_is_skipped_after_a_restart(spark, db, tmp_path, monkeypatch):
    create_table(spark, f"{db}.t", SCHEMA, ["day"])
    create_table(spark, f"{db}.merged_batches", TABLES["merged_batches"])
    source, mark = tmp_path / "in", tmp_path / "mark"
    source.mkdir()
    merges = []
    plain = ingest.merge_table
    monkeypatch.setattr(ingest, "merge_table", lambda *a, **k: (merges.append(a[1]), plain(*a, **k)))

    def drain(mark=mark):
        stream = spark.readStream.schema("k string, v int, day date").option("maxFilesPerTrigger", 1).json(str(source))
        ingest.upsert_stream(stream, str(mark), f"{db}.t", ["k"], ["v"], merged=f"{db}.merged_batches").awaitTermination()
        return sorted((r.k, r.v) for r in spark.table(f"{db}.t").collect())

    (source / "1.json").write_text('{"k":"a","v":1,"day":"2024-01-01"}')
    assert drain() == [("a", 1)] and len(merges) == 1
    (source / "2.json").write_text('{"k":"a","v":2,"day":"2024-01-01"}')
    assert drain() == [("a", 2)] and len(merges) == 2
    os.remove(mark / "commits" / "1")  # as if the run had broken off after the merge
    for crc in glob.glob(str(mark / "commits" / ".1.crc")):
        os.remove(crc)
    assert drain() == [("a", 2)] and len(merges) == 2
    (source / "3.json").write_text('{"k":"b","v":3,"day":"2024-01-01"}')
    assert drain() == [("a", 2), ("b", 3)] and len(merges) == 3
    assert drain(tmp_path / "other") == [("a", 2), ("b", 3)] and len(merges) == 6  # another stream has batches of its own


@pytest.fixture
def line(spark, db, tmp_path):
    """Tables, lookups and a function that feeds topics."""
    files = tmp_path / "lookup"
    files.mkdir()
    (files / "station_codes.csv").write_text("STANOX_NO,FULL_NAME,Route_Description\n101,Dover,Kent\n102,Deal,Kent\n")
    (files / "mapping.csv").write_text("Route,City\nKent,Canterbury\n")
    at = Layout(db, str(files), str(tmp_path / "marks"))
    jobs.create_tables(spark, at)
    names = ("rail", "weather", "forecast")
    for name in names:
        (tmp_path / name).mkdir()

    def feed(number, **messages):
        for name, values in messages.items():
            topic_file(tmp_path / name, f"{number}.json", *[(f"2024-01-20T08:00:0{number}Z", v) for v in values])
        jobs.run_bronze(spark, at, {f"{n}_bronze": read_topic(spark, {}, "json", path=str(tmp_path / n)) for n in names})
        jobs.stream_silver(spark, at)
        return jobs.run_gold_changes(spark, at)

    return at, feed


def on_day(day, train, **more):
    found = move(train, 30, **more)
    found["body"]["actual_timestamp"] = str(int(datetime(2024, 1, day, 8, 30).timestamp() * 1000))
    return found


def at_time(message, *when):
    text = json.dumps(message).replace(str(int(datetime(2024, 1, 10, 8, 0).timestamp())), str(int(datetime(2024, 1, *when).timestamp())))
    return json.loads(text)


def test_an_old_correction_reaches_gold_and_alerts_by_itself(spark, db, line):
    at, feed = line
    assert feed(1, rail=[on_day(5, "old"), on_day(15, "new")], weather=[weather("Canterbury", 0, "fog")], forecast=[forecast("Canterbury", 0, "fog")]) == {
        date(2024, 1, d) for d in (5, 15, 10, 11, 9)
    }

    def alerts():
        return {r.train_id: (r.delay_minutes, r.current_weather_description, r.forecast_weather_description) for r in spark.table(f"{db}.alerts").collect()}

    assert alerts() == {"old": (20, None, None), "new": (20, None, None)}
    untouched = set(spark.table(f"{db}.gold_weather_train").where("event_date = '2024-01-15'").inputFiles())
    assert feed(2) == set()  # nothing new
    assert feed(3, rail=[on_day(5, "old", delay="40")]) == {date(2024, 1, 5)}
    assert alerts() == {"old": (40, None, None), "new": (20, None, None)}
    assert spark.table(f"{db}.gold_route_reliability").where("date = '2024-01-05'").first().avg_delay == 40
    # weather of the evening before and forecasts of the next day reach a movement; days between stay closed
    late = at_time(weather("Canterbury", 0, "heavy rain"), 5, 8, 20)
    assert feed(4, weather=[late], forecast=[at_time(forecast("Canterbury", 0, "light snow"), 5, 9, 0)]) == {date(2024, 1, d) for d in (4, 5, 6)}
    assert alerts() == {"old": (40, "heavy rain", "light snow"), "new": (20, None, None)}
    assert set(spark.table(f"{db}.gold_weather_train").where("event_date = '2024-01-15'").inputFiles()) == untouched
    assert feed(5) == set()


def test_gold_of_changes_equals_gold_of_everything(spark, db, line):
    at, feed = line
    feed(1, rail=[on_day(5, "a"), on_day(6, "b", status="CANCELLED"), {"body": {"train_id": "t", "loc_stanox": "101", "variation_status": "CANCELLED"}}], weather=[at_time(weather("Canterbury", 0, "fog"), 5, 8, 15)])
    feed(2, rail=[on_day(5, "a", delay="7"), on_day(6, "c")], forecast=[at_time(forecast("Canterbury", 0, "fog"), 6, 9, 15)])

    def content():
        return {
            t: sorted(str(r) for r in spark.table(f"{db}.{t}").drop("ingest_timestamp").collect())
            for t in ("gold_weather_train", "gold_forecast_train", "gold_station_reliability", "gold_route_reliability", "alerts")
        }

    changed = content()
    assert len(changed["alerts"]) == 4 and "heavy" not in str(changed)
    jobs.run_gold(spark, at)
    for t in TABLES:
        if t.startswith("gold") or t == "alerts":
            spark.catalog.refreshTable(f"{db}.{t}")
    assert content() == changed


# --- files ------------------------------------------------------------------

def test_fifty_small_batches_write_fifty_files(spark, db, tmp_path):
    """Each micro-batch has four splits and two days; without dealing each would write eight files."""
    source = tmp_path / "rail"
    for i in range(200):
        topic_file(source, f"{i:03d}.json", (f"2024-01-{1 + i % 2:02d}T08:00:00Z", move(f"t{i}", i % 60)), (f"2024-01-0{2 - i % 2}T09:00:00Z", move(f"u{i}", i % 60)))
    at = Layout(db, "", str(tmp_path / "marks"))
    stream = read_topic(spark, {"maxFilesPerTrigger": "4"}, "json", path=str(source))
    jobs.run_bronze(spark, at, {"rail_bronze": stream})
    table = spark.table(f"{db}.rail_bronze")
    assert table.count() == 400 and table.where("kafka_date = '2024-01-01'").count() == 200
    assert len(table.inputFiles()) == 100  # 50 batches, 2 days
    assert "kafka_date=2024-01-02" in "".join(table.where("kafka_date = '2024-01-02'").inputFiles())


def test_silver_takes_bounded_batches(spark, db, line, monkeypatch):
    at, feed = line
    feed(1, rail=[on_day(5, "a")])
    feed(2, rail=[on_day(5, "b")])
    merges = []
    plain = ingest.merge_table
    monkeypatch.setattr(ingest, "merge_table", lambda *a, **k: (merges.append(a[1]), plain(*a, **k)))
    tight = Layout(at.database, at.lookups, str(at.checkpoints) + "/tight", silver_bytes=1)
    jobs.stream_silver(spark, tight)
    assert merges.count(f"{db}.rail_silver") == 2
    assert sorted(r.train_id for r in spark.table(f"{db}.rail_silver").collect()) == ["a", "b"]


# --- deliveries -------------------------------------------------------------

def test_tries_fold_in_any_order(table):
    tries = [("n", False, datetime(2024, 1, 1)), ("n", True, datetime(2024, 1, 2)), ("n", None, datetime(2024, 1, 3)), ("m", None, None)]
    for order in permutations(tries):
        got = sorted(tuple(r) for r in outcomes(table("notification_id string, delivered boolean, attempted_at timestamp", *order)).collect())
        assert got == [("m", False, 1, None), ("n", True, 3, datetime(2024, 1, 3))]


def dispatched(spark, db, days=(D1, D2)):
    """A database with two alerts a day, two riders each, drafted."""
    at = Layout(db)
    jobs.create_tables(spark, at)
    alerts = spark.createDataFrame([(f"{d}{x}", "Kent", d, 20, True, False, False) for d in days for x in "ab"] + [(f"{d}quiet", "Nowhere", d, 20, True, False, False) for d in days],
                                   "event_id string, route string, event_date date, delay_minutes int, is_delayed boolean, is_cancelled boolean, is_major_delay boolean")
    append_table(alerts, f"{db}.alerts")
    prefs = spark.createDataFrame([(u, f"{u}@x", "kent", 5, True, True, True) for u in ("u", "v")], "user_id string, email string, route string, delay_threshold_minute int, notify_delay boolean, notify_cancellation boolean, is_active boolean")
    append_table(prefs, f"{db}.rider_preferences")
    for day in days:
        jobs.run_dispatch(spark, at, F.lit(day), lookback_days=0)
        jobs.run_dispatch(spark, at, F.lit(day), lookback_days=0)
    return at


def test_alerts_without_riders_are_marked_at_once(spark, db):
    dispatched(spark, db)
    assert spark.table(f"{db}.dispatch_outbox").count() == 8
    assert spark.table(f"{db}.dispatch_cursor").where("event_date IS NULL").count() == 0
    marks = {r.event_id: r.notification_status for r in spark.table(f"{db}.alerts").collect()}
    assert {k for k, v in marks.items() if v == "SENT"} == {f"{D1}quiet", f"{D2}quiet"}


@pytest.mark.parametrize(("split", "by_day"), [([0, 1, 2, 3], False), ([[0, 1, 2, 3]], True), ([3, 2, 1, 0], True), ([[1, 2], [0, 3]], False)])
def test_results_in_any_split_end_alike(spark, table, db, split, by_day):
    at = dispatched(spark, db, (D1,))
    ids = [r.notification_id for r in spark.table(f"{db}.dispatch_outbox").orderBy("event_id", "user_id").collect()]
    results = [(ids[0], False), (ids[0], True), (ids[1], True), (ids[1], False)]
    schema = "notification_id string, delivered boolean" + (", event_date date" if by_day else "")
    for part in split:
        rows = [results[i] for i in (part if isinstance(part, list) else [part])]
        try:
            jobs.record_deliveries(spark, at, table(schema, *[(*r, D1) if by_day else r for r in rows]))
        except DispatchFailed:
            assert split != [[0, 1, 2, 3]]

    def log():
        return {r.notification_id: r.delivery_status for r in spark.table(f"{db}.delivery_log").collect()}

    assert log() == {ids[0]: "SENT", ids[1]: "SENT"}
    marks = {r.event_id: r.notification_status for r in spark.table(f"{db}.alerts").collect()}
    assert marks == {f"{D1}a": "SENT", f"{D1}b": None, f"{D1}quiet": "SENT"}
    with pytest.raises(DispatchFailed):
        jobs.record_deliveries(spark, at, table(schema), final=True)
    assert log() == {ids[0]: "SENT", ids[1]: "SENT", ids[2]: "FAILED", ids[3]: "FAILED"}
    jobs.record_deliveries(spark, at, table("notification_id string, delivered boolean", (ids[2], True), ("unknown", True)))
    assert log() == {ids[0]: "SENT", ids[1]: "SENT", ids[2]: "SENT", ids[3]: "FAILED"}
    assert spark.table(f"{db}.alerts").where("notification_status = 'SENT'").count() == 3


def test_logs_are_read_by_day(spark, table, db, monkeypatch):
    at = dispatched(spark, db)
    scans = []
    plain = DataFrame.checkpoint
    monkeypatch.setattr(DataFrame, "checkpoint", lambda self, *a, **k: (scans.append(self._jdf.queryExecution().executedPlan().toString()), plain(self, *a, **k))[1])
    ids = [r.notification_id for r in spark.table(f"{db}.dispatch_outbox").where(F.col("event_date") == F.lit(D2)).collect()]
    jobs.record_deliveries(spark, at, table("notification_id string, delivered boolean, event_date date", *[(i, True, D2) for i in ids]))
    jobs.run_dispatch(spark, at, F.lit(D2), lookback_days=0)
    read = [line for plan in scans for line in plan.splitlines() if "FileScan parquet" in line and db in line]
    assert read and all("PartitionFilters: [isnotnull(event_date" in line for line in read)
    assert any("dispatch_cursor" in line for line in read) and any("dispatch_outbox" in line for line in read) and any("delivery_attempts" in line for line in read)


def test_a_large_cursor_is_filtered_as_it_is_scanned(spark, db):
    at = dispatched(spark, db)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = pending(spark.table(at.name("alerts")), spark.table(at.name("dispatch_cursor")), F.lit(D2), 0, large_cursor=True)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        scan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert "might_contain" in plan
    cursor = next(line for line in scan.splitlines() if "FileScan" in line and "dispatch_cursor" in line)
    assert "PartitionFilters: [isnotnull(event_date" in cursor
    assert found.count() == 0


def test_a_large_cursor_changes_no_answer(table):
    alerts = table("event_id string, event_date date, is_delayed boolean, is_cancelled boolean, is_major_delay boolean", *[(str(i), [D1, D2, D3, None][i % 4], i % 3 > 0, False, False) for i in range(60)])
    cursor = table("event_id string, event_date date", *[(str(i), [D1, D2, D3, None][i % 4]) for i in range(0, 200, 7)], (None, D3))
    plain = pending(alerts, cursor.drop("event_date"), F.lit(D3), 1)
    for how in (pending(alerts, cursor, F.lit(D3), 1, large_cursor=True), pending(alerts, cursor.drop("event_date"), F.lit(D3), 1, large_cursor=True), pending(alerts, cursor, F.lit(D3), 1)):
        assert sorted(r.event_id for r in how.collect()) == sorted(r.event_id for r in plain.collect())


# --- weather words ----------------------------------------------------------

def test_words_that_only_look_like_weather(table):
    harsh = ["blizzard", "Extremely Hot", "extreme temperatures", "heat wave", "heatwave", "no wind, heavy rain", "light rain", "rainy", "thunderstorm", "snowfall", "extremely cold"]
    mild = ["no rain", "training", "no rain or snow", "without fog", "no more rain", "drained", "hot", "No Snow"]
    df = table("w string", *[(w,) for w in harsh + mild])
    got = {r.w: r.hit for r in df.select("w", wording.is_disruptive(F.col("w")).alias("hit")).collect()}
    assert got == {w: True for w in harsh} | {w: False for w in mild}
