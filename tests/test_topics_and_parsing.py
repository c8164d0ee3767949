import json
from datetime import datetime

import pytest

from linewatch.schemas import TABLES
from linewatch.sources.lookups import read_routes, read_stations, rider_preferences, rider_query
from linewatch.sources.topics import Sasl, envelope, kafka_options
from linewatch.streaming.parse import parse_forecast, parse_rail, parse_weather
from testbed.catalog import QUERIES


def message(spark, payload):
    text = payload if isinstance(payload, str) else json.dumps({"raw_payload": payload})
    df = spark.createDataFrame([(b"k", datetime(2024, 1, 1), text.encode())], "key binary, timestamp timestamp, value binary")
    return envelope(df)


def test_kafka_options():
    plain = kafka_options("host:1", "moves")
    assert plain == {
        "kafka.bootstrap.servers": "host:1", "subscribe": "moves", "startingOffsets": "latest",
        "failOnDataLoss": "true", "maxOffsetsPerTrigger": "5000",
    }
    assert "maxOffsetsPerTrigger" not in kafka_options("h", "t", max_offsets=None)
    full = kafka_options("h", "t", "earliest", sasl=Sasl("user", 'pa"ss'))
    assert full["kafka.security.protocol"] == "SASL_SSL" and full["kafka.sasl.mechanism"] == "PLAIN"
    assert 'username="user" password="pa\\"ss";' in full["kafka.sasl.jaas.config"]
    assert full["startingOffsets"] == "earliest"
    for missing in (Sasl(), Sasl("user"), Sasl(secret="x"), Sasl(protocol="sasl_plaintext")):
        with pytest.raises(ValueError):
            missing.options()
    assert "kafka.sasl.jaas.config" not in Sasl(protocol="SSL").options()


def test_rail_message(spark):
    body = {
        "train_id": "1A", "actual_timestamp": "1700000000999", "loc_stanox": "00123", "correction_ind": "false",
        "timetable_variation": "7", "planned_timestamp": "oops", "gbtt_timestamp": "", "toc_id": 21,
    }
    row = parse_rail(message(spark, {"header": {"a": "1", "n": 2}, "body": body})).first()
    assert list(row.asDict()) == list(TABLES["rail_bronze"])
    assert row.event_key == "k" and json.loads(row.raw_json)["raw_payload"]["body"]["train_id"] == "1A"
    assert row.actual_timestamp == datetime.fromtimestamp(1700000000)
    assert (row.planned_timestamp, row.gbtt_timestamp, row.next_report_stanox) == (None, None, None)
    assert row.toc_id == "21" and row.correction_ind == "false" and row.header == {"a": "1", "n": "2"}


def test_weather_message(spark):
    payload = {
        "name": "York", "dt": 1700000000, "main": {"temp": 3.5, "pressure": "1013.5", "humidity": "wet"},
        "weather": [], "wind": {"speed": 2, "deg": 180},
    }
    row = parse_weather(message(spark, payload)).first()
    assert list(row.asDict()) == list(TABLES["weather_bronze"])
    assert (row.city_name, row.temperature, row.pressure, row.humidity) == ("York", 3.5, 1013, None)
    assert (row.weather_description, row.wind_speed, row.wind_direction, row.wind_gust) == (None, 2.0, 180, None)
    assert row.weather_timestamp == datetime.fromtimestamp(1700000000)


def test_forecast_message(spark):
    payload = {
        "city": {"name": "Bath"},
        "forecast": {
            "dt": "1700000000", "dt_txt": "2023-11-14 22:13:20", "main": {"temp": 1}, "pop": 0.25, "visibility": 900,
            "weather": [{"description": "light rain"}, {"description": "fog"}],
        },
    }
    row = parse_forecast(message(spark, payload)).first()
    assert list(row.asDict()) == list(TABLES["forecast_bronze"])
    assert (row.city_name, row.weather_description, row.precipitation_probability) == ("Bath", "light rain", 0.25)
    assert row.forecast_time == datetime(2023, 11, 14, 22, 13, 20) and row.visibility == 900


@pytest.mark.parametrize("text", ["", "not json", "[1]", '{"raw_payload": 5}', '{"raw_payload": {"body": "x", "main": 3}}'])
def test_broken_messages_give_nulls(spark, text):
    for parse in (parse_rail, parse_weather, parse_forecast):
        row = parse(message(spark, text)).first().asDict()
        assert row.pop("raw_json") == text
        row = {k: v for k, v in row.items() if k not in ("event_key", "kafka_timestamp", "ingest_time", "ingest_timestamp")}
        assert not any(row.values())


def test_message_is_parsed_once(spark):
    plan = parse_rail(message(spark, {}))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


@pytest.mark.parametrize("name", ["clean_not_null", "json_map", "silver_weather_current", "silver_weather_forecast"])
def test_queries_parse_once_behind_filters_and_explodes(spark, name):
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_lookup_files(spark, tmp_path, rows):
    (tmp_path / "station_codes.csv").write_text("Extra,Route_Description,FULL_NAME,STANOX_NO\n1,Kent,Dover,00101\n")
    (tmp_path / "mapping.csv").write_text("Route,City\nKent,Canterbury\n")
    assert rows(read_stations(spark, str(tmp_path))) == [("00101", "Dover", "Kent")]
    assert rows(read_routes(spark, str(tmp_path) + "/")) == [("Kent", "Canterbury")]


def test_rider_preferences(table):
    df = rider_preferences(table("is_active boolean, user_id long, email string", (True, 7, "a@b")))
    assert df.dtypes == list(TABLES["rider_preferences"].items())
    assert df.first().user_id == "7"
    assert rider_query("p").startswith("SELECT user_id, email, route") and rider_query("p").endswith("FROM p")
