"""Topic messages to bronze columns. Works on streams and batches alike.

Each message is parsed once, into a struct of texts; typed columns follow from
forgiving casts, so dirty values give NULL and never stop a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linewatch.functions.casts import as_double, as_int, from_epoch_millis, from_epoch_seconds, wall_clock
from linewatch.schemas import TABLES

_ENVELOPE = ["event_key", "kafka_timestamp", "raw_json"]

# Fields of a movement message; the times among them are epoch
# milliseconds in text.
RAIL_TIMES = ["actual_timestamp", "gbtt_timestamp", "planned_timestamp"]
RAIL_BODY = [
    c for c, t in TABLES["rail_bronze"].items() if c not in (*_ENVELOPE, "header", "ingest_time")
]

# Bronze column, place in the message and type of the weather topics.
WEATHER_FIELDS = {
    "city_name": ("name", "string"),
    "weather_timestamp": ("dt", "epoch"),
    "temperature": ("main.temp", "double"),
    "temp_min": ("main.temp_min", "double"),
    "temp_max": ("main.temp_max", "double"),
    "feels_like": ("main.feels_like", "double"),
    "weather_description": ("weather[0].description", "string"),
    "humidity": ("main.humidity", "int"),
    "pressure": ("main.pressure", "int"),
    "sea_level": ("main.sea_level", "int"),
    "ground_level": ("main.grnd_level", "int"),
    "wind_speed": ("wind.speed", "double"),
    "wind_direction": ("wind.deg", "int"),
    "wind_gust": ("wind.gust", "double"),
}
FORECAST_FIELDS = {
    "city_name": ("city.name", "string"),
    "forecast_timestamp": ("forecast.dt", "epoch"),
    "forecast_time": ("forecast.dt_txt", "clock"),
    "temperature": ("forecast.main.temp", "double"),
    "feels_like": ("forecast.main.feels_like", "double"),
    "humidity": ("forecast.main.humidity", "int"),
    "pressure": ("forecast.main.pressure", "int"),
    "wind_speed": ("forecast.wind.speed", "double"),
    "wind_direction": ("forecast.wind.deg", "int"),
    "wind_gust": ("forecast.wind.gust", "double"),
    "weather_description": ("forecast.weather[0].description", "string"),
    "visibility": ("forecast.visibility", "int"),
    "precipitation_probability": ("forecast.pop", "double"),
}

_TYPED = {
    "string": lambda c: c,
    "double": as_double,
    "int": as_int,
    "epoch": from_epoch_seconds,
    "clock": wall_clock,
}


def _layout(paths: list[str]) -> T.StructType:
    """The struct of texts that holds ``paths``; ``x[0]`` makes ``x`` an array."""
    heads: dict[str, list[str]] = {}
    for path in paths:
        head, _, rest = path.partition(".")
        heads.setdefault(head, []).append(rest)
    out = T.StructType()
    for head, rests in heads.items():
        inner = _layout([r for r in rests if r]) if any(rests) else T.StringType()
        if head.endswith("[0]"):
            head, inner = head[:-3], T.ArrayType(inner)
        out.add(head, inner)
    return out


def _at(root: Column, path: str) -> Column:
    for step in path.split("."):
        root = F.get(root[step[:-3]], 0) if step.endswith("[0]") else root[step]
    return root


def _payload(df: DataFrame, layout: T.StructType) -> DataFrame:
    """The parsed payload as ``m``, from a one-row generator: later filters and explodes
    stay behind it instead of taking a copy of the parse along."""
    wrapped = T.StructType().add("m", layout)
    payload = F.from_json("raw_json", T.StructType().add("raw_payload", layout))["raw_payload"]
    return df.select(*_ENVELOPE, F.inline(F.array(F.struct(payload.alias("m")).cast(wrapped))))


def parse_rail(df: DataFrame) -> DataFrame:
    """Movement messages to bronze rail columns."""
    layout = T.StructType().add("header", T.MapType(T.StringType(), T.StringType())).add("body", _layout(RAIL_BODY))
    body = {
        c: from_epoch_millis(F.col(f"m.body.{c}")) if c in RAIL_TIMES else F.col(f"m.body.{c}") for c in RAIL_BODY
    }
    body["header"] = F.col("m.header")
    body["ingest_time"] = F.current_timestamp()
    order = [c for c in TABLES["rail_bronze"] if c not in _ENVELOPE]
    return _payload(df, layout).select(*_ENVELOPE, *[body[c].alias(c) for c in order])


def _parse_fields(df: DataFrame, fields: dict[str, tuple[str, str]]) -> DataFrame:
    parsed = _payload(df, _layout([path for path, _ in fields.values()]))
    typed = [_TYPED[kind](_at(F.col("m"), path)).alias(c) for c, (path, kind) in fields.items()]
    return parsed.select(*_ENVELOPE, *typed, F.current_timestamp().alias("ingest_timestamp"))


def parse_weather(df: DataFrame) -> DataFrame:
    """Current-weather messages to bronze columns."""
    return _parse_fields(df, WEATHER_FIELDS)


def parse_forecast(df: DataFrame) -> DataFrame:
    """Forecast messages to bronze columns."""
    return _parse_fields(df, FORECAST_FIELDS)
