"""Windowed counts and location lookup for web events, batch and streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linewatch.operators.clean import dedupe

# What a location lookup adds.
GEO_COLUMNS = ["country", "region", "city", "latitude", "longitude"]


def tumbling_counts(
    df: DataFrame,
    ts: str = "event_time",
    host: str = "host",
    ip: str = "ip",
    width: str = "10 minutes",
    watermark: str | None = None,
) -> DataFrame:
    """Events and unique ips per window and host, exact in batch and on a stream.

    Rows first collapse to one per window, host and ip, which are then counted. On
    a stream, which needs a ``watermark``, these are two stateful steps in a row: the first keeps each distinct ip
    until the watermark closes its window, the second gets closed windows only. A
    hot window or host spreads over its ips, and combines before it is shuffled to be counted. An unknown
    ip counts as an event and not as an ip.
    """
    if df.isStreaming:
        if watermark is None:
            raise ValueError("a stream needs a watermark")
        df = df.withWatermark(ts, watermark)
    per_ip = df.groupBy(F.window(ts, width).alias("w"), host, ip).agg(F.count(F.lit(1)).alias("n"))
    return (
        per_ip.groupBy(F.window(F.window_time("w"), width).alias("v"), host)
        .agg(F.sum("n").alias("event_count"), F.count(ip).alias("unique_ips"))
        .select(F.col("v.start").alias("window_start"), F.col("v.end").alias("window_end"), host, "event_count", "unique_ips")
    )


def geo_enrich(df: DataFrame, geo: DataFrame, key: str = "ip") -> DataFrame:
    """Add the location of ``key``; unknown ones stay, with NULLs.

    ``geo`` is a static table, so this also works on a stream; of several rows per
    ``key`` the first by content counts.
    """
    places = dedupe(geo.select(F.col(key).alias("_geo_key"), *GEO_COLUMNS), ["_geo_key"], [F.col(c).asc() for c in GEO_COLUMNS])
    return df.join(places, df[key] == places["_geo_key"], "left").drop("_geo_key").withColumn(
        "enriched_at", F.current_timestamp()
    )
