"""Message topics as streaming frames of ``event_key, kafka_timestamp, raw_json``."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# How a topic is read unless told otherwise, and the broker client's login modules.
MAX_OFFSETS_PER_TRIGGER = 5000

_LOGIN_MODULES = {
    "PLAIN": "org.apache.kafka.common.security.plain.PlainLoginModule",
    "SCRAM-SHA-256": "org.apache.kafka.common.security.scram.ScramLoginModule",
    "SCRAM-SHA-512": "org.apache.kafka.common.security.scram.ScramLoginModule",
}


@dataclass(frozen=True)
class Sasl:
    """Credentials and protocol of a broker."""

    key: str = ""
    secret: str = ""
    protocol: str = "SASL_SSL"
    mechanism: str = "PLAIN"

    def options(self) -> dict[str, str]:
        out = {"kafka.security.protocol": self.protocol, "kafka.sasl.mechanism": self.mechanism}
        if not self.protocol.upper().startswith("SASL"):
            return out
        if not (self.key and self.secret):
            raise ValueError(f"protocol {self.protocol} needs both a key and a secret")
        module = _LOGIN_MODULES.get(self.mechanism.upper())
        if module is None:
            raise ValueError(f"unsupported SASL mechanism {self.mechanism!r}")
        user, password = (v.replace("\\", "\\\\").replace('"', '\\"') for v in (self.key, self.secret))
        out["kafka.sasl.jaas.config"] = f'{module} required username="{user}" password="{password}";'
        return out


def kafka_options(
    bootstrap: str,
    topic: str,
    starting: str = "latest",
    max_offsets: int | None = MAX_OFFSETS_PER_TRIGGER,
    sasl: Sasl | None = None,
    fail_on_data_loss: bool = True,
) -> dict[str, str]:
    """Reader options of a Kafka topic. ``max_offsets=None`` lifts the rate limit.

    A stream fails when the broker has lost records that it still had to read;
    ``fail_on_data_loss=False`` goes on without them.
    """
    out = {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets is not None:
        out["maxOffsetsPerTrigger"] = str(max_offsets)
    if sasl is not None:
        out.update(sasl.options())
    return out


def envelope(messages: DataFrame) -> DataFrame:
    """Key and value as text, broker time as ``kafka_timestamp``."""
    return messages.select(
        F.col("key").cast("string").alias("event_key"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.col("value").cast("string").alias("raw_json"),
    )


def read_topic(
    spark: SparkSession,
    options: Mapping[str, str],
    fmt: str = "kafka",
    schema: str = "key STRING, timestamp TIMESTAMP, value STRING",
    path: str | None = None,
) -> DataFrame:
    """A topic as a stream. File formats need a ``path`` and carry ``schema``."""
    reader = spark.readStream.format(fmt).options(**options)
    if fmt != "kafka":
        reader = reader.schema(schema)
    return envelope(reader.load(path) if path else reader.load())
