"""Keyed JSON order events (the producer side), as a batch Spark job.

``order_events`` turns order rows into Kafka records: key = state (or
``UNKNOWN``), value = the whole row as JSON with explicit nulls and the
contract's timestamp format.  Integers stay integers.  ``write_kafka`` is the
thin Kafka writer (needs the Kafka connector on the classpath); ``limit`` is
the producer's optional first-N cap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import ORDER_COLUMNS, TIMESTAMP_FORMAT

JSON_OPTIONS = {"ignoreNullFields": "false", "timestampFormat": TIMESTAMP_FORMAT}

# Producer reliability and batching settings.
KAFKA_PRODUCER_OPTIONS = {
    "kafka.acks": "all",
    "kafka.retries": "3",
    "kafka.linger.ms": "5",
}


def order_events(orders: DataFrame, key_col: str = "customer_state", limit: int | None = None,
                 keep: list[str] | None = None) -> DataFrame:
    """``key``, ``value`` text columns, one record per order row (``keep``: order columns beside them)."""
    src = orders.limit(limit) if limit else orders
    return src.select(
        *(keep or []),
        F.coalesce(F.col(key_col).cast("string"), F.lit("UNKNOWN")).alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in ORDER_COLUMNS]), JSON_OPTIONS).alias("value"),
    )


def kafka_writer_options(bootstrap: str, topic: str, extra: dict | None = None) -> dict:
    return {"kafka.bootstrap.servers": bootstrap, "topic": topic, **KAFKA_PRODUCER_OPTIONS, **(extra or {})}


def write_kafka(events: DataFrame, bootstrap: str, topic: str, extra: dict | None = None) -> None:
    events.write.format("kafka").options(**kafka_writer_options(bootstrap, topic, extra)).save()
