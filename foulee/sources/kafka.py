"""Change-data-capture topic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


#: Events of one micro-batch at most: after a downtime the backlog comes in batches of this size.
PER_TRIGGER = 100_000


def feed_options(servers: str, topic: str, starting: str = "latest", per_trigger: int | None = None) -> dict[str, str]:
    """Options of the connector; without ``per_trigger`` a micro-batch has no bound."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    return {**options, "maxOffsetsPerTrigger": str(per_trigger)} if per_trigger else options


def read_feed(
    spark: SparkSession, servers: str, topic: str, starting: str = "latest", per_trigger: int | None = PER_TRIGGER
) -> DataFrame:
    """The topic as a stream with one string column ``value``. Needs Spark's Kafka connector.

    ``starting`` only matters for a new query; a restarted one continues from its checkpoint. A micro-batch
    holds at most ``per_trigger`` events; None lifts the bound.
    """
    options = feed_options(servers, topic, starting, per_trigger)
    return spark.readStream.format("kafka").options(**options).load().selectExpr("CAST(value AS STRING)")
