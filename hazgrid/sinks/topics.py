"""Keyed JSON messages, to a broker or to files that stand in for one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.encode import json_value
from ..schemas import TOPIC_KEY


def messages(events: DataFrame, kind: str) -> DataFrame:
    """(topic, key, value): the key keeps one network, satellite or parameter in order."""
    key = F.col(TOPIC_KEY[kind]).cast("string")
    return events.select(F.lit(kind).alias("topic"), key.alias("key"), json_value(events).alias("value"))


def publish(events: DataFrame, kind: str, servers: str) -> None:
    """To a broker; needs the Kafka connector on the class path. The broker partitions by key."""
    messages(events, kind).write.format("kafka").option("kafka.bootstrap.servers", servers).option(
        "kafka.acks", "all"
    ).save()


def land_messages(events: DataFrame, kind: str, path: str, mode: str = "append") -> None:
    """To text files, one message per line.

    There are only a handful of distinct keys, so rows are not shuffled by key:
    each task writes its own, and readers take files in parallel.
    """
    messages(events, kind).select("value").write.mode(mode).text(f"{path.rstrip('/')}/{kind}")
