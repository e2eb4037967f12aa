"""Relational sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame


def write_options(
    url: str, table: str, properties: Mapping[str, str] | None = None, cascade: bool = False
) -> dict[str, str]:
    """Writer options. ``truncate`` empties an existing table instead of dropping it, so the views
    and grants that depend on it stay; a missing table is created."""
    options = {"url": url, "dbtable": table, "truncate": "true", **(properties or {})}
    return {**options, "cascadeTruncate": "true"} if cascade else options


def publish(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    mode: str = "overwrite",
    connections: int | None = None,
    cascade: bool = False,
) -> None:
    """Replace (``overwrite``) or extend (``append``) a table straight from the executors, over at
    most ``connections`` connections."""
    if connections:
        df = df.coalesce(connections)
    df.write.format("jdbc").options(**write_options(url, table, properties, cascade)).mode(mode).save()


def reload_tables(
    frames: Sequence[tuple[str, DataFrame]],
    url: str,
    properties: Mapping[str, str] | None = None,
    connections: int | None = None,
) -> None:
    """Empty and refill related tables, given parents first: children are emptied before their
    parents, then everything is appended parents first."""
    for table, df in reversed(frames):
        publish(df.limit(0), url, table, properties, cascade=True)
    for table, df in frames:
        publish(df, url, table, properties, mode="append", connections=connections)
