"""Surrogate ids over many loads: each load gets a range of its own, once.

A journal beside the table has the next free id and the range of every load. A load that is tried again gets the range
it had, so the rows get the ids they would have had, and the table's own commit says whether they are in it already.
Ranges are dense while loads succeed; a load that is given up leaves its range unused.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from foulee.sinks.lake import write_table
from foulee.sources.extracts import with_surrogate_id
from foulee.sources.journal import ConflictingWrite, Journal
from foulee.sources.lake import Lake, state_of

_TRIES = 20
_MARK = "chargement:"


def _journal(spark: SparkSession, lake: Lake, table: str) -> Journal:
    return Journal(spark, f"{lake.path(table)}/_numeros")


def reserve_ids(spark: SparkSession, lake: Lake, table: str, load: str, count: int, restart: bool = False) -> int:
    """The first of ``count`` ids that only this load has. ``restart`` forgets all other loads and begins at 1."""
    journal = _journal(spark, lake, table)
    for _ in range(_TRIES):
        number, entries = journal.last()
        known = entries[0] if entries else {"suivant": 1, "chargements": {}}
        if load in known["chargements"]:
            first, reserved = known["chargements"][load]
            if reserved != count:
                raise ValueError(f"{table}: load {load!r} had {reserved} rows and now has {count}")
            return first
        if restart:
            known = {"suivant": 1, "chargements": {}}
        first = known["suivant"]
        after = {"suivant": first + count, "chargements": {**known["chargements"], load: [first, count]}}
        try:
            journal.commit(number, [after])
        except ConflictingWrite:
            continue
        return first
    raise ConflictingWrite(f"{table}: other loads kept reserving ids")


def append_numbered(df: DataFrame, order: Sequence[str], lake: Lake, table: str, load: str) -> bool:
    """Append a load with ids that no other load has; False, and nothing done, if it is in the table already.

    ``load`` names the load, and names it again when it is tried again: its rows must then be the same.
    """
    spark, mark = df.sparkSession, _MARK + load
    if mark in state_of(spark, lake, table).marks:
        return False
    numbered = with_surrogate_id(df, order, first=lambda n: reserve_ids(spark, lake, table, load, n))
    write_table(numbered, lake, table, mode="append", marks={mark: True})
    return True


def reload_numbered(df: DataFrame, order: Sequence[str], lake: Lake, table: str, load: str) -> bool:
    """Empty the table, restart its ids at 1 and load it; False if just this load is what it holds."""
    spark, mark = df.sparkSession, _MARK + load
    marks = state_of(spark, lake, table).marks
    if mark in marks:
        return False
    numbered = with_surrogate_id(df, order, first=lambda n: reserve_ids(spark, lake, table, load, n, restart=True))
    write_table(numbered, lake, table, marks={**{old: None for old in marks if old.startswith(_MARK)}, mark: True})
    return True
