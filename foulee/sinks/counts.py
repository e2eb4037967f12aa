"""Activity counts kept up to date in a lake table, batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foulee.operators.changes import add_counts
from foulee.sinks.lake import merge_rows, write_table
from foulee.sources.lake import Lake, read_table, state_of

#: Ids are dealt over so many buckets. A batch rewrites the files that hold buckets it touches.
BUCKETS = 1024


def _bucketed(counts: DataFrame) -> DataFrame:
    bucket = F.pmod(F.xxhash64("id_salarie"), F.lit(BUCKETS)).cast("int")
    return counts.select(bucket.alias("seau"), "id_salarie", "nb_activites", "nb_lignes")


def merge_counts(spark: SparkSession, lake: Lake, table: str, changes: DataFrame, feed: str, batch_id: int) -> bool:
    """Add a batch's signed counts (``id_salarie, nb_activites, nb_lignes``) to the table; False if they are in it.

    The batch id is committed with the rows, so a batch that is replayed changes nothing, wherever it failed. Only
    files with buckets of the batch are read and written; the others stay as they are.
    """
    mark = f"lot:{feed}"
    state = state_of(spark, lake, table)
    if state.marks.get(mark, -1) >= batch_id:
        return False
    deltas = _bucketed(changes).persist()
    try:
        if state.schema is None:
            write_table(deltas.repartitionByRange("seau"), lake, table, track=["seau"], marks={mark: batch_id})
            return True
        merge_rows(
            spark, lake, table, deltas.select("seau").distinct(),
            lambda rows: _bucketed(add_counts(rows.unionByName(deltas))).repartitionByRange("seau"), marks={mark: batch_id},
        )
    finally:
        deltas.unpersist()
    return True


def read_counts(spark: SparkSession, lake: Lake, table: str) -> DataFrame:
    """The counts as ``activity_counts`` has them."""
    return read_table(spark, lake, table).select("id_salarie", "nb_activites", "nb_lignes")
