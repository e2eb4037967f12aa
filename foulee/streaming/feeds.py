"""Message feed, declaration feed and count feed.

The first two split every micro-batch into what is usable and what is not, and write the two next to each
other in one folder per batch id, with what was observed while writing: how many rows went where. A batch that is
replayed after a failure replaces its own folder, so the outbox holds each event once. Events that a connector sends
again in later batches are dropped by a state store of the rows announced, which a watermark bounds. What is handed on
is noted in a ledger, before and after.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from foulee.operators.cdc import MOTIFS, decode_events, normalised, rejects
from foulee.operators.changes import count_changes, decode_changes, event_key
from foulee.operators.declarations import accepted, as_activities, declaration_errors, refused
from foulee.operators.messages import event_messages
from foulee.session import remove_folders
from foulee.sinks.counts import merge_counts
from foulee.sinks.lake import write_table
from foulee.sources.journal import Journal
from foulee.sources.lake import Lake, find_table

Sink = Callable[[DataFrame, int], None]


@dataclass(frozen=True)
class Once:
    """Announce each activity once. ``time_col`` is the events' time; a row announced again within ``within`` of the
    first time is dropped, and so is an event that comes later than that after newer ones: state is kept no longer."""

    time_col: str
    within: str


def _write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/lot={batch_id}")


def _write_observed(df: DataFrame, path: str, batch_id: int, **counts: Column) -> dict[str, int]:
    """Writes a batch and tells what went by: all rows, and for each named condition the rows that meet it."""
    seen = Observation(f"lot {batch_id}")
    conditions = [F.count_if(condition).alias(name) for name, condition in counts.items()]
    _write_batch(df.observe(seen, F.count(F.lit(1)).alias("lignes"), *conditions), path, batch_id)
    return seen.get


def _write_measures(spark: SparkSession, path: str, batch_id: int, measures: dict[str, int]) -> None:
    rows = spark.createDataFrame(list(measures.items()), "mesure string, nombre long")
    _write_batch(rows.coalesce(1), f"{path}/mesures", batch_id)


def _first_times(decoded: DataFrame, announced: Column, own_id: str, once: Once) -> DataFrame:
    """A decoded stream without the events that announce a row again."""
    key = event_key(announced, F.col(own_id).cast("string"), F.col("value"), F.col(once.time_col))
    # An event without a time counts as one of the batch that brings it.
    moment = F.coalesce(F.col(once.time_col).cast("timestamp"), F.current_timestamp())
    keyed = decoded.withColumns({"_cle": key, "_moment": moment}).withWatermark("_moment", once.within)
    return keyed.dropDuplicatesWithinWatermark(["_cle"]).drop("_cle", "_moment")


class Ledger:
    """Which batches of a feed have been handed on. A batch is noted before it is handed on and after: one that is
    noted only before may or may not have arrived when the feed died, and is the only one that is handed on again."""

    def __init__(self, spark: SparkSession, outbox: str) -> None:
        self._journal = Journal(spark, f"{outbox}/livraisons")

    def state(self) -> dict:
        """``livre``, the last batch that arrived; ``commence``, one that may have; ``repetes``, those handed on again."""
        entries = self._journal.last()[1]
        return entries[0] if entries else {"livre": -1, "commence": None, "repetes": []}

    def deliver(self, batch_id: int, hand_on: Callable[[], None]) -> bool:
        """Hands a batch on unless it has arrived already."""
        number, entries = self._journal.last()
        state = entries[0] if entries else self.state()
        if batch_id <= state["livre"]:
            return False
        again = state["commence"] == batch_id
        repeated = [*state["repetes"], batch_id] if again and batch_id not in state["repetes"] else state["repetes"]
        number = self._journal.commit(number, [{**state, "commence": batch_id, "repetes": repeated}])
        hand_on()
        self._journal.commit(number, [{"livre": batch_id, "commence": None, "repetes": repeated}])
        return True


def _start(events: DataFrame, each: Sink, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    return (
        events.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )


def batch_messages(decoded: DataFrame, employees: DataFrame) -> DataFrame:
    """Messages of one decoded batch. ``employees`` has one row per id, as silver employees do; it is cut
    to the ids of the batch first, so a batch never sorts or groups the staff."""
    usable = normalised(decoded)
    ids = usable.select("id_salarie").distinct()
    names = employees.select("id_salarie", "prenom", "nom").join(ids, "id_salarie", "left_semi")
    return event_messages(usable, names, unique=True)


def start_message_feed(
    events: DataFrame,
    employees: Callable[[], DataFrame],
    outbox: str,
    checkpoint: str,
    trigger: dict | None = None,
    deliver: Sink | None = None,
    once: Once | None = None,
) -> StreamingQuery:
    """Turn a stream of change events (``value``) into messages.

    ``employees`` is called per micro-batch, so new names are picked up; it gives the written silver
    employees, one row per id. Messages go to
    ``outbox/messages``, unusable events to ``outbox/rejets``, how many of each to ``outbox/mesures``; ``deliver`` may
    hand the messages of a batch that has any on to a chat system, and ``outbox/livraisons`` says what arrived (``Ledger``). With
    ``once``, an activity that a connector announces again (a new snapshot) is announced the first time only. A broken
    event never stops the feed.
    """
    if once is not None:
        decoded_stream = decode_events(events, activity_id=True).filter(F.col("annonce") | F.col("motif").isNotNull())
        usable = F.col("annonce") & F.col("motif").isNull()
        events = _first_times(decoded_stream, usable, "id_activite", once).drop("id_activite")

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        decoded = (batch if once is not None else decode_events(batch)).persist()
        try:
            messages = _write_observed(batch_messages(decoded, employees()), f"{outbox}/messages", batch_id)
            by_motif = {motif: F.col("motif") == motif for motif in MOTIFS}
            refused = _write_observed(rejects(decoded), f"{outbox}/rejets", batch_id, **by_motif)
            measures = {"messages": messages["lignes"], "rejets": refused.pop("lignes")}
            _write_measures(spark, outbox, batch_id, measures | {f"rejets:{m}": n for m, n in refused.items()})
            if deliver is not None and measures["messages"]:
                path = f"{outbox}/messages/lot={batch_id}"
                Ledger(spark, outbox).deliver(batch_id, lambda: deliver(spark.read.parquet(path), batch_id))
        finally:
            decoded.unpersist()

    return _start(events, each, checkpoint, trigger)


def start_declaration_feed(
    declarations: DataFrame,
    limits: DataFrame,
    target: str,
    checkpoint: str,
    trigger: dict | None = None,
    speed_unit: str = "kmh",
) -> StreamingQuery:
    """Validate a stream of declarations: accepted ones become activity rows under
    ``target/activites``, refused ones keep their errors under ``target/refus``, how many of each are under
    ``target/mesures``."""

    def each(batch: DataFrame, batch_id: int) -> None:
        checked = declaration_errors(batch, limits, speed_unit).persist()
        try:
            taken = _write_observed(as_activities(accepted(checked)), f"{target}/activites", batch_id)
            left = _write_observed(refused(checked), f"{target}/refus", batch_id)
            measures = {"activites": taken["lignes"], "refus": left["lignes"]}
            _write_measures(batch.sparkSession, target, batch_id, measures)
        finally:
            checked.unpersist()

    return _start(declarations, each, checkpoint, trigger)


def start_count_feed(
    events: DataFrame,
    lake: Lake,
    table: str,
    checkpoint: str,
    feed: str,
    trigger: dict | None = None,
    once: Once | None = None,
) -> StreamingQuery:
    """Keep the activity counts of a lake table up to date from a stream of change events (``value``).

    ``feed`` names this stream in the table's marks: each of its batches is added once, replayed or not. Events that
    cannot be counted are left out (``decode_changes`` says why). ``once`` drops rows that a new snapshot brings again.
    """
    changes = decode_changes(events)
    if once is not None:
        changes = _first_times(changes, F.col("op").isin("c", "r") & F.col("motif").isNull(), "apres_id", once)

    def each(batch: DataFrame, batch_id: int) -> None:
        signed = count_changes(batch).persist()
        try:
            signed.count()  # a batch must be read even if it is in the table already, or its state is not kept
            merge_counts(batch.sparkSession, lake, table, signed, feed, batch_id)
        finally:
            signed.unpersist()

    return _start(changes, each, checkpoint, trigger)


def _archive(path: str) -> tuple[Lake, str]:
    root, name = path.rstrip("/").rsplit("/", 1)
    return Lake(root), f"{name}_archive"


def _recent(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn("lot", F.col("lot").cast("long"))


def read_outbox(spark: SparkSession, path: str) -> DataFrame:
    """Everything a feed has written to one of its folders, compacted or not."""
    archived = find_table(spark, *_archive(path))
    if archived is None:
        return _recent(spark, path)
    last = archived.agg(F.max("lot")).first()[0]
    # Folders of archived batches may still be there if the compaction was interrupted.
    try:
        recent = _recent(spark, path).filter(F.col("lot") > last)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return archived
    return archived.unionByName(recent)


def compact_outbox(spark: SparkSession, path: str, closed_before: int) -> None:
    """Move the batches below ``closed_before`` from their small folders to the archive table.

    A feed only ever replays its last batch, so batches before it are closed. The archive is written in one
    step and readers skip folders it covers: interrupted anywhere, nothing is lost or seen twice.
    """
    lake, table = _archive(path)
    archived = find_table(spark, lake, table)
    last = -1 if archived is None else archived.agg(F.max("lot")).first()[0]
    closed = _recent(spark, path).filter((F.col("lot") > last) & (F.col("lot") < closed_before))
    if not closed.isEmpty():
        write_table(closed, lake, table, mode="append")
    remove_folders(spark, f"{path}/lot=*", lambda name: int(name.removeprefix("lot=")) < closed_before)
